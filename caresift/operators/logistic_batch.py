"""Many logistic regressions fitted side by side: one pass over the rows serves an iteration of all of them.

A pass takes the coefficients of every open candidate to the rows and brings back, per candidate, the loss, its gradient and its
curvature, added up in tasks and then in a tree, so the driver meets a bounded number of partial sums however many tasks
there are. The driver makes one Newton step a candidate: solved directly for a squared penalty, by coordinate
descent and direct solutions on the quadratic model for an absolute one. A step that did not lower the objective is halved.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Widest feature vector whose curvature is kept; Spark ML fits wider ones, one candidate at a time.
MOST_WIDTH = 200
#: Numbers of partial sums that one task holds for all its candidates; more candidates take more passes.
HELD_NUMBERS = 4_000_000
#: Partial sums that one task adds up, and that the driver takes in.
FAN_IN = 64
#: An iteration that changes the objective by less than this share ends a fit.
TOLERANCE = 1e-12


@dataclass
class LogisticJob:
    """One candidate: its penalty, the weights of the classes 0 and 1, and where its fit stands."""

    penalty: str
    strength: float
    weights: tuple[float, float]
    max_iter: int
    coef: np.ndarray = field(default_factory=lambda: np.zeros(0))
    accepted: np.ndarray = field(default_factory=lambda: np.zeros(0))
    step: np.ndarray | None = None
    mass: float = 1.0
    best: float = math.inf
    rounds: int = 0
    done: bool = False

    def objective(self, loss: float, at: np.ndarray) -> float:
        inner = at[:-1]
        return loss + self.strength * (np.abs(inner).sum() if self.penalty == "l1" else 0.5 * (inner @ inner))

    def advance(self, loss: float, slope: np.ndarray, curve: np.ndarray) -> None:
        """Judges the step under trial by its loss, then takes the next one; ``coef`` is always where the next pass looks."""
        now = self.objective(loss, self.coef)
        if not math.isfinite(now) or now > self.best + 1e-15:
            if self.step is None:
                raise ArithmeticError("the loss is not finite")
            self.step = self.step / 2
            self.done = np.abs(self.step).max() < 1e-10
            self.coef = self.accepted + (0 if self.done else self.step)
            return
        settled = self.best - now <= TOLERANCE * max(1.0, abs(now))
        self.best, self.accepted = now, self.coef
        self.rounds += 1
        if settled or self.rounds > self.max_iter:
            self.done = True
            return
        self.step = self._newton(slope, curve)
        self.coef = self.accepted + self.step

    def _newton(self, slope: np.ndarray, curve: np.ndarray) -> np.ndarray:
        free = np.ones(len(slope))
        free[-1] = 0.0
        if self.penalty != "l1":
            pull = self.strength * free
            return np.linalg.lstsq(curve + np.diag(pull), -(slope + pull * self.coef), rcond=1e-13)[0]
        return _lasso_step(self.coef, slope, curve + 1e-10 * np.trace(curve) / len(slope) * np.eye(len(slope)), self.strength * free)


def _lasso_step(at: np.ndarray, slope: np.ndarray, curve: np.ndarray, pull: np.ndarray) -> np.ndarray:
    """The step s that minimises slope·s + s·curve·s/2 + pull·|at + s|.

    Rounds of coordinate descent find the signs; between them the minimum for the signs at hand is solved for directly and
    gone to, or up to where the first sign would turn. Descent alone creeps where columns add up to a constant.
    """
    end, drift = at.copy(), slope.copy()
    for _ in range(1000):
        largest = 0.0
        for j in range(len(at)):
            if curve[j, j] <= 0:
                continue
            wanted = end[j] - drift[j] / curve[j, j]
            moved = math.copysign(max(abs(wanted) - pull[j] / curve[j, j], 0.0), wanted) - end[j]
            if moved:
                end[j] += moved
                drift += moved * curve[:, j]
                largest = max(largest, abs(moved))
        if largest < 1e-12:
            break
        free = np.flatnonzero(((end != 0) | (pull == 0)) & (np.diag(curve) > 0))
        way = np.linalg.lstsq(curve[np.ix_(free, free)], -(drift + pull * np.sign(end))[free], rcond=None)[0]
        turning = (pull[free] > 0) & (end[free] * way < 0)
        until = np.where(turning, -end[free] / np.where(turning, way, 1.0), np.inf)
        share = min(1.0, until.min(initial=np.inf))
        end[free] += share * way
        end[free[until <= share]] = 0.0
        drift = slope + curve @ (end - at)
    return end - at


def _matrix(column) -> np.ndarray:
    """The rows of an Arrow list column, with a last feature of ones for the intercept."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    rows = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
    return np.hstack([rows, np.ones((len(rows), 1))])


def _partial_sums(rows: DataFrame, coefs: np.ndarray, weights: np.ndarray) -> DataFrame:
    """One row a task: loss, gradient and curvature of every candidate over the task's rows, as bytes of doubles."""
    import pyarrow as pa

    many, wide = coefs.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((many, 1 + wide + wide * wide))
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
            x = _matrix(batch.column(1))
            if not len(y):
                continue
            weight = np.where(y[:, None] == 1, weights[:, 1], weights[:, 0]) * batch.column(2).to_numpy(zero_copy_only=False)[:, None]
            z = x @ coefs.T
            total[:, 0] += (weight * (np.logaddexp(0.0, z) - y[:, None] * z)).sum(axis=0)
            p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
            total[:, 1 : 1 + wide] += (weight * (p - y[:, None])).T @ x
            bend = weight * p * (1 - p)
            for k in range(many):
                total[k, 1 + wide :] += ((x * bend[:, k : k + 1]).T @ x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return rows.mapInArrow(work, "sums binary")


def _added(sums: DataFrame) -> DataFrame:
    """One row a task of the sum of its rows."""
    import pyarrow as pa

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0):
                part = np.frombuffer(value.as_py())
                total = part.copy() if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return sums.mapInArrow(work, "sums binary")


def fit_all(rows: DataFrame, label: str, vector: str, jobs: Sequence[LogisticJob], count: str | None = None) -> None:
    """Fits every job in place; ``rows`` should be a stored table, as every iteration reads it once.

    ``count`` tells how many rows a row stands for.

    The objective of a job is the weighted mean log loss plus ``strength`` times the penalty of all coefficients but the
    intercept, the last one. Null labels teach nothing.
    """
    each = F.col(count).cast("double") if count else F.lit(1.0)
    usable = rows.where(F.col(label).isNotNull()).select(
        F.col(label).cast("int").alias("y"), F.col(vector).cast("array<double>").alias("x"), each.alias("each")
    )
    sizes = [F.coalesce(F.sum(F.when(F.col("y") == y, F.col("each"))), F.lit(0.0)).alias(f"n{y}") for y in (0, 1)]
    facts = usable.agg(*sizes, F.max(F.size("x")).alias("wide")).first()
    if not facts["n0"] + facts["n1"]:
        raise ValueError("no training rows")
    wide = facts["wide"] + 1
    for job in jobs:
        job.coef = np.zeros(wide)
        job.mass = job.weights[0] * facts["n0"] + job.weights[1] * facts["n1"]
    at_once = max(1, HELD_NUMBERS // (1 + wide + wide * wide))
    for first in range(0, len(jobs), at_once):
        part = list(jobs[first : first + at_once])
        while open_ := [j for j in part if not j.done]:
            coefs, weights = np.stack([j.coef for j in open_]), np.array([j.weights for j in open_])
            sums = _partial_sums(usable, coefs, weights)
            tasks = sums.rdd.getNumPartitions()
            while tasks > FAN_IN:
                tasks = math.ceil(tasks / FAN_IN)
                sums = _added(sums.repartition(tasks))
            total = sum(np.frombuffer(r["sums"]) for r in sums.collect()).reshape(len(open_), -1)
            for job, row in zip(open_, total / np.array([[j.mass] for j in open_])):
                job.advance(row[0], row[1 : 1 + wide], row[1 + wide :].reshape(wide, wide))


def confusion_cells(rows: DataFrame, label: str, vector: str, group: str, coefs: np.ndarray, threshold: float, count: str | None = None) -> DataFrame:
    """(cand, grp, tp, fp, fn, tn) of many linear models in one pass; a model is a row of ``coefs``, the intercept last.

    ``count`` tells how many rows a row stands for.

    Counts are made in tasks, so the candidates do not multiply the rows.
    """
    import pyarrow as pa

    many = len(coefs)
    edge = math.log(threshold / (1 - threshold))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column(2).dictionary_encode(null_encoding="encode")
            names, place = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
            y, each = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 3))
            each = each[:, None]
            hit = _matrix(batch.column(1)) @ coefs.T >= edge
            cells = []
            for truth in (1, 0):
                for said in (True, False):
                    chosen = ((y == truth)[:, None] & (hit == said)) * each
                    cells.append(np.stack([np.bincount(place, chosen[:, k], minlength=len(names)) for k in range(many)]))
            tp, fn, fp, tn = (c.astype(np.int64).ravel() for c in cells)
            cand = np.repeat(np.arange(many), len(names))
            columns = [pa.array(cand), pa.array(names * many, pa.string()), *map(pa.array, (tp, fp, fn, tn))]
            yield pa.RecordBatch.from_arrays(columns, names=["cand", "grp", "tp", "fp", "fn", "tn"])

    each = (F.col(count).cast("double") if count else F.lit(1.0)).alias("each")
    plain = rows.select(F.col(label).cast("int").alias("y"), F.col(vector).cast("array<double>").alias("x"), F.col(group).cast("string").alias("g"), each)
    found = plain.where("y IS NOT NULL").mapInArrow(work, "cand long, grp string, tp long, fp long, fn long, tn long")
    return found.groupBy("cand", "grp").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])
