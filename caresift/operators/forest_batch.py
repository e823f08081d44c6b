"""Many forests grown side by side from counts of equal rows.

Features are cut into at most 256 bins: one for every value while there are no more, else by quantiles. Training rows that
fall into the same bins are one group with a count per class, so a survey of a few answers becomes a small table whatever its
size. A level of a tree needs the class counts per (open node, feature, bin) only; splits are chosen from those. Bootstrap
counts are drawn by hashes of (seed, tree, group): the same on any partitioning and in every pass.

While the groups are few they travel to the tasks, and the tasks divide the trees among them. Otherwise the groups stay where they
are: a pass over them brings a level's counts for a batch of trees, added up in tasks and in a tree of partial sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caresift.operators.logistic_batch import FAN_IN, _added
from caresift.session import materialize

MOST_BINS = 256
#: Bins of a feature in a kept forest, as in Spark ML.
KEPT_BINS = 32
#: Groups that travel to the tasks at most; counts that one pass brings for its open nodes; trees that one task grows in a row.
LOCAL_GROUPS, PASS_NUMBERS, TREES_PER_TASK = 100_000, 4_000_000, 16


@dataclass
class ForestJob:
    """One forest: bagged trees with the best cut of each feature, or whole-sample trees with a drawn cut."""

    trees: int = 100
    max_depth: int | None = None
    min_split: int = 2
    min_leaf: int = 1
    share: str | float | None = "sqrt"
    weights: tuple[float, float] = (1.0, 1.0)
    seed: int = 42
    drawn_cuts: bool = False
    #: Spark ML's rules: shares of features are rounded up, features that cannot split a node are drawn too, a split must gain.
    spark_rules: bool = False

    def features(self, width: int) -> int:
        """How many features a node looks at."""
        if self.share in (None, "none"):
            return width
        wanted = math.sqrt(width) if self.share == "sqrt" else math.log2(width) if self.share == "log2" else float(self.share) * width
        return min(width, max(1, math.ceil(wanted) if self.spark_rules else int(wanted)))


def _mixed(*parts) -> np.ndarray:
    """A 64-bit hash of whole numbers, element by element."""
    out = np.uint64(0x9E3779B97F4A7C15)
    for p in parts:
        with np.errstate(over="ignore"):
            out = (out ^ np.asarray(p).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            out = out ^ (out >> np.uint64(31))
    return out


def _uniform(*parts) -> np.ndarray:
    return (_mixed(*parts) >> np.uint64(11)).astype(float) / (1 << 53)


def bootstrap(job: ForestJob, tree: int, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often the rows of every group are drawn into a tree, per class: a Poisson number with the group's count as its mean."""
    if job.drawn_cuts:
        return counts.astype(float)
    u = np.stack([_uniform(job.seed, tree, keys.view(np.uint64), c) for c in (0, 1)], axis=1)
    out = np.zeros(counts.shape)
    few = counts <= 32
    mean, draw = counts[few].astype(float), u[few]
    term = np.exp(-mean)
    below, found = term.copy(), np.zeros(len(mean))
    for k in range(1, 128):
        open_ = draw > below
        if not open_.any():
            break
        found += open_
        term = term * mean / k
        below = below + term
    out[few] = found
    mean = counts[~few].astype(float)
    other = np.stack([_uniform(job.seed, tree, keys.view(np.uint64), c) for c in (2, 3)], axis=1)
    normal = np.sqrt(-2 * np.log(np.maximum(u, 1e-300))) * np.cos(2 * np.pi * other)
    out[~few] = np.maximum(0, np.rint(mean + np.sqrt(mean) * normal[~few]))
    return out


@dataclass
class Tree:
    """A tree under growth: nodes as arrays, children of a node side by side."""

    job: ForestJob
    number: int
    feature: np.ndarray = field(default_factory=lambda: np.full(1, -1))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(1, int))
    left: np.ndarray = field(default_factory=lambda: np.zeros(1, int))
    share: np.ndarray = field(default_factory=lambda: np.full(1, 0.5))
    gain: np.ndarray = field(default_factory=lambda: np.zeros(1))
    open: np.ndarray = field(default_factory=lambda: np.zeros(1, int))
    depth: int = 0

    def step(self, bins: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Rows in a node that was split go on to its children."""
        split = self.feature[node]
        goes = bins[np.arange(len(node)), np.maximum(split, 0)] > self.cut[node]
        return np.where(split >= 0, self.left[node] + goes, node)

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        node = np.zeros(len(bins), int)
        for _ in range(self.depth):
            node = self.step(bins, node)
        return node

    def counts(self, bins: np.ndarray, node: np.ndarray, drawn: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(open node, bin of any feature, class): the drawn rows, feature after feature from ``first`` on."""
        place = np.full(len(self.feature), -1)
        place[self.open] = np.arange(len(self.open))
        at = place[node]
        rows = np.flatnonzero(at >= 0)
        cells = (at[rows, None] * first[-1] + first[:-1] + bins[rows]).ravel()
        size = len(self.open) * int(first[-1])
        each = np.repeat(drawn[rows], bins.shape[1], axis=0)
        return np.stack([np.bincount(cells, each[:, c], minlength=size) for c in (0, 1)], axis=1).reshape(len(self.open), -1, 2)

    def advance(self, counts: np.ndarray, first: np.ndarray, values: Sequence[np.ndarray]) -> None:
        """Splits the open nodes by their counts; their children are open next."""
        job, width = self.job, len(values)
        weight = np.array(job.weights)
        total = counts[:, : first[1]].sum(axis=1)
        heavy = total * weight
        mass = heavy.sum(axis=1)
        self.share[self.open] = np.where(mass > 0, heavy[:, 1] / np.where(mass > 0, mass, 1), 0.5)
        deep = job.max_depth is not None and self.depth >= job.max_depth
        able = (total.sum(axis=1) >= job.min_split) & (total > 0).all(axis=1) & (not deep)
        gain, cut = np.full((len(self.open), width), -np.inf), np.zeros((len(self.open), width), int)
        for j in range(width):
            block = counts[:, first[j] : first[j + 1]]
            if block.shape[1] < 2:
                continue
            below = block.cumsum(axis=1)[:, :-1]
            above = total[:, None] - below
            low, high = below * weight, above * weight
            with np.errstate(divide="ignore", invalid="ignore"):
                score = (low**2).sum(2) / low.sum(2) + (high**2).sum(2) / high.sum(2)
            fits = (below.sum(2) >= max(1, job.min_leaf)) & (above.sum(2) >= max(1, job.min_leaf))
            if job.drawn_cuts:
                fits &= np.arange(block.shape[1] - 1) == self._drawn(block.sum(2) > 0, values[j], j)[:, None]
            score = np.where(fits, score, -np.inf)
            cut[:, j] = score.argmax(axis=1)
            gain[:, j] = score[np.arange(len(score)), cut[:, j]]
        draw = _uniform(job.seed, self.number, self.open[:, None], 3 + np.arange(width)[None, :])
        if job.spark_rules:
            whole = (heavy**2).sum(axis=1) / np.where(mass > 0, mass, 1)
            gain = np.where(gain > (whole + 1e-12 * mass)[:, None], gain, -np.inf)
        else:
            # features that cannot split a node come last in its draw
            draw = draw + 2.0 * ~np.isfinite(gain)
        rank = draw.argsort(axis=1).argsort(axis=1)
        gain = np.where(rank < job.features(width), gain, -np.inf)
        best = gain.argmax(axis=1)
        split = np.flatnonzero(able & np.isfinite(gain[np.arange(len(best)), best]))
        nodes = self.open[split]
        self.feature[nodes], self.cut[nodes] = best[split], cut[split, best[split]]
        whole = (heavy[split] ** 2).sum(axis=1) / mass[split]
        self.gain[nodes] = np.maximum(0.0, gain[split, best[split]] - whole)
        self.left[nodes] = len(self.feature) + 2 * np.arange(len(split))
        grown = 2 * len(split)
        self.open = len(self.feature) + np.arange(grown)
        self.feature = np.append(self.feature, np.full(grown, -1))
        self.cut, self.left = (np.append(x, np.zeros(grown, int)) for x in (self.cut, self.left))
        self.share, self.gain = np.append(self.share, np.full(grown, 0.5)), np.append(self.gain, np.zeros(grown))
        self.depth += 1 if grown else 0

    def prune(self) -> None:
        """Leaves side by side that decide the same become one, from the bottom up, as in a Spark ML tree."""
        for node in range(len(self.feature) - 1, -1, -1):
            a = self.left[node]
            if self.feature[node] >= 0 and self.feature[a] < 0 and self.feature[a + 1] < 0:
                if (self.share[a] > 0.5) == (self.share[a + 1] > 0.5):
                    self.feature[node], self.gain[node] = -1, 0.0

    def _drawn(self, full: np.ndarray, values: np.ndarray, j: int) -> np.ndarray:
        """For every open node a cut between its least and its largest value of feature ``j``."""
        low = values[full.argmax(axis=1)]
        high = values[full.shape[1] - 1 - full[:, ::-1].argmax(axis=1)]
        at = low + _uniform(self.job.seed, self.number, self.open, 1_000_003 + j) * (high - low)
        return np.searchsorted(values, at, side="right") - 1


def grow(job: ForestJob, number: int, bins: np.ndarray, keys: np.ndarray, counts: np.ndarray, first: np.ndarray, values) -> Tree:
    """One tree from all groups."""
    tree, node = Tree(job, number), np.zeros(len(bins), int)
    drawn = bootstrap(job, number, keys, counts)
    while len(tree.open):
        tree.advance(tree.counts(bins, node, drawn, first), first, values)
        node = tree.step(bins, node)
    return tree


def bin_edges(rows: DataFrame, vector: str, count: str | None = None) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(edges, values) of every feature: a value up to edge i, and above the one before, is in bin i.

    ``count`` tells how many rows a row stands for.
    """
    import pyarrow as pa

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, set] = {}
        for batch in batches:
            x = _rows_of(batch.column(0))
            for j in range(x.shape[1]):
                if len(held.setdefault(j, set())) <= MOST_BINS:
                    held[j].update(np.unique(x[:, j])[: MOST_BINS + 1].tolist())
        for j, found in held.items():
            some = sorted(found)[: MOST_BINS + 1]
            yield pa.RecordBatch.from_arrays([pa.array([j] * len(some), pa.int32()), pa.array(some, pa.float64())], names=["j", "v"])

    plain = rows.select(F.col(vector).cast("array<double>").alias("x"))
    found = materialize(plain.mapInArrow(work, "j int, v double").filter(~F.isnan("v")).distinct(), "feature-values")
    sizes = {r["j"]: r["n"] for r in found.groupBy("j").agg(F.count("*").alias("n")).collect()}
    wide = sorted(j for j, n in sizes.items() if n > MOST_BINS)
    few: dict[int, list[float]] = {}
    for r in found.filter(~F.col("j").isin(wide)).collect():
        few.setdefault(r["j"], []).append(r["v"])
    edges, values = [], []
    share = [i / MOST_BINS for i in range(1, MOST_BINS)]
    each = plain if count is None else rows.select(F.col(vector).cast("array<double>").alias("x"), F.explode(F.sequence(F.lit(1), count)))
    cuts = each.select(*[F.col("x")[j].alias(f"x{j}") for j in wide]).approxQuantile([f"x{j}" for j in wide], share, 0.2 / MOST_BINS) if wide else []
    for j in range(max(sizes, default=-1) + 1):
        if j in wide:
            cut = np.unique(np.array(cuts[wide.index(j)]))
            edges.append(cut)
            values.append(np.append(cut, cut[-1] + 1e-9 + abs(cut[-1]) * 1e-9))
        else:
            own = np.array(sorted(few.get(j, [0.0])))
            edges.append((own[1:] + own[:-1]) / 2)
            values.append(own)
    return edges, values


def _rows_of(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def grouped(rows: DataFrame, vector: str, edges: Sequence[np.ndarray], *by: str, count: str | None = None) -> DataFrame:
    """(bins, n) and the columns ``by`` of the groups of rows in the same bins; one byte a feature. Stored."""
    import pyarrow as pa

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows_of(batch.column(0))
            coded = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.uint8)
            texts = pa.array([r.tobytes() for r in coded], pa.binary())
            yield pa.RecordBatch.from_arrays([texts, *(batch.column(k) for k in range(1, batch.num_columns))], names=["bins", *by, "each"])

    kinds = dict(rows.dtypes)
    schema = "bins binary" + "".join(f", {c} {kinds[c]}" for c in by) + ", each long"
    each = F.col(count).cast("long") if count else F.lit(1).cast("long")
    plain = rows.select(F.col(vector).cast("array<double>").alias("x"), *by, each.alias("each"))
    return materialize(plain.mapInArrow(work, schema).groupBy("bins", *by).agg(F.sum("each").alias("n")), "groups")


def training_groups(rows: DataFrame, label: str, vector: str, edges: Sequence[np.ndarray], count: str | None = None) -> DataFrame:
    """(bins, key, n0, n1) of the training rows. Stored."""
    counts = [F.sum(F.when(F.col(label) == y, F.col("n")).otherwise(0)).alias(f"n{y}") for y in (0, 1)]
    found = grouped(rows.filter(F.col(label).isNotNull()), vector, edges, label, count=count).groupBy("bins").agg(*counts)
    return materialize(found.select("bins", F.xxhash64("bins").alias("key"), "n0", "n1"), "training-groups")


def _arrays(table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins, keys, counts) of an Arrow table or batch (bins, key, n0, n1)."""
    texts = table.column(0).to_pylist()
    bins = np.frombuffer(b"".join(texts), np.uint8).reshape(len(texts), -1).astype(np.int64)
    key, n0, n1 = (np.asarray(table.column(k).to_numpy()) for k in (1, 2, 3))
    return bins, key, np.stack([n0, n1], axis=1)


def first_bins(values: Sequence[np.ndarray]) -> np.ndarray:
    return np.append(0, np.cumsum([len(v) for v in values]))


def grow_by_passes(groups: DataFrame, jobs: Sequence[tuple[ForestJob, int]], values: Sequence[np.ndarray]) -> list[Tree]:
    """Trees of groups of any number: a pass brings the counts of as many open nodes as PASS_NUMBERS allows."""
    import pyarrow as pa

    first = first_bins(values)
    trees = [Tree(job, number) for job, number in jobs]
    while any(len(t.open) for t in trees):
        part, held = [], 0
        for t in trees:
            size = len(t.open) * 2 * int(first[-1])
            if size and (not part or held + size <= PASS_NUMBERS):
                part.append(t)
                held += size

        def work(batches: Iterator[pa.RecordBatch], part=part) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if batch.num_rows:
                    bins, keys, counts = _arrays(batch)
                    one = [t.counts(bins, t.leaf_of(bins), bootstrap(t.job, t.number, keys, counts), first).ravel() for t in part]
                    total = np.concatenate(one) if total is None else total + np.concatenate(one)
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        sums = groups.select("bins", "key", "n0", "n1").mapInArrow(work, "sums binary")
        tasks = sums.rdd.getNumPartitions()
        while tasks > FAN_IN:
            tasks = math.ceil(tasks / FAN_IN)
            sums = _added(sums.repartition(tasks))
        total, at = sum(np.frombuffer(r["sums"]) for r in sums.collect()), 0
        for t in part:
            size = len(t.open) * 2 * int(first[-1])
            t.advance(total[at : at + size].reshape(len(t.open), -1, 2), first, values)
            at += size
    return trees


CELLS = "cand long, grp string, tp long, fp long, fn long, tn long"


def _cells(cand: int, hit: np.ndarray, y: np.ndarray, grp: list, n: np.ndarray):
    """Arrow rows (cand, grp, tp, fp, fn, tn) of decisions on groups of rows."""
    import pyarrow as pa

    coded = pa.array(grp, pa.string()).dictionary_encode(null_encoding="encode")
    names, place = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    sums = [np.bincount(place, n * ((y == t) & (hit == h)), minlength=len(names)).astype(np.int64) for t, h in ((1, True), (0, True), (1, False), (0, False))]
    columns = [pa.array([cand] * len(names), pa.int64()), pa.array(names, pa.string()), *map(pa.array, sums)]
    return pa.RecordBatch.from_arrays(columns, names=["cand", "grp", "tp", "fp", "fn", "tn"])


def confusion_cells(
    train: DataFrame, test: DataFrame, label: str, vector: str, group: str, jobs: Sequence[tuple[int, ForestJob]], threshold: float, count: str | None = None
) -> DataFrame:
    """(cand, grp, tp, fp, fn, tn) of the forests (cand, job), fitted on ``train``, on the rows of ``test``.

    ``count`` tells how many rows a row of either table stands for.
    """
    import pyarrow as pa

    edges, values = bin_edges(train, vector, count)
    if not values:
        raise ValueError("no training rows")
    groups = training_groups(train, label, vector, edges, count)
    kept = [F.col(label).cast("int").alias("y"), F.col(group).cast("string").alias("grp"), *([count] if count else [])]
    asked = grouped(test.filter(F.col(label).isNotNull()).select(vector, *kept), vector, edges, "y", "grp", count=count)
    first = first_bins(values)
    if max(groups.count(), asked.count()) > LOCAL_GROUPS:
        return _cells_by_passes(groups, asked, jobs, values, threshold)
    bins, keys, counts = _arrays(groups.toArrow())
    table = asked.toArrow()
    texts = table.column("bins").to_pylist()
    others = np.frombuffer(b"".join(texts), np.uint8).reshape(len(texts), -1).astype(np.int64)
    y, n, grp = table.column("y").to_numpy(), table.column("n").to_numpy(), table.column("grp").to_pylist()
    by_cand = dict(jobs)
    tasks = [(c, a, min(job.trees, a + TREES_PER_TASK)) for c, job in jobs for a in range(0, job.trees, TREES_PER_TASK)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cand, a, b in zip(*(batch.column(k).to_pylist() for k in range(3))):
                total = np.zeros(len(others))
                for number in range(a, b):
                    tree = grow(by_cand[cand], number, bins, keys, counts, first, values)
                    total += tree.share[tree.leaf_of(others)]
                yield pa.RecordBatch.from_arrays([pa.array([cand]), pa.array([total.tobytes()], pa.binary())], names=["cand", "sums"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None
        for batch in batches:
            for cand, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if cand != held and held is not None:
                    yield _cells(held, total / by_cand[held].trees >= threshold - 1e-12, y, grp, n)
                total = np.frombuffer(sums) + (total if cand == held else 0)
                held = cand
        if held is not None:
            yield _cells(held, total / by_cand[held].trees >= threshold - 1e-12, y, grp, n)

    spark = train.sparkSession
    dealt = spark.createDataFrame(tasks, "cand long, a int, b int").repartition(min(len(tasks), 4 * spark.sparkContext.defaultParallelism))
    grown = dealt.mapInArrow(work, "cand long, sums binary").repartition("cand").sortWithinPartitions("cand")
    found = grown.mapInArrow(judge, CELLS)
    return found.groupBy("cand", "grp").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])


def _cells_by_passes(groups: DataFrame, asked: DataFrame, jobs: Sequence[tuple[int, ForestJob]], values, threshold: float) -> DataFrame:
    """The same for groups of any number, one forest after the other."""
    import pyarrow as pa

    found = None
    for cand, job in jobs:
        trees = grow_by_passes(groups, [(job, k) for k in range(job.trees)], values)

        def judge(batches: Iterator[pa.RecordBatch], cand=cand, trees=trees) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    texts = batch.column(0).to_pylist()
                    bins = np.frombuffer(b"".join(texts), np.uint8).reshape(len(texts), -1).astype(np.int64)
                    share = sum(t.share[t.leaf_of(bins)] for t in trees) / len(trees)
                    y, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 3))
                    yield _cells(cand, share >= threshold - 1e-12, y, batch.column(2).to_pylist(), n)

        part = asked.select("bins", "y", "grp", "n").mapInArrow(judge, CELLS)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("cand", "grp").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])


@dataclass
class KeptForest:
    """A grown forest that scores rows, tells its importances and can be stored."""

    edges: list[np.ndarray]
    trees: list[Tree]

    @property
    def numFeatures(self) -> int:
        return len(self.edges)

    @property
    def featureImportances(self) -> DenseVector:
        """Weighted impurity that the splits by a feature take away, each tree's sum being one, then the forest's."""
        total = np.zeros(self.numFeatures)
        for t in self.trees:
            own = np.bincount(np.maximum(t.feature, 0), np.where(t.feature >= 0, t.gain, 0.0), minlength=self.numFeatures)
            total += own / own.sum() if own.sum() > 0 else 0.0
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def probability(self, features: str) -> Column:
        """Share of the positive class in the leaves that a row's feature vector falls into."""
        edges, trees = self.edges, self.trees

        def work(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype=float)
            x = np.stack(vectors.to_numpy()).astype(float)
            coded = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
            bins, place = np.unique(coded, axis=0, return_inverse=True)
            share = sum(t.share[t.leaf_of(bins)] for t in trees) / len(trees)
            return pd.Series(share[place.ravel()])

        return F.pandas_udf(work, "double")(vector_to_array(F.col(features)))

    def leaf_paths(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(low, high, value) of every leaf: a row gets to it if low < x <= high in every feature."""
        width = self.numFeatures
        lows, highs, values = [], [], []
        for t in self.trees:
            todo = [(0, np.full(width, -np.inf), np.full(width, np.inf))]
            while todo:
                node, low, high = todo.pop()
                j = t.feature[node]
                if j < 0:
                    lows.append(low)
                    highs.append(high)
                    values.append(t.share[node] / len(self.trees))
                    continue
                edge, below, above = self.edges[j][t.cut[node]], high.copy(), low.copy()
                below[j], above[j] = min(high[j], edge), max(low[j], edge)
                todo += [(t.left[node], low, below), (t.left[node] + 1, above, high)]
        return np.array(lows).reshape(-1, width), np.array(highs).reshape(-1, width), np.array(values)

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        rows = [(t.number, t.depth, *[getattr(t, c).tolist() for c in _TREE_ARRAYS]) for t in self.trees]
        arrays = ", ".join(f"{c} array<{k}>" for c, k in _TREE_ARRAYS.items())
        spark.createDataFrame(rows, f"number int, depth int, {arrays}").write.mode("overwrite").parquet(f"{path}/trees")
        edges = [(j, e.tolist()) for j, e in enumerate(self.edges)]
        spark.createDataFrame(edges, "j int, edges array<double>").write.mode("overwrite").parquet(f"{path}/edges")

    @classmethod
    def load(cls, path: str) -> KeptForest:
        spark = SparkSession.active()
        edges = [np.array(r["edges"]) for r in spark.read.parquet(f"{path}/edges").orderBy("j").collect()]
        trees = []
        for r in spark.read.parquet(f"{path}/trees").orderBy("number").collect():
            arrays = {c: np.array(r[c], int if k == "int" else float) for c, k in _TREE_ARRAYS.items()}
            trees.append(Tree(ForestJob(), r["number"], depth=r["depth"], open=np.zeros(0, int), **arrays))
        return cls(edges, trees)


_TREE_ARRAYS = {"feature": "int", "cut": "int", "left": "int", "share": "double", "gain": "double"}


def _even_cuts(weight: np.ndarray) -> np.ndarray:
    """The places after which values are cut into at most KEPT_BINS bins of about equal weight."""
    held = np.flatnonzero(weight > 0)
    upto, stride = weight[held].cumsum(), weight.sum() / KEPT_BINS
    chosen, target = [], stride
    for i in range(1, len(held)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            chosen.append(held[i - 1])
            target += stride
    return np.array(chosen, int)


def kept_forest(train: DataFrame, label: str, vector: str, job: ForestJob, count: str | None = None) -> KeptForest | None:
    """The forest of a job; None while the training rows are no small number of groups.

    The groups travel to the tasks and the tasks divide the trees; trees come back, as a forest is as large as its model.
    """
    import pyarrow as pa

    edges, values = bin_edges(train, vector, count)
    if not values:
        raise ValueError("no training rows")
    groups = training_groups(train, label, vector, edges, count)
    if groups.count() > LOCAL_GROUPS:
        return None
    bins, keys, counts = _arrays(groups.orderBy("bins").toArrow())
    for j in range(len(edges)):
        if len(values[j]) > KEPT_BINS:
            chosen = _even_cuts(np.bincount(bins[:, j], counts @ np.array(job.weights), minlength=len(values[j])))
            edges[j], bins[:, j] = edges[j][chosen], np.searchsorted(chosen, bins[:, j], side="left")
            values[j] = np.arange(len(chosen) + 1.0)
    first = first_bins(values)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                tree = grow(job, number, bins, keys, counts, first, values)
                tree.prune()
                columns = [pa.array([number], pa.int32()), pa.array([tree.depth], pa.int32())]
                columns += [pa.array([getattr(tree, c).astype("<f8").tobytes()], pa.binary()) for c in _TREE_ARRAYS]
                yield pa.RecordBatch.from_arrays(columns, names=["number", "depth", *_TREE_ARRAYS])

    spark = train.sparkSession
    numbers = spark.range(job.trees).select(F.col("id").cast("int").alias("number"))
    dealt = numbers.repartition(min(job.trees, 4 * spark.sparkContext.defaultParallelism))
    schema = "number int, depth int, " + ", ".join(f"{c} binary" for c in _TREE_ARRAYS)
    trees = []
    for r in sorted(dealt.mapInArrow(work, schema).collect(), key=lambda r: r["number"]):
        arrays = {c: np.frombuffer(r[c]).astype(int if k == "int" else float) for c, k in _TREE_ARRAYS.items()}
        trees.append(Tree(job, r["number"], depth=r["depth"], open=np.zeros(0, int), **arrays))
    return KeptForest(edges, trees)
