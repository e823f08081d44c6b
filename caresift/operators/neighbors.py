"""Exact k-nearest-neighbour vote as a partitioned join.

Both sides are assigned to the nearest of some pivot vectors, more of them the more
training rows there are. A first round looks in a query's own cell and gives it a k-th
distance. Distances to the pivots bound the distance to every other cell, so a second
round visits only cells that can still hold a nearer neighbour (pivot-based kNN join,
Lu et al., PVLDB 2012). Cells are cut into blocks of bounded size on both sides, so no cell,
however full, ends up in one task, and each block gives at most k rows per query.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caresift.functions.draws import hashed
from caresift.session import materialize

BLOCK_ROWS = 2048
#: Training rows a pivot's cell is meant to hold, and the fewest and most pivots. Beyond the most, cells grow and are cut into more blocks.
CELL_ROWS, LEAST_PIVOTS, MOST_PIVOTS = 8192, 16, 4096


def _kernels():
    """Distance helpers as local functions, so that they travel to the workers with the task."""

    def distances(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
        diff = a[:, None, :] - b[None, :, :]
        return np.abs(diff).sum(axis=2) if p == 1 else np.sqrt((diff * diff).sum(axis=2))

    def matrix(series: pd.Series, width: int) -> np.ndarray:
        if not len(series):
            return np.empty((0, width))
        return np.stack(series.to_numpy()).astype(np.float64)

    return distances, matrix


def _closest_of():
    """The search inside a block, as a local function like the above."""

    def closest(asked: np.ndarray, b: np.ndarray, k: int, p: int, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, distance) of the ``k`` nearest rows of every query, not beyond its limit; of equal ones the first rows.

        Fast distances with a known error leave a few rows a query, whose distances are then taken exactly.
        """
        width = max(1, b.shape[1])
        scale = max(np.abs(asked).max(initial=0.0), np.abs(b).max(initial=0.0))
        rough = np.float32 if scale < 1e15 else np.float64
        if p == 1:
            slack = 4e-7 * width * (width + 4) * scale
            queries, columns = asked.astype(rough), np.ascontiguousarray(b.astype(rough).T)
            buffer = np.empty((min(32, len(asked)), len(b)), rough)
        else:
            slack = 1e-14 * width * (width + 4) * scale * scale
            norms = (b * b).sum(axis=1)
        found = []
        for start in range(0, len(asked), 32):
            part = asked[start : start + 32]
            if p == 1:
                near, step = np.zeros((len(part), len(b)), rough), buffer[: len(part)]
                for j in range(b.shape[1]):
                    np.subtract(queries[start : start + 32, j, None], columns[j], out=step)
                    np.abs(step, out=step)
                    near += step
                most = limits[start : start + 32]
            else:
                near = (part * part).sum(axis=1)[:, None] + norms - 2.0 * (part @ b.T)
                most = limits[start : start + 32] ** 2 * (1 + 1e-9)
            if k < len(b):
                most = np.minimum(most, np.partition(near, k - 1, axis=1)[:, k - 1])
            # a distance that is no number is never left out here
            q, n = np.nonzero(~(near > (most + 2 * slack)[:, None]))
            diff = part[q] - b[n]
            d = np.abs(diff).sum(axis=1) if p == 1 else np.sqrt((diff * diff).sum(axis=1))
            order = np.lexsort((n, d, q))
            q, n, d = q[order], n[order], d[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            kept = (rank < k) & ~(d > limits[start + q])
            found.append((start + q[kept], n[kept], d[kept]))
        return tuple(np.concatenate(x) for x in zip(*found))

    return closest


def _pivot_points(base: DataFrame, pivots: int | None) -> np.ndarray:
    """Vectors drawn by a hash of their key; about one for every CELL_ROWS rows."""
    if pivots is None:
        pivots = min(MOST_PIVOTS, max(LEAST_PIVOTS, -(-base.count() // CELL_ROWS)))
    chosen = base.orderBy(hashed("pivot", F.col("n_key").cast("string"))).limit(pivots).select("vec").collect()
    if not chosen:
        raise ValueError("no training rows")
    return np.unique(np.array([r["vec"] for r in chosen], dtype=np.float64), axis=0)


def nearest(
    train: DataFrame,
    queries: DataFrame,
    key: str,
    vector: str,
    label: str,
    k: int,
    p: int = 2,
    pivots: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(key, neighbor, label, distance, rank) for the k nearest training rows of each query."""
    distances, matrix = _kernels()
    key_types = tuple(t.schema[key].dataType.simpleString() for t in (queries, train))
    base = train.select(
        F.col(key).alias("n_key"), F.col(vector).cast("array<double>").alias("vec"), F.col(label).cast("int").alias("n_label")
    )
    asked = queries.select(F.col(key).alias("q_key"), F.col(vector).cast("array<double>").alias("vec"))
    points = _pivot_points(base, pivots)

    @F.pandas_udf("cell int, away double")
    def assign(vec: pd.Series) -> pd.DataFrame:
        cells, away = [], []
        for start in range(0, len(vec), 256):
            d = distances(matrix(vec[start : start + 256], points.shape[1]), points, p)
            best = d.argmin(axis=1)
            cells.append(best)
            away.append(d[np.arange(len(best)), best])
        return pd.DataFrame(
            {"cell": np.concatenate(cells or [np.array([], int)]), "away": np.concatenate(away or [np.array([], float)])}
        )

    celled = materialize(base.withColumn("a", assign("vec")).select("n_key", "vec", "n_label", "a.cell", "a.away"), "cells")
    stats = celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("far")).collect()
    far = np.full(len(points), -np.inf)
    sizes = np.zeros(len(points), dtype=int)
    for r in stats:
        far[r["cell"]], sizes[r["cell"]] = r["far"], r["n"]
    homes = materialize(asked.withColumn("a", assign("vec")).select("q_key", "vec", F.col("a.cell").alias("cell")), "homes")
    open_ = homes.withColumn("limit", F.lit(None).cast("double"))
    first = materialize(_in_cells(celled, open_, sizes, k, p, block_rows, key_types), "first-round")

    # the k-th distance so far; a query whose own cell holds fewer rows has none and goes everywhere
    limits = _ranked(first, k).groupBy("q_key").agg(F.max("distance").alias("limit"), F.count("*").alias("n"))
    limit = F.when(F.col("n") >= k, F.col("limit"))
    limited = homes.join(limits.select("q_key", limit.alias("limit")), "q_key", "left")

    @F.pandas_udf("array<int>")
    def reachable(vec: pd.Series, home: pd.Series, limit: pd.Series) -> pd.Series:
        out = []
        for start in range(0, len(vec), 256):
            d = distances(matrix(vec[start : start + 256], points.shape[1]), points, p)
            most = limit[start : start + 256].fillna(np.inf).to_numpy(dtype=float)
            keep = (d - far <= (most * (1 + 1e-9) + 1e-9)[:, None]) & (sizes > 0)
            keep[np.arange(len(d)), home[start : start + 256].to_numpy(dtype=int)] = False
            out += [np.flatnonzero(row).astype(np.int32) for row in keep]
        return pd.Series(out)

    routed = limited.select("q_key", "vec", "limit", F.explode(reachable("vec", "cell", "limit")).alias("cell"))
    second = _in_cells(celled, materialize(routed, "routed-queries"), sizes, k, p, block_rows, key_types)
    return _ranked(first.unionByName(second), k).select(
        F.col("q_key").alias(key), "neighbor", F.col("n_label").alias("label"), "distance", "rank"
    )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("q_key").orderBy("distance", "neighbor")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _in_cells(
    celled: DataFrame, routed: DataFrame, sizes: np.ndarray, k: int, p: int, block_rows: int, key_types: tuple[str, str]
) -> DataFrame:
    """(q_key, neighbor, n_label, distance): the k nearest rows, not beyond its limit, of every block that a query is routed to."""
    import pyarrow as pa
    import pyarrow.compute as pc

    closest = _closest_of()
    spark = celled.sparkSession
    loads = {r["cell"]: r["n"] for r in routed.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    cut = [(c, max(1, -(-int(s) // block_rows)), max(1, -(-loads.get(c, 0) // block_rows))) for c, s in enumerate(sizes.tolist())]
    blocks = F.broadcast(spark.createDataFrame(cut, "cell int, n_blocks int, q_blocks int"))
    left = (
        celled.join(blocks, "cell")
        .withColumn("n_block", F.pmod(F.xxhash64("n_key"), F.col("n_blocks")).cast("int"))
        .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)))
        .select("cell", "n_block", "q_block", "n_key", "vec", "n_label")
    )
    right = (
        routed.join(blocks, "cell")
        .withColumn("q_block", F.pmod(F.xxhash64("q_key"), F.col("q_blocks")).cast("int"))
        .withColumn("n_block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .select("cell", "n_block", "q_block", "q_key", "vec", "limit")
    )

    def matrix_of(column: pa.ChunkedArray) -> np.ndarray:
        flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))

    def local_nearest(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        q, n, d = (np.empty(0, t) for t in (int, int, float))
        if mine.num_rows and theirs.num_rows:
            mine = mine.take(pc.sort_indices(mine, sort_keys=[("n_key", "ascending")]))
            limits = pc.fill_null(theirs.column("limit"), np.inf).to_numpy()
            q, n, d = closest(matrix_of(theirs.column("vec")), matrix_of(mine.column("vec")), k, p, limits)
        asked, near = theirs.column("q_key").take(pa.array(q)), mine.select(["n_key", "n_label"]).take(pa.array(n))
        columns = {"q_key": asked, "neighbor": near.column("n_key"), "n_label": near.column("n_label"), "distance": pa.array(d)}
        return pa.table(columns)

    block = ["cell", "n_block", "q_block"]
    return (
        left.groupBy(*block)
        .cogroup(right.groupBy(*block))
        .applyInArrow(local_nearest, f"q_key {key_types[0]}, neighbor {key_types[1]}, n_label int, distance double")
    )


def vote_column(weights: str, k: int) -> Column:
    """Share of the positive class among the first ``k`` neighbours, as an aggregate.

    Under distance weights an exact match outvotes everything else.
    """
    inside = F.col("rank") <= k
    if weights == "uniform":
        return F.avg(F.when(inside, F.col("label")))
    if weights != "distance":
        raise ValueError(f"Unsupported weights: {weights}")
    exact = F.col("distance") == 0
    w = F.when(inside & ~exact, 1.0 / F.col("distance"))
    return F.coalesce(F.avg(F.when(inside & exact, F.col("label"))), F.sum(w * F.col("label")) / F.sum(w))


def vote(neighbors: DataFrame, key: str, weights: str = "uniform") -> DataFrame:
    """Share of the positive class among the neighbours."""
    return neighbors.groupBy(key).agg(vote_column(weights, 1 << 30).alias("y_prob"))


def votes(neighbors: DataFrame, key: str, candidates: Sequence[tuple[int, str, int]]) -> DataFrame:
    """(key, cand, y_prob) of many (cand, weights, k) from one search at their largest k."""
    wide = neighbors.groupBy(key).agg(*[vote_column(w, k).alias(f"p{i}") for i, (_, w, k) in enumerate(candidates)])
    each = [F.struct(F.lit(c).cast("bigint").alias("cand"), F.col(f"p{i}").alias("y_prob")) for i, (c, _, _) in enumerate(candidates)]
    return wide.select(key, F.explode(F.array(*each)).alias("v")).select(key, "v.*")
