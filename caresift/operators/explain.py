"""Feature importance and attribution tables."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caresift.functions.draws import hashed, uniform
from caresift.operators.forest_batch import KeptForest
from caresift.operators.models import LOGISTIC, FittedModel
from caresift.operators.prep import assembled
from caresift.session import scratch_path


def feature_importance(fitted: FittedModel, n: int = 10) -> DataFrame:
    """The ``n`` most important features of a tree model, or largest |coefficients|."""
    if fitted.name == LOGISTIC:
        values = [abs(v) for v in fitted.model.coefficients.toArray()]
    else:
        values = fitted.model.featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(fitted.prep.feature_names, values)]
    spark = SparkSession.active()
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(n)


def linear_attribution(df: DataFrame, coefficients: Mapping[str, float], n: int = 10) -> DataFrame:
    """Mean |coefficient * (x - mean)| per feature, largest first; exact for linear models."""
    names = list(coefficients)
    values = {c: F.col(f"`{c}`").cast("double") for c in names}
    means = df.agg(*[F.avg(v).alias(c) for c, v in values.items()]).first()
    impact = df.agg(
        *[
            F.avg(F.abs(F.lit(coefficients[c]) * (values[c] - F.lit(means[c])))).alias(c)
            for c in names
            if means[c] is not None
        ]
    )
    rows = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("mean_impact")) for c in impact.columns])
    )
    return impact.select(rows.alias("e")).select("e.*").orderBy(F.desc("mean_impact"), "feature").limit(n)


def marginal_slopes(df: DataFrame, features: Sequence[str], target: str) -> dict[str, float]:
    """Least-squares slope of the target on each feature alone, from one aggregation."""
    y = F.col(target).cast("double")
    row = df.agg(*[F.regr_slope(y, F.col(f"`{c}`").cast("double")).alias(f"s{i}") for i, c in enumerate(features)]).first()
    return {c: row[f"s{i}"] or 0.0 for i, c in enumerate(features)}


def sampled_shapley(
    fitted: FittedModel,
    df: DataFrame,
    background: Mapping[str, object],
    permutations: int = 4,
    seed: int = 42,
    n: int = 10,
) -> DataFrame:
    """Mean |Shapley value| per input column by permutation sampling.

    Each row is exploded into one row per (permutation, number of revealed
    columns); a column still hidden takes its background value. All variants are
    scored in one pass, and the gain of each reveal goes to the revealed column
    (Strumbelj & Kononenko, 2014).
    """
    columns = [*fitted.prep.categorical, *fitted.prep.numeric]
    key = fitted.key
    ranked = df.select(key, *[F.col(f"`{c}`") for c in columns]).withColumn(
        "perm", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1)))
    )
    draws = F.array_sort(
        F.array(
            *[F.struct(uniform(seed, F.col(key), F.col("perm"), c).alias("u"), F.lit(c).alias("c")) for c in columns]
        )
    )
    ordered = ranked.withColumn("sequence", F.transform(draws, lambda s: s["c"]))
    steps = ordered.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(len(columns)))))
    shown = {
        c: F.when(F.array_position("sequence", F.lit(c)) <= F.col("step"), F.col(f"`{c}`")).otherwise(
            F.lit(background[c]).cast(df.schema[c].dataType)
        )
        for c in columns
    }
    variants = steps.withColumns(shown).withColumn("variant", hashed(F.col(key), F.col("perm"), F.col("step")))
    scored = fitted.score(variants).select(key, "perm", "step", "sequence", "y_prob")
    gains = F.explode(
        F.filter(
            F.array(
                F.struct(F.col("step").alias("at"), F.col("y_prob").alias("gain")),
                F.struct((F.col("step") + 1).alias("at"), (-F.col("y_prob")).alias("gain")),
            ),
            lambda g: (g["at"] >= 1) & (g["at"] <= len(columns)),
        )
    )
    by_feature = scored.select(key, "sequence", gains.alias("g")).select(
        key, F.element_at("sequence", F.col("g.at")).alias("feature"), "g.gain"
    )
    values = by_feature.groupBy(key, "feature").agg((F.sum("gain") / permutations).alias("value"))
    out = values.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_impact"))
    return out.orderBy(F.desc("mean_impact"), "feature").limit(n)


#: Leaves that meet a batch of rows at once.
LEAF_BLOCK = 512


def leaf_paths(fitted: FittedModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(low, high, value) of every leaf of a forest: a row gets to it if low < x <= high in every feature.

    ``value`` is the leaf's share of the positive class over the number of trees. A forest is as large as its
    model; its nodes are read from the model's stored form.
    """
    if isinstance(fitted.model, KeptForest):
        return fitted.model.leaf_paths()
    spark = SparkSession.active()
    path = scratch_path(spark, "forest")
    fitted.model.write().save(path)
    columns = ["treeID", "nodeData.id", "nodeData.impurityStats", "nodeData.leftChild", "nodeData.rightChild", "nodeData.split"]
    nodes: dict[tuple[int, int], tuple] = {}
    for r in spark.read.parquet(f"{path}/data").select(*columns).collect():
        nodes[r["treeID"], r["id"]] = (r["impurityStats"], r["leftChild"], r["rightChild"], r["split"])
    width, trees = fitted.model.numFeatures, len({t for t, _ in nodes})
    lows, highs, values = [], [], []
    todo = [(t, 0, np.full(width, -np.inf), np.full(width, np.inf)) for t in sorted({t for t, _ in nodes})]
    while todo:
        tree, node, low, high = todo.pop()
        stats, left, right, split = nodes[tree, node]
        if left < 0:
            lows.append(low)
            highs.append(high)
            values.append(stats[1] / sum(stats) / trees)
            continue
        j, cut = split["featureIndex"], split["leftCategoriesOrThreshold"]
        # a 0/1 feature goes left by its value: 0 as below a half, 1 as above
        turned = split["numCategories"] >= 0 and list(cut) == [1.0]
        edge = 0.5 if split["numCategories"] >= 0 else cut[0]
        below, above = (low.copy(), high.copy()), (low.copy(), high.copy())
        below[1][j], above[0][j] = min(high[j], edge), max(low[j], edge)
        first, second = (above, below) if turned else (below, above)
        todo += [(tree, left, *first), (tree, right, *second)]
    return np.array(lows).reshape(-1, width), np.array(highs).reshape(-1, width), np.array(values)


def _reach_weights(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Shapley weights of a leaf that ``a`` columns must be shown for and ``c`` hidden: for a shown and for a hidden one."""
    f = math.factorial
    shown, hidden = np.zeros((most + 1, most + 1)), np.zeros((most + 1, most + 1))
    for a in range(most + 1):
        for c in range(most + 1 - a):
            shown[a, c] = f(a - 1) * f(c) / f(a + c) if a else 0.0
            hidden[a, c] = f(a) * f(c - 1) / f(a + c) if c else 0.0
    return shown, hidden


def leaf_values(x: np.ndarray, base: np.ndarray, paths: tuple, owner: np.ndarray) -> np.ndarray:
    """(row, column): exact Shapley values of rows against one background row, leaf by leaf.

    A column that only the row takes into a leaf must be shown for it, one that only the background takes there must be hidden;
    both, and the leaf is reached in any case. So a leaf's share of every column has a closed form.
    """
    low, high, value = paths
    columns = int(owner.max()) + 1
    shown, hidden = _reach_weights(columns)
    out = np.zeros((len(x), columns))
    first = np.searchsorted(owner, np.arange(columns))
    for a in range(0, len(value), LEAF_BLOCK):
        lo, hi, v = (t[a : a + LEAF_BLOCK] for t in paths)
        mine = np.logical_and.reduceat((x[:, None] > lo) & (x[:, None] <= hi), first, axis=2)
        theirs = np.logical_and.reduceat((base > lo) & (base <= hi), first, axis=1)[None]
        possible = (mine | theirs).all(axis=2)
        need, bar = mine & ~theirs, ~mine & theirs
        n_need, n_bar = need.sum(axis=2), bar.sum(axis=2)
        plus = np.where(possible, v * shown[n_need, n_bar], 0.0)
        minus = np.where(possible, v * hidden[n_need, n_bar], 0.0)
        out += (need * plus[:, :, None]).sum(axis=1) - (bar * minus[:, :, None]).sum(axis=1)
    return out


def tree_attribution(fitted: FittedModel, df: DataFrame, background: Mapping[str, object], n: int = 10) -> DataFrame:
    """Mean |Shapley value| per input column of a forest, exact, against one background row.

    Rows with equal prepared features are one, with their count. The features of a coded column are shown and hidden together.
    """
    import pyarrow as pa

    columns = [*fitted.prep.categorical, *fitted.prep.numeric]
    coded = [c for c in fitted.prep.categorical for _ in fitted.prep.levels[c]]
    players = list(dict.fromkeys([*coded, *fitted.prep.numeric]))
    owner = np.array([players.index(c) for c in [*coded, *fitted.prep.numeric]])
    paths = leaf_paths(fitted)
    typed = [F.lit(background[c]).cast(df.schema[c].dataType).alias(c) for c in columns]
    spark = df.sparkSession
    base = np.array(assembled(spark.range(1).select(*typed), fitted.prep).select(vector_to_array("features").alias("x")).first()["x"])
    counted = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count("*").alias("rows__n"))
    rows = assembled(counted, fitted.prep).select(vector_to_array("features").alias("x"), "rows__n")
    grouped = rows.groupBy("x").agg(F.sum("rows__n").alias("n")).repartition(4 * spark.sparkContext.defaultParallelism)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(players) + 1)
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                count = batch.column(1).to_numpy(zero_copy_only=False)
                for a in range(0, len(x), 64):
                    found = np.abs(leaf_values(x[a : a + 64], base, paths, owner))
                    total[:-1] += count[a : a + 64] @ found
                total[-1] += count.sum()
        columns_ = [pa.array(players), pa.array(total[:-1]), pa.array(np.full(len(players), total[-1]))]
        yield pa.RecordBatch.from_arrays(columns_, names=["feature", "total", "n"])

    found = grouped.mapInArrow(work, "feature string, total double, n double").groupBy("feature")
    impact = found.agg((F.sum("total") / F.sum("n")).alias("mean_impact"))
    return impact.orderBy(F.desc("mean_impact"), "feature").limit(n)
