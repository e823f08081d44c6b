"""Threshold sweeps and selection policies.

A sweep reads the scored table once: each score is mapped to the number of grid
thresholds it reaches, rows are counted per (group, number), and running sums
over those at most grid+1 counts give the confusion at every threshold.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caresift.functions import rates as R
from caresift.functions.constants import (
    COARSE_GRID,
    DEFAULT_THRESHOLD,
    FINE_GRID,
    RECALL_GRID,
    REQUIRED_RECALL,
)
from caresift.operators.ordering import join_groups


def single(value: float) -> float:
    """The value as held in single precision."""
    return struct.unpack("f", struct.pack("f", value))[0]


def sweep(
    df: DataFrame,
    by: Sequence[str],
    grid: Sequence[float],
    score: str = "y_prob",
    floored: bool = False,
    single_precision: bool = False,
) -> DataFrame:
    """Counts and rates at every grid threshold for every group."""
    by = list(by)
    edges = [single(t) if single_precision else float(t) for t in grid]
    value = F.col(score).cast("float").cast("double") if single_precision else F.col(score).cast("double")
    scored = df.select(*by, "y_true", value.alias("sweep__score"))
    reached = Bucketizer(
        splits=[-math.inf, *edges, math.inf],
        inputCol="sweep__score",
        outputCol="sweep__bin",
        handleInvalid="keep",
    ).transform(scored)
    missing = F.col("sweep__score").isNull() | F.isnan("sweep__score")
    level = F.when(missing, 0).otherwise(F.col("sweep__bin").cast("int")).alias("level")
    hist = reached.groupBy(*by, level).agg(
        F.count_if(F.col("y_true") == 1).alias("pos"), F.count_if(F.col("y_true") == 0).alias("neg")
    )
    blank = (
        hist.select(*by).distinct() if by else hist.sparkSession.range(1).select()
    ).select(
        *by,
        F.explode(F.sequence(F.lit(0), F.lit(len(edges)))).alias("level"),
        F.lit(0).cast("bigint").alias("pos"),
        F.lit(0).cast("bigint").alias("neg"),
    )
    full = hist.unionByName(blank).groupBy(*by, "level").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    down = W.partitionBy(*by).orderBy(F.desc("level")).rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*by)
    counts = full.select(
        *by,
        "level",
        F.sum("pos").over(down).alias("tp"),
        F.sum("neg").over(down).alias("fp"),
        F.sum("pos").over(whole).alias("all_pos"),
        F.sum("neg").over(whole).alias("all_neg"),
    ).filter("level >= 1")
    counts = counts.select(
        *by,
        F.element_at(F.array(*[F.lit(float(t)) for t in grid]), F.col("level")).alias("threshold"),
        "tp",
        "fp",
        (F.col("all_pos") - F.col("tp")).alias("fn"),
        (F.col("all_neg") - F.col("fp")).alias("tn"),
    )
    table = R.floored_rates() if floored else R.rates()
    return counts.select("*", *[v.alias(k) for k, v in table.items()])


def best_row(swept: DataFrame, by: Sequence[str], *priority: Column) -> DataFrame:
    """The row with the highest priorities; ties go to the lowest threshold."""
    order = F.struct(*[p.alias(f"p{i}") for i, p in enumerate(priority)], (-F.col("threshold")).alias("low"))
    everything = F.struct(*[c for c in swept.columns if c not in by])
    grouped = swept.groupBy(*by) if by else swept
    return grouped.agg(F.max_by(everything, order).alias("best")).select(*by, "best.*")


def recall_first(df: DataFrame, by: Sequence[str], grid=COARSE_GRID, score: str = "y_prob") -> DataFrame:
    """Highest (recall, f1, specificity)."""
    return best_row(sweep(df, by, grid, score), by, F.col("recall"), F.col("f1"), F.col("specificity"))


def weighted_recall(df: DataFrame, by: Sequence[str], grid=FINE_GRID, score: str = "y_prob") -> DataFrame:
    """Highest 2*recall + specificity + f1, in single precision."""
    swept = sweep(df, by, grid, score, floored=True, single_precision=True)
    return best_row(swept, by, F.round(F.col("recall") * 2.0 + F.col("specificity") + F.col("f1"), 12))


def accuracy_plus_f1(df: DataFrame, by: Sequence[str], grid=FINE_GRID, score: str = "y_prob") -> DataFrame:
    """Highest accuracy + f1, in single precision."""
    swept = sweep(df, by, grid, score, floored=True, single_precision=True)
    return best_row(swept, by, F.round(F.col("accuracy") + F.col("f1"), 12))


def lowest_with_recall(
    df: DataFrame, by: Sequence[str], required: float = REQUIRED_RECALL, grid=RECALL_GRID, score: str = "y_prob"
) -> DataFrame:
    """Smallest threshold whose recall is high enough; else the best recall on the grid."""
    swept = sweep(df, by, grid, score)
    enough = F.col("recall") >= F.lit(required)
    return best_row(
        swept,
        by,
        enough.cast("int"),
        F.when(enough, -F.col("threshold")).otherwise(F.lit(0.0)),
        F.col("recall"),
        F.col("specificity"),
        F.col("precision"),
        F.col("accuracy"),
    )


def top_thresholds(df: DataFrame, by: Sequence[str], n: int = 10, grid=RECALL_GRID, score: str = "y_prob") -> DataFrame:
    """The first ``n`` thresholds by (recall, specificity, precision, accuracy)."""
    order = [F.desc(c) for c in ("recall", "specificity", "precision", "accuracy")] + [F.asc("threshold")]
    ranked = sweep(df, by, grid, score).withColumn(
        "rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))
    )
    return ranked.filter(F.col("rank") <= n)


def compare_with_default(
    df: DataFrame, by: Sequence[str], chosen: DataFrame, default: float = DEFAULT_THRESHOLD, score: str = "y_prob"
) -> DataFrame:
    """Metrics at the default and at each group's chosen threshold, side by side.

    ``chosen`` has one row per group with ``threshold``; both scenarios are
    counted in one pass over the scored table.
    """
    from caresift.session import checked_broadcast

    picked = checked_broadcast(chosen.select(*by, F.col("threshold").alias("chosen__t")))
    joined = join_groups(df, picked, by) if by else df.join(picked)
    y = F.col("y_true")
    sums = []
    for tag, t in (("d", F.lit(default)), ("c", F.col("chosen__t"))):
        p = R.reaches(F.col(score), t)
        sums += [
            F.count_if((y == 1) & p).alias(f"tp_{tag}"),
            F.count_if((y == 0) & p).alias(f"fp_{tag}"),
            F.count_if((y == 1) & ~p).alias(f"fn_{tag}"),
            F.count_if((y == 0) & ~p).alias(f"tn_{tag}"),
        ]
    both = joined.groupBy(*by).agg(*sums, F.max("chosen__t").alias("chosen__t"))
    scenario = [
        F.struct(
            F.lit(name).alias("scenario"),
            t.alias("threshold"),
            *[F.col(f"{c}_{tag}").alias(c) for c in ("tp", "fp", "fn", "tn")],
        )
        for name, tag, t in (
            ("default", "d", F.lit(default)),
            ("chosen", "c", F.col("chosen__t")),
        )
    ]
    rows = both.select(*by, F.explode(F.array(*scenario)).alias("s")).select(*by, "s.*")
    return rows.select("*", *[v.alias(k) for k, v in R.rates().items()])
