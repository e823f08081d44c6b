"""Classification metrics as aggregations over a scored table.

A scored table has ``y_true`` INT, ``y_prob`` DOUBLE and grouping columns such
as ``model``. Every metric works for all groups at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresift.functions import rates as R


def confusion_counts(df: DataFrame, by: Sequence[str], pred: Column | str = "y_pred") -> DataFrame:
    return df.groupBy(*by).agg(*R.confusion(pred=pred))


def with_rates(counts: DataFrame, names: Sequence[str] | None = None, floored: bool = False) -> DataFrame:
    table = R.floored_rates() if floored else R.rates()
    chosen = names or list(table)
    return counts.select("*", *[table[n].alias(n) for n in chosen])


def accuracy_by(df: DataFrame, by: Sequence[str], pred: Column | str = "y_pred") -> DataFrame:
    hit = (F.col("y_true") == R.col(pred)).cast("int")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def class_report(df: DataFrame, by: Sequence[str], pred: Column | str = "y_pred") -> DataFrame:
    """Per-class rows plus accuracy, macro and weighted averages."""
    counts = df.groupBy(*by).agg(*R.confusion(pred=pred))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def one(name: str, hit: Column, extra: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            R.ratio(hit, hit + extra).alias("precision"),
            R.ratio(hit, hit + missed).alias("recall"),
            R.ratio(2 * hit, 2 * hit + extra + missed).alias("f1"),
            (hit + missed).alias("support"),
        )

    both = counts.select(*by, one("0", tn, fn, fp).alias("c0"), one("1", tp, fp, fn).alias("c1"), R.accuracy().alias("acc"))
    n0, n1 = F.col("c0.support"), F.col("c1.support")

    def average(name: str, w0: Column, w1: Column) -> Column:
        parts = [
            ((F.col(f"c0.{m}") * w0 + F.col(f"c1.{m}") * w1) / (w0 + w1)).alias(m)
            for m in ("precision", "recall", "f1")
        ]
        return F.struct(F.lit(name).alias("label"), *parts, (n0 + n1).alias("support"))

    overall = F.struct(
        F.lit("accuracy").alias("label"),
        F.col("acc").alias("precision"),
        F.col("acc").alias("recall"),
        F.col("acc").alias("f1"),
        (n0 + n1).alias("support"),
    )
    rows = F.array(
        F.col("c0"),
        F.col("c1"),
        overall,
        average("macro avg", F.lit(1.0), F.lit(1.0)),
        average("weighted avg", n0.cast("double"), n1.cast("double")),
    )
    return both.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def confusion_table(df: DataFrame, by: Sequence[str], pred: Column | str = "y_pred") -> DataFrame:
    """Two rows per group (real class), one column per predicted class."""
    counts = df.groupBy(*by).agg(*R.confusion(pred=pred))
    rows = F.array(
        F.struct(F.lit(0).alias("real"), F.col("tn").alias("pred_0"), F.col("fp").alias("pred_1")),
        F.struct(F.lit(1).alias("real"), F.col("fn").alias("pred_0"), F.col("tp").alias("pred_1")),
    )
    return counts.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def group_recall(df: DataFrame, by: Sequence[str], group: str, pred: Column | str = "y_pred") -> DataFrame:
    counts = df.groupBy(*by, group).agg(*R.confusion(pred=pred))
    return counts.select(*by, group, R.recall().alias("recall"))


def group_report(df: DataFrame, by: Sequence[str], group: str, pred: Column | str = "y_pred") -> DataFrame:
    counts = df.groupBy(*by, group).agg(*R.confusion(pred=pred))
    return counts.select(
        *by, group, R.recall().alias("recall"), R.specificity().alias("specificity"), R.f1().alias("f1")
    )


def recall_gap(df: DataFrame, by: Sequence[str], group: str, pred: Column | str = "y_pred") -> DataFrame:
    """Largest difference of recall between groups; 0 when there are no groups."""
    recalls = group_recall(df, by, group, pred)
    gap = F.coalesce(F.max("recall") - F.min("recall"), F.lit(0.0)).alias("gap")
    return recalls.groupBy(*by).agg(gap) if by else recalls.agg(gap)


def fairness_metrics(df: DataFrame, by: Sequence[str], group: str, pred: Column | str = "y_pred") -> DataFrame:
    """Counts, rates, recall gap and fitness of every candidate in one job.

    The base table is shuffled once, already reduced to one row per
    (candidate, group) and map task; all else works on those few rows.
    """
    return fairness_of_cells(df.groupBy(*by, group).agg(*R.confusion(pred=pred)), by)


def fairness_of_cells(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """The same from confusion counts per (candidate, group)."""
    counts = (
        cells.withColumn("group_recall", R.recall())
        .groupBy(*by)
        .agg(
            *[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")],
            (F.max("group_recall") - F.min("group_recall")).alias("gap"),
        )
    )
    return with_rates(counts).withColumn("fitness", R.tabular_fitness())
