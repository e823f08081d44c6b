"""ROC and precision-recall curves and their areas, with exact tie handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresift.operators.ordering import order_cuts, prefix_aggregates, with_range_cell


def score_histogram(df: DataFrame, by: Sequence[str], score: str = "y_prob") -> DataFrame:
    """Positives and negatives per distinct score; ties collapse before the shuffle.

    A null or NaN score reaches no threshold, so it stands below all others.
    """
    value = F.col(score).cast("double")
    ranked = F.when(value.isNull() | F.isnan(value), float("-inf")).otherwise(value)
    return df.groupBy(*by, ranked.alias("score")).agg(
        F.count_if(F.col("y_true") == 1).alias("pos"),
        F.count_if(F.col("y_true") == 0).alias("neg"),
    )


def ranked_scores(
    df: DataFrame, by: Sequence[str], score: str = "y_prob", cuts: Sequence[float] | None = None
) -> DataFrame:
    """The histogram with running positives and negatives from the highest score down."""
    if cuts is None:
        cuts = order_cuts(df, score)
    cells = with_range_cell(score_histogram(df, by, score), "score", cuts)
    return prefix_aggregates(
        cells, by, "score", {"tps": ("sum", "pos"), "fps": ("sum", "neg")}, descending=True
    )


def roc_points(df: DataFrame, by: Sequence[str], score: str = "y_prob", cuts=None) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, plus the origin (null threshold)."""
    ranked = ranked_scores(df, by, score, cuts)
    points = ranked.select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide("fps", "fps_total").alias("fpr"),
        F.try_divide("tps", "tps_total").alias("tpr"),
    )
    at_top = ranked.filter((F.col("tps_before") == 0) & (F.col("fps_before") == 0))
    origin = at_top.select(
        *by,
        F.lit(None).cast("double").alias("threshold"),
        F.when(F.col("fps_total") > 0, 0.0).alias("fpr"),
        F.when(F.col("tps_total") > 0, 0.0).alias("tpr"),
    )
    return points.unionByName(origin)


def precision_recall_points(df: DataFrame, by: Sequence[str], score: str = "y_prob", cuts=None) -> DataFrame:
    """(threshold, precision, recall) per distinct score, plus the end point (1, 0)."""
    ranked = ranked_scores(df, by, score, cuts)
    points = ranked.select(
        *by,
        F.col("score").alias("threshold"),
        (F.col("tps") / (F.col("tps") + F.col("fps"))).alias("precision"),
        F.try_divide("tps", "tps_total").alias("recall"),
    )
    at_top = ranked.filter((F.col("tps_before") == 0) & (F.col("fps_before") == 0))
    end = at_top.select(
        *by,
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)


def areas(df: DataFrame, by: Sequence[str], score: str = "y_prob", cuts=None) -> DataFrame:
    """ROC-AUC and average precision per group; null where a class is missing."""
    ranked = ranked_scores(df, by, score, cuts)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    area = F.sum(neg * (F.col("tps_before") + pos / 2.0))
    steps = F.sum(pos * F.col("tps") / (F.col("tps") + F.col("fps")))
    p = F.max("tps_total").cast("double")
    n = F.max("fps_total").cast("double")
    grouped = ranked.groupBy(*by) if by else ranked
    return grouped.agg(
        F.when((p > 0) & (n > 0), area / (p * n)).alias("auc_roc"),
        F.when((p > 0) & (n > 0), steps / p).alias("average_precision"),
    )
