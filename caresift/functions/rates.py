"""Column expressions for confusion counts, rates and fitness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caresift.functions.constants import IMAGE_WEIGHTS, TABULAR_WEIGHTS


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num, den) -> Column:
    """num/den, and 0 where the denominator is 0."""
    num, den = col(num), col(den)
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def floored_ratio(num, den) -> Column:
    """num/max(den, 1)."""
    return col(num) / F.greatest(col(den), F.lit(1))


def reaches(score: Column, threshold: Column) -> Column:
    """Whether a score reaches a threshold; a null or NaN score never does."""
    return F.coalesce((score >= threshold) & ~F.isnan(score), F.lit(False))


def decide(score="y_prob", threshold=0.5) -> Column:
    """1 where the score reaches the threshold."""
    t = F.lit(threshold) if not isinstance(threshold, Column) else threshold
    return reaches(col(score), t).cast("int")


def decide_float(score="y_prob", threshold=0.5) -> Column:
    """The same decision in single precision, as the image scores are held."""
    t = F.lit(threshold) if not isinstance(threshold, Column) else threshold
    return reaches(col(score).cast("float"), t.cast("float")).cast("int")


def confusion(truth="y_true", pred="y_pred") -> list[Column]:
    y, p = col(truth), col(pred)
    return [
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    ]


def precision() -> Column:
    return ratio("tp", F.col("tp") + F.col("fp"))


def recall() -> Column:
    return ratio("tp", F.col("tp") + F.col("fn"))


def specificity() -> Column:
    return ratio("tn", F.col("tn") + F.col("fp"))


def f1() -> Column:
    return ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))


def accuracy() -> Column:
    return ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))


def rates() -> dict[str, Column]:
    """Rates with zero denominators giving 0."""
    return {
        "accuracy": accuracy(),
        "precision": precision(),
        "recall": recall(),
        "specificity": specificity(),
        "f1": f1(),
    }


def floored_rates() -> dict[str, Column]:
    """Rates with denominators floored at 1 (1e-8 for f1)."""
    p = floored_ratio("tp", F.col("tp") + F.col("fp"))
    r = floored_ratio("tp", F.col("tp") + F.col("fn"))
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return {
        "accuracy": floored_ratio(F.col("tp") + F.col("tn"), total),
        "precision": p,
        "recall": r,
        "specificity": floored_ratio("tn", F.col("tn") + F.col("fp")),
        "f1": 2 * p * r / F.greatest(p + r, F.lit(1e-8)),
    }


def tabular_fitness(recall_="recall", specificity_="specificity", f1_="f1", gap="gap") -> Column:
    w = TABULAR_WEIGHTS
    return (
        w["recall"] * col(recall_)
        + w["specificity"] * col(specificity_)
        + w["f1"] * col(f1_)
        - w["gap"] * col(gap)
    )


def image_fitness(recall_="recall", specificity_="specificity", f1_="f1", auc="auc_roc") -> Column:
    w = IMAGE_WEIGHTS
    return (
        w["recall"] * col(recall_)
        + w["specificity"] * col(specificity_)
        + w["f1"] * col(f1_)
        + w["auc"] * F.coalesce(col(auc), F.lit(0.0))
    )


def round_half_even(x, digits: int) -> Column:
    """Rounding as numpy does it: scale, round half to even, unscale."""
    scale = float(10**digits)
    return F.rint(col(x) * scale) / scale
