"""From probabilities to decisions, bands, row numbers and per-row status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresift.functions import rates as R
from caresift.functions.constants import (
    CSV_EXTENSIONS,
    EXPLAINED_ROWS,
    HIGH_RISK,
    IMAGE_CLASSES,
    IMAGE_EXTENSIONS,
    LABEL_DISPLAY,
    LABEL_NAMES,
    MODERATE_RISK,
    SKIPPED_ROW_NOTICE,
)
from caresift.operators.ordering import with_row_index


def risk_band(score: str | Column = "y_prob") -> Column:
    p = R.col(score)
    return F.when(p >= HIGH_RISK, "alto").when(p >= MODERATE_RISK, "moderado").otherwise("baixo")


def extension(path: str | Column) -> Column:
    """Lower-cased suffix of the file name, with its dot; empty when there is none."""
    name = F.regexp_extract(R.col(path), r"([^/]*)$", 1)
    return F.lower(F.regexp_extract(name, r"[^.](\.[^.]+)$", 1))


def with_file_status(df: DataFrame, path: str, allowed: Sequence[str]) -> DataFrame:
    """Status and message by allowed extension."""
    shown = allowed[0] if list(allowed) == CSV_EXTENSIONS else str(tuple(allowed))
    ok = extension(path).isin(*allowed)
    message = (
        "Invalid file type. Only .csv files are allowed"
        if list(allowed) == CSV_EXTENSIONS
        else f"Invalid file type. Only {shown} are allowed"
    )
    return df.withColumn("status", F.when(ok, "success").otherwise("error")).withColumn(
        "message", F.when(~ok, F.lit(message))
    )


def image_status(df: DataFrame, path: str) -> DataFrame:
    return with_file_status(df, path, IMAGE_EXTENSIONS)


def numbered(df: DataFrame, order: Sequence[str], name: str = "row_index", start: int = 0) -> DataFrame:
    return with_row_index(df, order, name, start)


def gated(df: DataFrame, index: str, value: Column, out: str, limit: int = EXPLAINED_ROWS, notice: str = SKIPPED_ROW_NOTICE) -> DataFrame:
    """``value`` for rows below ``limit``, a fixed notice for the rest."""
    return df.withColumn(out, F.when(F.col(index) < limit, value).otherwise(F.lit(notice)))


def gated_by_frame(df: DataFrame, index: str, explain, out: str, limit: int = EXPLAINED_ROWS, notice: str = SKIPPED_ROW_NOTICE) -> DataFrame:
    """Gating for an expensive step: ``explain`` only ever sees the first rows."""
    head = explain(df.filter(F.col(index) < limit))
    rest = df.filter(F.col(index) >= limit).withColumn(out, F.lit(notice))
    return head.unionByName(rest)


def with_outcome(df: DataFrame, value: Column, out: str, message: Column) -> DataFrame:
    """A value that may be missing becomes a status and a message instead of a failure."""
    return (
        df.withColumn(out, value)
        .withColumn("status", F.when(F.col(out).isNull(), "error").otherwise("success"))
        .withColumn("message", F.when(F.col(out).isNull(), message))
    )


def predicted_class(score: str | Column = "y_prob", threshold: float = 0.5) -> Column:
    return F.when(R.col(score) >= threshold, LABEL_NAMES[1]).otherwise(LABEL_NAMES[0])


def class_display(name: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in LABEL_DISPLAY.items():
        out = F.when(name == k, v).otherwise(out)
    return out


def folder_display(folder: str | Column) -> Column:
    out = F.lit(None).cast("string")
    for name, _, display in IMAGE_CLASSES:
        out = F.when(R.col(folder) == name, display).otherwise(out)
    return out


def folder_label(folder: str | Column) -> Column:
    out = F.lit(None).cast("int")
    for name, label, _ in IMAGE_CLASSES:
        out = F.when(R.col(folder) == name, label).otherwise(out)
    return out


def example_report(df: DataFrame, folder: str, file: str, score: str, threshold: float) -> DataFrame:
    """Expected and predicted class with the rounded probability."""
    return df.select(
        folder_display(folder).alias("classe"),
        F.col(file).alias("arquivo"),
        folder_display(folder).alias("classe_esperada"),
        R.round_half_even(score, 4).alias("probabilidade_malignidade"),
        class_display(predicted_class(score, threshold)).alias("classe_predita"),
    )
