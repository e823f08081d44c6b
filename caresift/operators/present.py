"""Result tables for people: joined rows, totals, pages and file details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresift.functions import rates as R
from caresift.operators.ordering import rows_at, with_row_index


def percent_text(score: str | Column) -> Column:
    """A share as a percentage with two places."""
    return F.concat(F.regexp_replace(F.format_number(R.col(score) * 100, 2), ",", ""), F.lit("%"))


def with_predictions(inputs: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Input rows with display label, percentage and 1-based line number.

    The join is by key, so an input row without a prediction keeps its place
    with empty result columns.
    """
    shown = predictions.select(
        key,
        F.when(F.col("disease_detected"), "Positivo").otherwise("Negativo").alias("resultado"),
        R.round_half_even(F.col("probability") * 100, 2).alias("probabilidade_pct"),
    )
    return with_row_index(inputs.join(shown, key, "left"), [key], "linha", start=1)


def totals(df: DataFrame, flag: str = "disease_detected") -> DataFrame:
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(flag)).alias("positives"),
        F.count_if(~F.col(flag)).alias("negatives"),
    )


def page(df: DataFrame, order: list[str], page_index: int, size: int, hidden: str | None = None) -> DataFrame:
    """One page of rows in order; a page number past the end shows the last page."""
    total = df.count()
    pages = max((total - 1) // size + 1, 1)
    start = min(page_index, pages - 1) * size
    chosen = rows_at(df, order, start, start + size, "row_index", total)
    chosen = chosen.withColumn("total_pages", F.lit(pages).cast("bigint"))
    return chosen.drop(hidden) if hidden and hidden in chosen.columns else chosen


def with_highlight(df: DataFrame, label: str = "resultado") -> DataFrame:
    return df.withColumn("highlight", F.coalesce(F.col(label) == "Positivo", F.lit(False)))


def file_details(df: DataFrame, name: str, size: str, threshold: str | Column, flag: str | Column, score: str | Column) -> DataFrame:
    return df.select(
        F.col(name).alias("nome"),
        F.concat(F.col(size).cast("string"), F.lit(" bytes")).alias("tamanho"),
        percent_text(threshold).alias("limiar"),
        F.when(R.col(flag), "Sim").otherwise("Não").alias("achado_suspeito"),
        percent_text(score).alias("probabilidade"),
    )
