"""Column-name reconciliation, contract checks and label mapping."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresift.functions.constants import SPACED_NAMES, TARGET_CODES
from caresift.operators.ordering import with_row_index

_OTHER = r"[^0-9A-Za-z]+"


class ContractError(ValueError):
    """A table does not meet the expected contract."""


def spaced_names(df: DataFrame) -> DataFrame:
    """Rename the underscore spellings to the canonical spaced ones."""
    return df.withColumnsRenamed(SPACED_NAMES)


def joined_key(name: str) -> str:
    """Upper-case name with every other run of characters as one underscore."""
    return re.sub(_OTHER, "_", str(name).strip().upper()).strip("_")


def compact_key(name: str) -> str:
    """Upper-case name with every other run of characters removed."""
    return re.sub(_OTHER, "", str(name).strip().upper())


def joined_key_column(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.btrim(F.regexp_replace(F.upper(F.trim(c)), _OTHER, "_"), F.lit("_"))


def compact_key_column(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.upper(F.trim(c)), _OTHER, "")


def trimmed_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def normalized_names(df: DataFrame) -> DataFrame:
    """Rename every column to its joined key; two columns with one key are an error."""
    names = [joined_key(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ContractError(f"Duplicate normalized column name detected: {twice[0]}")
    return df.toDF(*names)


def missing_columns(df: DataFrame, expected: Sequence[str], key=joined_key) -> list[str]:
    present = {key(c) for c in df.columns}
    return [e for e in expected if key(e) not in present]


def aligned(df: DataFrame, expected: Sequence[str], key=joined_key) -> DataFrame:
    """Exactly the expected columns, in order and spelling; others are dropped.

    When several source columns share a key the last one is taken.
    """
    missing = missing_columns(df, expected, key)
    if missing:
        raise ContractError(f"CSV missing required columns: {missing}")
    source = {key(c): c for c in df.columns}
    return df.select(*[F.col(f"`{source[key(e)]}`").alias(e) for e in expected])


def alignment_status(df: DataFrame, expected: Sequence[str], key=joined_key) -> tuple[str, str | None]:
    """(status, message) as a batch job reports it."""
    missing = missing_columns(df, expected, key)
    if missing:
        return "error", f"CSV missing required columns: {missing}"
    return "success", None


def coded_target(df: DataFrame, target: str, out: str = "y_true") -> DataFrame:
    """Map NO/YES to 0/1. Any other label stops the job that reads the row."""
    if target not in df.columns:
        raise ContractError(f"Target column not found: {target}")
    code = F.lit(None).cast("int")
    for label, value in TARGET_CODES.items():
        code = F.when(F.col(target) == label, F.lit(value)).otherwise(code)
    bad = F.raise_error(F.concat(F.lit("Unexpected target label: "), F.coalesce(F.col(target), F.lit("null"))))
    return df.withColumn(out, F.coalesce(code, bad.cast("int")))


def has_unknown_target(df: DataFrame, target: str) -> bool:
    """True when some label is outside the domain; stops at the first one found."""
    unknown = F.col(target).isNull() | ~F.col(target).isin(*TARGET_CODES)
    return not df.filter(unknown).select(target).limit(1).isEmpty()


def category_codes(df: DataFrame, column: str, out: str) -> DataFrame:
    """Codes from 0 in sorted order of the distinct values; null becomes -1."""
    levels = df.filter(F.col(column).isNotNull()).select(column).distinct()
    joined = df.join(with_row_index(levels, [column], out), column, "left")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(-1)))


def lenient_target(df: DataFrame, target: str, out: str = "y_true") -> DataFrame:
    """Map trimmed, upper-cased NO/YES; when any label is foreign, code all labels instead."""
    tidy = F.upper(F.trim(F.col(target)))
    foreign = tidy.isNull() | ~tidy.isin(*TARGET_CODES)
    if df.filter(foreign).select(target).limit(1).isEmpty():
        return df.withColumn(out, F.when(tidy == "YES", 1).otherwise(0))
    return category_codes(df, target, out)


def ordinal_codes(df: DataFrame, column: str, out: str) -> DataFrame:
    """Sorted ordinal codes from 0."""
    return category_codes(df, column, out)


def with_group(df: DataFrame, group: str, out: str = "grp") -> DataFrame:
    """The group column as text, ``all`` for every row when the table has none."""
    if group not in df.columns:
        return df.withColumn(out, F.lit("all"))
    return df.withColumn(out, F.coalesce(F.col(group).cast("string"), F.lit("nan")))
