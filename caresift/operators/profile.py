"""Profiling and cleaning of survey tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType
from pyspark.sql.types import NumericType

from caresift.functions.rates import round_half_even
from caresift.operators.ordering import exact_quantiles, join_groups
from caresift.session import checked_broadcast


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"))


def _one_row_per(pairs: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    entries = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias(value)) for c in columns]))
    return pairs.select(entries.alias("e")).select("e.*")


def null_counts(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return _one_row_per(counts, df.columns, "nulls")


def schema_report(df: DataFrame) -> DataFrame:
    """Name, type and non-null count of every column."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    entries = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.col(f"`{c}`").alias("non_null")
                )
                for c in df.columns
            ]
        )
    )
    return counts.select(entries.alias("e")).select("e.*")


def long_form(
    df: DataFrame, columns: Sequence[str], name: str = "column", value: str = "value", kind: str = "double"
) -> DataFrame:
    """One row per (row, column), values as ``kind``; other columns are dropped."""
    entries = F.explode(
        F.array(*[F.struct(F.lit(c).alias(name), F.col(f"`{c}`").cast(kind).alias(value)) for c in columns])
    )
    return df.select(entries.alias("e")).select("e.*")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std (n-1), min, quartiles and max per column, all exact."""
    long = long_form(df, columns)
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(long, ["column"], "value", [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    return moments.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows; nulls are equal to each other."""
    copies = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"))


def without_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column)


def named_value_counts(df: DataFrame, column: str, names: Mapping) -> DataFrame:
    """Counts by key in key order, with a display name for each known key."""
    display = F.lit(None).cast("string")
    for k, v in names.items():
        display = F.when(F.col(column) == F.lit(k), F.lit(v)).otherwise(display)
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.select(column, display.alias("name"), "n").orderBy(column)


def class_share(df: DataFrame, label: str, split: str | None = None) -> DataFrame:
    """Share of each class, within each split or over the whole table."""
    if split:
        counts = df.groupBy(split, label).agg(F.count("*").alias("n"))
        return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(split)))
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def positive_rate(df: DataFrame, target: str, positive: str = "YES", negative: str = "NO") -> DataFrame:
    """Row, positive and negative counts, and the positive percentage in whole percents."""
    counts = df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(target) == positive).alias("positives"),
        F.count_if(F.col(target) == negative).alias("negatives"),
    )
    rate = round_half_even(F.col("positives") / F.col("total"), 2) * 100
    return counts.withColumn("positive_pct", rate)


def positives(df: DataFrame, target: str, positive: str = "YES") -> DataFrame:
    return df.filter(F.col(target) == positive)


def factor_counts(df: DataFrame, factors: Sequence[str]) -> DataFrame:
    """Count of every value of several factors at once; values are texts if any factor is one."""
    texts = any(isinstance(df.schema[c].dataType, (StringType, BooleanType)) for c in factors)
    long = long_form(df, factors, "factor", "value", "string" if texts else "double").filter(F.col("value").isNotNull())
    return long.groupBy("factor", "value").agg(F.count("*").alias("n"))


def box_stats(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR inside the data, and outliers beyond them."""
    by = list(by)
    rows = df.select(*by, F.col(f"`{value}`").cast("double").alias("value")).filter(F.col("value").isNotNull())
    quartiles = exact_quantiles(rows, by, "value", [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    iqr = F.col("q3") - F.col("q1")
    fences = checked_broadcast(
        quartiles.withColumn("low", F.col("q1") - 1.5 * iqr).withColumn("high", F.col("q3") + 1.5 * iqr)
    )
    if by:
        joined = join_groups(rows, fences, by)
    else:
        f = fences.first()
        joined = rows.select("*", *[F.lit(f[c]).alias(c) for c in fences.columns])
    inside = F.col("value").between(F.col("low"), F.col("high"))
    grouped = joined.groupBy(*by) if by else joined
    return grouped.agg(
        *[F.max(c).alias(c) for c in ("q1", "median", "q3")],
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over the data range, the last one closed; empty bins are kept."""
    values = df.select(F.col(f"`{column}`").cast("double").alias("value")).filter(F.col("value").isNotNull())
    low, high = values.agg(F.min("value"), F.max("value")).first()
    spark = df.sparkSession
    if low is None:
        return spark.createDataFrame([], "bin int, lower double, upper double, n bigint")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    slot = F.least(F.floor((F.col("value") - low) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(slot.alias("bin")).agg(F.count("*").alias("n"))
    frame = spark.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(low) + F.col("id") * width).alias("lower"),
        (F.lit(low) + (F.col("id") + 1) * width).alias("upper"),
    )
    return frame.join(F.broadcast(counts), "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of all pairs from one aggregation, rounded to 2 places."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]

    def both(a: str, b: str):
        x, y = F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")
        return F.corr(x, y)

    stats = df.agg(*[both(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        value = round_half_even(f"r{i}", 2)
        entries.append((a, b, value))
        if a != b:
            entries.append((b, a, value))
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), v.alias("corr"))
                for a, b, v in entries
            ]
        )
    )
    return stats.select(rows.alias("e")).select("e.*")


def target_correlations(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Features by absolute correlation with the target, strongest first."""
    matrix = correlation_matrix(df, [*columns, target])
    return (
        matrix.filter((F.col("b") == target) & (F.col("a") != target))
        .select(F.col("a").alias("feature"), "corr")
        .orderBy(F.desc(F.abs("corr")), "feature")
    )
