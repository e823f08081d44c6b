"""Stratified splits, shuffles, samples and class weights."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caresift.functions.draws import hashed
from caresift.operators.ordering import positions_by_score, rank_cuts, with_row_index
from caresift.session import checked_broadcast, materialize


def _share(fraction: float) -> Column:
    return F.floor(F.col("n") * F.lit(fraction) + 0.5)


def _stratum(label: str) -> Column:
    """The label as text that is never null: rows without a label are a class of their own."""
    return F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("~"))


def stratified_split(
    df: DataFrame, key: str, label: str, val_fraction: float, test_fraction: float, seed: int = 42, stored: bool = False
) -> DataFrame:
    """Add ``split`` (train, val, test) with equal class shares in every part.

    Rows of a class are ordered by a seeded digest of their key and cut at the
    cumulative fractions; rows without a label are a class of their own. The cut digests are found first; the assignment is
    then a comparison per row, with no shuffle of the table. With ``stored`` the rows and their digests are written
    once, so that neither the cuts nor later passes make them again.
    """
    train = 1.0 - val_fraction - test_fraction
    if train <= 0 or min(val_fraction, test_fraction) < 0:
        raise ValueError("fractions must leave rows for training")
    digested = df.withColumns({"split__digest": hashed(seed, F.col(key)), "split__class": _stratum(label)})
    digested = materialize(digested, "digested") if stored else digested
    edges = rank_cuts(
        digested,
        "split__class",
        "split__digest",
        {"train_edge": _share(train), "val_edge": _share(1.0 - test_fraction)},
    )
    digest = F.col("split__digest")
    part = (
        F.when(digest <= F.col("train_edge"), "train")
        .when(digest <= F.col("val_edge"), "val")
        .otherwise("test")
    )
    return (
        digested.join(checked_broadcast(edges), "split__class")
        .withColumn("split", part)
        .drop("split__digest", "split__class", "train_edge", "val_edge")
    )


def split_60_20_20(df: DataFrame, key: str, label: str, seed: int = 42, stored: bool = False) -> DataFrame:
    return stratified_split(df, key, label, 0.2, 0.2, seed, stored)


def split_test_first(
    df: DataFrame, key: str, label: str, test_fraction: float = 0.2, val_share: float = 0.25, seed: int = 42
) -> DataFrame:
    """Cut the test part off first, then take validation from what remains."""
    if not (0 < test_fraction < 1 and 0 < val_share < 1):
        raise ValueError("fractions must lie between 0 and 1")
    digested = df.withColumns({"split__digest": hashed(seed, F.col(key)), "split__class": _stratum(label)})
    test = _share(test_fraction)
    val = F.floor((F.col("n") - test) * F.lit(val_share) + 0.5)
    edges = rank_cuts(digested, "split__class", "split__digest", {"test_edge": test, "val_edge": test + val})
    digest = F.col("split__digest")
    part = (
        F.when(digest <= F.col("test_edge"), "test")
        .when(digest <= F.col("val_edge"), "val")
        .otherwise("train")
    )
    return (
        digested.join(checked_broadcast(edges), "split__class")
        .withColumn("split", part)
        .drop("split__digest", "split__class", "test_edge", "val_edge")
    )


def split_report(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Rows and class share per split."""
    counts = df.groupBy(split, label).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(split)))


def shuffled(df: DataFrame, key: str, seed: int = 42, name: str = "position") -> DataFrame:
    """All rows in a seeded random order, with their 0-based position."""
    digested = df.withColumn("shuffle__digest", hashed(seed, F.col(key)))
    return with_row_index(digested, ["shuffle__digest", key], name).drop("shuffle__digest")


def quantile_sample(df: DataFrame, score: str, key: str, size: int) -> DataFrame:
    """``size`` rows evenly spaced along the score order, numbered from 1."""
    n = df.count()
    positions = sorted({int(p) for p in np.linspace(0, n - 1, size).round()}) if n else []
    if not positions:
        return df.limit(0).withColumn("case_id", F.lit(0).cast("bigint"))
    picked = positions_by_score(df, score, key, positions)
    numbered = F.array_position(F.array(*[F.lit(p) for p in positions]), F.col("position"))
    return picked.withColumn("case_id", numbered).drop("position")


def first_per_class(df: DataFrame, label: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows of each class; the rank limit runs before the shuffle."""
    ranked = df.withColumn("rank_in_class", F.row_number().over(W.partitionBy(label).orderBy(order)))
    return ranked.filter(F.col("rank_in_class") <= n)


def train_and_val(df: DataFrame, split: str = "split") -> DataFrame:
    return df.filter(F.col(split).isin("train", "val"))


def binary_class_weights(df: DataFrame, label: str) -> DataFrame:
    """n / (2 * class count) for classes 0 and 1, counts floored at 1."""
    counts = df.agg(
        F.count("*").alias("n"),
        F.greatest(F.count_if(F.col(label) == 0), F.lit(1)).alias("n0"),
        F.greatest(F.count_if(F.col(label) == 1), F.lit(1)).alias("n1"),
    )
    pairs = F.explode(
        F.array(
            F.struct(F.lit(0).alias("label"), (F.col("n") / (2.0 * F.col("n0"))).alias("weight")),
            F.struct(F.lit(1).alias("label"), (F.col("n") / (2.0 * F.col("n1"))).alias("weight")),
        )
    )
    return counts.select(pairs.alias("w")).select("w.label", "w.weight")


def balanced_class_weights(df: DataFrame, label: str) -> DataFrame:
    """n / (classes * class count) for any number of classes."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("classes"))
    return counts.select(
        label,
        "n",
        (
            totals.select("rows").scalar() / (totals.select("classes").scalar() * F.col("n"))
        ).alias("weight"),
    )


def with_class_weight(df: DataFrame, label: str) -> DataFrame:
    """Attach the balanced weight of its class to every row."""
    weights = balanced_class_weights(df, label).select(label, "weight")
    return df.join(checked_broadcast(weights), label)


def sample_coverage(df: DataFrame, score: str, band: str) -> DataFrame:
    """Size, score range and distinct bands of a sample."""
    return df.agg(
        F.count("*").alias("n"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        F.array_join(F.array_sort(F.collect_set(band)), ", ").alias("bands"),
    )
