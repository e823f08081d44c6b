"""Leaderboards, histories and training-log analysis."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caresift.operators.ordering import prefix_aggregates, with_row_index

#: Epochs per cell when running aggregates follow an epoch number.
EPOCHS_PER_CELL = 4096


def best_by(df: DataFrame, by: Sequence[str], *priority: Column) -> DataFrame:
    """One whole row per group, the one with the highest priorities."""
    order = F.struct(*[p.alias(f"p{i}") for i, p in enumerate(priority)])
    rest = F.struct(*[c for c in df.columns if c not in by])
    grouped = df.groupBy(*by) if by else df
    return grouped.agg(F.max_by(rest, order).alias("best")).select(*by, "best.*")


def leaderboard(df: DataFrame) -> DataFrame:
    """Models by (recall, f1, accuracy), with their place."""
    order = [F.desc("recall"), F.desc("f1"), F.desc("accuracy"), F.asc("model")]
    return with_row_index(df, order, "place", start=1)


def best_experiment(results: DataFrame) -> DataFrame:
    """The experiment with the highest fitness of each model; ties go to the first name."""
    first = W.partitionBy("model").orderBy(F.desc("fitness"), "experiment")
    return results.withColumn("r", F.row_number().over(first)).filter("r = 1").drop("r")


def ranking(results: DataFrame, *ties: str) -> DataFrame:
    """All results by fitness, best first, with their place."""
    return with_row_index(results, [F.desc("fitness"), *ties], "place", start=1)


def best_so_far(df: DataFrame, by: Sequence[str], step: str, value: str) -> DataFrame:
    """Highest value up to and with each step."""
    per_step = (
        df.groupBy(*by, step)
        .agg(F.max(value).alias("step_best"))
        .withColumn("cell", F.floor(F.col(step) / EPOCHS_PER_CELL))
    )
    out = prefix_aggregates(per_step, by, step, {"best": ("max", "step_best")})
    return out.select(*by, step, "step_best", "best")


def compare_variants(df: DataFrame, key: str, variant: str, base: str, other: str, metrics: Sequence[str]) -> DataFrame:
    """Base value, other value and difference of every metric, one row per (key, metric)."""
    sides = []
    for m in metrics:
        sides += [
            F.max(F.when(F.col(variant) == base, F.col(m))).alias(f"{m}_a"),
            F.max(F.when(F.col(variant) == other, F.col(m))).alias(f"{m}_b"),
        ]
    wide = df.groupBy(key).agg(*sides)
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(m).alias("metric"),
                    F.col(f"{m}_a").alias("original"),
                    F.col(f"{m}_b").alias("optimized"),
                    (F.col(f"{m}_b") - F.col(f"{m}_a")).alias("delta"),
                )
                for m in metrics
            ]
        )
    )
    return wide.select(key, rows.alias("e")).select(key, "e.*")


def best_epoch(history: DataFrame, by: Sequence[str], monitor: str, mode: str = "min") -> DataFrame:
    """The epoch whose monitored metric is best; the first one on a tie."""
    rows = history.filter(F.col("metric") == monitor)
    pick = F.min_by if mode == "min" else F.max_by
    sign = 1 if mode == "min" else -1
    order = F.struct(F.col("value"), (F.lit(sign) * F.col("epoch")).alias("e"))
    return rows.groupBy(*by).agg(
        pick("epoch", order).alias("best_epoch"),
        (F.min("value") if mode == "min" else F.max("value")).alias("best_value"),
    )


def early_stop(history: DataFrame, by: Sequence[str], monitor: str, patience: int, mode: str = "min") -> DataFrame:
    """The first epoch that ends ``patience`` epochs without improvement; null when none does.

    A null or NaN value improves nothing.
    """
    by = list(by)
    rows = history.filter(F.col("metric") == monitor).select(
        *by, "epoch", (F.col("value") if mode == "min" else -F.col("value")).cast("double").alias("v")
    )
    # The smallest (value, epoch) so far stands at the last epoch that improved on all before it.
    known = F.col("v").isNotNull() & ~F.isnan("v")
    celled = rows.withColumns(
        {"pair": F.when(known, F.struct("v", "epoch")), "cell": F.floor(F.col("epoch") / EPOCHS_PER_CELL)}
    )
    best = prefix_aggregates(celled, by, "epoch", {"best": ("min", "pair")})
    waited = F.col("epoch") - F.coalesce(F.col("best.epoch"), F.lit(-1)) >= patience
    return best.groupBy(*by).agg(
        F.min(F.when(waited, F.col("epoch"))).alias("stop_epoch"), F.max("epoch").alias("last_epoch")
    )


def plateau_rates(
    history: DataFrame,
    run: str,
    monitor: str,
    patience: int,
    start_rate: float,
    factor: float = 0.5,
    min_rate: float = 1e-6,
    min_delta: float = 1e-4,
    mode: str = "min",
) -> DataFrame:
    """Learning rate after each epoch when it is cut on plateaus.

    The best value moves only on a gain of more than ``min_delta``, a true
    recurrence. Runs are spread over tasks in epoch order and each task carries
    one (run, best, wait, rate) from row to row, so no run is ever held in memory.
    """
    rows = history.filter(F.col("metric") == monitor).select(
        F.col(run).cast("string").alias("run"),
        F.col("epoch").cast("bigint").alias("epoch"),
        (F.col("value") if mode == "min" else -F.col("value")).cast("double").alias("v"),
    )

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, best, wait, rate = None, float("inf"), 0, start_rate
        for batch in batches:
            rates, cuts = [], []
            for name, value in zip(batch["run"], batch["v"]):
                if name != current:
                    current, best, wait, rate = name, float("inf"), 0, start_rate
                cut = False
                if value < best - min_delta:
                    best, wait = value, 0
                else:
                    wait += 1
                    if wait >= patience:
                        wait = 0
                        if rate > min_rate:
                            rate, cut = max(rate * factor, min_rate), True
                rates.append(rate)
                cuts.append(cut)
            yield pd.DataFrame(
                {"run": batch["run"], "epoch": batch["epoch"], "learning_rate": rates, "reduced": cuts}
            )

    ordered = rows.repartition("run").sortWithinPartitions("run", "epoch")
    return ordered.mapInPandas(follow, "run string, epoch bigint, learning_rate double, reduced boolean")


def grid_points(grids: dict[str, dict[str, list]], spark) -> DataFrame:
    """All parameter combinations of each model, as JSON text, numbered in search order."""
    import itertools
    import json

    rows = []
    for model, grid in grids.items():
        names = sorted(grid)
        for i, values in enumerate(itertools.product(*[grid[n] for n in names])):
            rows.append((model, i, json.dumps(dict(zip(names, values)), ensure_ascii=False)))
    return spark.createDataFrame(rows, "model string, point int, params string")


def grid_choice(results: DataFrame) -> DataFrame:
    """Best grid point per model by (recall, f1, accuracy); the first point wins ties."""
    return best_by(results, ["model"], F.col("recall"), F.col("f1"), F.col("accuracy"), -F.col("point"))
