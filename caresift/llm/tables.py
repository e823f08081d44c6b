"""The tables the registered queries read, under names that cannot clash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, as new name = old name; whatever else the table has is left behind."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])
