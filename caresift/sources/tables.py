"""Reading the driver tables and survey files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A comma-separated file with a header. Types are inferred only without a schema."""
    reader = spark.read.option("header", True).option("sep", ",")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    try:
        return reader.csv(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" in str(problem):
            raise FileNotFoundError(f"Dataset not found: {path}") from None
        raise


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).mode("overwrite").csv(path)
