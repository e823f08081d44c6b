"""Image catalogue from file paths; pixels are never read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caresift.operators.scoring import folder_label


def list_files(spark: SparkSession, folder: str, pattern: str = "*.jpg") -> DataFrame:
    """(path, length) of matching files below ``folder``; the content column is pruned."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length")
    )


def catalogue(paths: DataFrame, path: str = "path") -> DataFrame:
    """(image_path, label, class_original) for ``.jpg`` files in a known class folder."""
    folder = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    rows = paths.filter(F.col(path).endswith(".jpg")).select(
        F.col(path).alias("image_path"), folder_label(folder).alias("label"), folder.alias("class_original")
    )
    return rows.filter(F.col("label").isNotNull())


def read_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """The catalogue of a folder tree; a tree without any known image is an error."""
    found = catalogue(
        list_files(spark, folder).withColumn("path", F.url_decode(F.regexp_replace("path", r"\+", "%2B")))
    )
    if found.limit(1).isEmpty():
        raise RuntimeError(f"no image found in {folder}")
    return found
