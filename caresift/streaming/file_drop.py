"""Scoring of arriving files with Structured Streaming."""

from __future__ import annotations

import csv
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caresift.functions.constants import CSV_EXTENSIONS, EXPLAINED_ROWS
from caresift.functions.texts import fallback_text
from caresift.operators.models import FittedModel
from caresift.operators.schema import joined_key
from caresift.operators.scoring import gated, risk_band, with_file_status
from caresift.session import checked_broadcast, materialize


def arriving_csv(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """Rows of CSV files as they arrive, each with the name of its file."""
    rows = spark.readStream.schema(schema).option("header", True).csv(folder)
    return rows.withColumn("file_path", F.col("_metadata.file_path"))


def arriving_parquet(spark: SparkSession, folder: str, pattern: str, schema: StructType) -> DataFrame:
    rows = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    return rows.withColumn("file_path", F.col("_metadata.file_path"))


def score_arrivals(
    stream: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> None:
    """Score all files not yet processed and add the results to ``out``.

    Rows are independent, so nothing is kept between batches. Each batch writes
    a folder of its own number: a batch replayed after a failure replaces its
    earlier output instead of doubling it.
    """

    def one_batch(batch: DataFrame, number: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (
        stream.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file_path, line, value): the non-blank lines of text files, numbered from 0 within each file.

    Files are read once, by as many tasks as they have splits, and stored. A line's number is its place in its split plus
    the lines of the file's earlier splits, so nothing is sorted: one count per split meets the lines.
    """
    block, at = F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")
    lines = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("file_path"), block, "value")
    stored = materialize(lines.filter(F.trim("value") != "").select("*", at), "lines")
    splits = stored.groupBy("file_path", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = W.partitionBy("file_path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")
    bases = checked_broadcast(splits.select("file_path", "block", base.alias("base")))
    return stored.join(bases, ["file_path", "block"]).select("file_path", (F.col("at") + F.col("base")).alias("line"), "value")


def column_places(header: str, expected: Sequence[str]) -> tuple[list[int], str | None]:
    """Where a file has the expected columns, by their joined keys (the last of several), or the error message."""
    names = next(csv.reader([header.lstrip("\ufeff")]))
    place = {joined_key(n): i for i, n in enumerate(names)}
    missing = [e for e in expected if joined_key(e) not in place]
    if missing:
        return [], f"CSV missing required columns: {missing}"
    return [place[joined_key(e)] for e in expected], None


def score_csv_files(
    spark: SparkSession,
    paths: Sequence[str],
    expected: Mapping[str, str],
    score: Callable[[DataFrame], DataFrame],
) -> tuple[DataFrame, DataFrame]:
    """Score survey files whose column spellings and orders differ from file to file.

    ``expected`` maps column names to types; ``score`` gets these columns with ``file_path`` and a 0-based ``row_index``
    in each file. Returns the scored rows and one status row per file. A file with a wrong suffix, without a header
    or with missing columns gets an error status and no rows; the others are not affected. All files are parsed in one scan,
    whatever their headers: a file's columns are looked up by its own places. One header per file reaches the driver.
    """
    report_schema = "file_path string, status string, message string"
    listed = spark.read.format("binaryFile").load(list(paths)).select("path", F.col("_metadata.file_path").alias("file_path"))
    by_suffix = with_file_status(listed, "path", CSV_EXTENSIONS).collect()
    status = [(r["file_path"], r["status"], r["message"]) for r in by_suffix if r["status"] == "error"]
    good = {r["file_path"]: r["path"] for r in by_suffix if r["status"] == "success"}
    lines = read_lines(spark, list(good.values())) if good else None
    headers = {r["file_path"]: r["value"] for r in lines.filter("line = 0").collect()} if good else {}
    places, width = [], 1
    for path in good:
        if path not in headers:
            status.append((path, "error", "Could not read CSV file: No columns to parse from file"))
            continue
        found, problem = column_places(headers[path], list(expected))
        status.append((path, "error" if problem else "success", problem))
        if not problem:
            places.append((path, found))
            width = max(width, 1 + max(found, default=0))
    report = spark.createDataFrame(status, report_schema)
    if not places:
        blank = spark.createDataFrame([], "file_path string, row_index bigint")
        return score(blank.select("*", *[F.lit(None).cast(t).alias(c) for c, t in expected.items()])), report
    known = checked_broadcast(spark.createDataFrame(places, "file_path string, places array<int>"))
    fields = F.from_csv("value", ", ".join(f"c{i} string" for i in range(width)))
    cells = F.array(*[F.col(f"fields.c{i}") for i in range(width)])
    rows = lines.filter("line > 0").join(known, "file_path").withColumn("fields", fields).withColumn("cells", cells)
    typed = [F.get("cells", F.get("places", F.lit(i))).try_cast(t).alias(c) for i, (c, t) in enumerate(expected.items())]
    return score(rows.select("file_path", (F.col("line") - 1).alias("row_index"), *typed)), report


def artifact_scorer(
    fitted: FittedModel, meta: Mapping, limit: int = EXPLAINED_ROWS
) -> Callable[[DataFrame], DataFrame]:
    """Scoring with a saved model: probability, decision, risk level, and a text for the first rows of each file."""

    def score(rows: DataFrame) -> DataFrame:
        keyed = rows.withColumn(fitted.key, F.concat_ws("#", "file_path", "row_index"))
        scored = fitted.score(keyed).withColumnRenamed("y_prob", "probability")
        named = scored.withColumns(
            {
                "model_name": F.lit(meta["model_name"]),
                "disease_detected": F.coalesce(F.col("probability") >= F.lit(float(meta["threshold"])), F.lit(False)),
                "risk_level": risk_band("probability"),
            }
        )
        text = fallback_text("model_name", "probability", F.lit(""))
        return gated(named, "row_index", text, "interpretation", limit).select(
            "file_path", "row_index", "disease_detected", "probability", "risk_level", "interpretation"
        )

    return score


def score_csv_arrivals(
    spark: SparkSession,
    folder: str,
    expected: Mapping[str, str],
    score: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> None:
    """Score every file dropped into ``folder`` since the last run, each on its own.

    At most ``files_per_batch`` file names reach the driver per batch. A replayed
    batch replaces its own earlier output.
    """

    def one_batch(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.collect()]
        if not paths:
            return
        rows, report = score_csv_files(spark, paths, expected, score)
        rows.write.mode("overwrite").parquet(f"{out}/rows/batch={number}")
        report.write.mode("overwrite").parquet(f"{out}/status/batch={number}")

    arrivals = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path")
    )
    query = (
        arrivals.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
