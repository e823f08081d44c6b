"""Nested result documents, training histories, notebook outputs and text caches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caresift.operators.ordering import prefix_aggregates

RESULT_SCHEMA = (
    "map<string, map<string, struct<best_params: map<string, string>, best_fitness: double, "
    "validation_metrics: map<string, double>, history: array<double>>>>"
)
HISTORY_SCHEMA = "map<string, array<double>>"
NOTEBOOK_SCHEMA = (
    "struct<cells: array<struct<cell_type: string, outputs: array<struct<output_type: string, text: string>>>>>"
)


#: Phases that one cell of a run's order holds.
PHASES_PER_CELL = 4096


def result_rows(df: DataFrame, key: Sequence[str], text: str) -> DataFrame:
    """(model, experiment, section, name, value) rows of model -> experiment documents."""
    docs = df.select(*key, F.from_json(text, RESULT_SCHEMA).alias("doc"))
    # an inner explode would first read every document once more, to see whether it is empty
    models = docs.select(*key, F.explode_outer("doc").alias("model", "runs")).filter("model IS NOT NULL")
    runs = models.select(*key, "model", F.explode("runs").alias("experiment", "run"))
    plain = F.map_from_entries(F.array(F.struct(F.lit("best_fitness"), F.col("run.best_fitness").cast("string"))))
    metrics = F.transform_values("run.validation_metrics", lambda _, v: v.cast("string"))
    sections = F.explode(
        F.array(
            F.struct(F.lit("fitness").alias("section"), plain.alias("pairs")),
            F.struct(F.lit("param").alias("section"), F.col("run.best_params").alias("pairs")),
            F.struct(F.lit("metric").alias("section"), metrics.alias("pairs")),
        )
    )
    return (
        runs.select(*key, "model", "experiment", sections.alias("s"))
        .select(*key, "model", "experiment", "s.section", F.explode("s.pairs").alias("name", "value"))
    )


def epoch_rows(df: DataFrame, run: str, phase: str, text: str) -> DataFrame:
    """(run, metric, epoch, value) with the phases of a run joined end to end.

    The epoch offset of a phase is the running length of the phases before it. While the phases lie in one cell, as they
    do unless a run has thousands of them, the rows move once, by their run; otherwise the cells of a run are spread.
    """
    entries = F.explode_outer(F.from_json(text, HISTORY_SCHEMA)).alias("metric", "values")
    docs = df.select(run, phase, entries).filter("metric IS NOT NULL")
    cell = F.floor(F.col(phase) / PHASES_PER_CELL)
    sized = docs.withColumns({"epochs": F.size("values").cast("bigint"), "cell": cell}).filter("cell IS NOT NULL")
    ends = df.agg(F.min(cell).alias("least"), F.max(cell).alias("most")).first()
    if ends["least"] == ends["most"]:
        before = W.partitionBy(run, "metric").orderBy(phase).rowsBetween(W.unboundedPreceding, -1)
        placed = sized.repartition(run).withColumn("upto_before", F.coalesce(F.sum("epochs").over(before), F.lit(0)))
    else:
        placed = prefix_aggregates(sized, [run, "metric"], phase, {"upto": ("sum", "epochs")})
    return placed.select(run, "metric", "upto_before", F.posexplode("values").alias("at", "value")).select(
        run, "metric", (F.col("upto_before") + F.col("at")).alias("epoch"), "value"
    )


def stream_outputs(df: DataFrame, key: Sequence[str], text: str) -> DataFrame:
    """Stream texts of code cells that have outputs."""
    cells = df.select(*key, F.posexplode(F.from_json(text, NOTEBOOK_SCHEMA)["cells"]).alias("cell", "c"))
    code = cells.filter((F.col("c.cell_type") == "code") & (F.size("c.outputs") > 0))
    outputs = code.select(*key, "cell", F.posexplode("c.outputs").alias("output", "o"))
    return outputs.filter(F.col("o.output_type") == "stream").select(*key, "cell", "output", "o.text")


def as_json(*columns: str | Column) -> Column:
    """One document per row; nested structs, maps and arrays become JSON."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_json_lines(df: DataFrame, path: str, *columns: str) -> None:
    df.select(as_json(*(columns or df.columns)).alias("value")).write.mode("overwrite").text(path)


def write_cache(df: DataFrame, path: str) -> None:
    """Append texts made in this run; earlier ones stay."""
    df.write.mode("append").parquet(path)
