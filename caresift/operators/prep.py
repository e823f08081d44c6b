"""Feature preparation: parameters fitted on the training rows, applied as expressions.

A fitted parameter set is small (a few numbers per column), so it lives on the
driver like any Spark ML model and enters later plans as literals.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresift.operators.ordering import exact_quantiles
from caresift.operators.profile import long_form


@dataclass
class Preparation:
    categorical: list[str]
    numeric: list[str]
    modes: dict[str, str | None] = field(default_factory=dict)
    levels: dict[str, list[str]] = field(default_factory=dict)
    medians: dict[str, float | None] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    scales: dict[str, float] = field(default_factory=dict)

    @property
    def feature_names(self) -> list[str]:
        coded = [f"{c}_{level}" for c in self.categorical for level in self.levels[c]]
        return coded + list(self.numeric)


def column_roles(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    """(categorical, numeric) by column type."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    numeric = [c for c in features if kinds[c] not in ("string", "boolean", "char", "varchar")]
    return [c for c in features if c not in numeric], numeric


def modes_and_levels(df: DataFrame, columns: Sequence[str]) -> tuple[dict, dict]:
    """Most frequent value (smallest on a tie) and sorted levels of each column.

    Counting and the choice of the mode stay with Spark; one row a column comes to the driver, with
    the levels that become its coded features, as in a Spark ML string index.
    """
    if not columns:
        return {}, {}
    entries = F.explode(
        F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns])
    )
    counts = (
        df.select(entries.alias("e")).select("e.*").filter("v is not null").groupBy("c", "v").agg(F.count("*").alias("n"))
    )
    commonest = F.min(F.struct((-F.col("n")).alias("n"), "v"))["v"].alias("mode")
    rows = {r["c"]: r for r in counts.groupBy("c").agg(commonest, F.array_sort(F.collect_list("v")).alias("levels")).collect()}
    modes = {c: rows[c]["mode"] if c in rows else None for c in columns}
    return modes, {c: rows[c]["levels"] if c in rows else [] for c in columns}


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    if not columns:
        return {}
    found = exact_quantiles(long_form(df, columns), ["column"], "value", [0.5], ["median"]).collect()
    table = {r["column"]: r["median"] for r in found}
    return {c: table.get(c) for c in columns}


def fit_preparation(train: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> Preparation:
    """Learn modes, levels, medians, means and population deviations from training rows only."""
    prep = Preparation(list(categorical), list(numeric))
    prep.modes, prep.levels = modes_and_levels(train, categorical)
    prep.medians = medians(train, numeric)
    if numeric:
        filled = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(prep.medians[c])) for c in numeric]
        row = train.agg(
            *[F.avg(x).alias(f"m{i}") for i, x in enumerate(filled)],
            *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(filled)],
        ).first()
        for i, c in enumerate(numeric):
            prep.means[c] = row[f"m{i}"] or 0.0
            prep.scales[c] = row[f"s{i}"] or 1.0
    return prep


def imputed(df: DataFrame, prep: Preparation) -> DataFrame:
    filled = {c: F.coalesce(F.col(f"`{c}`"), F.lit(prep.modes[c])) for c in prep.categorical}
    filled |= {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(prep.medians[c])) for c in prep.numeric}
    return df.withColumns(filled)


def standardized(df: DataFrame, prep: Preparation) -> DataFrame:
    """(x - mean) / population deviation; a constant column is only centred."""
    return df.withColumns(
        {c: (F.col(f"`{c}`") - F.lit(prep.means[c])) / F.lit(prep.scales[c]) for c in prep.numeric}
    )


def one_hot(df: DataFrame, prep: Preparation) -> DataFrame:
    """One 0/1 column per level; an unseen level gives zeros everywhere."""
    return df.withColumns(
        {
            f"{c}_{level}": F.coalesce((F.col(f"`{c}`") == level).cast("double"), F.lit(0.0))
            for c in prep.categorical
            for level in prep.levels[c]
        }
    )


def prepared(df: DataFrame, prep: Preparation) -> DataFrame:
    """Impute, code and scale."""
    return one_hot(standardized(imputed(df, prep), prep), prep)


def assembled(df: DataFrame, prep: Preparation, out: str = "features") -> DataFrame:
    """The prepared features as one vector, coded columns first, then numeric ones."""
    ready = standardized(imputed(df, prep), prep)
    coded = [c for c in prep.categorical if prep.levels[c]]
    text, place, codes = ([f"{kind}{i}__prep" for i in range(len(coded))] for kind in ("t", "i", "c"))
    numbers = [f"n{i}__prep" for i in range(len(prep.numeric))]
    added = {t: F.col(f"`{c}`").cast("string") for t, c in zip(text, coded)}
    added |= {n: F.col(f"`{c}`") for n, c in zip(numbers, prep.numeric)}
    rows = ready.withColumns(added) if added else ready
    if coded:
        # unseen levels share the last place, which the encoder drops: zeros everywhere
        index = StringIndexerModel.from_arrays_of_labels(
            [prep.levels[c] for c in coded], inputCols=text, outputCols=place, handleInvalid="keep"
        )
        rows = index.transform(rows)
        rows = OneHotEncoder(inputCols=place, outputCols=codes, dropLast=True).fit(rows).transform(rows)
    rows = VectorAssembler(inputCols=[*codes, *numbers], outputCol=out, handleInvalid="keep").transform(rows)
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], out)
