"""Audit of explanation texts: cache lookups, checks, pass rates and manual scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresift.functions import constants as K
from caresift.functions import texts as T
from caresift.functions.rates import round_half_even


def with_cached_text(cases: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Cached text per case; null where it has still to be made."""
    return cases.join(cache, key, "left")


def pending(cases: DataFrame, cache: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Cases without a cached text; all of them when forced."""
    return cases if force else cases.join(cache.select(key), key, "left_anti")


def fallback_summary(df: DataFrame, text: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(T.is_fallback(text)).alias("fallbacks"),
        F.count_if(~T.is_fallback(text)).alias("evaluated"),
    )


def evaluated_only(df: DataFrame, text: str) -> DataFrame:
    return df.filter(~T.is_fallback(text))


def check_table(df: DataFrame, key: str, text: str, expected: str) -> DataFrame:
    return df.select(key, *[c.alias(n) for n, c in T.all_checks(text, expected).items()])


def evaluated_checks(df: DataFrame, key: str, text: str, expected: str) -> DataFrame:
    """The checks of all texts that are no fallback: ``check_table`` of ``evaluated_only``, each text made once.

    A filter would be moved below the expression that makes the text, and a copy of that expression into every
    place where the filter names the text. So the text goes through an array of one, or none for a fallback.
    """
    low = df.select(F.col(key).alias("key"), F.col(expected).alias("band"), F.col(text).alias("text")).withColumn("low", T.lowered("text"))
    kept = F.explode(F.when(~T.is_fallback("text", "low"), F.array("text"))).alias("text")
    rows = low.select("key", "band", "low", kept).withColumn("heads", T.section_heads("text"))
    return rows.select(F.col("key").alias(key), *[c.alias(n) for n, c in T.all_checks("text", "band", "low", "heads").items()])


def pass_rates(checks: DataFrame, names: Sequence[str]) -> DataFrame:
    """Share of cases that pass each check, in percent with one place, best first."""
    rates = checks.agg(
        *[round_half_even(F.avg(F.col(n).cast("int")) * 100, 1).alias(n) for n in names]
    )
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("pass_rate")) for n in names]))
    return rates.select(rows.alias("e")).select("e.*").orderBy(F.desc("pass_rate"), "check")


def extremes(table: DataFrame, name: str, value: str) -> DataFrame:
    """Best and worst entry (first by name on ties) and the overall mean."""
    return table.agg(
        F.min_by(name, F.struct((-F.col(value)).alias("v"), F.col(name))).alias("best"),
        F.max(value).alias("best_value"),
        F.min_by(name, F.struct(F.col(value).alias("v"), F.col(name))).alias("worst"),
        F.min(value).alias("worst_value"),
        F.avg(value).alias("mean_value"),
    )


def manual_with_cases(manual: DataFrame, cases: DataFrame, key: str, criteria: Sequence[str] = K.CRITERIA) -> DataFrame:
    return manual.join(cases.select(key, "y_prob", "risk_level"), key).select(
        key, "y_prob", "risk_level", *criteria
    )


def any_scored(df: DataFrame, criteria: Sequence[str] = K.CRITERIA) -> DataFrame:
    return df.agg(
        F.count_if(F.coalesce(*[F.col(c) for c in criteria]).isNotNull()).alias("scored"),
        F.count("*").alias("total"),
    )


def long_scores(df: DataFrame, criteria: Sequence[str] = K.CRITERIA) -> DataFrame:
    """(criterion, score); anything that is not a number becomes null."""
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("criterion"), F.col(c).cast("string").try_cast("double").alias("score"))
                for c in criteria
            ]
        )
    )
    return df.select(rows.alias("e")).select("e.*")


def score_statistics(df: DataFrame, criteria: Sequence[str] = K.CRITERIA) -> DataFrame:
    return long_scores(df, criteria).groupBy("criterion").agg(
        F.avg("score").alias("media"),
        F.stddev_samp("score").alias("desvio_padrao"),
        F.count("score").alias("n_avaliado"),
    )


def score_distribution(df: DataFrame, criteria: Sequence[str] = K.CRITERIA) -> DataFrame:
    """Count of every score 1..5, one column per criterion, zeros filled."""
    counts = df.agg(
        *[
            F.count_if(F.col(c).cast("string").try_cast("double") == s).alias(f"{c}_{s}")
            for c in criteria
            for s in range(1, 6)
        ]
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(s).alias("nota"), *[F.col(f"{c}_{s}").alias(c) for c in criteria])
                for s in range(1, 6)
            ]
        )
    )
    return counts.select(rows.alias("e")).select("e.*")


def manual_sentences(manual: DataFrame, criteria: Sequence[str] = K.CRITERIA, first: int = 1) -> DataFrame:
    """What the manual scores say, in numbered sentences; one sentence asks for them while there is none.

    The statistics are one row a criterion, and the sentences are put together by expressions.
    """
    stats = score_statistics(manual, criteria).filter("media IS NOT NULL")
    best = extremes(stats, "criterion", "media")
    mean = F.concat(F.lit(K.MANUAL_MEAN[0]), F.format_string("%.2f", "mean_value"), F.lit(K.MANUAL_MEAN[1]))
    parts = [F.col("best"), F.format_string("%.2f", "best_value"), F.col("worst"), F.format_string("%.2f", "worst_value")]
    ends = F.concat(F.lit(K.MANUAL_EXTREMES[0]), *[x for p, t in zip(parts, K.MANUAL_EXTREMES[1:]) for x in (p, F.lit(t))])
    scored = F.array(
        F.struct(F.lit(first).alias("line"), mean.alias("sentence")), F.struct(F.lit(first + 1).alias("line"), ends.alias("sentence"))
    )
    none = F.array(F.struct(F.lit(first).alias("line"), F.lit(K.MANUAL_MISSING).alias("sentence")))
    lines = F.explode(F.when(F.col("mean_value").isNull(), none).otherwise(scored))
    return best.select(lines.alias("l")).select("l.*")


def summary_sentences(cases: DataFrame, text: str, expected: str, key: str, manual: DataFrame | None = None) -> DataFrame:
    """The audit outcome in numbered sentences, those on the manual scores last if their table is given."""
    counts = fallback_summary(cases, text)
    names = list(T.all_checks(text, expected))
    rates = pass_rates(evaluated_checks(cases, key, text, expected), names)
    best = extremes(rates, "check", "pass_rate")
    c, b = counts.first(), None
    sentences = [
        f"Amostra avaliada: {c['evaluated']} de {c['total']} casos gerados "
        f"({c['fallbacks']} cairam em fallback de erro da API e foram excluidos)."
    ]
    if c["evaluated"]:
        b = best.first()
        sentences += [
            "Taxa media de conformidade automatica (formato, disclaimers, consistencia): "
            f"{b['mean_value']:.1f}%.",
            f"Criterio automatico com menor conformidade: '{b['worst']}' ({b['worst_value']:.0f}%).",
        ]
    else:
        sentences.append("Nenhum caso pode ser avaliado automaticamente (todos cairam em fallback da API).")
    said = cases.sparkSession.createDataFrame(list(enumerate(sentences, start=1)), "line int, sentence string")
    return said if manual is None else said.unionByName(manual_sentences(manual, first=len(sentences) + 1))


def marked_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """Lines of a log text that carry a metric under a baseline heading, or experiment scores."""
    lines = df.select(key, F.col(text).alias("log"), F.explode(F.split(text, "\n")).alias("line"))
    metric = F.col("log").contains(K.BASELINE_MARK) & F.col("line").rlike("|".join(K.METRIC_MARKS))
    score = F.col("line").rlike("|".join(K.SCORE_MARKS))
    kind = F.when(metric, "metric").when(score, "scores")
    return lines.withColumn("kind", kind).filter("kind is not null").select(
        key, F.trim("line").alias("line"), "kind"
    )


def experiment_scores(lines: DataFrame, key: str, line: str = "line") -> DataFrame:
    """The model and the scores out of ``... de MODEL: exp1=..., exp2=..., exp3=...``."""
    out = {"model": F.regexp_extract(line, r"de (\w+):", 1)}
    for mark in K.SCORE_MARKS:
        number = F.regexp_extract(line, mark + r"(-?[0-9.]+)", 1)
        out[mark.rstrip("=")] = number.try_cast("double")
    return lines.select(key, *[c.alias(n) for n, c in out.items()])
