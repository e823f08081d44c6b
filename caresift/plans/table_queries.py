"""Schema, profiling, splitting and preparation queries over the survey view."""

from __future__ import annotations

from pyspark.sql import functions as F

from caresift.operators import prep as P
from caresift.operators import profile as C
from caresift.operators import schema as B
from caresift.operators import split as D
from caresift.operators.scoring import risk_band
from caresift.plans.registry import query, r6, rounded
from caresift.plans.views import (
    BAND_SQL,
    LABELLED,
    SCORED,
    SURVEY,
    SURVEY_COLUMNS,
    SURVEY_NUMBERS,
    labelled,
    scored,
    survey,
)
from caresift.session import spread
from caresift.sources.tables import table

# --- schema -----------------------------------------------------------------------


@query(
    "b01_spaced_names",
    f"""WITH {SURVEY} SELECT case_key, "AGE", "CHRONIC DISEASE" AS "CHRONIC DISEASE", "SMOKING" AS "YELLOW FINGERS", "COUGHING" AS "CHEST PAIN" FROM survey""",
)
def spaced_names(spark, sf):
    raw = survey(spark, sf).select(
        "case_key",
        "AGE",
        F.col("CHRONIC DISEASE").alias("CHRONIC_DISEASE"),
        F.col("SMOKING").alias("YELLOW_FINGERS"),
        F.col("COUGHING").alias("CHEST_PAIN"),
    )
    return B.spaced_names(raw)


_NAME = "' ' || p_name || '--' || p_brand || ' '"


@query(
    "b02_joined_key",
    f"SELECT p_partkey, trim(regexp_replace(upper(trim({_NAME})), '[^0-9A-Za-z]+', '_', 'g'), '_') AS name_key FROM part",
)
def joined_key(spark, sf):
    name = F.concat(F.lit(" "), "p_name", F.lit("--"), "p_brand", F.lit(" "))
    return table(spark, sf, "part").select("p_partkey", B.joined_key_column(name).alias("name_key"))


@query(
    "b03_compact_key",
    f"SELECT p_partkey, regexp_replace(upper(trim({_NAME})), '[^0-9A-Za-z]+', '', 'g') AS name_key FROM part",
)
def compact_key(spark, sf):
    name = F.concat(F.lit(" "), "p_name", F.lit("--"), "p_brand", F.lit(" "))
    return table(spark, sf, "part").select("p_partkey", B.compact_key_column(name).alias("name_key"))


@query(
    "b04_aligned_columns",
    f'WITH {SURVEY} SELECT "GENDER", "AGE", "SMOKING", "COUGHING", "CHRONIC DISEASE", case_key AS "CASE KEY" FROM survey',
)
def aligned_columns(spark, sf):
    odd = survey(spark, sf).select(
        F.col("CHRONIC DISEASE").alias("chronic_disease "),
        F.col("COUGHING").alias(" Coughing"),
        F.col("LUNG_CANCER"),
        F.col("case_key"),
        F.col("AGE").alias("age"),
        F.col("SMOKING").alias("SMOKING "),
        F.col("GENDER").alias("gender"),
    )
    return B.aligned(odd, [*SURVEY_COLUMNS, "CASE KEY"])


@query(
    "b04_missing_columns",
    """SELECT 'error' AS status, 'CSV missing required columns: [''COUGHING'', ''CHRONIC DISEASE'']' AS message, count(*) AS n_rows FROM lineitem""",
)
def missing_columns(spark, sf):
    short = survey(spark, sf).select("GENDER", "AGE", "SMOKING")
    status, message = B.alignment_status(short, SURVEY_COLUMNS)
    return short.agg(F.lit(status).alias("status"), F.lit(message).alias("message"), F.count("*").alias("n_rows"))


@query(
    "b05_coded_target",
    f"""WITH {SURVEY} SELECT case_key, CASE "LUNG_CANCER" WHEN 'YES' THEN 1 WHEN 'NO' THEN 0 END AS y_true FROM survey""",
)
def coded_target(spark, sf):
    return B.coded_target(survey(spark, sf), "LUNG_CANCER").select("case_key", "y_true")


@query(
    "b06_lenient_target",
    f"""WITH {SURVEY} SELECT case_key, CASE "LUNG_CANCER" WHEN 'YES' THEN 1 ELSE 0 END AS y_true FROM survey""",
)
def lenient_target(spark, sf):
    loose = survey(spark, sf).withColumn("LUNG_CANCER", F.concat(F.lit(" "), F.lower("LUNG_CANCER"), F.lit(" ")))
    return B.lenient_target(loose, "LUNG_CANCER").select("case_key", "y_true")


@query(
    "b06_lenient_target_codes",
    "SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS y_true FROM orders",
)
def lenient_target_codes(spark, sf):
    return B.lenient_target(table(spark, sf, "orders"), "o_orderpriority").select("o_orderkey", "y_true")


@query(
    "b07_codes_of_many_levels",
    "SELECT l_orderkey, l_linenumber, dense_rank() OVER (ORDER BY l_orderkey::VARCHAR) - 1 AS order_code FROM lineitem",
)
def codes_of_many_levels(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("order_text"))
    return B.ordinal_codes(lines, "order_text", "order_code").select("l_orderkey", "l_linenumber", "order_code")


@query(
    "b07_ordinal_codes",
    "SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS type_code FROM part",
)
def ordinal_codes(spark, sf):
    return B.ordinal_codes(table(spark, sf, "part"), "p_type", "type_code").select("p_partkey", "type_code")


@query(
    "b08_group_column",
    f"""WITH {SURVEY} SELECT grp, count(*) AS n FROM (SELECT coalesce("GENDER", 'nan') AS grp FROM survey UNION ALL SELECT 'all' FROM survey) GROUP BY grp""",
)
def group_column(spark, sf):
    rows = survey(spark, sf)
    present = B.with_group(rows, "GENDER").select("grp")
    absent = B.with_group(rows.drop("GENDER"), "GENDER").select("grp")
    return present.unionByName(absent).groupBy("grp").agg(F.count("*").alias("n"))


# --- profile ----------------------------------------------------------------------


@query(
    "c01_preview",
    "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
)
def preview(spark, sf):
    return C.preview(table(spark, sf, "orders"), ["o_orderkey"])


@query("c02_shape", f"WITH {SURVEY} SELECT count(*) AS n_rows, 7::BIGINT AS n_columns FROM survey")
def shape(spark, sf):
    return C.shape(survey(spark, sf))


_ALL = ["case_key", *SURVEY_COLUMNS, "LUNG_CANCER"]


@query(
    "c03_null_counts",
    f"WITH {SURVEY} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE "{c}" IS NULL) AS nulls FROM survey""" for c in _ALL
    ),
)
def null_counts(spark, sf):
    return C.null_counts(survey(spark, sf))


@query(
    "c04_schema_report",
    f"WITH {SURVEY} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{"string" if c in ("case_key", "GENDER", "LUNG_CANCER") else "int"}' AS type, count("{c}") AS non_null FROM survey"""
        for c in _ALL
    ),
)
def schema_report(spark, sf):
    return C.schema_report(survey(spark, sf))


def _describe_sql(source: str, columns: dict[str, str], where: str = "") -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        round(min({c})::DOUBLE, 6) AS "min", round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50,
        round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75, round(max({c})::DOUBLE, 6) AS "max" FROM {source} {where}"""
        for name, c in columns.items()
    )


_DESCRIBED = ["mean", "std", "min", "p25", "p50", "p75", "max"]


@query("c05_describe", f"WITH {SURVEY} " + _describe_sql("survey", {c: f'"{c}"' for c in SURVEY_NUMBERS}))
def describe(spark, sf):
    return rounded(C.describe(survey(spark, sf), SURVEY_NUMBERS), *_DESCRIBED)


@query(
    "c05_describe_continuous",
    _describe_sql("lineitem", {c: c for c in ("l_extendedprice", "l_quantity", "l_discount")}),
)
def describe_continuous(spark, sf):
    return rounded(
        C.describe(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity", "l_discount"]), *_DESCRIBED
    )


@query(
    "c05_describe_positives",
    f"WITH {SURVEY} " + _describe_sql("survey", {c: f'"{c}"' for c in SURVEY_NUMBERS}, "WHERE \"LUNG_CANCER\" = 'YES'"),
)
def describe_positives(spark, sf):
    rows = C.positives(survey(spark, sf), "LUNG_CANCER")
    return rounded(C.describe(rows, SURVEY_NUMBERS), *_DESCRIBED)


_PLAIN = ", ".join(f'"{c}"' for c in [*SURVEY_COLUMNS, "LUNG_CANCER"])


@query(
    "c06_duplicate_count",
    f"WITH {SURVEY} SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM survey GROUP BY {_PLAIN})",
)
def duplicate_count(spark, sf):
    return C.duplicate_count(survey(spark, sf).drop("case_key"))


@query("c07_without_duplicates", f"WITH {SURVEY} SELECT DISTINCT {_PLAIN} FROM survey")
def without_duplicates(spark, sf):
    return C.without_duplicates(survey(spark, sf).drop("case_key"))


@query("c07_distinct_documents", f"WITH {LABELLED} SELECT DISTINCT text, lang, quality, toxic FROM labelled")
def distinct_documents(spark, sf):
    return C.without_duplicates(labelled(spark, sf).select("text", "lang", "quality", "toxic"))


@query(
    "c08_value_counts",
    f'WITH {SURVEY} SELECT "AGE", count(*) AS n FROM survey WHERE "AGE" IS NOT NULL GROUP BY "AGE" ORDER BY n DESC, "AGE"',
)
def value_counts(spark, sf):
    return C.value_counts(survey(spark, sf), "AGE")


@query(
    "c09_named_value_counts",
    f"""WITH {SCORED} SELECT y_true, CASE y_true WHEN 0 THEN 'nao_maligno' ELSE 'maligno' END AS name, count(*) AS n FROM scored GROUP BY y_true""",
)
def named_value_counts(spark, sf):
    return C.named_value_counts(scored(spark, sf), "y_true", {0: "nao_maligno", 1: "maligno"})


@query(
    "c10_class_share_by_split",
    f"""WITH {LABELLED}, c AS (SELECT lang, quality, count(*) AS n FROM labelled GROUP BY ALL)
    SELECT lang, quality, n, round(n::DOUBLE / sum(n) OVER (PARTITION BY lang), 6) AS share FROM c""",
)
def class_share_by_split(spark, sf):
    return rounded(C.class_share(labelled(spark, sf), "quality", "lang"), "share")


@query(
    "c10_class_share",
    f"""WITH {SURVEY} SELECT "LUNG_CANCER", count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM survey), 6) AS share
    FROM survey GROUP BY "LUNG_CANCER" """,
)
def class_share(spark, sf):
    return rounded(C.class_share(survey(spark, sf), "LUNG_CANCER"), "share")


@query(
    "c11_positive_rate",
    f"""WITH {SURVEY}, c AS (SELECT count(*) AS total, count(*) FILTER (WHERE "LUNG_CANCER" = 'YES') AS positives,
      count(*) FILTER (WHERE "LUNG_CANCER" = 'NO') AS negatives FROM survey)
    SELECT *, round(round_even(positives::DOUBLE / total * 100, 0) / 100 * 100, 6) AS positive_pct FROM c""",
)
def positive_rate(spark, sf):
    return rounded(C.positive_rate(survey(spark, sf), "LUNG_CANCER"), "positive_pct")


@query("c12_positives", f"WITH {SURVEY} SELECT * FROM survey WHERE \"LUNG_CANCER\" = 'YES'")
def positives(spark, sf):
    return C.positives(survey(spark, sf), "LUNG_CANCER")


@query(
    "c13_factor_counts",
    f"WITH {SURVEY} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS factor, "{c}"::DOUBLE AS value, count(*) AS n FROM survey WHERE "{c}" IS NOT NULL AND "LUNG_CANCER" = 'YES' GROUP BY "{c}" """
        for c in SURVEY_NUMBERS
    ),
)
def factor_counts(spark, sf):
    return C.factor_counts(C.positives(survey(spark, sf), "LUNG_CANCER"), SURVEY_NUMBERS)


@query(
    "c13_text_factor_counts",
    f"WITH {SURVEY} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS factor, "{c}"::VARCHAR AS value, count(*) AS n FROM survey WHERE "{c}" IS NOT NULL GROUP BY "{c}" """
        for c in ("GENDER", "LUNG_CANCER", "SMOKING")
    ),
)
def text_factor_counts(spark, sf):
    return C.factor_counts(survey(spark, sf), ["GENDER", "LUNG_CANCER", "SMOKING"])


_BOX = """round(max(q1), 6) AS q1, round(max(median), 6) AS median, round(max(q3), 6) AS q3,
  round(min(v) FILTER (WHERE v BETWEEN lo AND hi), 6) AS whisker_low, round(max(v) FILTER (WHERE v BETWEEN lo AND hi), 6) AS whisker_high,
  count(*) FILTER (WHERE NOT v BETWEEN lo AND hi) AS outliers"""
_BOX_COLUMNS = ["q1", "median", "q3", "whisker_low", "whisker_high"]


@query(
    "c14_box_stats",
    f"""WITH {SURVEY}, f AS (SELECT "LUNG_CANCER", quantile_cont("AGE"::DOUBLE, 0.25) AS q1, quantile_cont("AGE"::DOUBLE, 0.5) AS median,
      quantile_cont("AGE"::DOUBLE, 0.75) AS q3 FROM survey GROUP BY 1),
    j AS (SELECT s."LUNG_CANCER", s."AGE"::DOUBLE AS v, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
      FROM survey s JOIN f ON s."LUNG_CANCER" = f."LUNG_CANCER" WHERE s."AGE" IS NOT NULL)
    SELECT "LUNG_CANCER", {_BOX} FROM j GROUP BY 1""",
)
def box_stats(spark, sf):
    return rounded(C.box_stats(survey(spark, sf), "AGE", ["LUNG_CANCER"]), *_BOX_COLUMNS)


@query(
    "c14_box_stats_with_gaps",
    f"""WITH {SURVEY}, f AS (SELECT "GENDER", quantile_cont("AGE"::DOUBLE, 0.25) AS q1, quantile_cont("AGE"::DOUBLE, 0.5) AS median,
      quantile_cont("AGE"::DOUBLE, 0.75) AS q3 FROM survey GROUP BY 1),
    j AS (SELECT s."GENDER", s."AGE"::DOUBLE AS v, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
      FROM survey s JOIN f ON s."GENDER" IS NOT DISTINCT FROM f."GENDER" WHERE s."AGE" IS NOT NULL)
    SELECT "GENDER", {_BOX} FROM j GROUP BY 1""",
)
def box_stats_with_gaps(spark, sf):
    return rounded(C.box_stats(survey(spark, sf), "AGE", ["GENDER"]), *_BOX_COLUMNS)


@query(
    "c14_box_stats_all",
    f"""WITH f AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM events),
    j AS (SELECT value AS v, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM events CROSS JOIN f)
    SELECT {_BOX} FROM j""",
)
def box_stats_all(spark, sf):
    return rounded(C.box_stats(table(spark, sf, "events"), "value"), *_BOX_COLUMNS)


@query(
    "c15_histogram",
    """WITH b AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 10 AS w FROM events),
    c AS (SELECT CAST(least(floor((value - lo) / w), 9) AS INTEGER) AS bin, count(*) AS n FROM events CROSS JOIN b GROUP BY 1)
    SELECT CAST(r AS INTEGER) AS bin, round(lo + r * w, 6) AS lower, round(lo + (r + 1) * w, 6) AS upper, coalesce(n, 0) AS n
    FROM range(10) t(r) CROSS JOIN b LEFT JOIN c ON c.bin = r""",
)
def histogram(spark, sf):
    return rounded(C.histogram(table(spark, sf, "events"), "value"), "lower", "upper")


_CORR = [*SURVEY_NUMBERS, "TARGET"]
_CORR_SQL = f"""WITH {SURVEY}, x AS (SELECT *, CASE "LUNG_CANCER" WHEN 'YES' THEN 1 ELSE 0 END AS "TARGET" FROM survey)"""


@query(
    "c16_correlation_matrix",
    f"{_CORR_SQL} " + " UNION ALL ".join(
        f"""SELECT '{a}' AS a, '{b}' AS b, round_even(corr("{a}", "{b}") * 100, 0)::DOUBLE / 100 AS corr FROM x"""
        for a in _CORR
        for b in _CORR
    ),
)
def correlation_matrix(spark, sf):
    rows = survey(spark, sf).withColumn("TARGET", (F.col("LUNG_CANCER") == "YES").cast("int"))
    return C.correlation_matrix(rows, _CORR)


@query(
    "c17_target_correlations",
    f"{_CORR_SQL} " + " UNION ALL ".join(
        f"""SELECT '{a}' AS feature, round_even(corr("{a}", "TARGET") * 100, 0)::DOUBLE / 100 AS corr FROM x"""
        for a in SURVEY_NUMBERS
    ),
)
def target_correlations(spark, sf):
    rows = survey(spark, sf).withColumn("TARGET", (F.col("LUNG_CANCER") == "YES").cast("int"))
    return C.target_correlations(rows, SURVEY_NUMBERS, "TARGET")


# --- splits -------------------------------------------------------------------------


def split_sql(source: str, key: str, label: str, first: str, second: str, names: tuple[str, str, str], seed: int = 42) -> str:
    """Assignment by rank inside the class, all rows ranked at once."""
    return f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5('{seed}|' || {key})) AS rk,
        count(*) OVER (PARTITION BY {label}) AS n FROM {source}),
      parts AS (SELECT *, CASE WHEN rk <= {first} THEN '{names[0]}' WHEN rk <= {second} THEN '{names[1]}' ELSE '{names[2]}' END AS split FROM ranked)"""


CUT60 = ("floor(n * 0.6::DOUBLE + 0.5)", "floor(n * 0.8::DOUBLE + 0.5)")
CUT70 = ("floor(n * 0.7::DOUBLE + 0.5)", "floor(n * 0.85::DOUBLE + 0.5)")
_CUT20 = (
    "floor(n * 0.2::DOUBLE + 0.5)",
    "floor(n * 0.2::DOUBLE + 0.5) + floor((n - floor(n * 0.2::DOUBLE + 0.5)) * 0.25::DOUBLE + 0.5)",
)
TVT = ("train", "val", "test")


@query(
    "d01_split_60_20_20",
    f"WITH {SCORED}, {split_sql('scored', 'case_key', 'y_true', *CUT60, TVT)} SELECT case_key, y_true, split FROM parts",
)
def split_60_20_20(spark, sf):
    return D.split_60_20_20(scored(spark, sf), "case_key", "y_true").select("case_key", "y_true", "split")


_GAPS = "gaps AS (SELECT case_key, CASE WHEN part_no % 11 <> 0 THEN y_true END AS y_true FROM scored)"


@query(
    "d01_split_with_gaps",
    f"WITH {SCORED}, {_GAPS}, {split_sql('gaps', 'case_key', 'y_true', *CUT60, TVT)} SELECT case_key, y_true, split FROM parts",
)
def split_with_gaps(spark, sf):
    rows = scored(spark, sf).select("case_key", F.when(F.col("part_no") % 11 != 0, F.col("y_true")).alias("y_true"))
    return D.split_60_20_20(rows, "case_key", "y_true").select("case_key", "y_true", "split")


@query(
    "d02_split_test_first",
    f"WITH {SCORED}, {split_sql('scored', 'case_key', 'y_true', *_CUT20, ('test', 'val', 'train'))} SELECT case_key, y_true, split FROM parts",
)
def split_test_first(spark, sf):
    return D.split_test_first(scored(spark, sf), "case_key", "y_true").select("case_key", "y_true", "split")


@query(
    "d03_split_70_15_15",
    f"WITH {split_sql('embeddings', 'vec_id', 'label', *CUT70, TVT)} SELECT vec_id, label, split FROM parts",
)
def split_70_15_15(spark, sf):
    vectors = table(spark, sf, "embeddings").withColumn("key", F.col("vec_id").cast("string"))
    return D.stratified_split(vectors, "key", "label", 0.15, 0.15).select("vec_id", "label", "split")


@query(
    "d04_split_report",
    f"""WITH {SCORED}, {split_sql('scored', 'case_key', 'y_true', *CUT60, TVT)},
    c AS (SELECT split, y_true, count(*) AS n FROM parts GROUP BY ALL)
    SELECT split, y_true, n, round(n::DOUBLE / sum(n) OVER (PARTITION BY split), 6) AS share FROM c""",
)
def split_report(spark, sf):
    return rounded(D.split_report(D.split_60_20_20(scored(spark, sf), "case_key", "y_true"), "y_true"), "share")


@query(
    "d05_shuffle",
    f"WITH {SCORED} SELECT case_key, row_number() OVER (ORDER BY md5('42|' || case_key), case_key) - 1 AS position FROM scored",
)
def shuffle(spark, sf):
    return D.shuffled(scored(spark, sf).select("case_key"), "case_key")


_SAMPLE = f"""WITH {SCORED}, r AS (SELECT *, {BAND_SQL} AS risk_level, row_number() OVER (ORDER BY y_prob, md5(case_key), case_key) - 1 AS pos FROM scored),
  p AS (SELECT DISTINCT CAST(round_even(i * ((SELECT count(*) FROM scored) - 1)::DOUBLE / 7, 0) AS BIGINT) AS pos FROM range(8) t(i)),
  s AS (SELECT row_number() OVER (ORDER BY pos) AS case_id, case_key, y_prob, risk_level FROM r JOIN p USING (pos))"""


@query("d06_quantile_sample", f"{_SAMPLE} SELECT * FROM s")
def quantile_sample(spark, sf):
    rows = D.quantile_sample(scored(spark, sf), "y_prob", "case_key", 8)
    return rows.select("case_id", "case_key", "y_prob", risk_band().alias("risk_level"))


@query(
    "d07_first_per_class",
    f"""WITH {SCORED}, r AS (SELECT case_key, model, CAST(row_number() OVER (PARTITION BY model ORDER BY case_key) AS INTEGER) AS rank_in_class FROM scored)
    SELECT * FROM r WHERE rank_in_class <= 3""",
)
def first_per_class(spark, sf):
    return D.first_per_class(scored(spark, sf).select("case_key", "model"), "model", "case_key", 3)


@query(
    "d08_train_and_val",
    f"""WITH {SCORED}, {split_sql('scored', 'case_key', 'y_true', *CUT60, TVT)} SELECT case_key, split FROM parts WHERE split <> 'test'""",
)
def train_and_val(spark, sf):
    return D.train_and_val(D.split_60_20_20(scored(spark, sf), "case_key", "y_true")).select("case_key", "split")


@query(
    "d09_binary_class_weights",
    f"""WITH {LABELLED}, c AS (SELECT count(*) AS n, greatest(count(*) FILTER (WHERE toxic = 0), 1) AS n0, greatest(count(*) FILTER (WHERE toxic = 1), 1) AS n1 FROM labelled)
    SELECT 0 AS label, round(n / (2.0::DOUBLE * n0), 6) AS weight FROM c UNION ALL SELECT 1, round(n / (2.0::DOUBLE * n1), 6) FROM c""",
)
def binary_class_weights(spark, sf):
    return rounded(D.binary_class_weights(labelled(spark, sf), "toxic"), "weight")


@query(
    "d10_balanced_class_weights",
    """WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label)
    SELECT label, n, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n)::DOUBLE, 6) AS weight FROM c""",
)
def balanced_class_weights(spark, sf):
    return rounded(D.balanced_class_weights(table(spark, sf, "embeddings"), "label"), "weight")


@query(
    "d11_sample_coverage",
    f"""{_SAMPLE} SELECT count(*) AS n, round(min(y_prob), 6) AS min_score, round(max(y_prob), 6) AS max_score,
    (SELECT string_agg(risk_level, ', ' ORDER BY risk_level) FROM (SELECT DISTINCT risk_level FROM s)) AS bands FROM s""",
)
def sample_coverage(spark, sf):
    return rounded(D.sample_coverage(quantile_sample(spark, sf), "y_prob", "risk_level"), "min_score", "max_score")


# --- preparation ------------------------------------------------------------------------

_PARTS = f"""WITH {SURVEY}, {split_sql('survey', 'case_key', '"LUNG_CANCER"', *CUT60, TVT)}, tr AS (SELECT * FROM parts WHERE split = 'train')"""
_MODE = """(SELECT "GENDER" FROM tr WHERE "GENDER" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"""


def _split(spark, sf):
    return D.split_60_20_20(spread(survey(spark, sf)), "case_key", "LUNG_CANCER", stored=True)


def _fitted(spark, sf):
    rows = _split(spark, sf)
    return rows, P.fit_preparation(rows.filter("split = 'train'"), ["GENDER"], SURVEY_NUMBERS)


@query("e01_mode_imputation", f"""{_PARTS} SELECT case_key, coalesce("GENDER", {_MODE}) AS "GENDER" FROM parts""")
def mode_imputation(spark, sf):
    rows, prep = _fitted(spark, sf)
    return P.imputed(rows, prep).select("case_key", "GENDER")


@query(
    "e02_median_imputation",
    f"""{_PARTS} SELECT case_key, coalesce("AGE"::DOUBLE, (SELECT median("AGE") FROM tr)) AS "AGE" FROM parts""",
)
def median_imputation(spark, sf):
    rows, prep = _fitted(spark, sf)
    return P.imputed(rows, prep).select("case_key", "AGE")


@query(
    "e03_one_hot",
    f"""{_PARTS} SELECT case_key, CASE WHEN "GENDER" = 'F' THEN 1.0::DOUBLE ELSE 0 END AS "GENDER_F",
    CASE WHEN "GENDER" = 'M' THEN 1.0::DOUBLE ELSE 0 END AS "GENDER_M" FROM parts""",
)
def one_hot(spark, sf):
    rows, prep = _fitted(spark, sf)
    return P.one_hot(rows, prep).select("case_key", "GENDER_F", "GENDER_M")


_STD_SQL = ", ".join(
    f"""round((coalesce("{c}"::DOUBLE, (SELECT median("{c}") FROM tr)) - (SELECT avg(coalesce("{c}"::DOUBLE, (SELECT median("{c}") FROM tr))) FROM tr))
     / (SELECT stddev_pop(coalesce("{c}"::DOUBLE, (SELECT median("{c}") FROM tr))) FROM tr), 6) AS "{c}" """
    for c in SURVEY_NUMBERS
)


@query("e04_standardized", f"{_PARTS} SELECT case_key, {_STD_SQL} FROM parts WHERE split = 'train'")
def standardized(spark, sf):
    rows, prep = _fitted(spark, sf)
    out = P.standardized(P.imputed(rows.filter("split = 'train'"), prep), prep)
    return out.select("case_key", *[r6(F.col(f"`{c}`"), c) for c in SURVEY_NUMBERS])


@query(
    "e05_fit_on_train",
    f"""{_PARTS} SELECT case_key, split, CASE WHEN coalesce("GENDER", {_MODE}) = 'F' THEN 1.0::DOUBLE ELSE 0 END AS "GENDER_F", {_STD_SQL}
    FROM parts WHERE split <> 'train'""",
)
def fit_on_train(spark, sf):
    rows, prep = _fitted(spark, sf)
    out = P.prepared(rows.filter("split <> 'train'"), prep)
    return out.select("case_key", "split", "GENDER_F", *[r6(F.col(f"`{c}`"), c) for c in SURVEY_NUMBERS])


_NAMED = {f"GENDER_{g}": f"CASE WHEN coalesce(\"GENDER\", {_MODE}) = '{g}' THEN 1.0::DOUBLE ELSE 0 END" for g in "FM"}


@query(
    "e06_assembled_features",
    f"""{_PARTS}, z AS (SELECT {', '.join(f'{v} AS "{k}"' for k, v in _NAMED.items())}, {_STD_SQL.replace(', 6) AS', ', 12) AS')} FROM parts) """
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(avg("{c}"), 6) AS mean, count(*) AS n FROM z""" for c in [*_NAMED, *SURVEY_NUMBERS]
    ),
)
def assembled_features(spark, sf):
    from pyspark.ml.functions import vector_to_array

    rows, prep = _fitted(spark, sf)
    out = P.assembled(rows, prep).withColumn("values", vector_to_array("features"))
    names = F.array(*[F.lit(n) for n in prep.feature_names])
    pairs = out.select(F.explode(F.arrays_zip(names.alias("feature"), F.col("values").alias("value"))).alias("p"))
    return rounded(
        pairs.groupBy("p.feature").agg(F.avg("p.value").alias("mean"), F.count("*").alias("n")), "mean"
    )


