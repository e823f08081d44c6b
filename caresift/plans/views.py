"""Views derived from the driver tables, as DataFrames and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caresift.functions import texts as T
from caresift.operators.scoring import risk_band
from caresift.session import spread
from caresift.sources.tables import table

CASE_KEY_SQL = (
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "CAST(round(l_extendedprice * 100) AS BIGINT))"
)


def case_key():
    return F.concat_ws(
        "-",
        *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
        F.rint(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
    )


SCORED = f"""scored AS (
  SELECT {CASE_KEY_SQL} AS case_key, 'm' || (l_linenumber % 4) AS model, l_linestatus AS grp,
         CAST(l_returnflag = 'R' AS INTEGER) AS y_true, l_quantity / 50 AS y_prob,
         l_extendedprice / 110000 AS y_cont, l_orderkey AS order_no, l_suppkey AS supp_no,
         l_partkey AS part_no, l_linenumber AS line_no
  FROM lineitem)"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """The central scored table, from line items."""
    return table(spark, sf, "lineitem").select(
        case_key().alias("case_key"),
        F.concat(F.lit("m"), F.col("l_linenumber") % 4).alias("model"),
        F.col("l_linestatus").alias("grp"),
        (F.col("l_returnflag") == "R").cast("int").alias("y_true"),
        (F.col("l_quantity") / 50).alias("y_prob"),
        (F.col("l_extendedprice") / 110000).alias("y_cont"),
        F.col("l_orderkey").alias("order_no"),
        F.col("l_suppkey").alias("supp_no"),
        F.col("l_partkey").alias("part_no"),
        F.col("l_linenumber").alias("line_no"),
    )


SURVEY = f"""survey AS (
  SELECT {CASE_KEY_SQL} AS case_key,
         CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_linestatus = 'F' THEN 'F' ELSE 'M' END AS "GENDER",
         CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE CAST(30 + l_quantity AS INTEGER) END AS "AGE",
         CASE WHEN l_discount > 0.05 THEN 2 ELSE 1 END AS "SMOKING",
         CASE WHEN l_tax > 0.04 THEN 2 ELSE 1 END AS "COUGHING",
         CAST(1 + l_suppkey % 2 AS INTEGER) AS "CHRONIC DISEASE",
         CASE WHEN l_returnflag = 'R' THEN 'YES' ELSE 'NO' END AS "LUNG_CANCER"
  FROM lineitem)"""


def survey(spark: SparkSession, sf: str) -> DataFrame:
    """A questionnaire with gaps, from line items."""
    part = F.col("l_partkey")
    return table(spark, sf, "lineitem").select(
        case_key().alias("case_key"),
        F.when(part % 11 == 0, None).when(F.col("l_linestatus") == "F", "F").otherwise("M").alias("GENDER"),
        F.when(part % 10 == 0, None).otherwise((30 + F.col("l_quantity")).cast("int")).alias("AGE"),
        F.when(F.col("l_discount") > 0.05, 2).otherwise(1).alias("SMOKING"),
        F.when(F.col("l_tax") > 0.04, 2).otherwise(1).alias("COUGHING"),
        (1 + F.col("l_suppkey") % 2).cast("int").alias("CHRONIC DISEASE"),
        F.when(F.col("l_returnflag") == "R", "YES").otherwise("NO").alias("LUNG_CANCER"),
    )


SURVEY_COLUMNS = ["GENDER", "AGE", "SMOKING", "COUGHING", "CHRONIC DISEASE"]
SURVEY_NUMBERS = ["AGE", "SMOKING", "COUGHING", "CHRONIC DISEASE"]

BAND_SQL = "CASE WHEN y_prob >= 0.7 THEN 'alto' WHEN y_prob >= 0.4 THEN 'moderado' ELSE 'baixo' END"
PERCENT_SQL = "printf('%.2f', y_prob * 100) || '%'"

_OPENING = ("Resumo: o modelo ", " indicou probabilidade de ", " na triagem.\n\nRisco: ")
_BASIS = ".\n\nJustificativa: a probabilidade foi comparada com o limiar de 50.00% definido na validação.\n\n"
_ADVICE = "Recomendação: correlacionar com o quadro clínico e acompanhar conforme o protocolo do serviço.\n\n"
_NOTE = "Observação: este resultado é apoio à decisão clínica e não substitui a avaliação médica."
_BANNED = "\n\nNota: o paciente possui a doença."
_FAILED = (
    "O modelo ",
    " indicou uma probabilidade estimada de ",
    ", classificada como risco ",
    ". Nao foi possivel gerar a interpretacao pela LLM neste momento. Detalhes tecnicos: 429 RESOURCE_EXHAUSTED",
)


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


TEXTS = f"""texts AS (
  SELECT case_key, model, y_prob, risk_level, CASE order_no % 6
      WHEN 0 THEN opening || risk_level || {_q(_BASIS + _ADVICE + _NOTE)}
      WHEN 1 THEN opening || risk_level || {_q(_BASIS + _NOTE)}
      WHEN 2 THEN opening || CASE risk_level WHEN 'alto' THEN 'baixo' ELSE 'alto' END || {_q(_BASIS + _ADVICE + _NOTE)}
      WHEN 3 THEN opening || risk_level || {_q(_BASIS + _ADVICE + _NOTE + _BANNED)}
      WHEN 4 THEN 'Resumo: texto curto.' || chr(10) || 'Risco: ' || risk_level
      ELSE {_q(_FAILED[0])} || model || {_q(_FAILED[1])} || pct || {_q(_FAILED[2])} || risk_level || {_q(_FAILED[3])}
    END AS text
  FROM (SELECT *, {_q(_OPENING[0])} || model || {_q(_OPENING[1])} || pct || {_q(_OPENING[2])} AS opening
        FROM (SELECT *, {BAND_SQL} AS risk_level, {PERCENT_SQL} AS pct FROM scored)))"""


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """One explanation per scored row, with a defect planted by order number."""
    rows = scored(spark, sf).select("case_key", "model", "y_prob", "order_no")
    base = spread(rows).withColumn("risk_level", risk_band()).withColumn("pct", T.percent_text("y_prob"))
    band, model, pct = F.col("risk_level"), F.col("model"), F.col("pct")
    opening = F.concat(F.lit(_OPENING[0]), model, F.lit(_OPENING[1]), pct, F.lit(_OPENING[2]))
    wrong = F.when(band == "alto", "baixo").otherwise("alto")
    kind = F.col("order_no") % 6
    text = (
        F.when(kind == 0, F.concat(opening, band, F.lit(_BASIS + _ADVICE + _NOTE)))
        .when(kind == 1, F.concat(opening, band, F.lit(_BASIS + _NOTE)))
        .when(kind == 2, F.concat(opening, wrong, F.lit(_BASIS + _ADVICE + _NOTE)))
        .when(kind == 3, F.concat(opening, band, F.lit(_BASIS + _ADVICE + _NOTE + _BANNED)))
        .when(kind == 4, F.concat(F.lit("Resumo: texto curto.\nRisco: "), band))
        .otherwise(
            F.concat(F.lit(_FAILED[0]), model, F.lit(_FAILED[1]), pct, F.lit(_FAILED[2]), band, F.lit(_FAILED[3]))
        )
    )
    return base.select("case_key", "model", "y_prob", "risk_level", text.alias("text"))


LABELLED = "labelled AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")


DRAW = "(CAST('0x' || substr(md5({0}), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"


def draw_sql(*parts: str) -> str:
    """SQL of a draw from parts, each an SQL expression."""
    return DRAW.format("concat_ws('|', " + ", ".join(parts) + ")")


CONFUSION = """count(*) FILTER (WHERE y_true = 1 AND {p}) AS tp, count(*) FILTER (WHERE y_true = 0 AND {p}) AS fp,
  count(*) FILTER (WHERE y_true = 1 AND NOT ({p})) AS fn, count(*) FILTER (WHERE y_true = 0 AND NOT ({p})) AS tn"""
AT_HALF = CONFUSION.format(p="y_prob >= 0.5")


def ratio_sql(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) > 0 THEN ({num})::DOUBLE / ({den}) ELSE 0.0::DOUBLE END)"


PRECISION = ratio_sql("tp", "tp + fp")
RECALL = ratio_sql("tp", "tp + fn")
SPECIFICITY = ratio_sql("tn", "tn + fp")
F1 = ratio_sql("2 * tp", "2 * tp + fp + fn")
ACCURACY = ratio_sql("tp + tn", "tp + tn + fp + fn")
