"""Decision, presentation and source queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from caresift.functions import constants as K
from caresift.functions import rates as R
from caresift.functions import texts as T
from caresift.operators import audit as A
from caresift.operators import metrics as M
from caresift.operators import neighbors as N
from caresift.operators import present as L
from caresift.operators import scoring as S
from caresift.plans.derived import (
    HISTORY,
    RESULT_ROWS,
    history,
    notebook_documents,
    result_documents,
)
from caresift.plans.registry import query, r6, rounded
from caresift.plans.views import (
    ACCURACY,
    AT_HALF,
    BAND_SQL,
    CONFUSION,
    F1,
    PERCENT_SQL,
    PRECISION,
    RECALL,
    SCORED,
    SPECIFICITY,
    SURVEY,
    draw_sql,
    scored,
    survey,
)
from caresift.functions.draws import uniform
from caresift.session import scratch_path
from caresift.sources import documents as DOC
from caresift.sources import images as IMG
from caresift.sources import tables as TAB
from caresift.sources.tables import table
from caresift.streaming import file_drop

# --- decisions -----------------------------------------------------------------


def _knn_sql(k: int, weights: str, p: int) -> str:
    distance = (
        "list_distance(q.v, t.v)"
        if p == 2
        else "list_sum(list_transform(range(1, len(q.v) + 1), lambda i: abs(q.v[i] - t.v[i])))"
    )
    vote = (
        "avg(y::DOUBLE)"
        if weights == "uniform"
        else "coalesce(avg(y::DOUBLE) FILTER (WHERE d = 0), sum(y / d) FILTER (WHERE d > 0) / sum(1 / d) FILTER (WHERE d > 0))"
    )
    return f"""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v, CAST(label >= 5 AS INTEGER) AS y,
      {draw_sql("'knn'", 'vec_id')} < 0.7 AS is_train FROM embeddings),
    d AS (SELECT q.vec_id, t.vec_id AS n, t.y, {distance} AS d FROM v q JOIN v t ON t.is_train AND NOT q.is_train),
    r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, n) AS rn FROM d)
    SELECT vec_id, round({vote}, 6) AS y_prob FROM r WHERE rn <= {k} GROUP BY vec_id"""


def _vectors(spark, sf):
    v = table(spark, sf, "embeddings").select("vec_id", "embedding", (F.col("label") >= 5).cast("int").alias("y"))
    is_train = uniform("knn", F.col("vec_id")) < 0.7
    return v.filter(is_train), v.filter(~is_train)


@query("g04_neighbors_uniform", _knn_sql(7, "uniform", 2))
def neighbors_uniform(spark, sf):
    train, test = _vectors(spark, sf)
    return rounded(N.vote(N.nearest(train, test, "vec_id", "embedding", "y", 7), "vec_id"), "y_prob")


@query("g04_neighbors_distance", _knn_sql(5, "distance", 1))
def neighbors_distance(spark, sf):
    train, test = _vectors(spark, sf)
    return rounded(N.vote(N.nearest(train, test, "vec_id", "embedding", "y", 5, p=1), "vec_id", "distance"), "y_prob")


@query("g07_threshold_decision", f"WITH {SCORED} SELECT case_key, y_prob >= 0.5 AS disease_detected FROM scored")
def threshold_decision(spark, sf):
    return scored(spark, sf).select("case_key", (F.col("y_prob") >= K.DEFAULT_THRESHOLD).alias("disease_detected"))


@query("g08_risk_bands", f"WITH {SCORED} SELECT case_key, {BAND_SQL} AS risk_level FROM scored")
def risk_bands(spark, sf):
    return scored(spark, sf).select("case_key", S.risk_band().alias("risk_level"))


@query(
    "g09_row_index",
    f"WITH {SCORED} SELECT case_key, row_number() OVER (ORDER BY order_no, case_key) - 1 AS row_index FROM scored",
)
def row_index(spark, sf):
    return S.numbered(scored(spark, sf).select("case_key", "order_no"), ["order_no", "case_key"]).drop("order_no")


_NOTICE = "'" + K.SKIPPED_ROW_NOTICE + "'"


@query(
    "g10_gated_explanation",
    f"""WITH {SCORED}, i AS (SELECT *, row_number() OVER (ORDER BY case_key) - 1 AS row_index FROM scored)
    SELECT case_key, row_index, CASE WHEN row_index < 5 THEN 'Risco: ' || {BAND_SQL} || ' ' || {PERCENT_SQL} ELSE {_NOTICE} END AS explanation FROM i""",
)
def gated_explanation(spark, sf):
    rows = S.numbered(scored(spark, sf).select("case_key", "y_prob"), ["case_key"])

    def explain(head):
        text = F.concat(F.lit("Risco: "), S.risk_band(), F.lit(" "), L.percent_text("y_prob"))
        return head.withColumn("explanation", text)

    return S.gated_by_frame(rows, "row_index", explain, "explanation").drop("y_prob")


@query(
    "g11_row_outcomes",
    """WITH e AS (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'not a number' ELSE CAST(event_id % 100 AS VARCHAR) END AS raw FROM events),
    c AS (SELECT event_id, TRY_CAST(raw AS DOUBLE) / 100 AS probability, raw FROM e)
    SELECT event_id, round(probability, 6) AS probability, CASE WHEN probability IS NULL THEN 'error' ELSE 'success' END AS status,
      CASE WHEN probability IS NULL THEN 'could not read score: ' || raw END AS message FROM c""",
)
def row_outcomes(spark, sf):
    raw = F.when(F.col("event_id") % 9 == 0, "not a number").otherwise((F.col("event_id") % 100).cast("string"))
    rows = table(spark, sf, "events").select("event_id", raw.alias("raw"))
    value = F.col("raw").try_cast("double") / 100
    out = S.with_outcome(rows, value, "probability", F.concat(F.lit("could not read score: "), "raw"))
    return rounded(out.drop("raw"), "probability")


@query(
    "g13_test_evaluation",
    f"""WITH {SCORED}, c AS (SELECT model, {AT_HALF} FROM scored GROUP BY model)
    SELECT model, tp, tn, fp, fn, round({ACCURACY}, 6) AS accuracy, round({PRECISION}, 6) AS precision, round({RECALL}, 6) AS recall,
      round({SPECIFICITY}, 6) AS specificity, round({F1}, 6) AS f1, 0.5::DOUBLE AS threshold FROM c""",
)
def test_evaluation(spark, sf):
    c = M.with_rates(M.confusion_counts(scored(spark, sf), ["model"], R.decide()))
    return rounded(c, "accuracy", "precision", "recall", "specificity", "f1").withColumn("threshold", F.lit(0.5))


@query(
    "g14_class_names",
    f"""WITH {SCORED} SELECT case_key, CASE WHEN y_prob >= 0.1 THEN 'maligno' ELSE 'nao_maligno' END AS predicted,
    CASE WHEN y_prob >= 0.1 THEN 'Maligno' ELSE 'Nao maligno' END AS display FROM scored""",
)
def class_names(spark, sf):
    name = S.predicted_class("y_prob", 0.1)
    return scored(spark, sf).select("case_key", name.alias("predicted"), S.class_display(name).alias("display"))


_FOLDER_SQL = "CASE line_no % 3 WHEN 0 THEN 'Normal cases' WHEN 1 THEN 'Bengin cases' ELSE 'Malignant cases' END"
_DISPLAY_SQL = "CASE line_no % 3 WHEN 0 THEN 'Normal' WHEN 1 THEN 'Benigno' ELSE 'Maligno' END"


def _folder(number):
    return F.when(number % 3 == 0, "Normal cases").when(number % 3 == 1, "Bengin cases").otherwise("Malignant cases")


@query(
    "g15_example_report",
    f"""WITH {SCORED} SELECT {_DISPLAY_SQL} AS classe, case_key || '.jpg' AS arquivo, {_DISPLAY_SQL} AS classe_esperada,
    round_even(y_cont * 10000, 0)::DOUBLE / 10000 AS probabilidade_malignidade, CASE WHEN y_cont >= 0.1 THEN 'Maligno' ELSE 'Nao maligno' END AS classe_predita FROM scored""",
)
def example_report(spark, sf):
    rows = scored(spark, sf).select(
        _folder(F.col("line_no")).alias("folder"), F.concat("case_key", F.lit(".jpg")).alias("file"), "y_cont"
    )
    return S.example_report(rows, "folder", "file", "y_cont", 0.1)


# --- presentation -------------------------------------------------------------------


def _predictions(spark, sf):
    return scored(spark, sf).select(
        "case_key", (F.col("y_prob") >= 0.5).alias("disease_detected"), F.col("y_prob").alias("probability"), "order_no"
    )


@query(
    "l01_joined_results",
    f"""WITH {SCORED}, {SURVEY}, p AS (SELECT case_key, y_prob FROM scored WHERE order_no % 7 <> 0)
    SELECT s.case_key, "AGE", "GENDER", CASE WHEN y_prob >= 0.5 THEN 'Positivo' WHEN y_prob < 0.5 THEN 'Negativo' END AS resultado,
      round_even(y_prob * 100 * 100, 0)::DOUBLE / 100 AS probabilidade_pct, row_number() OVER (ORDER BY s.case_key) AS linha
    FROM survey s LEFT JOIN p ON s.case_key = p.case_key""",
)
def joined_results(spark, sf):
    inputs = survey(spark, sf).select("case_key", "AGE", "GENDER")
    return L.with_predictions(inputs, _predictions(spark, sf).filter("order_no % 7 <> 0"), "case_key")


@query(
    "l02_totals",
    f"""WITH {SCORED} SELECT count(*) AS total, count(*) FILTER (WHERE y_prob >= 0.5) AS positives, count(*) FILTER (WHERE y_prob < 0.5) AS negatives FROM scored""",
)
def totals(spark, sf):
    return L.totals(_predictions(spark, sf))


def _page_sql(index: int) -> str:
    return f"""WITH {SCORED}, i AS (SELECT case_key, y_prob AS probability, row_number() OVER (ORDER BY case_key) - 1 AS row_index, count(*) OVER () AS n FROM scored),
    j AS (SELECT *, greatest((n - 1) // 50 + 1, 1) AS total_pages FROM i)
    SELECT case_key, probability, row_index, total_pages FROM j WHERE row_index >= least({index}, total_pages - 1) * 50 AND row_index < least({index}, total_pages - 1) * 50 + 50"""


def _page(spark, sf, index):
    rows = _predictions(spark, sf).select("case_key", "probability", F.lit("x").alias("explanation"))
    return L.page(rows, ["case_key"], index, 50, hidden="explanation")


@query("l03_page", _page_sql(3))
def page(spark, sf):
    return _page(spark, sf, 3)


@query("l03_page_past_end", _page_sql(10**9))
def page_past_end(spark, sf):
    return _page(spark, sf, 10**9)


@query("l04_highlight", f"WITH {SCORED} SELECT case_key, y_prob >= 0.5 AS highlight FROM scored")
def highlight(spark, sf):
    shown = _predictions(spark, sf).select(
        "case_key", F.when(F.col("disease_detected"), "Positivo").otherwise("Negativo").alias("resultado")
    )
    return L.with_highlight(shown).drop("resultado")


@query(
    "l05_file_details",
    f"""WITH {SCORED} SELECT case_key || '.jpg' AS nome, part_no || ' bytes' AS tamanho, '10.00%' AS limiar,
    CASE WHEN y_prob >= 0.1 THEN 'Sim' ELSE 'Não' END AS achado_suspeito, {PERCENT_SQL} AS probabilidade FROM scored""",
)
def file_details(spark, sf):
    rows = scored(spark, sf).select(F.concat("case_key", F.lit(".jpg")).alias("name"), "part_no", "y_prob")
    return L.file_details(rows, "name", "part_no", F.lit(0.1), F.col("y_prob") >= 0.1, "y_prob")


# --- sources and sinks ----------------------------------------------------------------

_CSV_SCHEMA = "case_key string, GENDER string, AGE int, SMOKING int, COUGHING int, `CHRONIC DISEASE` int, LUNG_CANCER string"


@query("a01_csv_scan", f"WITH {SURVEY} SELECT * FROM survey")
def csv_scan(spark, sf):
    path = scratch_path(spark, "survey-csv")
    TAB.write_csv(survey(spark, sf), path)
    return TAB.read_csv(spark, path, _CSV_SCHEMA)


_EXT = r"regexp_extract(lower(regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '([^/]*)$', 1)), '[^.](\.[^.]+)$', 1)"


@query(
    "a02_extension_filter",
    f"""SELECT page_id, CASE WHEN {_EXT} IN ('.html', '.pdf') THEN 'success' ELSE 'error' END AS status,
    CASE WHEN {_EXT} NOT IN ('.html', '.pdf') THEN 'Invalid file type. Only (''.html'', ''.pdf'') are allowed' END AS message FROM pages""",
)
def extension_filter(spark, sf):
    path = F.split_part(F.split_part("url", F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1))
    rows = table(spark, sf, "pages").select("page_id", path.alias("path"))
    return S.with_file_status(rows, "path", [".html", ".pdf"]).drop("path")


@query(
    "a03_image_catalogue",
    f"""WITH {SCORED} SELECT 'data/' || {_FOLDER_SQL} || '/' || case_key || '.jpg' AS image_path, CASE line_no % 3 WHEN 2 THEN 1 ELSE 0 END AS label,
    {_FOLDER_SQL} AS class_original FROM scored WHERE order_no % 5 > 1""",
)
def image_catalogue(spark, sf):
    number = F.col("order_no") % 5
    suffix = F.when(number > 1, ".jpg").otherwise(".png")
    folder = F.when(number == 1, "Other cases").otherwise(_folder(F.col("line_no")))
    path = F.concat(F.lit("data/"), folder, F.lit("/"), "case_key", suffix)
    return IMG.catalogue(scored(spark, sf).select(path.alias("path")))


@query("a04_result_documents", f"WITH {RESULT_ROWS} SELECT * FROM result_rows")
def result_rows(spark, sf):
    return DOC.result_rows(result_documents(spark, sf), ["doc_id"], "doc")


@query("a05_epoch_history", f"WITH {HISTORY} SELECT * FROM history")
def epoch_history(spark, sf):
    return history(spark, sf)


_CACHE_SQL = "cache AS (SELECT DISTINCT conv_id AS doc_id FROM conversations)"


def _pending(spark, sf, force):
    path = scratch_path(spark, "text-cache")
    turns = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("doc_id"))
    DOC.write_cache(turns.agg(F.max_by("text", "turn").alias("cached")), path)
    return A.pending(table(spark, sf, "documents").select("doc_id", "lang"), spark.read.parquet(path), "doc_id", force)


@query("a06_pending_texts", f"WITH {_CACHE_SQL} SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM cache)")
def pending_texts(spark, sf):
    return _pending(spark, sf, False)


@query("a06_forced_texts", "SELECT doc_id, lang FROM documents")
def forced_texts(spark, sf):
    return _pending(spark, sf, True)


@query("a07_csv_sink", f"WITH {SCORED} SELECT case_key, y_prob, y_prob >= 0.5 AS disease_detected, {BAND_SQL} AS risk_level FROM scored")
def csv_sink(spark, sf):
    path = scratch_path(spark, "results-csv")
    rows = scored(spark, sf).select(
        "case_key", "y_prob", (F.col("y_prob") >= 0.5).alias("disease_detected"), S.risk_band().alias("risk_level")
    )
    TAB.write_csv(rows, path)
    return TAB.read_csv(spark, path, "case_key string, y_prob double, disease_detected boolean, risk_level string")


@query(
    "a08_json_sink",
    f"""WITH {SCORED} SELECT to_json(struct_pack(case_key := case_key, y_prob := y_prob, risk_level := {BAND_SQL}, group_name := CASE WHEN order_no % 4 = 0 THEN NULL ELSE grp END)) AS doc FROM scored""",
)
def json_sink(spark, sf):
    path = scratch_path(spark, "results-json")
    group = F.when(F.col("order_no") % 4 == 0, None).otherwise(F.col("grp"))
    rows = scored(spark, sf).select("case_key", "y_prob", S.risk_band().alias("risk_level"), group.alias("group_name"))
    DOC.write_json_lines(rows, path)
    return spark.read.text(path).withColumnRenamed("value", "doc")


@query(
    "a10_file_drop_scoring",
    f"WITH {SCORED} SELECT case_key, model, y_prob >= 0.5 AS disease_detected, {BAND_SQL} AS risk_level FROM scored",
)
def file_drop_scoring(spark, sf):
    from caresift.plans import views

    schema = table(spark, sf, "lineitem").schema
    stream = file_drop.arriving_parquet(spark, sf, "lineitem.parquet", schema)

    def score(batch):
        key, quantity = views.case_key(), F.col("l_quantity") / 50
        return batch.select(
            key.alias("case_key"),
            F.concat(F.lit("m"), F.col("l_linenumber") % 4).alias("model"),
            (quantity >= 0.5).alias("disease_detected"),
            S.risk_band(quantity).alias("risk_level"),
        )

    out = scratch_path(spark, "arrivals")
    file_drop.score_arrivals(stream, score, out, scratch_path(spark, "arrivals-checkpoint"))
    return spark.read.parquet(out).drop("batch")


@query(
    "a11_stream_outputs",
    """WITH l AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS cell
      FROM conversations WHERE role = 'assistant')
    SELECT conv_id, turn, CAST(cell AS INTEGER) AS cell, 0 AS output, line AS text FROM l WHERE line <> ''""",
)
def stream_outputs(spark, sf):
    return DOC.stream_outputs(notebook_documents(spark, sf), ["conv_id", "turn"], "doc")
