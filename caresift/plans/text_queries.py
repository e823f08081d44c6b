"""Prompt, explanation-audit and log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from caresift.functions import constants as K
from caresift.functions import texts as T
from caresift.operators import audit as A
from caresift.plans.derived import LOGS, logs
from caresift.plans.registry import query, r6, rounded
from caresift.plans.views import BAND_SQL, PERCENT_SQL, SCORED, TEXTS, scored, texts
from caresift.sources.tables import table


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def prompt_sql(exam: str, finding: str, rules: str) -> str:
    return f"""WITH {SCORED} SELECT case_key, {_q(K.PROMPT_OPENING)} || model || {_q(chr(10) + '- Tipo de exame: ' + exam + chr(10) + '- Probabilidade estimada: ')}
      || {PERCENT_SQL} || {_q(chr(10) + '- Limiar de decisão: ')} || '50.00%' || {_q(chr(10) + '- ' + finding + ': ')}
      || CASE WHEN y_prob >= 0.5 THEN 'sim' ELSE 'não' END || {_q(chr(10) + '- Nível de risco estimado: ')} || {BAND_SQL}
      || {_q(K.PROMPT_SECTIONS + rules)} AS prompt FROM scored"""


@query("j01_tabular_prompt", prompt_sql(K.TABULAR_EXAM, K.TABULAR_FINDING, K.TABULAR_RULES))
def tabular_prompt(spark, sf):
    return scored(spark, sf).select(
        "case_key", T.tabular_prompt(threshold=F.lit(0.5), detected=F.col("y_prob") >= 0.5).alias("prompt")
    )


@query("j02_image_prompt", prompt_sql(K.IMAGE_EXAM, K.IMAGE_FINDING, K.IMAGE_RULES))
def image_prompt(spark, sf):
    return scored(spark, sf).select(
        "case_key", T.image_prompt(threshold=F.lit(0.5), detected=F.col("y_prob") >= 0.5).alias("prompt")
    )


@query(
    "j03_fallback_text",
    f"""WITH {SCORED} SELECT case_key, 'O modelo ' || model || ' indicou uma probabilidade estimada de ' || {PERCENT_SQL}
    || ', classificada como risco ' || {BAND_SQL} || {_q('. ' + K.FALLBACK_TAIL)} || 'grupo ' || grp AS text FROM scored""",
)
def fallback_text(spark, sf):
    return scored(spark, sf).select(
        "case_key", T.fallback_text(details=F.concat(F.lit("grupo "), F.col("grp"))).alias("text")
    )


_ERRORS = """errors AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'HTTP 429: ' || props WHEN 1 THEN 'Quota exceeded for ' || event_type
  WHEN 2 THEN 'RESOURCE_EXHAUSTED' WHEN 3 THEN 'Rate Limit reached' WHEN 4 THEN event_type || ': Too Many Requests' ELSE 'connection reset by ' || event_type END AS message FROM events)"""


@query(
    "j04_retryable_errors",
    f"""WITH {_ERRORS} SELECT event_id, lower(message) LIKE '%429%' OR lower(message) LIKE '%quota%' OR contains(lower(message), 'resource_exhausted')
    OR lower(message) LIKE '%rate limit%' OR lower(message) LIKE '%too many requests%' AS retryable FROM errors""",
)
def retryable_errors(spark, sf):
    kind, of = F.col("event_id") % 6, F.col("event_type")
    message = (
        F.when(kind == 0, F.concat(F.lit("HTTP 429: "), "props"))
        .when(kind == 1, F.concat(F.lit("Quota exceeded for "), of))
        .when(kind == 2, "RESOURCE_EXHAUSTED")
        .when(kind == 3, "Rate Limit reached")
        .when(kind == 4, F.concat(of, F.lit(": Too Many Requests")))
        .otherwise(F.concat(F.lit("connection reset by "), of))
    )
    return table(spark, sf, "events").select("event_id", T.is_retryable(message).alias("retryable"))


@query(
    "j05_explained_rows",
    f"""WITH {SCORED} SELECT case_key, CASE order_no % 3 WHEN 0 THEN false ELSE true END AS explained FROM scored""",
)
def explained_rows(spark, sf):
    kind = F.col("order_no") % 3
    text = F.when(kind == 0, K.SKIPPED_ROW_NOTICE).when(kind == 1, F.concat(F.lit("Resumo: "), F.col("model")))
    return scored(spark, sf).select("case_key", T.was_explained(text).alias("explained"))


_CACHE_SQL = "cache AS (SELECT conv_id AS doc_id, arg_max(text, turn) AS cached FROM conversations GROUP BY conv_id)"


def _cache(spark, sf):
    turns = table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("doc_id"))
    return turns.agg(F.max_by("text", "turn").alias("cached"))


@query("j06_cached_text", f"WITH {_CACHE_SQL} SELECT d.doc_id, cached FROM documents d LEFT JOIN cache c ON d.doc_id = c.doc_id")
def cached_text(spark, sf):
    return A.with_cached_text(table(spark, sf, "documents").select("doc_id"), _cache(spark, sf), "doc_id")


@query(
    "j07_fallback_summary",
    f"""WITH {SCORED}, {TEXTS}, f AS (SELECT contains(lower(text), 'nao foi possivel gerar a interpretacao pela llm') AS bad FROM texts)
    SELECT count(*) AS total, count(*) FILTER (WHERE bad) AS fallbacks, count(*) FILTER (WHERE NOT bad) AS evaluated FROM f""",
)
def fallback_summary(spark, sf):
    return A.fallback_summary(texts(spark, sf), "text")


def section_sql(stem: str) -> str:
    return f"regexp_matches(text, '(?im)^\\s*{stem}\\s*:?')"


CHECKS_SQL = {name: section_sql(stem) for name, stem in K.SECTION_STEMS.items()} | {
    "tem_disclaimer_medico": "contains(lower(text), 'não substitui') AND (contains(lower(text), 'médic') OR contains(lower(text), 'profissional'))",
    "sem_linguagem_categorica": "NOT (" + " OR ".join(f"contains(lower(text), '{p}')" for p in K.BANNED_PHRASES) + ")",
    "tamanho_adequado": "length(text) BETWEEN 200 AND 2500",
    "risco_consistente": "contains(line, risk_level) AND NOT ((risk_level <> 'baixo' AND contains(line, 'baixo')) OR (risk_level <> 'moderado' AND contains(line, 'moderado')) OR (risk_level <> 'alto' AND contains(line, 'alto')))",
}
_LINES = r"""lines AS (SELECT *, lower(regexp_extract(text, '(?im)^\s*risco\s*:?\s*(.+)$', 1)) AS line FROM texts)"""
_EVALUATED = f"""WITH {SCORED}, {TEXTS}, {_LINES}, ev AS (SELECT * FROM lines WHERE NOT contains(lower(text), 'nao foi possivel gerar a interpretacao pela llm'))"""


@query(
    "j08_sections",
    f"WITH {SCORED}, {TEXTS} SELECT case_key, " + ", ".join(f"{section_sql(s)} AS {n}" for n, s in K.SECTION_STEMS.items()) + " FROM texts",
)
def sections(spark, sf):
    return texts(spark, sf).select(
        "case_key", *[T.has_section("text", stem).alias(name) for name, stem in K.SECTION_STEMS.items()]
    )


@query(
    "j09_disclaimer",
    f"WITH {SCORED}, {TEXTS} SELECT case_key, {CHECKS_SQL['tem_disclaimer_medico']} AS has_disclaimer FROM texts",
)
def disclaimer(spark, sf):
    return texts(spark, sf).select("case_key", T.has_disclaimer("text").alias("has_disclaimer"))


@query(
    "j10_banned_phrases",
    f"WITH {SCORED}, {TEXTS} SELECT case_key, NOT ({CHECKS_SQL['sem_linguagem_categorica']}) AS categorical FROM texts",
)
def banned_phrases(spark, sf):
    return texts(spark, sf).select("case_key", T.has_banned_phrase("text").alias("categorical"))


_FOLD = f"translate(lower(text), '{K.ACCENTED}', '{K.UNACCENTED}')"


@query(
    "j10_banned_phrases_folded",
    "SELECT doc_id, " + " OR ".join(f"contains({_FOLD}, '{p}')" for p in K.BANNED_PHRASES) + " AS categorical FROM documents",
)
def banned_phrases_folded(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", T.has_banned_phrase("text", fold_accents=True).alias("categorical")
    )


@query("j11_length_window", "SELECT doc_id, length(text) BETWEEN 200 AND 2500 AS length_ok FROM documents")
def length_window(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.length_ok("text").alias("length_ok"))


@query(
    "j12_risk_consistency",
    f"WITH {SCORED}, {TEXTS}, {_LINES} SELECT case_key, line AS risk_line, {CHECKS_SQL['risco_consistente']} AS consistent FROM lines",
)
def risk_consistency(spark, sf):
    return texts(spark, sf).select(
        "case_key", T.risk_line("text").alias("risk_line"), T.risk_consistent("text", "risk_level").alias("consistent")
    )


@query(
    "j13_all_checks",
    f"{_EVALUATED} SELECT case_key, " + ", ".join(f"{v} AS {k}" for k, v in CHECKS_SQL.items()) + " FROM ev",
)
def all_checks(spark, sf):
    return A.evaluated_checks(texts(spark, sf), "case_key", "text", "risk_level")


_RATES = f"{_EVALUATED}, rates AS (" + " UNION ALL ".join(
    f"""SELECT '{k}' AS "check", round_even(avg(CASE WHEN {v} THEN 1.0::DOUBLE ELSE 0 END) * 100 * 10, 0)::DOUBLE / 10 AS pass_rate FROM ev"""
    for k, v in CHECKS_SQL.items()
) + ")"


def _rates(spark, sf):
    return A.pass_rates(all_checks(spark, sf), list(CHECKS_SQL))


@query("j14_pass_rates", f"{_RATES} SELECT * FROM rates")
def pass_rates(spark, sf):
    return _rates(spark, sf)


@query(
    "j15_best_and_worst_check",
    f"""{_RATES} SELECT (SELECT "check" FROM rates ORDER BY pass_rate DESC, "check" LIMIT 1) AS best, max(pass_rate) AS best_value,
    (SELECT "check" FROM rates ORDER BY pass_rate, "check" LIMIT 1) AS worst, min(pass_rate) AS worst_value, round(avg(pass_rate), 6) AS mean_value FROM rates""",
)
def best_and_worst_check(spark, sf):
    return rounded(A.extremes(_rates(spark, sf), "check", "pass_rate"), "mean_value")


# Manual scores: one row per order, with gaps and a value that is not a number.
_SCORE_SQL = ", ".join(
    f"CASE WHEN (o_orderkey + {i}) % 4 = 0 THEN NULL WHEN (o_orderkey + {i}) % 13 = 5 THEN 'n/a' ELSE CAST(1 + (o_orderkey * {i + 3}) % 5 AS VARCHAR) END AS {c}"
    for i, c in enumerate(K.CRITERIA)
)
_MANUAL = f"manual AS (SELECT o_orderkey AS case_no, {_SCORE_SQL} FROM orders WHERE o_orderkey % 3 <> 0)"
_CASES = f"cases AS (SELECT o_orderkey AS case_no, o_orderkey % 101 / 100.0::DOUBLE AS y_prob, CASE WHEN o_orderkey % 101 / 100.0::DOUBLE >= 0.7 THEN 'alto' WHEN o_orderkey % 101 / 100.0::DOUBLE >= 0.4 THEN 'moderado' ELSE 'baixo' END AS risk_level FROM orders WHERE o_orderkey % 5 <> 0)"
_JOINED = f"WITH {_MANUAL}, {_CASES}, joined AS (SELECT case_no, y_prob, risk_level, {', '.join(K.CRITERIA)} FROM manual JOIN cases USING (case_no))"


def _manual(spark, sf):
    key = F.col("o_orderkey")
    scores = []
    for i, c in enumerate(K.CRITERIA):
        value = (1 + (key * (i + 3)) % 5).cast("string")
        scores.append(F.when((key + i) % 4 == 0, None).when((key + i) % 13 == 5, "n/a").otherwise(value).alias(c))
    return table(spark, sf, "orders").filter(key % 3 != 0).select(key.alias("case_no"), *scores)


def _cases(spark, sf):
    from caresift.operators.scoring import risk_band

    p = F.col("o_orderkey") % 101 / 100.0
    return (
        table(spark, sf, "orders")
        .filter("o_orderkey % 5 <> 0")
        .select(F.col("o_orderkey").alias("case_no"), p.alias("y_prob"), risk_band(p).alias("risk_level"))
    )


def _scores(spark, sf):
    return A.manual_with_cases(_manual(spark, sf), _cases(spark, sf), "case_no")


@query("j16_manual_scores", f"{_JOINED} SELECT * FROM joined")
def manual_scores(spark, sf):
    return _scores(spark, sf)


@query(
    "j17_any_scored",
    f"{_JOINED} SELECT count(*) FILTER (WHERE coalesce({', '.join(K.CRITERIA)}) IS NOT NULL) AS scored, count(*) AS total FROM joined",
)
def any_scored(spark, sf):
    return A.any_scored(_scores(spark, sf))


_STATS = " UNION ALL ".join(
    f"SELECT '{c}' AS criterion, round(avg(TRY_CAST({c} AS DOUBLE)), 6) AS media, round(stddev_samp(TRY_CAST({c} AS DOUBLE)), 6) AS desvio_padrao, count(TRY_CAST({c} AS DOUBLE)) AS n_avaliado FROM joined"
    for c in K.CRITERIA
)


@query("j18_score_statistics", f"{_JOINED} {_STATS}")
def score_statistics(spark, sf):
    return rounded(A.score_statistics(_scores(spark, sf)), "media", "desvio_padrao")


@query(
    "j18_manual_extremes",
    f"""{_JOINED}, stats AS ({_STATS}) SELECT (SELECT criterion FROM stats ORDER BY media DESC, criterion LIMIT 1) AS best, max(media) AS best_value,
    (SELECT criterion FROM stats ORDER BY media, criterion LIMIT 1) AS worst, min(media) AS worst_value, round(avg(media), 6) AS mean_value FROM stats""",
)
def manual_extremes(spark, sf):
    stats = score_statistics(spark, sf)
    return rounded(A.extremes(stats, "criterion", "media"), "mean_value")


@query(
    "j19_score_distribution",
    f"{_JOINED} SELECT CAST(s AS INTEGER) AS nota, "
    + ", ".join(f"count(*) FILTER (WHERE TRY_CAST({c} AS DOUBLE) = s) AS {c}" for c in K.CRITERIA)
    + " FROM joined CROSS JOIN range(1, 6) t(s) GROUP BY s",
)
def score_distribution(spark, sf):
    return A.score_distribution(_scores(spark, sf))


@query(
    "j20_audit_summary",
    f"""{_RATES}, n AS (SELECT (SELECT count(*) FROM texts) AS total, (SELECT count(*) FROM ev) AS good)
    SELECT 1 AS line, 'Amostra avaliada: ' || good || ' de ' || total || ' casos gerados (' || (total - good) || ' cairam em fallback de erro da API e foram excluidos).' AS sentence FROM n
    UNION ALL SELECT 2, 'Taxa media de conformidade automatica (formato, disclaimers, consistencia): ' || printf('%.1f', avg(pass_rate)) || '%.' FROM rates
    UNION ALL SELECT 3, 'Criterio automatico com menor conformidade: ''' || "check" || ''' (' || printf('%.0f', pass_rate) || '%).'
      FROM (SELECT * FROM rates ORDER BY pass_rate, "check" LIMIT 1)""",
)
def audit_summary(spark, sf):
    return A.summary_sentences(texts(spark, sf), "text", "risk_level", "case_key")


@query(
    "j20_manual_sentences",
    f"""{_JOINED}, stats AS ({_STATS}),
    best AS (SELECT criterion, media FROM stats ORDER BY media DESC, criterion LIMIT 1), worst AS (SELECT criterion, media FROM stats ORDER BY media, criterion LIMIT 1)
    SELECT 1 AS line, 'Nota media geral da avaliacao qualitativa: ' || printf('%.2f', (SELECT avg(media) FROM stats)) || ' de 5.' AS sentence
    UNION ALL SELECT 2, 'Melhor criterio qualitativo: ''' || best.criterion || ''' (' || printf('%.2f', best.media) || '); pior criterio: '''
      || worst.criterion || ''' (' || printf('%.2f', worst.media) || ').' FROM best CROSS JOIN worst""",
)
def manual_sentences(spark, sf):
    return A.manual_sentences(_scores(spark, sf))


@query("j21_log_lines", f"WITH {LOGS} SELECT log_id, line, kind FROM log_lines")
def log_lines(spark, sf):
    return A.marked_lines(logs(spark, sf), "log_id", "log")


@query(
    "j21_experiment_scores",
    f"WITH {LOGS} SELECT log_id, model, CAST(exp1 AS DOUBLE) AS exp1, CAST(exp2 AS DOUBLE) AS exp2, CAST(exp3 AS DOUBLE) AS exp3 FROM logs",
)
def experiment_scores(spark, sf):
    lines = A.marked_lines(logs(spark, sf), "log_id", "log").filter("kind = 'scores'")
    return A.experiment_scores(lines, "log_id")


_TAGGED = r"""tagged AS (SELECT page_id, regexp_replace(html, '<a href="([^"]+)">', '<img src="\1" alt="x"/>', 'g') AS body FROM pages)"""
_TAG = r"""<img\s+src="([^"]+)"\s*(?:alt="[^"]*")?\s*/?>"""


@query(
    "j22_image_tags",
    rf"""WITH {_TAGGED} SELECT page_id, regexp_replace(body, '{_TAG}', '![](\1)', 'g') AS body,
    CAST(len(regexp_extract_all(body, '{_TAG}')) AS INTEGER) AS replaced FROM tagged""",
)
def image_tags(spark, sf):
    body = F.regexp_replace("html", r'<a href="([^"]+)">', '<img src="$1" alt="x"/>')
    text, count = T.image_tags_rewritten(F.col("body"))
    pages = table(spark, sf, "pages").select("page_id", body.alias("body"))
    return pages.select("page_id", text.alias("body"), count.alias("replaced"))


SCRUB = [
    (r"<!--[^>]*-->", ""),
    (r"<script>[^<]*</script>", ""),
    (r"<style>[^<]*</style>", ""),
    (r"</?[a-zA-Z][^>]*>", " "),
    (r"&amp;", "&"),
    (r"[ \t\r\n]+", " "),
]


def _scrub_sql() -> str:
    text = "html"
    for pattern, new in SCRUB:
        text = f"regexp_replace({text}, '{pattern}', '{new}', 'g')"
    return text


@query("j23_regex_scrub", f"SELECT page_id, {_scrub_sql()} AS text FROM pages")
def regex_scrub(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.scrubbed("html", SCRUB).alias("text"))


_TEX = r"""tex AS (SELECT doc_id, '\title{' || source || '}' || chr(10) || '\pagestyle{plain}' || chr(10) || '\lhead{' || lang || '}\begin{document}\maketitle ' || text AS body FROM documents)"""


def _tex_sql() -> str:
    text = "body"
    for pattern, new in T.header_scrub_steps():
        text = f"regexp_replace({text}, '{pattern}', '{new}', 'g')"
    return text


@query("j23_header_scrub", f"WITH {_TEX} SELECT doc_id, {_tex_sql()} AS body FROM tex")
def header_scrub(spark, sf):
    body = F.concat(
        F.lit("\\title{"), "source", F.lit("}\n\\pagestyle{plain}\n\\lhead{"), "lang",
        F.lit("}\\begin{document}\\maketitle "), "text",
    )
    tex = table(spark, sf, "documents").select("doc_id", body.alias("body"))
    return tex.select("doc_id", T.scrubbed("body", T.header_scrub_steps()).alias("body"))
