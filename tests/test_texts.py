import pytest
from pyspark.sql import functions as F

from caresift.functions import constants as K
from caresift.functions import texts as T
from caresift.operators import audit as A

GOOD = (
    "Resumo: texto.\n\nRisco: baixo\n\nJustificativa: texto.\n\nRecomendação: acompanhar.\n\n"
    "Observação: não substitui a avaliação médica. " + "x" * 120
)


def check(spark, text, band="baixo"):
    df = spark.createDataFrame([(1, text, band)], "case_id int, text string, band string")
    return A.check_table(df, "case_id", "text", "band").first().asDict()


def test_a_complete_text_passes_everything(spark):
    row = check(spark, GOOD)
    assert all(v for k, v in row.items() if k != "case_id")


@pytest.mark.parametrize("n,ok", [(199, False), (200, True), (2500, True), (2501, False)])
def test_length_edges(spark, n, ok):
    assert check(spark, "ã" * n)["tamanho_adequado"] is ok


@pytest.mark.parametrize(
    "line,band,ok",
    [
        ("Risco: O nível estimado é MODERADO.", "moderado", True),
        ("  risco baixo ou alto", "baixo", False),
        ("Risco: alto", "baixo", False),
        ("sem linha", "baixo", False),
        ("o risco: baixo", "baixo", False),
    ],
)
def test_risk_line(spark, line, band, ok):
    assert check(spark, f"Resumo: x\n{line}\nfim", band)["risco_consistente"] is ok


def test_sections_are_line_anchored(spark):
    row = check(spark, "o resumo: x\n   RISCO baixo")
    assert not row["tem_secao_resumo"] and row["tem_secao_risco"]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("Nao foi possivel gerar a interpretacao pela LLM", True),
        ("... Não foi possível gerar a interpretação pela LLM neste momento.", True),
        ("Interpretação pela LLM pronta", False),
        (None, False),
    ],
)
def test_fallback_in_both_spellings(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(T.is_fallback("t")).first()[0] is expected


def test_banned_phrases_match_accents_only_when_folded(spark):
    df = spark.createDataFrame([("Diagnóstico confirmado",), ("diagnostico confirmado",)], "t string")
    assert [r[0] for r in df.select(T.has_banned_phrase("t")).collect()] == [False, True]
    assert [r[0] for r in df.select(T.has_banned_phrase("t", fold_accents=True)).collect()] == [True, True]


def test_published_manual_scores(spark):
    rows = [(1, 5, 5, 5, 5, 5), (3, 5, 3, 5, 1, 4), (4, 5, 4, 4, 2, 2), (5, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "case_id int, " + ", ".join(f"{c} int" for c in K.CRITERIA))
    stats = {r["criterion"]: (round(r["media"], 2), round(r["desvio_padrao"], 2), r["n_avaliado"]) for r in A.score_statistics(df).collect()}
    assert stats == {
        "clareza": (5.0, 0.0, 3),
        "coerencia": (4.0, 1.0, 3),
        "seguranca_clinica": (4.67, 0.58, 3),
        "utilidade_clinica": (2.67, 2.08, 3),
        "padronizacao": (3.67, 1.53, 3),
    }
    assert A.any_scored(df).first().asDict() == {"scored": 3, "total": 4}
    counts = {r["nota"]: r["clareza"] for r in A.score_distribution(df).collect()}
    assert counts == {1: 0, 2: 0, 3: 0, 4: 0, 5: 3}


def test_published_mean_pass_rate(spark):
    without = GOOD.replace("não substitui", "complementa")
    rows = [(1, GOOD, "baixo"), (3, GOOD, "baixo"), (4, without, "baixo")]
    df = spark.createDataFrame(rows, "case_id int, text string, band string")
    checks = A.check_table(df, "case_id", "text", "band")
    rates = A.pass_rates(checks, [c for c in checks.columns if c != "case_id"])
    row = A.extremes(rates, "check", "pass_rate").first()
    assert round(row["mean_value"], 1) == 96.3
    assert row["worst"] == "tem_disclaimer_medico" and row["worst_value"] == 66.7


def test_summary_when_nothing_can_be_evaluated(spark):
    df = spark.createDataFrame([(1, "Nao foi possivel gerar a interpretacao pela LLM", "baixo")], "k int, t string, b string")
    lines = [r["sentence"] for r in A.summary_sentences(df, "t", "b", "k").orderBy("line").collect()]
    assert lines[0].startswith("Amostra avaliada: 0 de 1") and "Nenhum caso" in lines[1]


def test_header_scrub_keeps_the_body(spark):
    tex = "\\title{A}\n\\author{B}\\date{}\\usepackage{fancyhdr}\nx\\makeatother\n\\lhead{n}\n\\fancyhead[L]{q}text\\maketitle"
    df = spark.createDataFrame([(tex,)], "t string")
    out = df.select(T.scrubbed("t", T.header_scrub_steps())).first()[0]
    assert out == "text"  # the date pattern takes the line end left by the header line


def test_image_tags(spark):
    df = spark.createDataFrame([('a <img src="x.png" alt="y"/> b <img  src="z"> <img alt="q">',)], "t string")
    text, n = T.image_tags_rewritten("t")
    row = df.select(text.alias("t"), n.alias("n")).first()
    assert row["t"] == 'a ![](x.png) b ![](z) <img alt="q">' and row["n"] == 2


def test_notice_detection(spark):
    df = spark.createDataFrame([(K.SKIPPED_ROW_NOTICE,), (K.SKIPPED_IMAGE_NOTICE,), (None,), ("Resumo",)], "t string")
    assert [r[0] for r in df.select(T.was_explained("t")).collect()] == [False, False, True, True]


def test_pending_texts(spark):
    cases = spark.createDataFrame([(1,), (2,)], "k int")
    cache = spark.createDataFrame([(2, "done")], "k int, text string")
    assert [r["k"] for r in A.pending(cases, cache, "k").collect()] == [1]
    assert A.pending(cases, cache, "k", force=True).count() == 2


def test_experiment_scores_from_a_log(spark):
    log = "x\nFim de KNeighborsClassifier: exp1=0.5440, exp2=-1.0000, exp3=0.5534\nAccuracy: 0.1"
    df = spark.createDataFrame([(1, log)], "k int, log string")
    lines = A.marked_lines(df, "k", "log")
    assert lines.count() == 1
    row = A.experiment_scores(lines, "k").first()
    assert (row["model"], row["exp1"], row["exp2"], row["exp3"]) == ("KNeighborsClassifier", 0.544, -1.0, 0.5534)


def test_manual_sentences_with_and_without_scores(spark):
    from caresift.operators import audit
    from caresift.functions.constants import CRITERIA, MANUAL_MISSING

    schema = "case_key string, " + ", ".join(f"{c} string" for c in CRITERIA)
    scored = spark.createDataFrame([("a", *["4" for _ in CRITERIA]), ("b", "5", *["x" for _ in CRITERIA[1:]])], schema)
    lines = {r["line"]: r["sentence"] for r in audit.manual_sentences(scored, first=4).collect()}
    assert sorted(lines) == [4, 5] and f"'{CRITERIA[0]}' (4.50)" in lines[5]
    mean = (4.5 + 4 * (len(CRITERIA) - 1)) / len(CRITERIA)
    assert f"{mean:.2f} de 5." in lines[4]
    blank = spark.createDataFrame([("a", *[None for _ in CRITERIA])], schema)
    assert [tuple(r) for r in audit.manual_sentences(blank).collect()] == [(1, MANUAL_MISSING)]
    assert [tuple(r) for r in audit.manual_sentences(blank.limit(0)).collect()] == [(1, MANUAL_MISSING)]


def test_checks_of_evaluated_texts_make_each_text_once(spark):
    made = spark.sparkContext.accumulator(0)

    def write(k):
        made.add(1)
        return GOOD if k % 3 else "Nao foi possivel gerar a interpretacao pela LLM"

    df = spark.range(12).withColumn("band", F.lit("baixo"))
    df = df.withColumn("text", F.udf(write, "string", useArrow=False)("id"))
    rows = A.evaluated_checks(df, "id", "text", "band").collect()
    assert sorted(r["id"] for r in rows) == [k for k in range(12) if k % 3]
    assert all(all(v for k, v in r.asDict().items() if k != "id") for r in rows)
    assert made.value == 12


def test_checks_of_evaluated_texts_are_the_checks_of_whole_texts(spark):
    bits = ["Resumo", "reſumo", "RİSCO baixo", "rısco alto", "Risco: baixo", "recomenda", "observa", "justificativa", " ", "\u00a0", "\u2003", ":", "x",
            "\n", "\n\n", "\r", "\u2028", "\t", "não substitui", "MÉDIC", "o paciente tem", "interpretação pela LLM", "não foi possível gerar a "]
    texts = [None, "", *["".join(bits[(i * i + 7 * i * j + j * j * 3) % len(bits)] for j in range(i % 14)) for i in range(400)]]
    rows = [(i % 90 or None, t, [None, "baixo", "moderado", "alto"][i % 4], i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "low int, text string, band string, heads int")
    got = A.evaluated_checks(df, "low", "text", "band")
    want = A.check_table(A.evaluated_only(df, "text"), "low", "text", "band")
    assert got.columns == want.columns and got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
