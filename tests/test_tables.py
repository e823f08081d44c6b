import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from caresift.functions.constants import FEATURE_COLUMNS
from caresift.operators import prep as P
from caresift.operators import present as L
from caresift.operators import profile as C
from caresift.operators import schema as B
from caresift.operators import scoring as S
from caresift.operators import split as D

# --- names and contracts ---------------------------------------------------------


def test_the_two_name_keys_differ():
    assert B.joined_key(" Chronic  Disease ") == "CHRONIC_DISEASE"
    assert B.compact_key(" Chronic_Disease ") == "CHRONICDISEASE"
    assert B.joined_key("A_B") != B.joined_key("AB") and B.compact_key("A_B") == B.compact_key("AB")


def test_underscore_spellings_align(spark):
    raw = spark.createDataFrame([tuple(range(15))], [c.replace(" ", "_").lower() + " " for c in FEATURE_COLUMNS])
    assert B.aligned(raw.withColumn("extra", F.lit(1)), FEATURE_COLUMNS).columns == FEATURE_COLUMNS


def test_missing_columns_are_listed(spark):
    short = spark.createDataFrame([("M", 60, 2)], ["GENDER", "AGE", "SMOKING"])
    with pytest.raises(B.ContractError, match="missing required columns.*YELLOW FINGERS"):
        B.aligned(short, FEATURE_COLUMNS)
    assert B.alignment_status(short, FEATURE_COLUMNS)[0] == "error"


def test_duplicate_normalized_names(spark):
    with pytest.raises(B.ContractError, match="A_B"):
        B.normalized_names(spark.createDataFrame([(1, 2)], ["a b", "A_B"]))
    assert B.normalized_names(spark.createDataFrame([(1,)], [" x y "])).columns == ["X_Y"]
    assert B.trimmed_names(spark.createDataFrame([(1,)], ["FATIGUE "])).columns == ["FATIGUE"]


def test_target_domain(spark):
    good = spark.createDataFrame([("YES",), ("NO",)], ["LUNG_CANCER"])
    bad = spark.createDataFrame([("YES",), ("maybe",)], ["LUNG_CANCER"])
    assert not B.has_unknown_target(good, "LUNG_CANCER") and B.has_unknown_target(bad, "LUNG_CANCER")
    with pytest.raises(PySparkException, match="Unexpected target label: maybe"):
        B.coded_target(bad, "LUNG_CANCER").collect()
    with pytest.raises(B.ContractError, match="Target column not found"):
        B.coded_target(good, "OTHER")


def test_lenient_target_codes_all_labels_when_one_is_foreign(spark):
    df = spark.createDataFrame([("yes ",), ("NO",), ("maybe",), (None,)], "t string")
    got = [(r["t"], r["y_true"]) for r in B.lenient_target(df, "t").collect()]
    assert dict(got) == {"NO": 0, "maybe": 1, "yes ": 2, None: -1}


def test_group_defaults_to_all(spark):
    df = spark.createDataFrame([("F",), (None,)], "GENDER string")
    assert {r["grp"] for r in B.with_group(df, "GENDER").collect()} == {"F", "nan"}
    assert {r["grp"] for r in B.with_group(df, "OTHER").collect()} == {"all"}


# --- profile -----------------------------------------------------------------------


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "a int, b string")
    assert C.duplicate_count(df).first()["duplicates"] == 2
    assert C.without_duplicates(df).count() == 2
    assert C.duplicate_count(df.limit(0)).first()["duplicates"] == 0


def test_describe_and_box(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "v double")
    d = C.describe(df, ["v"]).first()
    assert (d["count"], d["p25"], d["p50"], d["p75"], d["min"], d["max"]) == (5, 2.0, 3.0, 4.0, 1.0, 100.0)
    assert d["std"] == pytest.approx(43.6176, abs=1e-4)
    box = C.box_stats(df, "v").first()
    assert (box["whisker_low"], box["whisker_high"], box["outliers"]) == (1.0, 4.0, 1)


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    assert [r["n"] for r in C.histogram(df, "v").orderBy("bin").collect()] == [1] * 9 + [2]
    constant = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert sum(r["n"] for r in C.histogram(constant, "v").collect()) == 2


def test_correlation_of_a_column_with_itself(spark):
    df = spark.createDataFrame([(1, 3), (2, 1), (3, 2)], "a int, b int")
    rows = {(r["a"], r["b"]): r["corr"] for r in C.correlation_matrix(df, ["a", "b"]).collect()}
    assert rows[("a", "a")] == 1.0 and rows[("a", "b")] == rows[("b", "a")] == -0.5


# --- preparation -------------------------------------------------------------------


def test_preparation_uses_training_rows_only(spark):
    train = spark.createDataFrame([("b", 1.0), ("a", 3.0), ("a", None), ("b", 3.0), (None, 5.0)], "c string, n double")
    prep = P.fit_preparation(train, ["c"], ["n"])
    assert prep.modes == {"c": "a"} and prep.medians == {"n": 3.0}
    assert prep.feature_names == ["c_a", "c_b", "n"]
    test = spark.createDataFrame([("zzz", 3.0), (None, None)], "c string, n double")
    rows = P.prepared(test, prep).collect()
    assert (rows[0]["c_a"], rows[0]["c_b"], rows[0]["n"]) == (0.0, 0.0, 0.0)
    assert (rows[1]["c_a"], rows[1]["c_b"], rows[1]["n"]) == (1.0, 0.0, 0.0)
    vector = P.assembled(test, prep).first()["features"]
    assert list(vector) == [0.0, 0.0, 0.0]


def test_constant_column_is_only_centred(spark):
    train = spark.createDataFrame([(2.0,), (2.0,)], "n double")
    prep = P.fit_preparation(train, [], ["n"])
    assert P.standardized(train, prep).first()["n"] == 0.0


def test_column_roles(spark):
    df = spark.createDataFrame([("a", 1, 2.0)], "s string, i int, d double")
    assert P.column_roles(df, ["s", "i", "d"]) == (["s"], ["i", "d"])


# --- decisions and presentation --------------------------------------------------------


def test_band_edges(spark):
    df = spark.createDataFrame([(0.7,), (0.69999,), (0.4,), (0.39999,)], "y_prob double")
    assert [r[0] for r in df.select(S.risk_band()).collect()] == ["alto", "moderado", "moderado", "baixo"]


def test_extensions(spark):
    df = spark.createDataFrame([("a/B.JPG",), ("x.tar.gz",), ("a.b/none",), (".csv",)], "p string")
    assert [r[0] for r in df.select(S.extension("p")).collect()] == [".jpg", ".gz", "", ""]
    status = [r["status"] for r in S.image_status(df, "p").collect()]
    assert status == ["success", "error", "error", "error"]


def test_percent_text_rounds_like_the_exact_value(spark):
    df = spark.createDataFrame([(0.02675,), (0.12345,), (1.0,), (0.5,)], "p double")
    assert [r[0] for r in df.select(L.percent_text("p")).collect()] == [f"{v * 100:.2f}%" for v in (0.02675, 0.12345, 1.0, 0.5)]


def test_page_is_clamped(spark):
    df = spark.range(60).select("id", F.lit("t").alias("note"))
    last = L.page(df, ["id"], 99, 25, hidden="note")
    assert sorted(r["id"] for r in last.collect()) == list(range(50, 60))
    assert "note" not in last.columns and last.first()["total_pages"] == 3
    assert L.page(df.limit(0), ["id"], 0, 25).count() == 0


def test_expensive_step_sees_only_the_first_rows(spark):
    df = spark.range(10).withColumnRenamed("id", "i")
    seen = []

    def explain(head):
        seen.append(head.count())
        return head.withColumn("text", F.lit("made"))

    out = S.gated_by_frame(df, "i", explain, "text", limit=3)
    assert seen == [3] and out.filter("text = 'made'").count() == 3 and out.count() == 10


def test_rows_without_a_label_are_split_too(spark):
    df = spark.createDataFrame([(f"k{i}", None if i % 4 == 0 else str(i % 2)) for i in range(40)], "k string, y string")
    for rows in (D.split_60_20_20(df, "k", "y").collect(), D.split_test_first(df, "k", "y").collect()):
        assert len(rows) == 40 and {r["k"] for r in rows} == {f"k{i}" for i in range(40)}
        parts = [r["split"] for r in rows if r["y"] is None]
        assert (parts.count("train"), parts.count("val"), parts.count("test")) == (6, 2, 2)


def test_many_levels(spark):
    train = spark.range(12_000).selectExpr("lpad(id, 6, '0') AS c", "double(id) AS n")
    prep = P.fit_preparation(train, ["c"], ["n"])
    assert prep.modes == {"c": "000000"} and len(prep.levels["c"]) == 12_000
    vector = P.assembled(train.filter("n = 7"), prep).first()["features"]
    assert vector.size == 12_001 and vector[7] == 1.0 and vector.numNonzeros() == 2
    codes = B.category_codes(train, "c", "code").agg({"code": "max"}).first()[0]
    assert codes == 11_999
