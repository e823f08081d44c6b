from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from caresift.operators.scoring import risk_band
from caresift.session import BROADCAST_ROW_LIMIT, checked_broadcast, scratch_root
from caresift.sources import documents as DOC
from caresift.sources import images as IMG
from caresift.sources import tables as TAB
from caresift.streaming import file_drop

EXPECTED = {"AGE": "int", "CHRONIC DISEASE": "int"}


def score(df):
    p = F.col("AGE") / 100
    return df.select("file_path", "row_index", "AGE", p.alias("y_prob"), risk_band(p).alias("risk_level"))


def test_missing_csv_names_the_path(spark):
    with pytest.raises(FileNotFoundError, match="nowhere.csv"):
        TAB.read_csv(spark, "/tmp/nowhere.csv")


def test_csv_types_are_inferred_without_a_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("GENDER,AGE,FATIGUE \nM,61,2\nF,50,1\n")
    df = TAB.read_csv(spark, str(tmp_path / "a.csv"))
    assert dict(df.dtypes)["AGE"] == "int" and "FATIGUE " in df.columns


def test_catalogue_from_folders(spark, tmp_path):
    for folder, name in (("Normal cases", "a (1).jpg"), ("Malignant cases", "b+1.jpg"), ("Other", "c.jpg"), ("Bengin cases", "d.png")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_bytes(b"\xff\xd8")
    rows = {(r["class_original"], r["label"]) for r in IMG.read_catalogue(spark, str(tmp_path)).collect()}
    assert rows == {("Normal cases", 0), ("Malignant cases", 1)}
    (tmp_path / "empty").mkdir()
    with pytest.raises(RuntimeError):
        IMG.read_catalogue(spark, str(tmp_path / "empty"))


def test_phases_are_joined_in_order(spark):
    rows = [("r", 1, '{"loss": [3.0]}'), ("r", 0, '{"loss": [1.0, 2.0], "auc": [0.5]}')]
    df = spark.createDataFrame(rows, "run string, phase int, doc string")
    got = {(r["metric"], r["epoch"]): r["value"] for r in DOC.epoch_rows(df, "run", "phase", "doc").collect()}
    assert got == {("loss", 0): 1.0, ("loss", 1): 2.0, ("loss", 2): 3.0, ("auc", 0): 0.5}


def test_cache_appends(spark, tmp_path):
    path = str(tmp_path / "cache")
    DOC.write_cache(spark.createDataFrame([(1, "a")], "k int, t string"), path)
    DOC.write_cache(spark.createDataFrame([(2, "b")], "k int, t string"), path)
    assert spark.read.parquet(path).count() == 2


def test_each_dropped_file_is_scored_on_its_own(spark, tmp_path):
    drop, out, check = tmp_path / "drop", str(tmp_path / "out"), str(tmp_path / "check")
    drop.mkdir()
    (drop / "one.csv").write_text("age,Chronic_Disease,more\n80,1,x\n45,2,y\n10,1,z\n")
    (drop / "two.csv").write_text("CHRONIC DISEASE ,AGE\n2,71\n1,bad\n")
    (drop / "three.csv").write_text("AGE\n50\n")
    (drop / "four.txt").write_text("AGE\n50\n")
    file_drop.score_csv_arrivals(spark, str(drop), EXPECTED, score, out, check)
    status = {r["file_path"].rsplit("/", 1)[1]: (r["status"], r["message"]) for r in spark.read.parquet(f"{out}/status").collect()}
    assert status["one.csv"][0] == status["two.csv"][0] == "success"
    assert status["three.csv"] == ("error", "CSV missing required columns: ['CHRONIC DISEASE']")
    assert status["four.txt"][1] == "Invalid file type. Only .csv files are allowed"
    rows = {(r["file_path"].rsplit("/", 1)[1], r["row_index"]): (r["AGE"], r["risk_level"]) for r in spark.read.parquet(f"{out}/rows").collect()}
    assert rows == {
        ("one.csv", 0): (80, "alto"),
        ("one.csv", 1): (45, "moderado"),
        ("one.csv", 2): (10, "baixo"),
        ("two.csv", 0): (71, "alto"),
        ("two.csv", 1): (None, "baixo"),
    }
    (drop / "late.csv").write_text("AGE,CHRONIC DISEASE\n99,1\n")
    file_drop.score_csv_arrivals(spark, str(drop), EXPECTED, score, out, check)
    assert spark.read.parquet(f"{out}/rows").count() == 6


def test_fixed_schema_stream(spark, tmp_path):
    drop = tmp_path / "fixed"
    drop.mkdir()
    (drop / "a.csv").write_text("k,p\nx,0.9\ny,0.2\n")
    stream = file_drop.arriving_csv(spark, str(drop), "k string, p double")
    file_drop.score_arrivals(stream, lambda b: b.withColumn("band", risk_band("p")), str(tmp_path / "o"), str(tmp_path / "c"))
    rows = {r["k"]: (r["band"], r["file_path"].endswith(quote("a.csv"))) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert rows == {"x": ("alto", True), "y": ("baixo", True)}


def test_broadcast_only_below_the_limit(spark):
    small, large = checked_broadcast(spark.range(3), 3), checked_broadcast(spark.range(4), 3)
    assert small.count() == 3 and large.count() == 4
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    joined = spark.range(10).join(small, "id")
    assert "broadcast" in plan(joined).lower() and BROADCAST_ROW_LIMIT > 0
    assert "strategy=broadcast" not in plan(spark.range(10).join(large, "id"))


def test_scratch_is_the_shared_folder(spark):
    assert scratch_root(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_epochs_are_the_same_whether_phases_lie_in_one_cell_or_more(spark, monkeypatch):
    docs = [(r, p, '{"loss": [%d.0, 1.0], "acc": [0.%d]}' % (p, r)) for r in (1, 2) for p in (0, 1, 2)]
    docs += [(3, 0, None), (3, 1, "{}"), (3, 2, '{"loss": []}'), (None, 0, '{"loss": [7.0]}'), (4, None, '{"loss": [5.0]}')]
    df = spark.createDataFrame(docs, "run int, phase int, doc string")
    one = sorted(map(tuple, DOC.epoch_rows(df, "run", "phase", "doc").collect()), key=repr)
    monkeypatch.setattr(DOC, "PHASES_PER_CELL", 2)
    assert one == sorted(map(tuple, DOC.epoch_rows(df, "run", "phase", "doc").collect()), key=repr)
    assert (2, "loss", 4, 2.0) in one and len(one) == 2 * (6 + 3) + 1


def test_documents_are_parsed_once(spark):
    """An inner explode of a parsed text is parsed again by a filter for empty ones."""
    results = DOC.result_rows(spark.createDataFrame([(1, "{}")], "k int, doc string"), ["k"], "doc")
    epochs = DOC.epoch_rows(spark.createDataFrame([(1, 0, "{}")], "run int, phase int, doc string"), "run", "phase", "doc")
    for df in (results, epochs):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1
        assert df.count() == 0
