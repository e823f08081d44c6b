import pytest
from pyspark.sql import functions as F

from caresift.functions import rates as R
from caresift.operators import curves as C
from caresift.operators import metrics as M
from caresift.operators import thresholds as T

SCHEMA = "model string, grp string, y_true int, y_prob double"


def scored(spark, rows):
    return spark.createDataFrame([("m", g, y, p) for g, y, p in rows], SCHEMA)


def test_counts_sum_to_rows_and_rates_use_zero_for_empty_denominators(spark):
    df = scored(spark, [("a", 1, 0.1), ("a", 1, 0.2), ("b", 1, 0.3)])
    row = M.with_rates(M.confusion_counts(df, ["model"], R.decide())).first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (0, 0, 3, 0)
    assert row["precision"] == row["recall"] == row["specificity"] == row["f1"] == 0.0


def test_gap_keeps_groups_without_positives(spark):
    df = scored(spark, [("a", 1, 0.9), ("b", 0, 0.9)])
    assert M.recall_gap(df, ["model"], "grp", R.decide()).first()["gap"] == 1.0


def test_gap_without_groups_is_zero(spark):
    df = scored(spark, []).drop("model")
    assert M.recall_gap(df, [], "grp", R.decide()).first()["gap"] == 0.0


def test_published_fitness_identity(spark):
    row = spark.createDataFrame(
        [(0.5493421052631579, 0.5168918918918919, 0.5439739413680782, 0.005863701515875341)],
        "recall double, specificity double, f1 double, gap double",
    ).select(R.tabular_fitness().alias("f")).first()
    assert row["f"] == pytest.approx(0.538846579051951, abs=1e-12)


def test_image_fitness_and_missing_area(spark):
    df = spark.createDataFrame([(0.9, 0.8, 0.85, 0.95), (0.9, 0.8, 0.85, None)], "recall double, specificity double, f1 double, auc_roc double")
    values = [r["f"] for r in df.select(R.image_fitness().alias("f")).collect()]
    assert values[0] == pytest.approx(0.8775)
    assert values[1] == pytest.approx(0.735)


def test_published_image_metrics_from_counts(spark):
    df = spark.createDataFrame([(83, 4, 1, 77)], "tp long, fp long, fn long, tn long")
    row = M.with_rates(df, floored=True).first()
    assert round(row["accuracy"], 4) == 0.9697
    assert round(row["recall"], 4) == 0.9881
    assert round(row["specificity"], 4) == 0.9506
    assert round(row["f1"], 4) == 0.9708


def test_area_with_all_scores_tied_is_half(spark):
    df = scored(spark, [("a", 1, 0.4), ("a", 0, 0.4), ("a", 0, 0.4)])
    assert C.areas(df, ["model"]).first()["auc_roc"] == 0.5


def test_areas_are_null_on_one_class(spark):
    row = C.areas(scored(spark, [("a", 1, 0.4), ("a", 1, 0.6)]), ["model"]).first()
    assert row["auc_roc"] is None and row["average_precision"] is None


def test_area_of_reversed_scores_is_the_complement(spark):
    import random

    rng = random.Random(5)
    rows = [("a", rng.randint(0, 1), round(rng.random(), 2)) for _ in range(500)]
    rows += [("a", rng.randint(0, 1), 0.77) for _ in range(300)]
    df = scored(spark, rows)
    up = C.areas(df, ["model"]).first()["auc_roc"]
    down = C.areas(df.withColumn("y_prob", 1 - F.col("y_prob")), ["model"]).first()["auc_roc"]
    pairs = [(p > n) + 0.5 * (p == n) for _, y, p in rows if y for _, z, n in rows if not z]
    assert up == pytest.approx(sum(pairs) / len(pairs))
    assert up + down == pytest.approx(1.0)


def test_roc_has_origin_and_end(spark):
    points = C.roc_points(scored(spark, [("a", 1, 0.9), ("a", 0, 0.2)]), ["model"]).collect()
    assert {(p["fpr"], p["tpr"]) for p in points} == {(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)}


def test_class_report_supports(spark):
    df = scored(spark, [("a", 1, 0.9), ("a", 0, 0.9), ("a", 0, 0.1)])
    rows = {r["label"]: r for r in M.class_report(df, ["model"], R.decide()).collect()}
    assert rows["0"]["support"] == 2 and rows["1"]["support"] == 1
    assert rows["macro avg"]["recall"] == pytest.approx(0.75)
    assert rows["weighted avg"]["recall"] == pytest.approx(2 / 3)
    assert rows["accuracy"]["f1"] == pytest.approx(2 / 3)


# --- thresholds -------------------------------------------------------------------


def test_weighted_recall_prefers_high_recall(spark):
    df = scored(spark, [("a", 0, 0.1), ("a", 0, 0.3), ("a", 1, 0.8), ("a", 1, 0.9)])
    row = T.weighted_recall(df, ["model"]).first()
    assert row["recall"] == 1.0
    assert row["threshold"] == pytest.approx(0.31)


def test_ties_give_the_lowest_threshold(spark):
    df = scored(spark, [("a", 1, 0.95), ("a", 0, 0.05)])
    assert T.recall_first(df, ["model"]).first()["threshold"] == 0.1


def test_threshold_equal_to_a_score_counts_as_reached(spark):
    df = scored(spark, [("a", 1, 0.7)])
    double = T.sweep(df, ["model"], [0.7]).first()
    single = T.sweep(df, ["model"], [0.7], single_precision=True).first()
    assert double["tp"] == single["tp"] == 1
    held = spark.createDataFrame([(0.7,)], "y_prob float")
    row = held.select(R.decide("y_prob", 0.7).alias("d"), R.decide_float("y_prob", 0.7).alias("f")).first()
    assert (row["d"], row["f"]) == (0, 1)


def test_missing_scores_never_reach_a_threshold(spark):
    df = scored(spark, [("a", 1, None), ("a", 1, float("nan")), ("a", 1, 0.9)])
    row = T.sweep(df, ["model"], [0.5]).first()
    assert (row["tp"], row["fn"]) == (1, 2)


def test_recall_never_rises_with_the_threshold(spark):
    import random

    rng = random.Random(1)
    df = scored(spark, [("a", rng.randint(0, 1), rng.random()) for _ in range(400)])
    rows = T.sweep(df, ["model"], [i / 20 for i in range(1, 20)]).orderBy("threshold").collect()
    recalls = [r["recall"] for r in rows]
    assert recalls == sorted(recalls, reverse=True)
    assert all(r["tp"] + r["fp"] + r["fn"] + r["tn"] == 400 for r in rows)


def test_lowest_threshold_falls_back_to_best_recall(spark):
    low = scored(spark, [("a", 1, 0.05), ("a", 1, 0.6), ("a", 0, 0.3)])
    row = T.lowest_with_recall(low, ["model"]).first()
    assert row["recall"] == 0.5
    assert 0.3 < row["threshold"] < 0.32
    enough = scored(spark, [("a", 1, 0.8), ("a", 0, 0.3)])
    assert T.lowest_with_recall(enough, ["model"]).first()["threshold"] == pytest.approx(0.15)


def test_sweep_over_the_whole_table(spark):
    df = scored(spark, [("a", 1, 0.8), ("a", 0, 0.3)]).drop("model")
    assert T.recall_first(df, []).first()["threshold"] == 0.35
