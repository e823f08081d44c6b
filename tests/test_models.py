import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caresift.operators import explain as X
from caresift.operators import models as MOD
from caresift.operators import neighbors as N
from caresift.operators import selection as S
from caresift.plans import search


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        age, smoke = rng.randint(30, 80), rng.randint(1, 2)
        sick = rng.random() < 0.15 + 0.5 * (smoke == 2) + 0.2 * (age > 60)
        rows.append((str(i), rng.choice(["F", "M", None]), age if i % 17 else None, smoke, "YES" if sick else "NO"))
    df = spark.createDataFrame(rows, "case_key string, GENDER string, AGE int, SMOKING int, LUNG_CANCER string")
    return search.prepare_dataset(df, "case_key")


def test_dataset_has_roles_and_split(data):
    assert data.categorical == ["GENDER"] and data.numeric == ["AGE", "SMOKING"]
    sizes = {r["split"]: r["count"] for r in data.rows.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 600 and abs(sizes["train"] - 360) <= 1
    assert {r["grp"] for r in data.rows.select("grp").distinct().collect()} == {"F", "M", "nan"}


def test_saturated_logistic_model_gives_class_frequencies(spark):
    rows = [(str(i), "a" if i % 3 else "b", int(i % 5 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "case_key string, c string, y_true int")
    from caresift.operators.prep import fit_preparation

    prep = fit_preparation(df, ["c"], [])
    fitted = MOD.fit(MOD.LOGISTIC, {"C": 1e9, "max_iter": 200}, df, prep)
    got = {r["c"]: r["p"] for r in fitted.score(df).groupBy("c").agg(F.max("y_prob").alias("p")).collect()}
    want = {r["c"]: r["p"] for r in df.groupBy("c").agg(F.avg("y_true").alias("p")).collect()}
    assert got == pytest.approx(want, abs=1e-4)


@pytest.mark.parametrize(
    "name,params",
    [
        (MOD.LOGISTIC, {"C": 0.5, "penalty": "l1", "class_weight": "balanced", "solver": "saga"}),
        (MOD.FOREST, {"n_estimators": 5, "max_depth": 31, "max_features": 0.8, "min_samples_split": 4}),
        (MOD.EXTRA, {"n_estimators": 5, "max_depth": "none"}),
        (MOD.NEIGHBORS, {"n_neighbors": 5, "weights": "distance", "p": 1}),
    ],
)
def test_every_model_scores_every_row(data, name, params):
    scored = MOD.fit(name, params, data.part("train"), data.prep).score(data.part("val"))
    row = scored.agg(F.count("*").alias("n"), F.count("y_prob").alias("p"), F.min("y_prob").alias("lo"), F.max("y_prob").alias("hi")).first()
    assert row["n"] == row["p"] == data.part("val").count()
    assert 0 <= row["lo"] <= row["hi"] <= 1


def test_failing_candidates_get_minus_one(data):
    rows = {r["cand"]: r for r in search.score_candidates(data, [(0, MOD.LOGISTIC, {}), (1, "Nope", {})]).collect()}
    assert rows[0]["fitness"] > 0 and rows[0]["error"] is None
    assert rows[1]["fitness"] == -1.0 and "Unsupported model" in rows[1]["error"]
    with pytest.raises(ValueError):
        MOD.known_params("Nope", {})
    assert MOD.known_params(MOD.NEIGHBORS, {"p": 2, "alien": 1}) == {"p": 2}


@pytest.mark.parametrize("name,params", [(MOD.FOREST, {"n_estimators": 4, "max_depth": 4}), (MOD.NEIGHBORS, {"n_neighbors": 3})])
def test_artifact_round_trip(data, tmp_path, name, params):
    fitted, chosen, test = search.final_model(data, name, params)
    threshold = chosen.first()["threshold"]
    assert 0.1 <= threshold <= 0.9 and 0 <= test.first()["accuracy"] <= 1
    MOD.save_artifact(fitted, str(tmp_path), threshold, data.features, {"accuracy": test.first()["accuracy"]})
    loaded, meta = MOD.load_artifact(str(tmp_path))
    assert meta["threshold"] == threshold and meta["feature_columns"] == data.features
    part = data.part("test")
    a = {r["case_key"]: r["y_prob"] for r in fitted.score(part).collect()}
    b = {r["case_key"]: r["y_prob"] for r in loaded.score(part).collect()}
    assert a == b


def test_search_keeps_the_best_and_does_not_refit_known_candidates(data, monkeypatch):
    fitted = []
    original = MOD.fit_many

    def counting(jobs, *args, **kwargs):
        fitted.extend(jobs)
        return original(jobs, *args, **kwargs)

    monkeypatch.setattr(MOD, "fit_many", counting)
    space = {MOD.LOGISTIC: [("C", "float", 0.01, 10.0, []), ("penalty", "cat", 0.0, 0.0, ["l1", "l2"])]}
    runs = [{"name": "e", "pop_size": 3, "generations": 2, "cx_prob": 0.8, "mut_prob": 0.2, "seed": 7}]
    rows = search.run_search(data, space, runs).collect()
    assert len(rows) == 6 and len(fitted) < 6
    best = [max(r["fitness"] for r in rows if r["generation"] == g) for g in (0, 1)]
    assert best[1] >= best[0] > 0


def brute_force(train, queries, k, p, weights):
    out = {}
    for q, v in queries:
        d = sorted((float(np.abs(v - w).sum() if p == 1 else np.sqrt(((v - w) ** 2).sum())), n, y) for n, w, y in train)[:k]
        if weights == "uniform":
            out[q] = sum(y for _, _, y in d) / len(d)
        else:
            exact = [y for dist, _, y in d if dist == 0]
            out[q] = sum(exact) / len(exact) if exact else sum(y / s for s, _, y in d) / sum(1 / s for s, _, _ in d)
    return out


@pytest.mark.parametrize("p,weights,block", [(2, "uniform", 2048), (1, "distance", 7)])
def test_neighbors_match_brute_force_with_a_hot_spot(spark, p, weights, block):
    rng = np.random.default_rng(2)
    base = [(i, rng.integers(0, 4, 3).astype(float) + (50 if i % 2 else 0), int(rng.integers(0, 2))) for i in range(120)]
    base += [(1000 + i, np.array([1.0, 1.0, 1.0]), i % 2) for i in range(60)]
    asked = [(i, rng.integers(0, 4, 3).astype(float) + (50 if i % 3 else 0)) for i in range(40)]
    train = spark.createDataFrame([(i, v.tolist(), y) for i, v, y in base], "id long, v array<double>, y int")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in asked], "id long, v array<double>")
    found = N.nearest(train, queries, "id", "v", "y", 5, p=p, pivots=6, block_rows=block)
    got = {r["id"]: r["y_prob"] for r in N.vote(found, "id", weights).collect()}
    assert got == pytest.approx(brute_force(base, asked, 5, p, weights))


def test_fewer_training_rows_than_neighbours(spark):
    train = spark.createDataFrame([(1, [0.0], 1), (2, [5.0], 0)], "id long, v array<double>, y int")
    queries = spark.createDataFrame([(9, [1.0])], "id long, v array<double>")
    assert N.nearest(train, queries, "id", "v", "y", 7).count() == 2


def test_permutation_values_add_up(data):
    fitted = MOD.fit(MOD.LOGISTIC, {}, data.part("train"), data.prep)
    background = {**data.prep.modes, **data.prep.medians}
    table = X.sampled_shapley(fitted, data.part("val"), background, permutations=2)
    values = {r["feature"]: r["mean_impact"] for r in table.collect()}
    assert set(values) == {"GENDER", "AGE", "SMOKING"} and max(values, key=values.get) == "SMOKING"


def test_tree_attribution_equals_all_subsets(spark):
    """Every value against the definition, over all subsets of four columns."""
    from itertools import combinations
    from math import factorial

    from pyspark.ml.functions import vector_to_array

    from caresift.operators.prep import assembled, fit_preparation

    draw = random.Random(9)
    rows = []
    for i in range(300):
        c, a, b, d = draw.choice(["u", "v", "w", None]), draw.randint(0, 5), draw.choice([1, 2]), round(draw.random(), 2)
        rows.append((str(i), c, a, b, d, int(draw.random() < 0.2 + 0.3 * (c == "u") + 0.3 * (a > 2) * (b == 2) + 0.2 * d)))
    df = spark.createDataFrame(rows, "case_key string, c string, a int, b int, d double, y_true int")
    prep = fit_preparation(df, ["c"], ["a", "b", "d"])
    fitted = MOD.fit(MOD.FOREST, {"n_estimators": 6, "max_depth": 6}, df, prep)
    background = {"c": "v", "a": 2, "b": 1, "d": 0.4}
    names = ["c", "a", "b", "d"]
    asked = [dict(zip(names, r[1:5])) for r in rows[:25]]
    mixed = []
    for i, row in enumerate(asked):
        for k in range(5):
            for shown in combinations(names, k):
                mixed.append((f"{i}|{','.join(shown)}", *[row[n] if n in shown else background[n] for n in names]))
    scored = fitted.score(spark.createDataFrame(mixed, "case_key string, c string, a int, b int, d double"))
    p = {r["case_key"]: r["y_prob"] for r in scored.collect()}
    want = []
    for i in range(len(asked)):
        values = []
        for n in names:
            others = [m for m in names if m != n]
            value = 0.0
            for k in range(4):
                for shown in combinations(others, k):
                    with_n = [m for m in names if m in shown or m == n]
                    gain = p[f"{i}|{','.join(with_n)}"] - p[f"{i}|{','.join(m for m in names if m in shown)}"]
                    value += factorial(k) * factorial(3 - k) / 24 * gain
            values.append(value)
        want.append(values)
    ready = assembled(df.limit(25), prep).orderBy(F.col("case_key").cast("int")).select(vector_to_array("features").alias("x")).collect()
    base = assembled(spark.createDataFrame([("b", *background.values())], "case_key string, c string, a int, b int, d double"), prep)
    base = np.array(base.select(vector_to_array("features").alias("x")).first()["x"])
    owner = np.array([0, 0, 0, 1, 2, 3])
    got = X.leaf_values(np.array([r["x"] for r in ready]), base, X.leaf_paths(fitted), owner)
    assert np.allclose(got, want, atol=1e-9)
    table = {r["feature"]: r["mean_impact"] for r in X.tree_attribution(fitted, df.limit(25), background).collect()}
    assert [table[n] for n in names] == pytest.approx(np.abs(want).mean(axis=0).tolist())


def test_importance_names_come_from_the_preparation(data):
    fitted = MOD.fit(MOD.FOREST, {"n_estimators": 5, "max_depth": 4}, data.part("train"), data.prep)
    rows = X.feature_importance(fitted, 3).collect()
    assert len(rows) == 3 and {r["feature"] for r in rows} <= set(data.prep.feature_names)


def test_multilayer_head(spark):
    rows = [([float(i % 2), float(i % 3)], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "v array<double>, y int")
    scored = MOD.score_head(MOD.fit_head(df, "v", "y", hidden=4), df, "v")
    assert scored.filter((F.col("y_prob") >= 0.5) == (F.col("y") == 1)).count() == 60


# --- training logs --------------------------------------------------------------------


def history(spark, values):
    return spark.createDataFrame([("r", "val_loss", i, v) for i, v in enumerate(values)], "run string, metric string, epoch long, value double")


def test_early_stop_and_best_epoch(spark):
    h = history(spark, [0.5, 0.4, 0.4, 0.41, 0.3])
    assert S.best_epoch(h, ["run"], "val_loss").first()["best_epoch"] == 4
    assert S.early_stop(h, ["run"], "val_loss", 2).first()["stop_epoch"] == 3
    assert S.early_stop(h, ["run"], "val_loss", 3).first()["stop_epoch"] is None
    flat = history(spark, [0.4, 0.4, 0.4])
    assert S.best_epoch(flat, ["run"], "val_loss").first()["best_epoch"] == 0


def test_plateau_needs_a_gain_above_the_margin(spark):
    h = history(spark, [0.5, 0.49995, 0.4999, 0.49985])
    rows = S.plateau_rates(h, "run", "val_loss", patience=1, start_rate=4e-6).orderBy("epoch").collect()
    assert [r["learning_rate"] for r in rows] == pytest.approx([4e-6, 2e-6, 2e-6, 1e-6]) or [
        r["learning_rate"] for r in rows
    ] == pytest.approx([4e-6, 2e-6, 1e-6, 1e-6])
    assert [r["reduced"] for r in rows][:2] == [False, True]


def test_grid_points_and_choice(spark):
    points = S.grid_points({"m": {"b": [1, 2], "a": ["x"]}}, spark).orderBy("point").collect()
    assert [r["params"] for r in points] == ['{"a": "x", "b": 1}', '{"a": "x", "b": 2}']
    tied = spark.createDataFrame([("m", 1, 0.5, 0.5, 0.5), ("m", 0, 0.5, 0.5, 0.5)], "model string, point int, recall double, f1 double, accuracy double")
    assert S.grid_choice(tied).first()["point"] == 0
