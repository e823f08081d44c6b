"""Fits side by side, whole searches and their export."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caresift.functions.constants import IMAGE_SPACE
from caresift.operators import forest_batch as FB
from caresift.operators import logistic_batch as LB
from caresift.operators import metrics as M
from caresift.operators import models as MOD
from caresift.operators import neighbors as N
from caresift.operators import prep as P
from caresift.operators import selection as S
from caresift.operators import split as D
from caresift.plans import search


@pytest.fixture(scope="module")
def points(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(400, 4)) * [1, 2, 0.5, 1]
    y = (draw.random(400) < 1 / (1 + np.exp(-(x @ [1.0, -0.5, 0.0, 0.0] - 0.7)))).astype(int)
    groups = draw.choice(["a", "b", None], 400)
    rows = [(i, int(y[i]), groups[i], x[i].tolist()) for i in range(400)]
    return x, y, groups, spark.createDataFrame(rows, "k long, y int, g string, vec array<double>").repartition(5)


def jobs():
    return [
        LB.LogisticJob("l2", 0.01, (1.0, 1.0), 500),
        LB.LogisticJob("l2", 1.0, (0.8, 1.4), 500),
        LB.LogisticJob("l1", 0.02, (1.0, 1.0), 500),
        LB.LogisticJob("l1", 0.2, (0.7, 1.9), 500),
        LB.LogisticJob("l1", 50.0, (1.0, 1.0), 500),
    ]


def test_every_fit_is_optimal(points):
    """The slope of the objective is zero, or within the penalty where an absolute penalty holds a coefficient at zero."""
    x, y, _, rows = points
    fits = jobs()
    LB.fit_all(rows, "y", "vec", fits)
    ones = np.hstack([x, np.ones((len(x), 1))])
    for job in fits:
        w = np.where(y == 1, job.weights[1], job.weights[0])
        p = 1 / (1 + np.exp(-(ones @ job.accepted)))
        slope = ones.T @ (w * (p - y)) / w.sum()
        assert abs(slope[-1]) < 1e-7
        for b, s in zip(job.accepted[:-1], slope[:-1]):
            if job.penalty == "l2":
                assert abs(s + job.strength * b) < 1e-7
            elif b == 0:
                assert abs(s) <= job.strength + 1e-9
            else:
                assert abs(s + job.strength * np.sign(b)) < 1e-7
    assert np.count_nonzero(fits[2].accepted[:-1]) > np.count_nonzero(fits[4].accepted[:-1]) == 0


def test_partial_sums_are_added_in_a_tree(points, monkeypatch):
    whole, small = jobs()[:2], jobs()[:2]
    LB.fit_all(points[3], "y", "vec", whole)
    monkeypatch.setattr(LB, "FAN_IN", 2)
    monkeypatch.setattr(LB, "HELD_NUMBERS", 40)
    LB.fit_all(points[3], "y", "vec", small)
    for a, b in zip(whole, small):
        assert np.allclose(a.accepted, b.accepted, atol=1e-9)


def test_iterations_are_bounded(points):
    job = LB.LogisticJob("l2", 1e-9, (1.0, 1.0), 1)
    LB.fit_all(points[3], "y", "vec", [job])
    assert job.rounds == 2


def test_no_rows_and_null_labels(spark, points):
    with pytest.raises(ValueError, match="no training rows"):
        LB.fit_all(points[3].limit(0), "y", "vec", jobs())
    extra = spark.createDataFrame([(9999, None, "a", [1e6] * 4)], points[3].schema)
    one, other = jobs()[:1], jobs()[:1]
    LB.fit_all(points[3], "y", "vec", one)
    LB.fit_all(points[3].unionByName(extra), "y", "vec", other)
    assert np.allclose(one[0].accepted, other[0].accepted)


def test_confusion_cells(points):
    x, y, groups, rows = points
    coefs = np.random.default_rng(1).normal(size=(3, 5))
    got = {(r["cand"], r["grp"]): (r["tp"], r["fp"], r["fn"], r["tn"]) for r in LB.confusion_cells(rows, "y", "vec", "g", coefs, 0.3).collect()}
    ones = np.hstack([x, np.ones((len(x), 1))])
    for k in range(3):
        hit = 1 / (1 + np.exp(-(ones @ coefs[k]))) >= 0.3
        for g in ("a", "b", None):
            mine = np.array([v == g for v in groups])
            want = tuple(int((mine & (y == t) & (hit == h)).sum()) for t, h in ((1, True), (0, True), (1, False), (0, False)))
            assert got[k, g] == want


def arrays(seed, rows=400):
    draw = np.random.default_rng(seed)
    bins = draw.integers(0, [4, 2, 6], (rows, 3))
    bins, inverse = np.unique(bins, axis=0, return_inverse=True)
    p = 0.2 + 0.6 * ((bins[:, 0] >= 2) ^ (bins[:, 1] == 1))
    label = draw.random(rows) < p[inverse]
    counts = np.stack([np.bincount(inverse, ~label, len(bins)), np.bincount(inverse, label, len(bins))], axis=1).astype(int)
    values = [np.arange(4.0), np.arange(2.0), np.arange(6.0)]
    return bins, np.arange(len(bins)) * 7919 - 5000, counts, values


def plain_tree(bins, counts, job, depth=0):
    """Share of label 1 for every group, by trying every cut of every feature; the first best feature counts."""
    weight = np.array(job.weights)
    total = counts.sum(axis=0)
    out = np.full(len(bins), (total * weight)[1] / (total * weight).sum())
    if (total == 0).any() or total.sum() < job.min_split or depth == job.max_depth:
        return out
    best = None
    for j in range(bins.shape[1]):
        for c in range(bins[:, j].max()):
            low = bins[:, j] <= c
            a, b = counts[low].sum(axis=0), counts[~low].sum(axis=0)
            if min(a.sum(), b.sum()) < max(1, job.min_leaf):
                continue
            score = sum(((s * weight) ** 2).sum() / (s * weight).sum() for s in (a, b))
            if best is None or score > best[0] + 1e-9:
                best = (score, low)
    if best is None:
        return out
    for part in (best[1], ~best[1]):
        out[part] = plain_tree(bins[part], counts[part], job, depth + 1)
    return out


@pytest.mark.parametrize("job", [FB.ForestJob(1, share=None, drawn_cuts=True), FB.ForestJob(1, 2, 5, 3, None, (0.7, 1.6), drawn_cuts=True)])
def test_a_tree_with_all_cuts_equals_plain_search(job, monkeypatch):
    """Whole-sample trees with best cuts: the cut that a node would draw is set aside."""
    bins, keys, counts, values = arrays(1)
    whole = FB.ForestJob(**{**job.__dict__, "drawn_cuts": False})
    monkeypatch.setattr(FB, "bootstrap", lambda job, tree, keys, counts: counts.astype(float))
    tree = FB.grow(whole, 0, bins, keys, counts, FB.first_bins(values), values)
    assert np.allclose(tree.share[tree.leaf_of(bins)], plain_tree(bins, counts, whole))


def test_drawn_cuts_lie_between_the_values_of_a_node():
    bins, keys, counts, values = arrays(2)
    first = FB.first_bins(values)
    firsts = set()
    for number in range(60):
        tree = FB.grow(FB.ForestJob(60, drawn_cuts=True), number, bins, keys, counts, first, values)
        leaf = tree.leaf_of(bins)
        for node in np.unique(leaf):
            mine = counts[leaf == node].sum(axis=0)
            assert tree.share[node] == pytest.approx(mine[1] / mine.sum())
            # a leaf is pure, or its rows cannot be told apart
            assert (mine == 0).any() or len(np.unique(bins[leaf == node], axis=0)) == 1
        firsts.add((int(tree.feature[0]), int(tree.cut[0])))
    assert len(firsts) > 3


def test_bootstrap_draws_poisson_counts():
    keys = np.arange(40_000) * 31 - 600_000
    for n in (0, 1, 7, 32, 33, 500):
        drawn = FB.bootstrap(FB.ForestJob(seed=3), 5, keys, np.full((len(keys), 2), n))
        assert drawn.mean() == pytest.approx(n, rel=0.01, abs=0.01) and drawn.var() == pytest.approx(n, rel=0.03, abs=0.02)
        assert (drawn >= 0).all() and (drawn == np.rint(drawn)).all()
    half = FB.bootstrap(FB.ForestJob(seed=3), 5, keys[::2], np.full((20_000, 2), 500))
    assert (half == drawn[::2]).all()
    assert abs(np.corrcoef(drawn[:, 0], drawn[:, 1])[0, 1]) < 0.05


def test_passes_grow_the_same_trees(spark, monkeypatch):
    bins, keys, counts, values = arrays(3)
    rows = [(bytes(b.astype(np.uint8)), int(k), int(c[0]), int(c[1])) for b, k, c in zip(bins, keys, counts)]
    groups = spark.createDataFrame(rows, "bins binary, key long, n0 long, n1 long").repartition(3)
    monkeypatch.setattr(FB, "PASS_NUMBERS", 200)
    monkeypatch.setattr(FB, "FAN_IN", 2)
    jobs = [(FB.ForestJob(2, 5), 0), (FB.ForestJob(2, None, drawn_cuts=True), 1)]
    for (job, number), tree in zip(jobs, FB.grow_by_passes(groups, jobs, values)):
        alone = FB.grow(job, number, bins, keys, counts, FB.first_bins(values), values)
        assert np.allclose(tree.share[tree.leaf_of(bins)], alone.share[alone.leaf_of(bins)])
        assert sorted(tree.feature.tolist()) == sorted(alone.feature.tolist())


def test_forests_in_tasks_and_by_passes_agree(points, monkeypatch):
    x, y, groups, rows = points
    wide = rows.withColumn("vec", F.transform("vec", lambda v: F.round(v, 0)))
    jobs = [(4, FB.ForestJob(6, 4, weights=(0.8, 1.3))), (9, FB.ForestJob(20, drawn_cuts=True))]
    train, test = wide.filter("k % 3 > 0"), wide.filter("k % 3 = 0")
    one = sorted(map(tuple, FB.confusion_cells(train, test, "y", "vec", "g", jobs, 0.5).collect()), key=repr)
    assert sum(sum(r[2:]) for r in one) == 2 * test.count()
    monkeypatch.setattr(FB, "LOCAL_GROUPS", 10)
    other = sorted(map(tuple, FB.confusion_cells(train, test, "y", "vec", "g", jobs, 0.5).collect()), key=repr)
    assert one == other


def test_bins_of_many_and_few_values(spark):
    rows = [([float(k % 3), float(k), float("nan") if k == 5 else 1.0],) for k in range(2000)]
    edges, values = FB.bin_edges(spark.createDataFrame(rows, "vec array<double>").repartition(3), "vec")
    assert values[0].tolist() == [0.0, 1.0, 2.0] and edges[0].tolist() == [0.5, 1.5] and len(edges[2]) == 0
    assert 200 < len(edges[1]) < 256 and len(values[1]) == len(edges[1]) + 1


@pytest.fixture(scope="module")
def data(spark):
    draw = random.Random(11)
    rows = []
    for i in range(500):
        age, smoke = draw.randint(30, 80), draw.randint(1, 2)
        sick = draw.random() < 0.15 + 0.5 * (smoke == 2) + 0.2 * (age > 60)
        rows.append((str(i), draw.choice(["F", "M", None]), age if i % 17 else None, smoke, "YES" if sick else "NO"))
    df = spark.createDataFrame(rows, "case_key string, GENDER string, AGE int, SMOKING int, LUNG_CANCER string")
    return search.prepare_dataset(df, "case_key")


def test_side_by_side_equals_one_by_one(data):
    candidates = [
        (MOD.LOGISTIC, {"C": 0.05, "penalty": "l2", "max_iter": 500}),
        (MOD.LOGISTIC, {"C": 0.3, "penalty": "l1", "class_weight": "balanced", "solver": "saga", "max_iter": 500}),
        (MOD.NEIGHBORS, {"n_neighbors": 7, "weights": "distance", "p": 1}),
        (MOD.NEIGHBORS, {"n_neighbors": 3, "weights": "uniform", "p": 1}),
        (MOD.LOGISTIC, {"C": 0.05, "penalty": "l2", "max_iter": 500, "unknown": 3}),
        (MOD.LOGISTIC, {"C": 0.0}),
        ("Nothing", {}),
    ]
    got = {r["cand"]: r for r in search.score_candidates(data, [(i, n, p) for i, (n, p) in enumerate(candidates)]).collect()}
    assert sorted(got) == list(range(7))
    for i, (name, params) in enumerate(candidates[:4]):
        scored = MOD.fit(name, params, data.part("train"), data.prep).score(data.part("val"))
        hit = F.when(F.col("y_prob") >= 0.5, 1).otherwise(0)
        want = M.fairness_metrics(scored.withColumn("cand", F.lit(i)), ["cand"], "grp", hit).first()
        for c in ("fitness", "recall", "specificity", "f1", "gap"):
            assert got[i][c] == pytest.approx(want[c]), (name, c)
    assert got[4]["fitness"] == got[0]["fitness"]
    assert got[5]["fitness"] == got[6]["fitness"] == -1 and "C must be positive" in got[5]["error"] and "Nothing" in got[6]["error"]


def test_votes_of_many_candidates_from_one_search(data):
    train, val = data.vectors("train"), data.vectors("val")
    found = N.nearest(train, val, "case_key", "vec", "y_true", 9)
    many = N.votes(found, "case_key", [(0, "uniform", 9), (1, "distance", 4)])
    for cand, weights, k in ((0, "uniform", 9), (1, "distance", 4)):
        alone = {r["case_key"]: r["y_prob"] for r in N.vote(N.nearest(train, val, "case_key", "vec", "y_true", k), "case_key", weights).collect()}
        assert {r["case_key"]: r["y_prob"] for r in many.filter(F.col("cand") == cand).collect()} == pytest.approx(alone)


def test_crowded_cell_is_exact_and_copies_are_few(spark):
    """Most training rows stand in one cell: queries elsewhere do not visit it."""
    draw = np.random.default_rng(6)
    base = [(i, (draw.normal(size=3) * 0.01).tolist(), i % 2) for i in range(900)]
    base += [(1000 + i, (draw.normal(size=3) + 20 * (1 + i % 5)).tolist(), i % 2) for i in range(100)]
    asked = [(i, (draw.normal(size=3) + 20 * (1 + i % 5)).tolist()) for i in range(50)]
    train = spark.createDataFrame(base, "id long, v array<double>, y int")
    queries = spark.createDataFrame(asked, "id long, v array<double>")
    found = N.nearest(train, queries, "id", "v", "y", 5, pivots=40, block_rows=64).collect()
    got = {(r["id"], r["rank"]): r["neighbor"] for r in found}
    for q, v in asked:
        order = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), n) for n, w, _ in base)[:5]
        assert [got[q, k + 1] for k in range(5)] == [n for _, n in order]


def test_search_and_export(spark, data, tmp_path):
    space = {MOD.LOGISTIC: [("C", "float", 0.01, 10.0, []), ("penalty", "cat", 0.0, 0.0, ["l1", "l2"])], MOD.NEIGHBORS: [("n_neighbors", "int", 3.0, 15.0, [])]}
    experiments = [{"name": "e1", "pop_size": 4, "generations": 2, "cx_prob": 0.8, "mut_prob": 0.3, "seed": 1}]
    history = search.run_search(data, space, experiments)
    rows = history.collect()
    assert len(rows) == 2 * 2 * 4 and {r["model"] for r in rows} == set(space)
    ranking, test = search.export_best(data, history, str(tmp_path / "artifact"))
    ranked = ranking.orderBy("place").collect()
    assert [r["place"] for r in ranked] == [1, 2] and ranked[0]["fitness"] == max(r["fitness"] for r in rows)
    loaded, meta = MOD.load_artifact(str(tmp_path / "artifact"))
    assert loaded.name == ranked[0]["model"] and meta["selected_params"] == json.loads(ranked[0]["params"])
    assert meta["target_mapping"] == {"NO": 0, "YES": 1} and len(meta["validation_summary"]) == 1
    assert meta["validation_summary"][0]["threshold"] == meta["threshold"] == test.first()["threshold"]


def test_heads_are_searched_saved_and_loaded(spark, tmp_path):
    rows = [(str(i), [float(i % 2) + 0.1 * (i % 3), float(i % 5), 1.0], i % 2) for i in range(200)]
    v = spark.createDataFrame(rows, "key string, embedding array<double>, y_true int")
    score = search.head_scorer(v, "key")
    genes = {"frozen_epochs": 3, "fine_tune_epochs": 1, "use_class_weight": "true"}
    found = score([(0, "ImageHead", {**genes, "dense_units": "4"}), (1, "ImageHead", {**genes, "dense_units": "8"})]).collect()
    assert sorted(r["cand"] for r in found) == [0, 1] and max(r["recall"] for r in found) == 1.0
    assert set(IMAGE_SPACE) == {"ImageHead"}
    for hidden in (None, 4):
        head = MOD.fit_head(v, "embedding", "y_true", hidden, balanced=True)
        MOD.save_head(head, str(tmp_path / str(hidden)), 0.4, {"vector": "embedding"})
        again, meta = MOD.load_head(str(tmp_path / str(hidden)))
        assert meta["best_threshold"] == 0.4
        first, second = ({r["key"]: r["y_prob"] for r in MOD.score_head(m, v, "embedding").collect()} for m in (head, again))
        assert first == second


def test_equal_grid_points_go_to_the_first(spark, data):
    grid = {"C": [1.0, 1.0], "max_iter": [500]}
    found = search.grid_search(data, {"one": (MOD.LOGISTIC, {}, grid), "two": (MOD.LOGISTIC, {}, grid)})
    best = S.grid_choice(found.select("model", "point", "place", "params", "recall", "f1", "accuracy")).collect()
    assert {(r["model"], r["point"], r["place"]) for r in best} == {("one", 0, 0), ("two", 0, 2)}


def test_lasso_step_is_exact_where_columns_add_up_to_a_constant():
    import numpy as np

    from caresift.operators.logistic_batch import _lasso_step

    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 5))
    x[:, 0] = rng.integers(0, 2, 300)
    x[:, 1], x[:, 4] = 1 - x[:, 0], 1.0
    curve = x.T @ x / 1200
    curve += 1e-10 * np.trace(curve) / 5 * np.eye(5)
    slope, pull, at = x.T @ rng.normal(size=300) / 300, np.array([1e-6] * 4 + [0.0]), np.zeros(5)
    step = _lasso_step(at, slope, curve, pull)
    left, end = slope + curve @ step, at + step
    wrong = np.where(end != 0, np.abs(left + pull * np.sign(end)), np.maximum(np.abs(left) - pull, 0))
    assert wrong.max() < 1e-12


def test_equal_rows_are_one_row_with_their_number(spark, data, monkeypatch):
    monkeypatch.setattr(data, "tally", None)
    counted, rows = data.counted("train"), data.vectors("train")
    assert counted.count() < rows.count() == counted.agg(F.sum("n")).first()[0]
    one, other = (LB.LogisticJob("l2", 0.01, (1.0, 2.0), 100) for _ in range(2))
    LB.fit_all(rows, "y_true", "vec", [one])
    LB.fit_all(counted, "y_true", "vec", [other], "n")
    assert np.allclose(one.accepted, other.accepted, atol=1e-8)
    job = [(0, FB.ForestJob(trees=5, seed=3))]
    plain = FB.confusion_cells(rows, data.vectors("val"), "y_true", "vec", "grp", job, 0.5)
    short = FB.confusion_cells(counted, data.counted("val"), "y_true", "vec", "grp", job, 0.5, "n")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, short.collect()))


def test_wide_features_are_cut_by_rows_and_not_by_counted_rows(spark):
    rows = [([float(i)], 1000 if i == 0 else 1) for i in range(600)]
    counted = spark.createDataFrame(rows, "vec array<double>, n int")
    each = counted.select("vec", F.explode(F.sequence(F.lit(1), "n"))).select("vec")
    assert np.array_equal(FB.bin_edges(counted, "vec", "n")[0][0], FB.bin_edges(each, "vec")[0][0])


def test_only_the_first_keys_of_equal_rows_can_be_neighbours(spark, data):
    near = data.within_reach(2, "train")
    assert near.groupBy("vec").count().agg(F.max("count")).first()[0] >= 2 and near.count() < data.part("train").count()
    asked = data.vectors("val").select("case_key", "vec")
    found = [sorted(map(tuple, N.nearest(t, asked, "case_key", "vec", "y_true", 2).collect())) for t in (near, data.vectors("train"))]
    assert found[0] == found[1]


def test_kept_forest_grows_from_counts_and_is_stored(spark, data, tmp_path):
    params = {"n_estimators": 7, "max_depth": 5}
    train = data.part("train")
    fitted = MOD.fit(MOD.FOREST, params, train, data.prep)
    assert isinstance(fitted.model, FB.KeptForest) and len(fitted.model.trees) == 7
    assert sum(fitted.model.featureImportances.toArray()) == pytest.approx(1.0)
    again = MOD.fit(MOD.FOREST, params, train.repartition(5), data.prep)
    scored = [{r["case_key"]: r["y_prob"] for r in f.score(data.part("val")).collect()} for f in (fitted, again)]
    assert scored[0] == scored[1] and len(set(scored[0].values())) > 5
    MOD.save_artifact(fitted, str(tmp_path), 0.5, data.features, {})
    loaded, _ = MOD.load_artifact(str(tmp_path))
    assert {r["case_key"]: r["y_prob"] for r in loaded.score(data.part("val")).collect()} == scored[0]
    assert np.array_equal(loaded.model.featureImportances.toArray(), fitted.model.featureImportances.toArray())


def test_importance_of_a_pure_split(spark):
    rows = [(str(i), i % 2, i % 3, i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "case_key string, a int, b int, y_true int")
    prep = P.fit_preparation(df, [], ["a", "b"])
    fitted = MOD.fit(MOD.FOREST, {"n_estimators": 9, "max_features": "all"}, df, prep)
    assert fitted.model.featureImportances.toArray().tolist() == [1.0, 0.0]


def test_too_many_groups_are_left_to_spark_ml(spark, data, monkeypatch):
    monkeypatch.setattr(FB, "LOCAL_GROUPS", 5)
    fitted = MOD.fit(MOD.FOREST, {"n_estimators": 2, "max_depth": 3}, data.part("train"), data.prep)
    assert not isinstance(fitted.model, FB.KeptForest) and fitted.score(data.part("val")).count() == data.part("val").count()


def test_kept_forest_follows_the_rules_of_spark_ml(data):
    assert FB.ForestJob(share="sqrt", spark_rules=True).features(6) == 3 and FB.ForestJob(share="sqrt").features(6) == 2
    fitted = MOD.fit(MOD.FOREST, {"n_estimators": 3}, data.part("train"), data.prep)
    assert max(len(e) for e in fitted.model.edges) == FB.KEPT_BINS - 1
    assert FB._even_cuts(np.array([64.0] + [1.0] * 64))[0] == 0


@pytest.mark.parametrize("p", [1, 2])
def test_rough_distances_leave_out_no_neighbour(p):
    draw = np.random.default_rng(p)
    b, asked = draw.integers(0, 4, (300, 5)) + 1e6, draw.integers(0, 4, (70, 5)) + 1e6
    diff = asked[:, None, :] - b[None, :, :]
    d = np.abs(diff).sum(axis=2) if p == 1 else np.sqrt((diff * diff).sum(axis=2))
    order = np.argsort(d, axis=1, kind="stable")[:, :7]
    for limits in (np.full(70, np.inf), np.sort(d, axis=1)[:, 3]):
        q, n, found = N._closest_of()(asked, b, 7, p, limits)
        want = [(i, j, d[i, j]) for i in range(70) for j in order[i] if d[i, j] <= limits[i]]
        assert list(zip(q.tolist(), n.tolist(), found.tolist())) == want


def test_stored_split_is_the_same(spark):
    df = spark.createDataFrame([(str(i), i % 3 if i % 7 else None) for i in range(200)], "k string, y int")
    plain, stored = (sorted(map(tuple, D.split_60_20_20(df, "k", "y", stored=s).collect()), key=repr) for s in (False, True))
    assert plain == stored and len(plain) == 200
