"""Queries that fit models; fitted numbers have no SQL form, so most are checked by rows."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caresift.functions import rates as R
from caresift.operators import curves as C
from caresift.operators import explain as X
from caresift.operators import metrics as M
from caresift.operators import models as MOD
from caresift.operators import selection as S
from caresift.operators import split as D
from caresift.operators import thresholds as T
from caresift.plans import search
from caresift.plans.registry import query, rounded
from caresift.functions import constants as K
from caresift.functions.constants import COARSE_GRID
from caresift.plans.table_queries import CUT60, CUT70, TVT, split_sql
from caresift.plans.views import (
    ACCURACY,
    CONFUSION,
    F1,
    PRECISION,
    RECALL,
    SPECIFICITY,
    SURVEY,
    SURVEY_NUMBERS,
    survey,
)
from caresift.session import materialize, scratch_path, spread
from caresift.streaming import file_drop
from caresift.sources.tables import table

_RATES = ["accuracy", "precision", "recall", "specificity", "f1"]
_USUAL_FOREST = {"n_estimators": 100}


def dataset(spark, sf) -> search.Dataset:
    return search.prepare_dataset(survey(spark, sf), "case_key")


def _evaluated(spark, sf, name, params):
    out = search.validation_counts(dataset(spark, sf), name, params)
    return rounded(out.withColumn("model", F.lit(name)), *_RATES)


@query("g01_logistic_regression")
def logistic_regression(spark, sf):
    return _evaluated(spark, sf, MOD.LOGISTIC, {"C": 1.0, "penalty": "l2", "class_weight": "balanced", "max_iter": 2000})


@query("g01_logistic_regression_l1")
def logistic_regression_l1(spark, sf):
    return _evaluated(spark, sf, MOD.LOGISTIC, {"C": 0.16, "penalty": "l1", "solver": "saga", "max_iter": 1000})


@query("g02_random_forest")
def random_forest(spark, sf):
    return _evaluated(spark, sf, MOD.FOREST, {"n_estimators": 200})


@query("g03_extra_trees")
def extra_trees(spark, sf):
    return _evaluated(spark, sf, MOD.EXTRA, {"n_estimators": 700})


@query("g05_candidates_with_failure")
def candidates_with_failure(spark, sf):
    data = dataset(spark, sf)
    jobs = [
        (0, MOD.LOGISTIC, {"C": 1.0, "unknown": 1}),
        (1, "UnknownClassifier", {}),
        (2, MOD.LOGISTIC, {"C": -1.0}),
    ]
    return rounded(search.score_candidates(data, jobs), "fitness", "recall", "specificity", "f1", "accuracy", "gap")


@query("g06_positive_probability")
def positive_probability(spark, sf):
    data = dataset(spark, sf)
    fitted = MOD.fit(MOD.LOGISTIC, {}, data.part("train"), data.prep)
    return fitted.score(data.part("val", "test")).select("case_key", F.round("y_prob", 4).alias("y_prob"))


@query("g12_vector_head")
def vector_head(spark, sf):
    """Frozen vectors to a logistic head: split, fit, threshold on validation, metrics on test."""
    v = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("key"), "embedding", (F.col("label") >= 5).cast("int").alias("y_true")
    )
    parts = D.stratified_split(v, "key", "y_true", 0.15, 0.15)
    head = MOD.fit_head(parts.filter("split = 'train'"), "embedding", "y_true")
    scored = MOD.score_head(head, parts.filter("split <> 'train'"), "embedding")
    best = T.weighted_recall(scored.filter("split = 'val'"), []).first()["threshold"]
    test = scored.filter("split = 'test'").withColumn("model", F.lit("head"))
    counts = M.with_rates(
        M.confusion_counts(test, ["model"], R.decide_float("y_prob", best)), floored=True
    ).withColumn("threshold", F.lit(best))
    both = counts.join(C.areas(test, ["model"]), "model")
    return rounded(both.withColumn("fitness", R.image_fitness()), *_RATES, "auc_roc", "average_precision", "fitness")


_SHOWN = {
    "Regressão Logística": (MOD.LOGISTIC, {"max_iter": 2000, "class_weight": "balanced"}),
    "KNN": (MOD.NEIGHBORS, {}),
    "Random Forest": (MOD.FOREST, {}),
    "Extra Trees": (MOD.EXTRA, {}),
}


def _best_points(results):
    """The best point of each model, and whether it is the best of all; the first of equal points counts."""
    kept = results.select("model", "point", "place", "params", "recall", "f1", "accuracy")
    best = S.grid_choice(kept)
    order = [F.desc(c) for c in ("recall", "f1", "accuracy")] + [F.asc("place")]
    whole = best.withColumn("best_of_all", F.row_number().over(W.orderBy(*order)) == 1)
    return rounded(whole.drop("place"), "recall", "f1", "accuracy")


@query("i09_grid_search")
def grid_search(spark, sf):
    """All grids, the best point of each model and the best of all."""
    grids = {shown: (*_SHOWN[shown], grid) for shown, grid in K.PARAMETER_GRIDS.items()}
    return _best_points(search.grid_search(dataset(spark, sf), grids))


@query("i17_final_refit")
def final_refit(spark, sf):
    _, _, test = search.final_model(dataset(spark, sf), MOD.LOGISTIC, {"C": 1.0})
    return rounded(test, *_RATES)


@query("j24_feature_importance")
def feature_importance(spark, sf):
    data = dataset(spark, sf)
    fitted = MOD.fit(MOD.FOREST, _USUAL_FOREST, data.part("train"), data.prep)
    return rounded(X.feature_importance(fitted), "importance")


_X = f"""WITH {SURVEY}, x AS (SELECT *, CASE "LUNG_CANCER" WHEN 'YES' THEN 1.0::DOUBLE ELSE 0 END AS y FROM survey)"""


@query(
    "j25_linear_attribution",
    f"{_X} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(avg(abs(slope * (v - m))), 6) AS mean_impact FROM (SELECT "{c}"::DOUBLE AS v,
        (SELECT regr_slope(y, "{c}") FROM x) AS slope, (SELECT avg("{c}") FROM x) AS m FROM x)"""
        for c in SURVEY_NUMBERS
    ),
)
def linear_attribution(spark, sf):
    rows = survey(spark, sf).withColumn("y", (F.col("LUNG_CANCER") == "YES").cast("double"))
    slopes = X.marginal_slopes(rows, SURVEY_NUMBERS, "y")
    return rounded(X.linear_attribution(rows, slopes), "mean_impact")


@query("j25_tree_attribution")
def tree_attribution(spark, sf):
    """Exact values of a forest of the usual size, against the commonest and median answers."""
    data = dataset(spark, sf)
    fitted = MOD.fit(MOD.FOREST, _USUAL_FOREST, data.part("train"), data.prep)
    background = {**data.prep.modes, **data.prep.medians}
    return rounded(X.tree_attribution(fitted, data.part("val"), background), "mean_impact")


@query("k09_search")
def evolutionary_search(spark, sf):
    """All experiments over the spaces of all models, whole."""
    history = search.run_search(dataset(spark, sf), K.TABULAR_SPACES, K.TABULAR_EXPERIMENTS)
    return rounded(history, "fitness", "recall", "specificity", "f1", "gap")


@query("k09_image_search")
def image_search(spark, sf):
    """All image experiments over heads on the embedding vectors."""
    v = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("key"), "embedding", (F.col("label") >= 5).cast("int").alias("y_true")
    )
    data = search.Dataset(v, "key", [], [], [], None)
    history = search.run_search(data, K.IMAGE_SPACE, K.IMAGE_EXPERIMENTS, score=search.head_scorer(v, "key"))
    return rounded(history.drop("gap"), "fitness", "recall", "specificity", "f1")


@query("a09_model_artifact")
def model_artifact(spark, sf):
    data = dataset(spark, sf)
    fitted, chosen, test = search.final_model(data, MOD.LOGISTIC, {"C": 1.0})
    path = scratch_path(spark, "artifact")
    metrics = {k: v for k, v in test.first().asDict().items()}
    MOD.save_artifact(fitted, path, chosen.first()["threshold"], data.features, metrics, [chosen.first().asDict()])
    loaded, meta = MOD.load_artifact(path)
    scored = loaded.score(data.part("test"))
    return scored.select(
        "case_key",
        F.round("y_prob", 4).alias("y_prob"),
        (F.col("y_prob") >= meta["threshold"]).alias("disease_detected"),
    )




# --- models with a closed form --------------------------------------------------------
# A logistic model that can tell all values of its only input apart gives each value its
# class frequency, so these fits have SQL to compare with.

_CODED = f"""{SURVEY}, base AS (SELECT case_key, CASE "LUNG_CANCER" WHEN 'YES' THEN 1 ELSE 0 END AS y_true, "GENDER", "SMOKING" FROM survey),
  {split_sql('base', 'case_key', 'y_true', *CUT60, TVT)},
  mode AS (SELECT "GENDER" AS g FROM parts WHERE split = 'train' AND "GENDER" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
  mode2 AS (SELECT "GENDER" AS g FROM parts WHERE split <> 'test' AND "GENDER" IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"""
_PLAIN_LOGISTIC = {"C": 1e9, "max_iter": 200}


def _by_gender(spark, sf):
    return search.prepare_dataset(survey(spark, sf).select("case_key", "GENDER", "LUNG_CANCER"), "case_key")


@query(
    "g06_saturated_logistic",
    f"""WITH {_CODED}, f AS (SELECT coalesce("GENDER", (SELECT g FROM mode)) AS g, avg(y_true) AS p FROM parts WHERE split = 'train' GROUP BY 1)
    SELECT case_key, round(p, 4) AS y_prob FROM parts JOIN f ON f.g = coalesce("GENDER", (SELECT g FROM mode)) WHERE split <> 'train'""",
)
def saturated_logistic(spark, sf):
    data = _by_gender(spark, sf)
    fitted = MOD.fit(MOD.LOGISTIC, _PLAIN_LOGISTIC, data.part("train"), data.prep)
    return fitted.score(data.part("val", "test")).select("case_key", F.round("y_prob", 4).alias("y_prob"))


_GRID = ", ".join(f"({t!r}::DOUBLE)" for t in COARSE_GRID)
_REFIT = f"""WITH {_CODED}, f AS (SELECT coalesce("GENDER", (SELECT g FROM mode)) AS g, avg(y_true) AS p FROM parts WHERE split = 'train' GROUP BY 1),
  val AS (SELECT y_true, p AS y_prob FROM parts JOIN f ON f.g = coalesce("GENDER", (SELECT g FROM mode)) WHERE split = 'val'),
  grid(t) AS (VALUES {_GRID}),
  c AS (SELECT t, {CONFUSION.format(p='y_prob >= t')} FROM val CROSS JOIN grid GROUP BY t),
  best AS (SELECT t FROM c ORDER BY {RECALL} DESC, {F1} DESC, {SPECIFICITY} DESC, t LIMIT 1),
  f2 AS (SELECT coalesce("GENDER", (SELECT g FROM mode2)) AS g, avg(y_true) AS p FROM parts WHERE split <> 'test' GROUP BY 1),
  test AS (SELECT case_key, y_true, p AS y_prob FROM parts JOIN f2 ON f2.g = coalesce("GENDER", (SELECT g FROM mode2)) WHERE split = 'test')"""


@query(
    "i17_saturated_refit",
    f"""{_REFIT}, k AS (SELECT (SELECT t FROM best) AS threshold, {CONFUSION.format(p='y_prob >= (SELECT t FROM best)')} FROM test)
    SELECT tp, fp, fn, tn, round({ACCURACY}, 6) AS accuracy, round({PRECISION}, 6) AS precision, round({RECALL}, 6) AS recall,
      round({SPECIFICITY}, 6) AS specificity, round({F1}, 6) AS f1, threshold FROM k""",
)
def saturated_refit(spark, sf):
    _, _, test = search.final_model(_by_gender(spark, sf), MOD.LOGISTIC, _PLAIN_LOGISTIC)
    return rounded(test, *_RATES)


@query(
    "a09_saturated_artifact",
    f"{_REFIT} SELECT case_key, round(y_prob, 4) AS y_prob, y_prob >= (SELECT t FROM best) AS disease_detected FROM test",
)
def saturated_artifact(spark, sf):
    data = _by_gender(spark, sf)
    fitted, chosen, test = search.final_model(data, MOD.LOGISTIC, _PLAIN_LOGISTIC)
    path = scratch_path(spark, "artifact")
    MOD.save_artifact(fitted, path, chosen.first()["threshold"], data.features, test.first().asDict())
    loaded, meta = MOD.load_artifact(path)
    return loaded.score(data.part("test")).select(
        "case_key",
        F.round("y_prob", 4).alias("y_prob"),
        (F.col("y_prob") >= meta["threshold"]).alias("disease_detected"),
    )


@query(
    "a09_artifact_metadata",
    f"""{_REFIT}, v AS (SELECT t, {CONFUSION.format(p='y_prob >= t')} FROM val CROSS JOIN best GROUP BY t),
      k AS (SELECT {CONFUSION.format(p='y_prob >= (SELECT t FROM best)')} FROM test)
    SELECT 'LogisticRegression' AS model_name, (SELECT t FROM best) AS threshold, 'GENDER' AS feature_columns, 'NO=0,YES=1' AS target_mapping,
      v.t AS validation_threshold, round(v_recall, 6) AS validation_recall, round(v_f1, 6) AS validation_f1, round({ACCURACY}, 6) AS test_accuracy,
      round({RECALL}, 6) AS test_recall
    FROM (SELECT t, {RECALL} AS v_recall, {F1} AS v_f1 FROM v) v, k""",
)
def artifact_metadata(spark, sf):
    """What a saved artifact says about itself, read back from its folder."""
    data = _by_gender(spark, sf)
    fitted, chosen, test = search.final_model(data, MOD.LOGISTIC, _PLAIN_LOGISTIC)
    path = scratch_path(spark, "artifact")
    summary = [chosen.first().asDict()]
    MOD.save_artifact(fitted, path, summary[0]["threshold"], data.features, test.first().asDict(), summary)
    rows = spark.read.parquet(f"{path}/metadata").select(F.from_json("metadata", ARTIFACT_SCHEMA).alias("m")).select("m.*")
    pairs = F.array_sort(F.transform(F.map_entries("target_mapping"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))))
    first = F.col("validation_summary")[0]
    out = rows.select(
        "model_name",
        "threshold",
        F.array_join("feature_columns", ",").alias("feature_columns"),
        F.array_join(pairs, ",").alias("target_mapping"),
        first["threshold"].alias("validation_threshold"),
        first["recall"].alias("validation_recall"),
        first["f1"].alias("validation_f1"),
        F.col("test_metrics.accuracy").alias("test_accuracy"),
        F.col("test_metrics.recall").alias("test_recall"),
    )
    return rounded(out, "validation_recall", "validation_f1", "test_accuracy", "test_recall")


ARTIFACT_SCHEMA = (
    "model_name string, threshold double, feature_columns array<string>, target_mapping map<string, int>, "
    "validation_summary array<struct<threshold: double, recall: double, f1: double>>, test_metrics struct<accuracy: double, recall: double>"
)

# --- scoring of dropped files with a saved model -----------------------------------------
# The files: every fourth order's rows under a spelling of its own, some files without the column that the model
# needs, and texts that are no table. Folders name the kind and the part, so that rows can be told to their files.

_KINDS = "CASE o % 4 WHEN 0 THEN 'plain' WHEN 1 THEN 'lower' WHEN 2 THEN 'short' ELSE 'notes' END"
_DROPPED = f"""dropped AS (SELECT case_key, "GENDER", {_KINDS} AS kind, CAST(o // 4 % 8 AS INTEGER) AS part
  FROM (SELECT survey.*, CAST(split_part(case_key, '-', 1) AS BIGINT) AS o FROM survey))"""


def _drop_files(spark, sf) -> str:
    """The files of the rows above, in one folder a kind and part."""
    drop = scratch_path(spark, "drop")
    order = F.split("case_key", "-")[0].cast("long")
    kind = F.when(order % 4 == 0, "plain").when(order % 4 == 1, "lower").when(order % 4 == 2, "short").otherwise("notes")
    rows = survey(spark, sf).withColumns({"kind": kind, "part": F.floor(order / 4) % 8})
    rows = materialize(spread(rows.select("kind", "part", "case_key", "GENDER", "AGE", "SMOKING")), "to-drop", ["kind"])
    dealt = rows.repartition("kind", "part").sortWithinPartitions("part", "case_key")
    forms = {
        "plain": {"case_key": "case_key", "GENDER": "GENDER", "AGE": "AGE"},
        "lower": {"AGE": "age", "GENDER": " gender ", "SMOKING": "smoking", "case_key": "case_key"},
        "short": {"case_key": "case_key", "AGE": "AGE"},
    }

    def write(name: str) -> None:
        mine = dealt.filter(F.col("kind") == name)
        if name == "notes":
            mine.select(F.col("case_key").alias("value"), "part").write.partitionBy("part").text(f"{drop}/kind=notes")
            return
        named = mine.select(*[F.col(f"`{c}`").alias(a) for c, a in forms[name].items()], "part")
        named.write.option("header", True).partitionBy("part").csv(f"{drop}/kind={name}")

    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(write, [*forms, "notes"]))
    return drop


def _file_names():
    """(kind, part) of a dropped file, from its folders."""
    names = {"kind": "string", "part": "int"}
    return [F.regexp_extract("file_path", f"/{n}=([^/]*)/", 1).cast(t).alias(n) for n, t in names.items()]


def _score_drop(spark, sf) -> str:
    """Scores all dropped files with a saved and loaded model; the folder of the results."""
    data = _by_gender(spark, sf)
    fitted, chosen, test = search.final_model(data, MOD.LOGISTIC, _PLAIN_LOGISTIC)
    path = scratch_path(spark, "artifact")
    MOD.save_artifact(fitted, path, chosen.first()["threshold"], data.features, test.first().asDict(), [chosen.first().asDict()])
    loaded, meta = MOD.load_artifact(path)
    out = scratch_path(spark, "scored-files")
    file_drop.score_csv_arrivals(
        spark,
        _drop_files(spark, sf),
        {c: "string" for c in meta["feature_columns"]},
        file_drop.artifact_scorer(loaded, meta),
        out,
        scratch_path(spark, "files-checkpoint"),
    )
    return out


_TEXT = "'O modelo LogisticRegression indicou uma probabilidade estimada de ' || printf('%.2f', p * 100) || '%' || ', classificada como risco ' || level || '. " + K.FALLBACK_TAIL.replace("'", "''") + "'"


@query(
    "a10_csv_arrivals",
    f"""{_REFIT}, {_DROPPED}, rated AS (
      SELECT kind, part, row_number() OVER (PARTITION BY kind, part ORDER BY case_key) - 1 AS row_index, p,
        CASE WHEN p >= 0.7 THEN 'alto' WHEN p >= 0.4 THEN 'moderado' ELSE 'baixo' END AS level
      FROM dropped JOIN f2 ON f2.g = coalesce("GENDER", (SELECT g FROM mode2)) WHERE kind IN ('plain', 'lower'))
    SELECT kind, part, row_index, p >= (SELECT t FROM best) AS disease_detected, round(p, 4) AS probability, level AS risk_level,
      CASE WHEN row_index < 5 THEN {_TEXT} ELSE '{K.SKIPPED_ROW_NOTICE}' END AS interpretation FROM rated""",
)
def csv_arrivals(spark, sf):
    """Rows of all dropped files, numbered in each file, scored by a loaded model, the first five of a file with a text."""
    rows = spark.read.parquet(f"{_score_drop(spark, sf)}/rows")
    columns = ["row_index", "disease_detected", F.round("probability", 4).alias("probability"), "risk_level", "interpretation"]
    return rows.select(*_file_names(), *columns)


@query(
    "a10_file_status",
    f"""WITH {SURVEY}, {_DROPPED}
    SELECT DISTINCT kind, part, CASE WHEN kind IN ('plain', 'lower') THEN 'success' ELSE 'error' END AS status,
      CASE kind WHEN 'short' THEN 'CSV missing required columns: [''GENDER'']' WHEN 'notes' THEN 'Invalid file type. Only .csv files are allowed' END AS message
    FROM dropped""",
)
def file_status(spark, sf):
    """One status a dropped file: a bad suffix or a missing column stops that file only."""
    return spark.read.parquet(f"{_score_drop(spark, sf)}/status").select(*_file_names(), "status", "message")


# Rows weighted by class: a value's frequency is then that of the weights. Whole-sample trees give it in every tree,
# and sampled trees come close enough to decide the same.
_WEIGHTED = f"""WITH {_CODED}, n AS (SELECT count(*) / 2.0::DOUBLE / count(*) FILTER (WHERE y_true = 1) AS w1,
    count(*) / 2.0::DOUBLE / count(*) FILTER (WHERE y_true = 0) AS w0 FROM parts WHERE split = 'train'),
  f AS (SELECT coalesce("GENDER", (SELECT g FROM mode)) AS g,
    sum(y_true * (SELECT w1 FROM n)) / sum(CASE WHEN y_true = 1 THEN (SELECT w1 FROM n) ELSE (SELECT w0 FROM n) END) AS p
    FROM parts WHERE split = 'train' GROUP BY 1),
  rated AS (SELECT case_key, p FROM parts JOIN f ON f.g = coalesce("GENDER", (SELECT g FROM mode)) WHERE split = 'val')"""


def _weighted(spark, sf, name, params):
    data = _by_gender(spark, sf)
    return MOD.fit(name, params, data.part("train"), data.prep).score(data.part("val"))


@query("g01_balanced_saturated", f"{_WEIGHTED} SELECT case_key, round(p, 4) AS y_prob FROM rated")
def balanced_saturated(spark, sf):
    scored = _weighted(spark, sf, MOD.LOGISTIC, {**_PLAIN_LOGISTIC, "class_weight": "balanced"})
    return scored.select("case_key", F.round("y_prob", 4).alias("y_prob"))


@query("g02_forest_decisions", f"{_WEIGHTED} SELECT case_key, (p >= 0.5)::INTEGER AS y_pred FROM rated")
def forest_decisions(spark, sf):
    return _weighted(spark, sf, MOD.FOREST, {"n_estimators": 100}).select("case_key", R.decide().alias("y_pred"))


@query("g03_whole_sample_trees", f"{_WEIGHTED} SELECT case_key, round(p, 4) AS y_prob FROM rated")
def whole_sample_trees(spark, sf):
    scored = _weighted(spark, sf, MOD.EXTRA, {"n_estimators": 100})
    return scored.select("case_key", F.round("y_prob", 4).alias("y_prob"))


@query(
    "j24_importance_of_one_input",
    f"WITH {SURVEY} SELECT 'GENDER' AS input, (count(DISTINCT \"GENDER\") > 1)::INTEGER::DOUBLE AS importance FROM survey",
)
def importance_of_one_input(spark, sf):
    data = _by_gender(spark, sf)
    fitted = MOD.fit(MOD.FOREST, {"n_estimators": 100}, data.part("train"), data.prep)
    by_input = X.feature_importance(fitted).groupBy(F.split("feature", "_")[0].alias("input"))
    return rounded(by_input.agg(F.sum("importance").alias("importance")), "importance")


# A tree of all rows and two levels over two 0/1 inputs: the input with the larger gain is asked first, the other below it. Leaves
# side by side that decide the same are one.


def _gain_sql(parent: str, by: str, where: str) -> str:
    """Weighted Gini gain of splitting the rows of ``where`` by a 0/1 column."""
    gini = "(1 - pow({0}::DOUBLE / ({0} + {1}), 2) - pow({1}::DOUBLE / ({0} + {1}), 2)) * ({0} + {1})"
    sides = " + ".join(
        f"(SELECT coalesce({gini.format('sum(w * y_true)', 'sum(w * (1 - y_true))')}, 0) FROM b WHERE {where} AND {by} = {v})" for v in (0, 1)
    )
    return f"((SELECT {gini.format('sum(w * y_true)', 'sum(w * (1 - y_true))')} FROM b WHERE {where}) - ({sides}))"


_TWO_INPUTS = f"""WITH {_CODED}, n AS (SELECT count(*) / 2.0::DOUBLE / count(*) FILTER (WHERE y_true = 1) AS w1,
    count(*) / 2.0::DOUBLE / count(*) FILTER (WHERE y_true = 0) AS w0 FROM parts WHERE split = 'train'),
  b AS (SELECT y_true, ("SMOKING" = 2)::INTEGER AS s, (coalesce("GENDER", (SELECT g FROM mode)) = 'F')::INTEGER AS f,
    CASE WHEN y_true = 1 THEN (SELECT w1 FROM n) ELSE (SELECT w0 FROM n) END AS w FROM parts WHERE split = 'train'),
  q AS (SELECT s, f, sum(w * y_true) / sum(w) AS p FROM b GROUP BY s, f),
  qs AS (SELECT s, sum(w * y_true) / sum(w) AS p FROM b GROUP BY s), qf AS (SELECT f, sum(w * y_true) / sum(w) AS p FROM b GROUP BY f),
  ks AS (SELECT s, max(CASE WHEN f = 0 THEN p END) > 0.5 AS a, max(CASE WHEN f = 1 THEN p END) > 0.5 AS z FROM q GROUP BY s),
  kf AS (SELECT f, max(CASE WHEN s = 0 THEN p END) > 0.5 AS a, max(CASE WHEN s = 1 THEN p END) > 0.5 AS z FROM q GROUP BY f),
  root AS (SELECT {_gain_sql('b', 's', 'true')} AS s, {_gain_sql('b', 'f', 'true')} AS f,
    (SELECT count(*) FROM ks WHERE a <> z) > 0 OR (SELECT count(DISTINCT p > 0.5) FROM qs) > 1 AS s_kept,
    (SELECT count(*) FROM kf WHERE a <> z) > 0 OR (SELECT count(DISTINCT p > 0.5) FROM qf) > 1 AS f_kept),
  below AS (SELECT
    {' + '.join(f"CASE WHEN (SELECT a <> z FROM kf WHERE f = {v}) THEN {_gain_sql('b', 's', f'f = {v}')} ELSE 0 END" for v in (0, 1))} AS s,
    {' + '.join(f"CASE WHEN (SELECT a <> z FROM ks WHERE s = {v}) THEN {_gain_sql('b', 'f', f's = {v}')} ELSE 0 END" for v in (0, 1))} AS f),
  g AS (SELECT CASE WHEN root.s > root.f THEN CASE WHEN s_kept THEN root.s ELSE 0 END ELSE below.s END AS s,
    CASE WHEN root.s > root.f THEN below.f ELSE CASE WHEN f_kept THEN root.f ELSE 0 END END AS f FROM root, below),
  grown AS (SELECT q.s, q.f, CASE WHEN root.s > root.f
      THEN CASE WHEN NOT s_kept THEN (SELECT sum(w * y_true) / sum(w) FROM b) WHEN ks.a <> ks.z THEN q.p ELSE qs.p END
      ELSE CASE WHEN NOT f_kept THEN (SELECT sum(w * y_true) / sum(w) FROM b) WHEN kf.a <> kf.z THEN q.p ELSE qf.p END END AS p
    FROM q JOIN qs ON qs.s = q.s JOIN qf ON qf.f = q.f JOIN ks ON ks.s = q.s JOIN kf ON kf.f = q.f, root)"""


def _by_two_inputs(spark, sf):
    data = search.prepare_dataset(survey(spark, sf).select("case_key", "GENDER", "SMOKING", "LUNG_CANCER"), "case_key")
    params = {"n_estimators": 1, "max_depth": 2, "max_features": "all"}
    return data, MOD.fit_trees(params, data.part("train"), data.prep)


@query(
    "j24_importance_of_two_inputs",
    f"""{_TWO_INPUTS} SELECT 'SMOKING' AS input, round(s / CASE WHEN s + f > 0 THEN s + f ELSE 1 END, 6) AS importance FROM g
    UNION ALL SELECT 'GENDER', round(f / CASE WHEN s + f > 0 THEN s + f ELSE 1 END, 6) FROM g""",
)
def importance_of_two_inputs(spark, sf):
    _, fitted = _by_two_inputs(spark, sf)
    by_input = X.feature_importance(fitted).groupBy(F.split("feature", "_")[0].alias("input"))
    return rounded(by_input.agg(F.sum("importance").alias("importance")), "importance")


@query(
    "j25_attribution_of_two_inputs",
    f"""{_TWO_INPUTS}, usual AS (SELECT ((SELECT median("SMOKING") FROM parts WHERE split = 'train') = 2)::INTEGER AS s, ((SELECT g FROM mode) = 'F')::INTEGER AS f),
    v AS (SELECT ("SMOKING" = 2)::INTEGER AS s, (coalesce("GENDER", (SELECT g FROM mode)) = 'F')::INTEGER AS f FROM parts WHERE split = 'val'),
    x AS (SELECT own.p AS both_shown, sb.p AS s_shown, fb.p AS f_shown, none.p AS none_shown FROM v CROSS JOIN usual u
      JOIN grown own ON own.s = v.s AND own.f = v.f JOIN grown sb ON sb.s = v.s AND sb.f = u.f
      JOIN grown fb ON fb.s = u.s AND fb.f = v.f JOIN grown none ON none.s = u.s AND none.f = u.f)
    SELECT 'SMOKING' AS feature, round(avg(abs((s_shown - none_shown + both_shown - f_shown) / 2)), 6) AS mean_impact FROM x
    UNION ALL SELECT 'GENDER', round(avg(abs((f_shown - none_shown + both_shown - s_shown) / 2)), 6) FROM x""",
)
def attribution_of_two_inputs(spark, sf):
    data, fitted = _by_two_inputs(spark, sf)
    background = {**data.prep.modes, **data.prep.medians}
    return rounded(X.tree_attribution(fitted, data.part("val"), background), "mean_impact")


_W = K.TABULAR_WEIGHTS
_CANDIDATES = f"""WITH {_CODED}, f AS (SELECT coalesce("GENDER", (SELECT g FROM mode)) AS g, avg(y_true) AS p FROM parts WHERE split = 'train' GROUP BY 1),
  v AS (SELECT y_true, coalesce("GENDER", 'nan') AS grp, (p >= 0.5)::INTEGER AS y_pred
    FROM parts JOIN f ON f.g = coalesce("GENDER", (SELECT g FROM mode)) WHERE split = 'val'),
  c AS (SELECT {CONFUSION.format(p='y_pred = 1')} FROM v),
  g AS (SELECT grp, CASE WHEN sum(y_true) > 0 THEN sum(y_true * y_pred)::DOUBLE / sum(y_true) ELSE 0 END AS r FROM v GROUP BY grp),
  k AS (SELECT {RECALL} AS recall, {SPECIFICITY} AS specificity, {F1} AS f1, {ACCURACY} AS accuracy, (SELECT max(r) - min(r) FROM g) AS gap FROM c)"""


@query(
    "g05_saturated_and_failing",
    f"""{_CANDIDATES} SELECT 0::BIGINT AS cand, round({_W['recall']} * recall + {_W['specificity']} * specificity + {_W['f1']} * f1 - {_W['gap']} * gap, 6) AS fitness,
      round(recall, 6) AS recall, round(specificity, 6) AS specificity, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy, round(gap, 6) AS gap, NULL AS error FROM k
    UNION ALL SELECT 1, -1, NULL, NULL, NULL, NULL, NULL, 'Unsupported model: UnknownClassifier'""",
)
def saturated_and_failing(spark, sf):
    jobs = [(0, MOD.LOGISTIC, _PLAIN_LOGISTIC), (1, "UnknownClassifier", {})]
    out = search.score_candidates(_by_gender(spark, sf), jobs)
    return rounded(out, "fitness", "recall", "specificity", "f1", "accuracy", "gap")


# A logistic model with hardly any penalty gives each value of its only input the class frequency, so whole
# searches over such models have SQL: a candidate's metrics depend on its class weights alone.

_BY_WEIGHT = f"""WITH {_CODED}, n AS (SELECT count(*) / 2.0::DOUBLE / count(*) FILTER (WHERE y_true = 1) AS w1,
    count(*) / 2.0::DOUBLE / count(*) FILTER (WHERE y_true = 0) AS w0 FROM parts WHERE split = 'train'),
  kinds(class_weight) AS (VALUES ('balanced'), ('none')),
  f AS (SELECT class_weight, coalesce("GENDER", (SELECT g FROM mode)) AS g,
    sum(y_true * CASE class_weight WHEN 'none' THEN 1.0::DOUBLE ELSE (SELECT w1 FROM n) END)
      / sum(CASE WHEN class_weight = 'none' THEN 1.0::DOUBLE WHEN y_true = 1 THEN (SELECT w1 FROM n) ELSE (SELECT w0 FROM n) END) AS p
    FROM parts CROSS JOIN kinds WHERE split = 'train' GROUP BY 1, 2),
  v AS (SELECT class_weight, y_true, coalesce("GENDER", 'nan') AS grp, (p >= 0.5)::INTEGER AS y_pred
    FROM parts JOIN f ON f.g = coalesce("GENDER", (SELECT g FROM mode)) WHERE split = 'val'),
  c AS (SELECT class_weight, {CONFUSION.format(p='y_pred = 1')} FROM v GROUP BY 1),
  g AS (SELECT class_weight, max(r) - min(r) AS gap FROM (SELECT class_weight, grp,
    CASE WHEN sum(y_true) > 0 THEN sum(y_true * y_pred)::DOUBLE / sum(y_true) ELSE 0 END AS r FROM v GROUP BY 1, 2) GROUP BY 1),
  k AS (SELECT c.class_weight, {RECALL} AS recall, {SPECIFICITY} AS specificity, {F1} AS f1, {ACCURACY} AS accuracy, gap FROM c JOIN g ON c.class_weight = g.class_weight)"""
_FITNESS = f"{_W['recall']} * recall + {_W['specificity']} * specificity + {_W['f1']} * f1 - {_W['gap']} * gap"


@query(
    "i09_saturated_grid",
    f"""{_BY_WEIGHT}, points AS (
      SELECT s.model, s.m * 4 + p.i AS place, p.i AS point, p.w AS class_weight, p.c
      FROM (VALUES ('first', 0), ('second', 1)) s(model, m)
        CROSS JOIN (VALUES (0, 'none', 1), (1, 'balanced', 1), (2, 'none', 2), (3, 'balanced', 2)) p(i, w, c)),
    rated AS (SELECT points.*, recall, f1, accuracy FROM points JOIN k ON points.class_weight = k.class_weight),
    best AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY recall DESC, f1 DESC, accuracy DESC, place) AS r FROM rated)
    SELECT model, point, class_weight, round(recall, 6) AS recall, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy,
      row_number() OVER (ORDER BY recall DESC, f1 DESC, accuracy DESC, place) = 1 AS best_of_all FROM best WHERE r = 1""",
)
def saturated_grid(spark, sf):
    grid = {"C": [1e8, 1e9], "class_weight": ["none", "balanced"]}
    grids = {"first": (MOD.LOGISTIC, {"max_iter": 200}, grid), "second": (MOD.LOGISTIC, {"max_iter": 300}, grid)}
    best = _best_points(search.grid_search(_by_gender(spark, sf), grids))
    return best.withColumn("class_weight", F.get_json_object("params", "$.class_weight")).drop("params")


@query(
    "k09_saturated_search",
    f"""{_BY_WEIGHT}, best AS (SELECT class_weight, {_FITNESS} AS fitness, recall, gap FROM k ORDER BY {_FITNESS} DESC LIMIT 1)
    SELECT e AS experiment, round(fitness, 6) AS fitness, round(recall, 6) AS recall, round(gap, 6) AS gap
    FROM best CROSS JOIN (VALUES ('exp1'), ('exp2'), ('exp3')) x(e)""",
)
def saturated_search(spark, sf):
    """A whole search whose best candidate is known: every experiment meets both class weights and keeps the better one."""
    space = {MOD.LOGISTIC: [("C", "float", 1e8, 1e9, []), ("class_weight", "cat", 0.0, 0.0, ["none", "balanced"])]}
    history = search.run_search(_by_gender(spark, sf), space, K.TABULAR_EXPERIMENTS)
    best = S.best_by(history, ["experiment"], F.col("fitness"), -F.col("generation"), -F.col("cand"))
    return rounded(best.select("experiment", "fitness", "recall", "gap"), "fitness", "recall", "gap")


@query(
    "g12_head_on_separable_vectors",
    f"""WITH v AS (SELECT vec_id::VARCHAR AS key, (label >= 5)::INTEGER AS y_true FROM embeddings),
    {split_sql('v', 'key', 'y_true', *CUT70, TVT)}
    SELECT count(*) FILTER (WHERE y_true = 1) AS tp, 0 AS fp, 0 AS fn, count(*) FILTER (WHERE y_true = 0) AS tn, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS auc_roc
    FROM parts WHERE split = 'test'""",
)
def head_on_separable_vectors(spark, sf):
    """Vectors that are the label's own axis: a head tells them apart, so the chosen threshold makes no error."""
    axes = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: (i == F.col("label")).cast("double"))
    v = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("key"), axes.alias("axes"), (F.col("label") >= 5).cast("int").alias("y_true")
    )
    parts = D.stratified_split(v, "key", "y_true", 0.15, 0.15)
    head = MOD.fit_head(parts.filter("split = 'train'"), "axes", "y_true")
    scored = MOD.score_head(head, parts.filter("split <> 'train'"), "axes")
    best = T.weighted_recall(scored.filter("split = 'val'"), []).first()["threshold"]
    test = scored.filter("split = 'test'").withColumn("model", F.lit("head"))
    counts = M.with_rates(M.confusion_counts(test, ["model"], R.decide_float("y_prob", best)), floored=True)
    both = counts.join(C.areas(test, ["model"]), "model")
    return rounded(both, "recall", "auc_roc").select("tp", "fp", "fn", "tn", "recall", "auc_roc")
