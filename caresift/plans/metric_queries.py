"""Scoring, metric and curve queries over the scored table."""

from __future__ import annotations

from pyspark.sql import functions as F

from caresift.functions import rates as R
from caresift.operators import curves as C
from caresift.operators import metrics as M
from caresift.operators.ordering import join_groups
from caresift.plans.registry import query, r6, rounded
from caresift.plans.views import (
    ACCURACY,
    AT_HALF,
    CONFUSION,
    F1,
    PRECISION,
    RECALL,
    SCORED,
    SPECIFICITY,
    scored,
)



@query("h01_confusion_counts", f"WITH {SCORED} SELECT model, {AT_HALF} FROM scored GROUP BY model")
def confusion_counts(spark, sf):
    return M.confusion_counts(scored(spark, sf), ["model"], R.decide())


@query(
    "h02_precision_recall_f1",
    f"""WITH {SCORED}, c AS (SELECT model, {AT_HALF} FROM scored GROUP BY model)
    SELECT model, round({PRECISION}, 6) AS precision, round({RECALL}, 6) AS recall, round({F1}, 6) AS f1 FROM c""",
)
def precision_recall_f1(spark, sf):
    c = M.confusion_counts(scored(spark, sf), ["model"], R.decide())
    return c.select("model", r6(R.precision(), "precision"), r6(R.recall(), "recall"), r6(R.f1(), "f1"))


@query(
    "h03_sensitivity_specificity",
    f"""WITH {SCORED}, c AS (SELECT model, {AT_HALF} FROM scored GROUP BY model)
    SELECT model, round({RECALL}, 6) AS sensitivity, round({SPECIFICITY}, 6) AS specificity FROM c""",
)
def sensitivity_specificity(spark, sf):
    c = M.confusion_counts(scored(spark, sf), ["model"], R.decide())
    return c.select("model", r6(R.recall(), "sensitivity"), r6(R.specificity(), "specificity"))


FLOAT_HALF = CONFUSION.format(p="CAST(y_prob AS FLOAT) >= CAST(0.7 AS FLOAT)")
FLOORED_SQL = """round((tp + tn)::DOUBLE / greatest(tp + tn + fp + fn, 1), 6) AS accuracy,
    round(tp::DOUBLE / greatest(tp + fp, 1), 6) AS precision, round(tp::DOUBLE / greatest(tp + fn, 1), 6) AS recall,
    round(tn::DOUBLE / greatest(tn + fp, 1), 6) AS specificity,
    round(2 * (tp::DOUBLE / greatest(tp + fp, 1)) * (tp::DOUBLE / greatest(tp + fn, 1))
      / greatest(tp::DOUBLE / greatest(tp + fp, 1) + tp::DOUBLE / greatest(tp + fn, 1), 1e-8), 6) AS f1"""


@query(
    "h04_floored_metrics",
    f"""WITH {SCORED}, c AS (SELECT model, {FLOAT_HALF} FROM scored GROUP BY model)
    SELECT model, tp, fp, fn, tn, {FLOORED_SQL} FROM c""",
)
def floored_metrics(spark, sf):
    c = M.confusion_counts(scored(spark, sf), ["model"], R.decide_float("y_prob", 0.7))
    return rounded(M.with_rates(c, floored=True), "accuracy", "precision", "recall", "specificity", "f1")


@query(
    "h05_accuracy",
    f"""WITH {SCORED} SELECT model, round(avg(CASE WHEN y_true = CAST(y_prob >= 0.5 AS INTEGER) THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy
    FROM scored GROUP BY model""",
)
def accuracy(spark, sf):
    return rounded(M.accuracy_by(scored(spark, sf), ["model"], R.decide()), "accuracy")


REPORT_SQL = f"""WITH {SCORED}, c AS (SELECT model, {AT_HALF} FROM scored GROUP BY model),
per AS (
  SELECT model, '1' AS label, {PRECISION} AS precision, {RECALL} AS recall, {F1} AS f1, tp + fn AS support FROM c
  UNION ALL
  SELECT model, '0', {PRECISION.replace('tp', 'tn').replace('fp', 'fn')},
         {SPECIFICITY}, {F1.replace('tp', 'tn')}, tn + fp FROM c),
al AS (
  SELECT * FROM per
  UNION ALL SELECT model, 'accuracy', {ACCURACY}, {ACCURACY}, {ACCURACY}, tp + fp + fn + tn FROM c
  UNION ALL SELECT model, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per GROUP BY model
  UNION ALL SELECT model, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM per GROUP BY model)
SELECT model, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM al"""


@query("h06_class_report", REPORT_SQL)
def class_report(spark, sf):
    return rounded(M.class_report(scored(spark, sf), ["model"], R.decide()), "precision", "recall", "f1")


@query(
    "h07_confusion_table",
    f"""WITH {SCORED} SELECT model, y_true AS real, count(*) FILTER (WHERE y_prob < 0.5) AS pred_0,
    count(*) FILTER (WHERE y_prob >= 0.5) AS pred_1 FROM scored GROUP BY model, y_true""",
)
def confusion_table(spark, sf):
    return M.confusion_table(scored(spark, sf), ["model"], R.decide())


def ranked_sql(score: str) -> str:
    return f"""WITH {SCORED},
h AS (SELECT model, {score} AS score, count(*) FILTER (WHERE y_true = 1) AS pos, count(*) FILTER (WHERE y_true = 0) AS neg
      FROM scored GROUP BY model, {score}),
r AS (SELECT *, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps,
        sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n
      FROM h WINDOW w AS (PARTITION BY model ORDER BY score DESC))"""


@query(
    "h08_roc_curve",
    f"""{ranked_sql('y_prob')}
    SELECT model, round(score, 6) AS threshold, round(fps::DOUBLE / n, 6) AS fpr, round(tps::DOUBLE / p, 6) AS tpr FROM r
    UNION ALL SELECT DISTINCT model, NULL, 0.0::DOUBLE, 0.0::DOUBLE FROM r""",
)
def roc_curve(spark, sf):
    return rounded(C.roc_points(scored(spark, sf), ["model"]), "threshold", "fpr", "tpr")


AUC_SQL = "round(sum(neg * (tps - pos + pos / 2.0::DOUBLE)) / (max(p)::DOUBLE * max(n)), 6)"
AP_SQL = "round(sum(pos * tps::DOUBLE / (tps + fps)) / max(p), 6)"


@query("h09_roc_auc", f"{ranked_sql('y_prob')} SELECT model, {AUC_SQL} AS auc_roc FROM r GROUP BY model")
def roc_auc(spark, sf):
    return rounded(C.areas(scored(spark, sf), ["model"]), "auc_roc").select("model", "auc_roc")


@query("h09_roc_auc_continuous", f"{ranked_sql('y_cont')} SELECT model, {AUC_SQL} AS auc_roc, {AP_SQL} AS average_precision FROM r GROUP BY model")
def roc_auc_continuous(spark, sf):
    return rounded(C.areas(scored(spark, sf), ["model"], "y_cont"), "auc_roc", "average_precision")


@query(
    "h09_roc_auc_one_class",
    f"WITH {SCORED} SELECT model, grp, NULL::DOUBLE AS auc_roc FROM scored WHERE y_true = 1 GROUP BY model, grp",
)
def roc_auc_one_class(spark, sf):
    positives = scored(spark, sf).filter("y_true = 1")
    return C.areas(positives, ["model", "grp"]).select("model", "grp", "auc_roc")


MISSING = f"""WITH {SCORED}, gaps AS (
  SELECT CASE WHEN line_no <> 7 THEN model END AS model, y_true,
    CASE WHEN part_no % 13 = 0 THEN NULL WHEN part_no % 17 = 0 THEN 'NaN'::DOUBLE ELSE y_prob::DOUBLE END AS y_prob FROM scored),
known AS (SELECT model, y_true, CASE WHEN y_prob IS NULL OR isnan(y_prob) THEN '-inf'::DOUBLE ELSE y_prob END AS y_prob FROM gaps)"""


def with_gaps(spark, sf):
    """Scored rows with null models, null scores and NaN scores."""
    score = F.when(F.col("part_no") % 17 == 0, float("nan")).otherwise(F.col("y_prob").cast("double"))
    return scored(spark, sf).select(
        F.when(F.col("line_no") != 7, F.col("model")).alias("model"),
        "y_true",
        F.when(F.col("part_no") % 13 != 0, score).alias("y_prob"),
    )


@query(
    "h01_counts_with_gaps",
    f"""{MISSING} SELECT model, count(*) FILTER (WHERE y_true = 1 AND y_prob >= 0.5) AS tp, count(*) FILTER (WHERE y_true = 0 AND y_prob >= 0.5) AS fp,
    count(*) FILTER (WHERE y_true = 1 AND y_prob < 0.5) AS fn, count(*) FILTER (WHERE y_true = 0 AND y_prob < 0.5) AS tn FROM known GROUP BY model""",
)
def counts_with_gaps(spark, sf):
    return M.confusion_counts(with_gaps(spark, sf), ["model"], R.decide()).select("model", "tp", "fp", "fn", "tn")


@query(
    "h09_areas_with_gaps",
    f"""{MISSING}, h AS (SELECT model, y_prob AS score, count(*) FILTER (WHERE y_true = 1) AS pos, count(*) FILTER (WHERE y_true = 0) AS neg
      FROM known GROUP BY model, y_prob),
    r AS (SELECT *, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps, sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n
      FROM h WINDOW w AS (PARTITION BY model ORDER BY score DESC))
    SELECT model, {AUC_SQL} AS auc_roc, {AP_SQL} AS average_precision FROM r GROUP BY model""",
)
def areas_with_gaps(spark, sf):
    return rounded(C.areas(with_gaps(spark, sf), ["model"]), "auc_roc", "average_precision")


@query(
    "h10_precision_recall_curve",
    f"""{ranked_sql('y_prob')}
    SELECT model, round(score, 6) AS threshold, round(tps::DOUBLE / (tps + fps), 6) AS precision, round(tps::DOUBLE / p, 6) AS recall FROM r
    UNION ALL SELECT DISTINCT model, NULL, 1.0::DOUBLE, 0.0::DOUBLE FROM r""",
)
def precision_recall_curve(spark, sf):
    return rounded(C.precision_recall_points(scored(spark, sf), ["model"]), "threshold", "precision", "recall")


@query("h11_average_precision", f"{ranked_sql('y_prob')} SELECT model, {AP_SQL} AS average_precision FROM r GROUP BY model")
def average_precision(spark, sf):
    return rounded(C.areas(scored(spark, sf), ["model"]), "average_precision").select("model", "average_precision")


GROUP_CTE = f"WITH {SCORED}, g AS (SELECT model, grp, {AT_HALF} FROM scored GROUP BY model, grp)"


@query("h12_group_recall", f"{GROUP_CTE} SELECT model, grp, round({RECALL}, 6) AS recall FROM g")
def group_recall(spark, sf):
    return rounded(M.group_recall(scored(spark, sf), ["model"], "grp", R.decide()), "recall")


@query(
    "h13_recall_gap",
    f"{GROUP_CTE} SELECT model, round(max({RECALL}) - min({RECALL}), 6) AS gap FROM g GROUP BY model",
)
def recall_gap(spark, sf):
    return rounded(M.recall_gap(scored(spark, sf), ["model"], "grp", R.decide()), "gap")


@query(
    "h14_subgroup_report",
    f"""{GROUP_CTE} SELECT model, grp, round({RECALL}, 6) AS recall, round({SPECIFICITY}, 6) AS specificity,
    round({F1}, 6) AS f1 FROM g""",
)
def subgroup_report(spark, sf):
    return rounded(M.group_report(scored(spark, sf), ["model"], "grp", R.decide()), "recall", "specificity", "f1")


def fitness_sql(keys: str, source: str = "scored", with_cte: str = SCORED) -> str:
    return f"""WITH {with_cte}, g AS (SELECT {keys}, grp, {AT_HALF} FROM {source} GROUP BY {keys}, grp),
    c AS (SELECT {keys}, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, sum(tn) AS tn,
            max({RECALL}) - min({RECALL}) AS gap FROM g GROUP BY {keys})
    SELECT {keys}, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
      round(gap, 6) AS gap, round({ACCURACY}, 6) AS accuracy, round({PRECISION}, 6) AS precision, round({RECALL}, 6) AS recall,
      round({SPECIFICITY}, 6) AS specificity, round({F1}, 6) AS f1,
      round(0.6::DOUBLE * {RECALL} + 0.2::DOUBLE * {SPECIFICITY} + 0.2::DOUBLE * {F1} - 0.5::DOUBLE * gap, 6) AS fitness FROM c"""


RATE_COLUMNS = ["gap", "accuracy", "precision", "recall", "specificity", "f1", "fitness"]


@query("h15_tabular_fitness", fitness_sql("model"))
def tabular_fitness(spark, sf):
    return rounded(M.fairness_metrics(scored(spark, sf), ["model"], "grp", R.decide()), *RATE_COLUMNS)


@query(
    "h16_image_fitness",
    f"""{ranked_sql('y_prob')}, a AS (SELECT model, sum(neg * (tps - pos + pos / 2.0::DOUBLE)) / (max(p)::DOUBLE * max(n)) AS auc FROM r GROUP BY model),
    c AS (SELECT model, {AT_HALF} FROM scored GROUP BY model)
    SELECT model, round(0.45::DOUBLE * {RECALL} + 0.2::DOUBLE * {SPECIFICITY} + 0.2::DOUBLE * {F1} + 0.15::DOUBLE * coalesce(auc, 0), 6) AS fitness
    FROM c JOIN a USING (model)""",
)
def image_fitness(spark, sf):
    base = scored(spark, sf)
    counts = M.with_rates(M.confusion_counts(base, ["model"], R.decide()), ["recall", "specificity", "f1"], floored=True)
    both = join_groups(counts, C.areas(base, ["model"]), ["model"])
    return both.select("model", r6(R.image_fitness(), "fitness"))


@query(
    "h16_fitness_with_gaps",
    f"""{MISSING}, h AS (SELECT model, y_prob AS score, count(*) FILTER (WHERE y_true = 1) AS pos, count(*) FILTER (WHERE y_true = 0) AS neg
      FROM known GROUP BY model, y_prob),
    r AS (SELECT *, sum(pos) OVER w AS tps, sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n
      FROM h WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
    a AS (SELECT model, sum(neg * (tps - pos + pos / 2.0::DOUBLE)) / (max(p)::DOUBLE * max(n)) AS auc FROM r GROUP BY model),
    c AS (SELECT model, {AT_HALF} FROM known GROUP BY model)
    SELECT c.model, round(0.45::DOUBLE * {RECALL} + 0.2::DOUBLE * {SPECIFICITY} + 0.2::DOUBLE * {F1} + 0.15::DOUBLE * coalesce(auc, 0), 6) AS fitness
    FROM c JOIN a ON c.model IS NOT DISTINCT FROM a.model""",
)
def fitness_with_gaps(spark, sf):
    base = with_gaps(spark, sf)
    counts = M.with_rates(M.confusion_counts(base, ["model"], R.decide()), ["recall", "specificity", "f1"], floored=True)
    both = join_groups(counts, C.areas(base, ["model"]), ["model"])
    return both.select("model", r6(R.image_fitness(), "fitness"))


CANDIDATES = """cands AS (SELECT *, 'exp' || (1 + line_no % 3) AS experiment, CAST(part_no % 3 AS INTEGER) AS generation,
  supp_no AS cand FROM scored)"""


@query(
    "h17_many_candidates",
    fitness_sql("experiment, generation, cand", "cands", f"{SCORED}, {CANDIDATES}"),
)
def many_candidates(spark, sf):
    cands = scored(spark, sf).select(
        "*",
        F.concat(F.lit("exp"), 1 + F.col("line_no") % 3).alias("experiment"),
        (F.col("part_no") % 3).cast("int").alias("generation"),
        F.col("supp_no").alias("cand"),
    )
    return rounded(M.fairness_metrics(cands, ["experiment", "generation", "cand"], "grp", R.decide()), *RATE_COLUMNS)


@query(
    "h18_metric_bundle",
    f"""{ranked_sql('y_prob')}, a AS (SELECT model, {AUC_SQL} AS auc_roc, {AP_SQL} AS average_precision FROM r GROUP BY model),
    c AS (SELECT model, {FLOAT_HALF} FROM scored GROUP BY model)
    SELECT model, tp, fp, fn, tn, {FLOORED_SQL}, auc_roc, average_precision FROM c JOIN a USING (model)""",
)
def metric_bundle(spark, sf):
    base = scored(spark, sf)
    counts = M.with_rates(M.confusion_counts(base, ["model"], R.decide_float("y_prob", 0.7)), floored=True)
    areas = C.areas(base.withColumn("y_f", F.col("y_prob").cast("float")), ["model"], "y_f")
    both = join_groups(counts, areas, ["model"])
    return rounded(both, "accuracy", "precision", "recall", "specificity", "f1", "auc_roc", "average_precision")
