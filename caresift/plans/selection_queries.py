"""Threshold, ranking and training-log queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from caresift.functions import rates as R
from caresift.functions.constants import COARSE_GRID, FINE_GRID, PARAMETER_GRIDS, RECALL_GRID
from caresift.operators import metrics as M
from caresift.operators import selection as S
from caresift.operators import thresholds as T
from caresift.plans.registry import query, r6, rounded
from caresift.plans.derived import HISTORY, history
from caresift.sources.tables import table
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

RATES = ["precision", "recall", "specificity", "f1", "accuracy"]


def grid_sql(grid, single=False) -> str:
    """Confusion at each grid threshold, counted threshold by threshold."""
    values = ", ".join(f"({t!r}::DOUBLE)" for t in grid)
    test = "CAST(y_prob AS FLOAT) >= CAST(threshold AS FLOAT)" if single else "y_prob >= threshold"
    return f"""WITH {SCORED}, h AS (SELECT model, y_prob, y_true, count(*) AS n FROM scored GROUP BY ALL),
    grid(threshold) AS (VALUES {values}),
    c AS (SELECT model, threshold,
        CAST(sum(CASE WHEN y_true = 1 AND {test} THEN n ELSE 0 END) AS BIGINT) AS tp,
        CAST(sum(CASE WHEN y_true = 0 AND {test} THEN n ELSE 0 END) AS BIGINT) AS fp,
        CAST(sum(CASE WHEN y_true = 1 AND NOT ({test}) THEN n ELSE 0 END) AS BIGINT) AS fn,
        CAST(sum(CASE WHEN y_true = 0 AND NOT ({test}) THEN n ELSE 0 END) AS BIGINT) AS tn
      FROM h CROSS JOIN grid GROUP BY model, threshold),
    m AS (SELECT *, {ACCURACY} AS accuracy, {PRECISION} AS precision, {RECALL} AS recall, {SPECIFICITY} AS specificity, {F1} AS f1 FROM c)"""


OUT_SQL = """model, round(threshold, 6) AS threshold, tp, fp, fn, tn, round(accuracy, 6) AS accuracy,
  round(precision, 6) AS precision, round(recall, 6) AS recall, round(specificity, 6) AS specificity, round(f1, 6) AS f1"""


def best_sql(grid, order: str, single=False) -> str:
    return f"""{grid_sql(grid, single)},
    b AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY {order}) AS rn FROM m)
    SELECT {OUT_SQL} FROM b WHERE rn = 1"""


def _out(df):
    return rounded(df, "threshold", *RATES)


@query("i01_threshold_sweep", f"{grid_sql(COARSE_GRID)} SELECT {OUT_SQL} FROM m")
def threshold_sweep(spark, sf):
    return _out(T.sweep(scored(spark, sf), ["model"], COARSE_GRID))


@query("i02_recall_first_threshold", best_sql(COARSE_GRID, "recall DESC, f1 DESC, specificity DESC, threshold"))
def recall_first_threshold(spark, sf):
    return _out(T.recall_first(scored(spark, sf), ["model"]))


@query(
    "i03_weighted_recall_threshold",
    best_sql(FINE_GRID, "round(recall * 2.0::DOUBLE + specificity + f1, 12) DESC, threshold", single=True),
)
def weighted_recall_threshold(spark, sf):
    return _out(T.weighted_recall(scored(spark, sf), ["model"]))


@query(
    "i04_accuracy_f1_threshold",
    best_sql(FINE_GRID, "round(accuracy + f1, 12) DESC, threshold", single=True),
)
def accuracy_f1_threshold(spark, sf):
    return _out(T.accuracy_plus_f1(scored(spark, sf), ["model"]))


LOWEST_ORDER = (
    "(recall >= 0.99) DESC, CASE WHEN recall >= 0.99 THEN threshold ELSE 0 END, "
    "recall DESC, specificity DESC, precision DESC, accuracy DESC, threshold"
)


@query("i05_lowest_threshold_with_recall", best_sql(RECALL_GRID, LOWEST_ORDER))
def lowest_threshold_with_recall(spark, sf):
    return _out(T.lowest_with_recall(scored(spark, sf), ["model"]))


@query(
    "i05_lowest_threshold_reached",
    best_sql(COARSE_GRID, LOWEST_ORDER.replace("0.99", "0.9")),
)
def lowest_threshold_reached(spark, sf):
    return _out(T.lowest_with_recall(scored(spark, sf), ["model"], required=0.9, grid=COARSE_GRID))


@query(
    "i06_top_thresholds",
    f"""{grid_sql(RECALL_GRID)},
    b AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY recall DESC, specificity DESC, precision DESC, accuracy DESC, threshold) AS rank FROM m)
    SELECT {OUT_SQL}, CAST(rank AS INTEGER) AS rank FROM b WHERE rank <= 10""",
)
def top_thresholds(spark, sf):
    return _out(T.top_thresholds(scored(spark, sf), ["model"]))


@query(
    "i07_default_vs_chosen",
    f"""{grid_sql(COARSE_GRID)},
    b AS (SELECT model, threshold AS chosen, row_number() OVER (PARTITION BY model ORDER BY recall DESC, f1 DESC, specificity DESC, threshold) AS rn FROM m),
    s AS (SELECT model, 'default' AS scenario, 0.5::DOUBLE AS threshold, {AT_HALF} FROM scored GROUP BY model
      UNION ALL SELECT model, 'chosen', chosen, {CONFUSION.format(p='y_prob >= chosen')} FROM scored JOIN b USING (model) WHERE rn = 1 GROUP BY model, chosen)
    SELECT model, scenario, threshold, tp, fp, fn, tn, round({ACCURACY}, 6) AS accuracy, round({PRECISION}, 6) AS precision,
      round({RECALL}, 6) AS recall, round({SPECIFICITY}, 6) AS specificity, round({F1}, 6) AS f1 FROM s""",
)
def default_vs_chosen(spark, sf):
    base = scored(spark, sf)
    return rounded(T.compare_with_default(base, ["model"], T.recall_first(base, ["model"])), *RATES)


@query(
    "i08_leaderboard",
    f"""WITH {SCORED}, c AS (SELECT model, {AT_HALF} FROM scored GROUP BY model),
    m AS (SELECT model, {RECALL} AS recall, {F1} AS f1, {ACCURACY} AS accuracy FROM c)
    SELECT model, round(recall, 6) AS recall, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy,
      row_number() OVER (ORDER BY recall DESC, f1 DESC, accuracy DESC, model) AS place FROM m""",
)
def leaderboard(spark, sf):
    c = M.with_rates(M.confusion_counts(scored(spark, sf), ["model"], R.decide()), ["recall", "f1", "accuracy"])
    return rounded(S.leaderboard(c.select("model", "recall", "f1", "accuracy")), "recall", "f1", "accuracy")


GRID_SIZES = {m: math.prod(len(v) for v in g.values()) for m, g in PARAMETER_GRIDS.items()}
_MODEL_CASE = "CASE line_no % 4 " + " ".join(
    f"WHEN {i} THEN '{m}'" for i, m in enumerate(PARAMETER_GRIDS)
) + " END"
_SIZE_CASE = "CASE line_no % 4 " + " ".join(
    f"WHEN {i} THEN {GRID_SIZES[m]}" for i, m in enumerate(PARAMETER_GRIDS)
) + " END"


def _grid_candidates(spark, sf):
    slot = F.col("line_no") % 4
    model, size = F.lit(None).cast("string"), F.lit(1)
    for i, m in enumerate(PARAMETER_GRIDS):
        model = F.when(slot == i, m).otherwise(model)
        size = F.when(slot == i, GRID_SIZES[m]).otherwise(size)
    return scored(spark, sf).select(
        model.alias("model"), (F.col("supp_no") % size).cast("int").alias("point"), "y_true", "y_prob"
    )


@query(
    "i09_grid_choice",
    f"""WITH {SCORED}, k AS (SELECT {_MODEL_CASE} AS gm, CAST(supp_no % {_SIZE_CASE} AS INTEGER) AS point, y_true, y_prob FROM scored),
    c AS (SELECT gm, point, {AT_HALF} FROM k GROUP BY gm, point),
    m AS (SELECT gm, point, {RECALL} AS recall, {F1} AS f1, {ACCURACY} AS accuracy FROM c),
    b AS (SELECT *, row_number() OVER (PARTITION BY gm ORDER BY recall DESC, f1 DESC, accuracy DESC, point) AS rn FROM m)
    SELECT gm AS model, point, round(recall, 6) AS recall, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy FROM b WHERE rn = 1""",
)
def grid_choice(spark, sf):
    points = S.grid_points(PARAMETER_GRIDS, spark)
    counts = M.confusion_counts(_grid_candidates(spark, sf), ["model", "point"], R.decide())
    results = M.with_rates(counts, ["recall", "f1", "accuracy"]).join(F.broadcast(points), ["model", "point"])
    best = S.grid_choice(results.select("model", "point", "params", "recall", "f1", "accuracy"))
    return rounded(best.drop("params"), "recall", "f1", "accuracy")


EXPERIMENTS = f"""{SCORED}, g AS (SELECT model, 'exp' || (1 + supp_no % 3) AS experiment, grp, {AT_HALF} FROM scored GROUP BY ALL),
  c AS (SELECT model, experiment, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, sum(tn) AS tn, max({RECALL}) - min({RECALL}) AS gap
        FROM g GROUP BY model, experiment),
  e AS (SELECT model, experiment, round(0.6::DOUBLE * {RECALL} + 0.2::DOUBLE * {SPECIFICITY} + 0.2::DOUBLE * {F1} - 0.5::DOUBLE * gap, 6) AS fitness FROM c)"""


def _experiments(spark, sf):
    rows = scored(spark, sf).withColumn("experiment", F.concat(F.lit("exp"), (1 + F.col("supp_no") % 3)))
    return M.fairness_metrics(rows, ["model", "experiment"], "grp", R.decide()).select(
        "model", "experiment", r6("fitness")
    )


@query(
    "i10_best_experiment",
    f"""WITH {EXPERIMENTS}, b AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY fitness DESC, experiment) AS rn FROM e)
    SELECT model, experiment, fitness FROM b WHERE rn = 1""",
)
def best_experiment(spark, sf):
    return S.best_experiment(_experiments(spark, sf))


@query(
    "i11_global_ranking",
    f"WITH {EXPERIMENTS} SELECT model, experiment, fitness, row_number() OVER (ORDER BY fitness DESC, model, experiment) AS place FROM e",
)
def global_ranking(spark, sf):
    return S.ranking(_experiments(spark, sf), "model", "experiment")


@query(
    "i12_best_so_far",
    """WITH e AS (SELECT o_orderpriority AS experiment, CAST(floor(o_orderkey / 10) AS BIGINT) AS generation, max(o_totalprice) AS step_best
      FROM orders GROUP BY ALL)
    SELECT experiment, generation, round(step_best, 6) AS step_best,
      round(max(step_best) OVER (PARTITION BY experiment ORDER BY generation), 6) AS best FROM e""",
)
def best_so_far(spark, sf):
    steps = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("experiment"),
        F.floor(F.col("o_orderkey") / 10).alias("generation"),
        F.col("o_totalprice").alias("fitness"),
    )
    return rounded(S.best_so_far(steps, ["experiment"], "generation", "fitness"), "step_best", "best")


@query(
    "i13_original_vs_optimized",
    f"""WITH {SCORED}, c AS (SELECT model, CASE WHEN supp_no % 2 = 0 THEN 'original' ELSE 'optimized' END AS variant, {AT_HALF} FROM scored GROUP BY ALL),
    m AS (SELECT model, variant, {ACCURACY} AS accuracy, {RECALL} AS recall, {SPECIFICITY} AS specificity, {F1} AS f1 FROM c),
    u AS (UNPIVOT m ON accuracy, recall, specificity, f1 INTO NAME metric VALUE v)
    SELECT model, metric, round(max(v) FILTER (WHERE variant = 'original'), 6) AS original,
      round(max(v) FILTER (WHERE variant = 'optimized'), 6) AS optimized,
      round(max(v) FILTER (WHERE variant = 'optimized') - max(v) FILTER (WHERE variant = 'original'), 6) AS delta
    FROM u GROUP BY model, metric""",
)
def original_vs_optimized(spark, sf):
    rows = scored(spark, sf).withColumn(
        "variant", F.when(F.col("supp_no") % 2 == 0, "original").otherwise("optimized")
    )
    m = M.with_rates(M.confusion_counts(rows, ["model", "variant"], R.decide()))
    out = S.compare_variants(m, "model", "variant", "original", "optimized", ["accuracy", "recall", "specificity", "f1"])
    return rounded(out, "original", "optimized", "delta")


@query(
    "i14_best_epoch",
    f"""WITH {HISTORY}, b AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY value, epoch) AS rn FROM history WHERE metric = 'val_loss')
    SELECT run, epoch AS best_epoch, value AS best_value FROM b WHERE rn = 1""",
)
def best_epoch(spark, sf):
    return S.best_epoch(history(spark, sf), ["run"], "val_loss", "min")


@query(
    "i14_best_epoch_max",
    f"""WITH {HISTORY}, b AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY value DESC, epoch) AS rn FROM history WHERE metric = 'loss')
    SELECT run, epoch AS best_epoch, value AS best_value FROM b WHERE rn = 1""",
)
def best_epoch_max(spark, sf):
    return S.best_epoch(history(spark, sf), ["run"], "loss", "max")


@query(
    "i15_early_stop",
    f"""WITH {HISTORY}, a AS (SELECT run, epoch, value, min(value) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
      FROM history WHERE metric = 'val_loss'),
    b AS (SELECT run, epoch, max(CASE WHEN before IS NULL OR value < before THEN epoch END) OVER (PARTITION BY run ORDER BY epoch) AS last FROM a)
    SELECT run, min(epoch) FILTER (WHERE epoch - last >= 4) AS stop_epoch, max(epoch) AS last_epoch FROM b GROUP BY run""",
)
def early_stop(spark, sf):
    return S.early_stop(history(spark, sf), ["run"], "val_loss", patience=4)


@query(
    "i16_plateau_rates",
    f"""WITH RECURSIVE {HISTORY}, v AS (SELECT CAST(run AS VARCHAR) AS run, epoch, value FROM history WHERE metric = 'val_loss'),
    t(run, epoch, best, wait, rate, reduced) AS (
      SELECT run, epoch, value, 0, 0.0001::DOUBLE, false FROM v WHERE epoch = 0
      UNION ALL
      SELECT v.run, v.epoch, CASE WHEN value < best - 0.0001::DOUBLE THEN value ELSE best END,
        CASE WHEN value < best - 0.0001::DOUBLE OR wait + 1 >= 2 THEN 0 ELSE wait + 1 END,
        CASE WHEN value >= best - 0.0001::DOUBLE AND wait + 1 >= 2 THEN greatest(rate * 0.5::DOUBLE, 1e-6::DOUBLE) ELSE rate END,
        value >= best - 0.0001::DOUBLE AND wait + 1 >= 2 AND rate > 1e-6::DOUBLE
      FROM t JOIN v ON v.run = t.run AND v.epoch = t.epoch + 1)
    SELECT run, epoch, round(rate, 9) AS learning_rate, reduced FROM t""",
)
def plateau_rates(spark, sf):
    out = S.plateau_rates(history(spark, sf), "run", "val_loss", patience=2, start_rate=1e-4)
    return out.withColumn("learning_rate", F.round("learning_rate", 9))
