"""Nested documents, logs and populations that Spark derives from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caresift.functions.constants import IMAGE_SPACE, TABULAR_EXPERIMENTS, TABULAR_SPACES
from caresift.functions.draws import uniform
from caresift.plans.views import draw_sql
from caresift.sources.documents import epoch_rows
from caresift.session import spread
from caresift.sources.tables import table

PHASES = [(0, 5), (1, 3)]

HISTORY = f"""history AS (
  SELECT o_orderkey AS run, metric, CAST(CASE phase WHEN 0 THEN i ELSE 5 + i END AS BIGINT) AS epoch,
    round({draw_sql('o_orderkey', 'metric', 'phase', 'i')}, 3) AS value
  FROM orders CROSS JOIN (VALUES ('loss'), ('val_loss')) m(metric)
    CROSS JOIN (VALUES (0, 0), (0, 1), (0, 2), (0, 3), (0, 4), (1, 0), (1, 1), (1, 2)) p(phase, i))"""


def history_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Two training phases per order, each a JSON map of metric to values per epoch."""

    def values(metric: str, phase: int, n: int):
        draws = [F.round(uniform(F.col("o_orderkey"), metric, phase, i), 3) for i in range(n)]
        return F.array(*draws)

    docs = [
        F.struct(
            F.lit(phase).alias("phase"),
            F.to_json(
                F.create_map(
                    F.lit("loss"), values("loss", phase, n), F.lit("val_loss"), values("val_loss", phase, n)
                )
            ).alias("doc"),
        )
        for phase, n in PHASES
    ]
    orders = spread(table(spark, sf, "orders").select("o_orderkey"))
    return orders.select(F.col("o_orderkey").alias("run"), F.explode(F.array(*docs)).alias("d")).select("run", "d.*")


def history(spark: SparkSession, sf: str) -> DataFrame:
    return epoch_rows(history_documents(spark, sf), "run", "phase", "doc")


RESULT_MODELS = ["RandomForestClassifier", "LogisticRegression"]
RESULT_RUNS = ["exp1", "exp2", "exp3"]


def result_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One search-result document per customer."""
    key = F.col("c_custkey")

    def run(model: str, exp: str):
        def number(name: str):
            return F.round(uniform(key, model, exp, name), 3)

        return F.struct(
            F.create_map(
                F.lit("max_depth"), F.floor(3 + 28 * number("max_depth")).cast("string"),
                F.lit("weights"), F.when(number("weights") < 0.5, "uniform").otherwise("distance"),
            ).alias("best_params"),
            number("fitness").alias("best_fitness"),
            F.create_map(F.lit("recall"), number("recall"), F.lit("f1"), number("f1")).alias("validation_metrics"),
            F.array(number("h0"), number("h1")).alias("history"),
        )

    models = []
    for model in RESULT_MODELS:
        runs = []
        for exp in RESULT_RUNS:
            runs += [F.lit(exp), run(model, exp)]
        models += [F.lit(model), F.create_map(*runs)]
    return spread(table(spark, sf, "customer").select("c_custkey")).select(
        key.alias("doc_id"), F.to_json(F.create_map(*models)).alias("doc")
    )


_NUM = "round({}, 3)"


def _n(name: str) -> str:
    return _NUM.format(draw_sql("c_custkey", "model", "experiment", f"'{name}'"))


RESULT_ROWS = f"""runs AS (
  SELECT c_custkey, model, experiment FROM customer
    CROSS JOIN (VALUES {', '.join(f"('{m}')" for m in RESULT_MODELS)}) a(model)
    CROSS JOIN (VALUES {', '.join(f"('{e}')" for e in RESULT_RUNS)}) b(experiment)),
result_rows AS (
  SELECT c_custkey AS doc_id, model, experiment, 'fitness' AS section, 'best_fitness' AS name, CAST({_n('fitness')} AS VARCHAR) AS value FROM runs
  UNION ALL SELECT c_custkey, model, experiment, 'param', 'max_depth', CAST(CAST(floor(3 + 28 * {_n('max_depth')}) AS BIGINT) AS VARCHAR) FROM runs
  UNION ALL SELECT c_custkey, model, experiment, 'param', 'weights', CASE WHEN {_n('weights')} < 0.5 THEN 'uniform' ELSE 'distance' END FROM runs
  UNION ALL SELECT c_custkey, model, experiment, 'metric', 'recall', CAST({_n('recall')} AS VARCHAR) FROM runs
  UNION ALL SELECT c_custkey, model, experiment, 'metric', 'f1', CAST({_n('f1')} AS VARCHAR) FROM runs)"""


def notebook_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One notebook per conversation turn: a cell per line, with outputs where the line is not empty."""
    kind = F.when(F.col("role") == "assistant", "code").otherwise("markdown")
    lines = F.split("text", "\n")
    none = F.array().cast("array<struct<output_type:string,text:string>>")
    cells = F.transform(
        lines,
        lambda line: F.struct(
            kind.alias("cell_type"),
            F.when(line == "", none)
            .otherwise(
                F.array(
                    F.struct(F.lit("stream").alias("output_type"), line.alias("text")),
                    F.struct(F.lit("display_data").alias("output_type"), F.lit("figure").alias("text")),
                )
            )
            .alias("outputs"),
        ),
    )
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.to_json(F.struct(cells.alias("cells"))).alias("doc")
    )


LOG_MODELS = ["RandomForestClassifier", "LogisticRegression", "KNeighborsClassifier", "ExtraTreesClassifier"]


def _model_of(key):
    model = F.lit(None).cast("string")
    for i, m in enumerate(LOG_MODELS):
        model = F.when(key % len(LOG_MODELS) == i, m).otherwise(model)
    return model


def logs(spark: SparkSession, sf: str) -> DataFrame:
    """A training log per order, some with a baseline block."""
    key = F.col("o_orderkey")

    def number(name: str):
        return F.format_number(F.round(uniform(key, name), 4), 4)

    tail = F.concat(
        F.lit("Fim de "), _model_of(key), F.lit(": exp1="), number("exp1"),
        F.lit(", exp2="), number("exp2"), F.lit(", exp3="), number("exp3"),
    )
    head = F.concat(
        F.lit("Baseline RandomForest\n  Accuracy: "), number("acc"), F.lit("\n  Recall: "), number("rec"), F.lit("\n")
    )
    text = F.concat(F.when(key % 3 == 0, head).otherwise("Accuracy solta\n"), F.lit("Gen 1/3 - melhor fitness: 0.5\n"), tail)
    return spread(table(spark, sf, "orders").select("o_orderkey")).select(key.alias("log_id"), text.alias("log"))


def _ln(name: str) -> str:
    return f"printf('%.4f', round({draw_sql('o_orderkey', repr(name))}, 4))"


_LOG_CASE = "CASE o_orderkey % 4 " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(LOG_MODELS)) + " END"
LOGS = f"""logs AS (
  SELECT o_orderkey AS log_id, o_orderkey % 3 = 0 AS base, {_LOG_CASE} AS model, {_ln('acc')} AS acc, {_ln('rec')} AS rec,
    {_ln('exp1')} AS exp1, {_ln('exp2')} AS exp2, {_ln('exp3')} AS exp3 FROM orders),
log_lines AS (
  SELECT log_id, 'Accuracy: ' || acc AS line, 'metric' AS kind FROM logs WHERE base
  UNION ALL SELECT log_id, 'Recall: ' || rec, 'metric' FROM logs WHERE base
  UNION ALL SELECT log_id, 'Fim de ' || model || ': exp1=' || exp1 || ', exp2=' || exp2 || ', exp3=' || exp3, 'scores' FROM logs)"""


# --- populations: every customer is a slot of every model and experiment ----------------

SPACES = {**TABULAR_SPACES, **IMAGE_SPACE}


def experiment_config(spark: SparkSession) -> DataFrame:
    rows = [(e["name"], str(e["seed"]), e["cx_prob"], e["mut_prob"]) for e in TABULAR_EXPERIMENTS]
    return spark.createDataFrame(rows, "experiment string, seed string, cx_prob double, mut_prob double")


def _in_every_run(candidates: DataFrame) -> DataFrame:
    """``candidates`` as candidates of every model and experiment, with the experiment's seed."""
    kept = candidates.columns
    models = F.explode(F.array(*[F.lit(m) for m in SPACES])).alias("model")
    runs = F.explode(
        F.array(
            *[F.struct(F.lit(e["name"]).alias("experiment"), F.lit(str(e["seed"])).alias("seed")) for e in TABULAR_EXPERIMENTS]
        )
    ).alias("run")
    each = candidates.select(*kept, models).select(*kept, "model", runs)
    return each.select("model", "run.experiment", "run.seed", *kept)


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    """(cand): customer numbers are the candidate numbers."""
    return spread(table(spark, sf, "customer").select("c_custkey")).select(F.col("c_custkey").alias("cand"))


def search_slots(spark: SparkSession, sf: str) -> DataFrame:
    """(model, experiment, seed, cand) of all candidates."""
    return _in_every_run(_candidates(spark, sf))


def search_fitness(spark: SparkSession, sf: str) -> DataFrame:
    """A fitness per candidate from its balance and a draw per experiment; ties occur.

    Candidates meet their balances once, before models and experiments multiply them.
    """
    balances = table(spark, sf, "customer").select(F.col("c_custkey").alias("cand"), "c_acctbal").hint("merge")
    slots = _in_every_run(_candidates(spark, sf).join(balances, "cand"))
    value = F.round(F.abs("c_acctbal") / 10000 * 0.5 + uniform("fit", F.col("model"), F.col("experiment"), F.col("cand")) * 0.5, 2)
    return slots.select("model", "experiment", "cand", value.alias("fitness"))


_SPACE_ROWS = ", ".join(
    f"('{m}', '{g[0]}', '{g[1]}', {g[2]!r}::DOUBLE, {g[3]!r}::DOUBLE, {g[4] if g[4] else '[]'}::VARCHAR[])"
    for m, genes in SPACES.items()
    for g in genes
)
_RUN_ROWS = ", ".join(
    f"('{e['name']}', '{e['seed']}', {e['cx_prob']}::DOUBLE, {e['mut_prob']}::DOUBLE)" for e in TABULAR_EXPERIMENTS
)
SPACE = f"genes(model, gene, kind, low, high, choices) AS (VALUES {_SPACE_ROWS}), config(experiment, seed, cx_prob, mut_prob) AS (VALUES {_RUN_ROWS})"
SLOTS = """slots AS MATERIALIZED (SELECT model, experiment, seed, cx_prob, mut_prob, c_custkey AS cand
  FROM customer CROSS JOIN (SELECT DISTINCT model FROM genes) CROSS JOIN config)"""
SEARCH_FITNESS = f"""fitness AS MATERIALIZED (SELECT model, experiment, cand,
  round(abs(c_acctbal) / 10000 * 0.5::DOUBLE + {draw_sql("'fit'", 'model', 'experiment', 'cand')} * 0.5::DOUBLE, 2) AS fitness
  FROM slots JOIN customer ON c_custkey = cand)"""


def gene_sql(u: str) -> tuple[str, str]:
    """(num, cat) of a drawn gene, as SQL over kind, low, high, choices."""
    num = f"""CASE kind WHEN 'int' THEN low + floor({u} * (high - low + 1)) WHEN 'float' THEN round(low + {u} * (high - low), 4)
      WHEN 'log_float' THEN round(pow(10.0::DOUBLE, log10(low) + {u} * (log10(high) - log10(low))), 6)
      ELSE floor({u} * len(choices))::DOUBLE END"""
    cat = f"CASE WHEN kind = 'cat' THEN choices[CAST(floor({u} * len(choices)) AS BIGINT) + 1] END"
    return num, cat
