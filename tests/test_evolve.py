import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from caresift.functions.constants import IMAGE_SPACE, TABULAR_SPACES
from caresift.operators import evolve as E


def slots(spark, model, n, seed="1", experiment="e"):
    return spark.range(n).select(F.lit(model).alias("model"), F.lit(experiment).alias("experiment"), F.lit(seed).alias("seed"), F.col("id").alias("cand"))


def parents(spark, n, seed="1"):
    return (
        slots(spark, "KNeighborsClassifier", n, seed)
        .withColumnRenamed("cand", "slot")
        .withColumn("gen", F.lit(1))
        .withColumn("pop_size", F.lit(n).cast("bigint"))
        .withColumn("parent", F.explode(F.array(F.lit("A"), F.lit("B"))))
    )


def test_values_stay_in_their_space(spark):
    genes = E.gene_table(spark, {**TABULAR_SPACES, **IMAGE_SPACE})
    for model, spec in {**TABULAR_SPACES, **IMAGE_SPACE}.items():
        rows = E.initial_population(slots(spark, model, 200), genes).collect()
        table = {g[0]: g for g in spec}
        assert len(rows) == 200 * len(spec)
        for r in rows:
            _, kind, low, high, choices = table[r["gene"]]
            if kind == "cat":
                assert r["cat"] in choices
            else:
                assert low - 1e-6 <= r["num"] <= high + 1e-6 and r["cat"] is None
                assert kind != "int" or r["num"] == int(r["num"])


def test_unknown_kind_is_an_error(spark):
    genes = E.gene_table(spark, {"m": [("g", "odd", 0.0, 1.0, [])]})
    with pytest.raises(PySparkException, match="Unknown parameter type: odd"):
        E.initial_population(slots(spark, "m", 1), genes).collect()


@pytest.mark.parametrize("n,k", [(2, 3), (3, 3), (12, 3), (3, 2), (1, 3)])
def test_contestants_are_distinct_and_in_range(spark, n, k):
    drawn = {}
    for r in E.contestants(parents(spark, n), "pop_size", k).collect():
        drawn.setdefault((r["slot"], r["parent"]), []).append(r["cand"])
    assert len(drawn) == 2 * n
    for picks in drawn.values():
        assert len(picks) == len(set(picks)) == min(k, n)
        assert all(0 <= p < n for p in picks)


def test_every_index_is_drawn_about_equally(spark):
    counts = E.contestants(parents(spark, 300), "pop_size", 3).groupBy("cand").count().collect()
    assert len(counts) == pytest.approx(300, abs=5)
    assert max(r["count"] for r in counts) < 25


def test_winner_is_the_fittest_contestant(spark):
    fitness = spark.range(30).select(
        F.lit("KNeighborsClassifier").alias("model"), F.lit("e").alias("experiment"), F.col("id").alias("cand"), (F.col("id") % 5 / 10).alias("fitness")
    )
    drawn = {}
    for r in E.contestants(parents(spark, 30), "pop_size", 3).orderBy("turn").collect():
        drawn.setdefault((r["slot"], r["parent"]), []).append(r["cand"])
    for r in E.tournament(parents(spark, 30), fitness, "pop_size").collect():
        assert r["cand"] == max(drawn[(r["slot"], r["parent"])], key=lambda c: c % 5)


def test_elite_takes_the_first_of_equals(spark):
    rows = [("m", "e", 2, 0.5), ("m", "e", 1, 0.5), ("m", "e", 0, 0.1)]
    df = spark.createDataFrame(rows, "model string, experiment string, cand long, fitness double")
    assert E.elite(df).first()["cand"] == 1


def test_generation_is_whole_and_independent_of_partitions(spark):
    genes = E.gene_table(spark, {"KNeighborsClassifier": TABULAR_SPACES["KNeighborsClassifier"]})
    config = spark.createDataFrame([("e", "1", 0.8, 0.3)], "experiment string, seed string, cx_prob double, mut_prob double")
    first = E.initial_population(slots(spark, "KNeighborsClassifier", 40), genes)
    fitness = first.groupBy("model", "experiment", "cand").agg(F.round(F.sum("num") / 100, 3).alias("fitness"))
    children = parents(spark, 40).filter("parent = 'A' and slot >= 1").drop("parent", "gen")
    results = []
    for n in (2, 7):
        step = E.next_generation(first.repartition(n), fitness, children.repartition(n), genes, config, 1)
        results.append(sorted(map(str, step.collect())))
    assert results[0] == results[1] and len(results[0]) == 40 * 3
    best = E.elite(fitness).first()["cand"]
    kept = {r["gene"]: (r["num"], r["cat"]) for r in step.filter("cand = 0").collect()}
    assert kept == {r["gene"]: (r["num"], r["cat"]) for r in first.filter(F.col("cand") == best).collect()}


def test_crossover_direction(spark):
    config = spark.createDataFrame([("e", "1", 1.0, 0.0)], "experiment string, seed string, cx_prob double, mut_prob double")
    population = spark.createDataFrame([("m", "e", 0, "g", 1.0, None), ("m", "e", 1, "g", 2.0, None)], "model string, experiment string, cand long, gene string, num double, cat string")
    genes = E.gene_table(spark, {"m": [("g", "float", 0.0, 1.0, [])]})
    winners = spark.createDataFrame([("m", "e", 5, "A", 0), ("m", "e", 5, "B", 1)], "model string, experiment string, slot long, parent string, cand long")
    assert E.crossover(winners, population, genes, config, 1).first()["num"] == 2.0
    assert E.crossover(winners, population, genes, config, 1, take="A").first()["num"] == 1.0


def _broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_multiplied_sides_are_never_broadcast(spark):
    genes = E.gene_table(spark, TABULAR_SPACES)
    config = spark.createDataFrame([("e", "1", 0.8, 0.1)], "experiment string, seed string, cx_prob double, mut_prob double")
    fitness = slots(spark, "KNeighborsClassifier", 50).select("model", "experiment", "cand", (F.col("cand") % 7 / 7).alias("fitness"))
    population = E.initial_population(slots(spark, "KNeighborsClassifier", 50), genes)
    winners = E.tournament(parents(spark, 50), fitness, "pop_size", 3)
    assert _broadcasts(winners) == 0
    # the genes of either side, and the experiments
    assert _broadcasts(E.crossover(winners, population, genes, config, 1)) == 3


def test_fitness_is_joined_before_it_is_multiplied(spark):
    from caresift.plans.derived import search_fitness

    found = search_fitness(spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert _broadcasts(found) == 0 and plan.index("Generate") < plan.index("Join")
