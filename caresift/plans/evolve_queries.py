"""Evolutionary search steps; every customer is a candidate of every experiment."""

from __future__ import annotations

from pyspark.sql import functions as F

from caresift.operators import evolve as E
from caresift.plans.derived import (
    SEARCH_FITNESS,
    SLOTS,
    SPACE,
    SPACES,
    experiment_config,
    gene_sql,
    search_fitness,
    search_slots,
)
from caresift.plans.registry import query
from caresift.plans.views import draw_sql
from caresift.sources.tables import table

INIT_NUM, INIT_CAT = gene_sql(draw_sql("seed", "0", "cand", "gene", "'init'"))
POPULATION = f"population AS MATERIALIZED (SELECT model, experiment, cand, gene, {INIT_NUM} AS num, {INIT_CAT} AS cat FROM slots JOIN genes USING (model))"
BASE = f"WITH {SPACE}, {SLOTS}, {SEARCH_FITNESS}, {POPULATION}"
LONG = "model, experiment, cand, gene, round(num, 6) AS num, cat"


def _genes(spark):
    return E.gene_table(spark, SPACES)


def _population(spark, sf):
    return E.initial_population(search_slots(spark, sf), _genes(spark))


def _by_kind(spark, sf, *kinds):
    genes = _genes(spark).filter(F.col("kind").isin(*kinds))
    return E.initial_population(search_slots(spark, sf), genes)


def _kind_sql(*kinds):
    listed = ", ".join(f"'{k}'" for k in kinds)
    return f"""WITH {SPACE}, {SLOTS} SELECT model, experiment, cand, gene, round({INIT_NUM}, 6) AS num, {INIT_CAT} AS cat
    FROM slots JOIN genes USING (model) WHERE kind IN ({listed})"""


@query("k01_draw_genes", _kind_sql("int", "float", "cat"))
def draw_genes(spark, sf):
    return _by_kind(spark, sf, "int", "float", "cat")


@query("k02_draw_log_genes", _kind_sql("log_float"))
def draw_log_genes(spark, sf):
    return _by_kind(spark, sf, "log_float")


@query("k03_initial_population", f"{BASE} SELECT {LONG} FROM population")
def initial_population(spark, sf):
    return _population(spark, sf)


def _parents(spark, sf):
    n = table(spark, sf, "customer").count()
    return (
        search_slots(spark, sf)
        .filter("cand >= 1")
        .withColumnRenamed("cand", "slot")
        .withColumn("gen", F.lit(1))
        .withColumn("pop_size", F.lit(n).cast("bigint"))
        .withColumn("parent", F.explode(F.array(F.lit("A"), F.lit("B"))))
    )


def tournament_sql(k: int, distinct: bool = True) -> str:
    """Winners of every slot and parent."""
    u = [draw_sql("seed", "1", "slot", "parent", f"'t{i}'") for i in range(k)]
    if not distinct:
        picks = ", ".join(f"CAST(floor({x} * n) AS BIGINT) AS i{i}" for i, x in enumerate(u))
        steps = f"picks AS MATERIALIZED (SELECT *, {picks} FROM parents)"
    else:
        steps = f"""p0 AS (SELECT *, CAST(floor({u[0]} * n) AS BIGINT) AS i0 FROM parents),
        p1 AS (SELECT *, CAST(floor({u[1]} * (n - 1)) AS BIGINT) AS r1 FROM p0),
        {'picks AS MATERIALIZED' if k == 2 else 'p2 AS'} (SELECT *, r1 + CASE WHEN r1 >= i0 THEN 1 ELSE 0 END AS i1 FROM p1)"""
        if k == 3:
            steps += f""", p3 AS (SELECT *, CAST(floor({u[2]} * (n - 2)) AS BIGINT) AS r2 FROM p2),
            p4 AS (SELECT *, r2 + CASE WHEN r2 >= least(i0, i1) THEN 1 ELSE 0 END AS s2 FROM p3),
            picks AS MATERIALIZED (SELECT *, s2 + CASE WHEN s2 >= greatest(i0, i1) THEN 1 ELSE 0 END AS i2 FROM p4)"""
    turns = " UNION ALL ".join(
        f"SELECT model, experiment, slot, parent, {i} AS turn, i{i} AS cand FROM picks" for i in range(k)
    )
    return f"""parents AS (SELECT model, experiment, seed, cand AS slot, parent, (SELECT count(*) FROM customer) AS n
      FROM slots CROSS JOIN (VALUES ('A'), ('B')) v(parent) WHERE cand >= 1),
    {steps}, turns AS ({turns}),
    judged AS (SELECT t.*, fitness, row_number() OVER (PARTITION BY t.model, t.experiment, slot, parent ORDER BY fitness DESC, turn) AS rn
      FROM turns t JOIN fitness f ON f.model = t.model AND f.experiment = t.experiment AND f.cand = t.cand),
    winners AS MATERIALIZED (SELECT model, experiment, slot, parent, cand FROM judged WHERE rn = 1)"""


@query("k04_tournament", f"WITH {SPACE}, {SLOTS}, {SEARCH_FITNESS}, {tournament_sql(3)} SELECT * FROM winners")
def tournament(spark, sf):
    return E.tournament(_parents(spark, sf), search_fitness(spark, sf), "pop_size", 3)


@query("k04_tournament_of_two", f"WITH {SPACE}, {SLOTS}, {SEARCH_FITNESS}, {tournament_sql(2)} SELECT * FROM winners")
def tournament_of_two(spark, sf):
    return E.tournament(_parents(spark, sf), search_fitness(spark, sf), "pop_size", 2)


@query(
    "k04_tournament_with_replacement",
    f"WITH {SPACE}, {SLOTS}, {SEARCH_FITNESS}, {tournament_sql(3, distinct=False)} SELECT * FROM winners",
)
def tournament_with_replacement(spark, sf):
    return E.tournament(_parents(spark, sf), search_fitness(spark, sf), "pop_size", 3, distinct=False)


def cross_sql(take: str) -> str:
    other = "A" if take == "B" else "B"
    u = draw_sql("c.seed", "1", "w.slot", "p.gene", "'cx'")
    return f"""children AS MATERIALIZED (SELECT w.model, w.experiment, w.slot, p.gene, p.num, p.cat
    FROM winners w JOIN config c ON c.experiment = w.experiment
    JOIN population p ON p.model = w.model AND p.experiment = w.experiment AND p.cand = w.cand
    WHERE w.parent = CASE WHEN {u} < c.cx_prob THEN '{take}' ELSE '{other}' END)"""


@query(
    "k05_crossover",
    f"{BASE}, {tournament_sql(3)}, {cross_sql('B')} SELECT model, experiment, slot, gene, round(num, 6) AS num, cat FROM children",
)
def crossover(spark, sf):
    winners = tournament(spark, sf)
    return E.crossover(winners, _population(spark, sf), _genes(spark), experiment_config(spark), 1)


@query(
    "k05_crossover_from_first",
    f"{BASE}, {tournament_sql(3)}, {cross_sql('A')} SELECT model, experiment, slot, gene, round(num, 6) AS num, cat FROM children",
)
def crossover_from_first(spark, sf):
    winners = tournament(spark, sf)
    return E.crossover(winners, _population(spark, sf), _genes(spark), experiment_config(spark), 1, take="A")


def mutate_sql(source: str) -> str:
    """Every draw is made once a row, whatever its outcome is used for."""
    num, cat = gene_sql("u")
    return f"""mutated AS MATERIALIZED (SELECT model, experiment, slot, gene,
      CASE WHEN h < mut_prob THEN {num} ELSE old_num END AS num, CASE WHEN h < mut_prob THEN {cat} ELSE old_cat END AS cat
    FROM (SELECT x.model, x.experiment, x.slot, x.gene, x.num AS old_num, x.cat AS old_cat, g.kind, g.low, g.high, g.choices, c.mut_prob,
        {draw_sql("c.seed", "1", "x.slot", "x.gene", "'mut'")} AS h, {draw_sql("c.seed", "1", "x.slot", "x.gene", "'new'")} AS u
      FROM {source} x JOIN genes g ON g.model = x.model AND g.gene = x.gene JOIN config c ON c.experiment = x.experiment))"""


@query(
    "k06_mutation",
    f"""{BASE}, first AS (SELECT model, experiment, cand AS slot, gene, num, cat FROM population), {mutate_sql('first')}
    SELECT model, experiment, slot, gene, round(num, 6) AS num, cat FROM mutated""",
)
def mutation(spark, sf):
    children = _population(spark, sf).withColumnRenamed("cand", "slot")
    return E.mutation(children, _genes(spark), experiment_config(spark), 1)


ELITE = """best AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY model, experiment ORDER BY fitness DESC, cand) AS rn FROM fitness)"""


@query(
    "k07_elite",
    f"WITH {SPACE}, {SLOTS}, {SEARCH_FITNESS}, {ELITE} SELECT model, experiment, cand, fitness FROM best WHERE rn = 1",
)
def elite(spark, sf):
    return E.elite(search_fitness(spark, sf))


@query(
    "k08_next_generation",
    f"""{BASE}, {tournament_sql(3)}, {cross_sql('B')}, {mutate_sql('children')}, {ELITE}
    SELECT model, experiment, slot AS cand, gene, round(num, 6) AS num, cat FROM mutated
    UNION ALL SELECT p.model, p.experiment, 0, p.gene, round(p.num, 6), p.cat FROM population p
      JOIN best b ON b.model = p.model AND b.experiment = p.experiment AND b.cand = p.cand WHERE rn = 1""",
)
def next_generation(spark, sf):
    slots = _parents(spark, sf).filter("parent = 'A'").drop("parent", "gen")
    return E.next_generation(
        _population(spark, sf), search_fitness(spark, sf), slots, _genes(spark), experiment_config(spark), 1
    )
