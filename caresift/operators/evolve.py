"""Evolutionary search as table steps over one long population table.

A population has one row per (model, experiment, cand, gene) with the value in
``num`` and, for categories, its text in ``cat``. Every step handles all
experiments at once. Draws are hashes of (seed, generation, slot, gene, tag), so
a step gives the same rows on any partitioning and after any retry.

Slots, contestants and genes are exploded rows, whose number Spark's size estimates
do not see. Joins between two such tables are therefore always merged, never broadcast;
their keys begin with the number, as sorting by it first compares few texts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caresift.functions.draws import uniform

SPEC = "model string, gene string, kind string, low double, high double, choices array<string>"
BY = ["model", "experiment"]


def gene_table(spark: SparkSession, spaces: Mapping[str, Sequence[tuple]]) -> DataFrame:
    """The genes of each model: a fixed handful of rows."""
    rows = [(model, *gene) for model, genes in spaces.items() for gene in genes]
    return spark.createDataFrame(rows, SPEC)


def drawn_gene(u: Column) -> tuple[Column, Column]:
    """(num, cat) for a draw ``u`` and the gene in columns kind, low, high, choices."""
    kind, low, high, choices = (F.col(c) for c in ("kind", "low", "high", "choices"))
    place = F.floor(u * F.size(choices))
    lo10, hi10 = F.log10(low), F.log10(high)
    unknown = F.raise_error(F.concat(F.lit("Unknown parameter type: "), F.coalesce(kind, F.lit("null"))))
    num = (
        F.when(kind == "int", low + F.floor(u * (high - low + 1)))
        .when(kind == "float", F.round(low + u * (high - low), 4))
        .when(kind == "log_float", F.round(F.pow(F.lit(10.0), lo10 + u * (hi10 - lo10)), 6))
        .when(kind == "cat", place.cast("double"))
        .otherwise(unknown.cast("double"))
    )
    cat = F.when(kind == "cat", F.try_element_at(choices, (place + 1).cast("int")))
    return num, cat


def sampled_genes(slots: DataFrame, genes: DataFrame, *parts: str) -> DataFrame:
    """Every gene of its model drawn for every slot; ``parts`` are the columns that seed the draw."""
    rows = slots.join(F.broadcast(genes), "model")
    rows = rows.withColumn("u", uniform(*[F.col(p) for p in parts], F.col("gene"), "init"))
    num, cat = drawn_gene(F.col("u"))
    return rows.withColumns({"num": num, "cat": cat}).drop("u", "kind", "low", "high", "choices")


def initial_population(slots: DataFrame, genes: DataFrame) -> DataFrame:
    """``slots`` has model, experiment, seed, cand; one row per gene comes out."""
    drawn = sampled_genes(slots.withColumn("gen", F.lit(0)), genes, "seed", "gen", "cand")
    return drawn.select(*BY, "cand", "gene", "num", "cat")


def contestants(slots: DataFrame, size: str, k: int, distinct: bool = True) -> DataFrame:
    """k indices below ``size`` per (slot, parent), in contest order.

    Distinct indices come from shrinking draws shifted past the earlier ones;
    with ``distinct=False`` the draws are independent.
    """
    u = [uniform(F.col("seed"), F.col("gen"), F.col("slot"), F.col("parent"), f"t{i}") for i in range(k)]
    n = F.col(size)
    if not distinct:
        picks = [F.floor(x * n) for x in u]
        rows = slots.withColumns({f"i{i}": p for i, p in enumerate(picks)})
        wanted = F.array(*[F.col(f"i{i}") for i in range(k)])
    else:
        rows = slots
        for i in range(k):
            value = F.floor(u[i] * F.greatest(n - i, F.lit(1)))
            taken = F.array_sort(F.array(*[F.col(f"i{j}") for j in range(i)])) if i else None
            rows = rows.withColumn(f"i{i}", value)
            for j in range(i):
                rows = rows.withColumn(
                    f"i{i}", F.col(f"i{i}") + (F.col(f"i{i}") >= taken[j]).cast("long")
                )
        wanted = F.slice(F.array(*[F.col(f"i{i}") for i in range(k)]), F.lit(1), F.least(F.lit(k), n.cast("int")))
    kept = [c for c in slots.columns]
    return rows.select(*kept, F.posexplode(wanted).alias("turn", "cand"))


def tournament(slots: DataFrame, fitness: DataFrame, size: str, k: int = 3, distinct: bool = True) -> DataFrame:
    """The fittest contestant of each (slot, parent); the first one drawn wins ties."""
    judged = fitness.select(*BY, "cand", "fitness").hint("merge")
    joined = contestants(slots, size, k, distinct).join(judged, ["cand", *BY])
    # a contest has few rows, so counting in tasks first would only sort them once more
    order = F.struct(F.col("fitness"), (-F.col("turn")).alias("early"))
    gathered = joined.repartition("slot", *BY, "parent")
    best = gathered.groupBy("slot", *BY, "parent").agg(F.max_by("cand", order).alias("cand"))
    return best.select(*BY, "slot", "parent", "cand")


def crossover(
    winners: DataFrame, population: DataFrame, genes: DataFrame, config: DataFrame, gen: int, take: str = "B"
) -> DataFrame:
    """Children by uniform crossover: each gene comes from parent ``take`` with cx_prob.

    The giving parent is drawn per gene before any gene is looked up, so one row a gene meets the population.
    """
    other = "A" if take == "B" else "B"
    drawn = winners.join(F.broadcast(config.select("experiment", "seed", "cx_prob")), "experiment")
    drawn = drawn.join(F.broadcast(genes.select("model", "gene")), "model")
    u = uniform(F.col("seed"), F.lit(str(gen)), F.col("slot"), F.col("gene"), "cx")
    giver = F.when(u < F.col("cx_prob"), take).otherwise(other)
    given = drawn.filter(F.col("parent") == giver).select(*BY, "slot", "cand", "gene")
    return given.join(population.hint("merge"), ["cand", *BY, "gene"]).select(*BY, "slot", "gene", "num", "cat")


def mutation(children: DataFrame, genes: DataFrame, config: DataFrame, gen: int) -> DataFrame:
    """Each gene is drawn anew with mut_prob."""
    rows = children.withColumnsRenamed({"num": "old_num", "cat": "old_cat"})
    rows = rows.join(F.broadcast(genes), ["model", "gene"]).join(
        F.broadcast(config.select("experiment", "seed", "mut_prob")), "experiment"
    )
    at = [F.col("seed"), F.lit(str(gen)), F.col("slot"), F.col("gene")]
    hit = uniform(*at, "mut") < F.col("mut_prob")
    rows = rows.withColumns({"hit": hit, "u": uniform(*at, "new")})
    num, cat = drawn_gene(F.col("u"))
    return rows.select(
        *BY,
        "slot",
        "gene",
        F.when(F.col("hit"), num).otherwise(F.col("old_num")).alias("num"),
        F.when(F.col("hit"), cat).otherwise(F.col("old_cat")).alias("cat"),
    )


def elite(fitness: DataFrame) -> DataFrame:
    """The fittest candidate of each experiment, the first one on a tie."""
    order = F.struct(F.col("fitness"), (-F.col("cand")).alias("early"))
    return fitness.groupBy(*BY).agg(
        F.max_by("cand", order).alias("cand"), F.max("fitness").alias("fitness")
    )


def next_generation(
    population: DataFrame, fitness: DataFrame, slots: DataFrame, genes: DataFrame, config: DataFrame, gen: int, k: int = 3
) -> DataFrame:
    """Elite in slot 0, children of tournament winners in the other slots.

    ``slots`` has model, experiment, seed, slot (from 1) and pop_size.
    """
    parents = slots.withColumn("gen", F.lit(gen)).withColumn(
        "parent", F.explode(F.array(F.lit("A"), F.lit("B")))
    )
    winners = tournament(parents, fitness, "pop_size", k)
    children = mutation(crossover(winners, population, genes, config, gen), genes, config, gen)
    # one row an experiment
    best = F.broadcast(elite(fitness).select(*BY, "cand")).join(population, [*BY, "cand"])
    kept = best.select(*BY, F.lit(0).cast("bigint").alias("cand"), "gene", "num", "cat")
    return kept.unionByName(children.withColumnRenamed("slot", "cand"))
