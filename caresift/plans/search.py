"""Model search end to end: grid search, evolutionary search, final refit and export."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caresift.functions import rates as R
from caresift.functions.constants import DEFAULT_THRESHOLD, GROUP_COLUMN, TARGET_COLUMN
from caresift.operators import curves as C
from caresift.operators import evolve as E
from caresift.operators import forest_batch as FB
from caresift.operators import logistic_batch as LB
from caresift.operators import metrics as M
from caresift.operators import models as MOD
from caresift.operators import neighbors as N
from caresift.operators import prep as P
from caresift.operators import schema as B
from caresift.operators import selection as S
from caresift.operators import split as D
from caresift.operators import thresholds as T
from caresift.session import materialize, spread


@dataclass
class Dataset:
    """One table with a ``split`` column, its feature columns and their roles."""

    rows: DataFrame
    key: str
    features: list[str]
    categorical: list[str]
    numeric: list[str]
    prep: P.Preparation

    stored: DataFrame | None = None
    tally: DataFrame | None = None
    nearby: dict[tuple[int, tuple[str, ...]], DataFrame] = field(default_factory=dict)

    def part(self, *names: str) -> DataFrame:
        return self.rows.filter(F.col("split").isin(*names))

    def vectors(self, *names: str) -> DataFrame:
        """(key, y_true, grp, vec) of some splits, prepared once and stored for all fits and passes."""
        if self.stored is None:
            ready = P.assembled(self.rows, self.prep).withColumn("vec", vector_to_array("features"))
            self.stored = materialize(ready.select(self.key, "y_true", "grp", "vec", "split"), "vectors", ["split"])
        return self.stored.filter(F.col("split").isin(*names)).drop("split")

    def counted(self, *names: str) -> DataFrame:
        """(y_true, grp, vec, n): rows of some splits that are equal in features, label and group are one, with their number.

        They are counted before they are prepared, and stored for all fits and passes.
        """
        if self.tally is None:
            by = [F.col(f"`{c}`") for c in (*self.categorical, *self.numeric, "y_true", "grp", "split")]
            ready = P.assembled(self.rows.groupBy(*by).agg(F.count("*").alias("rows__n")), self.prep)
            ready = ready.select("y_true", "grp", vector_to_array("features").alias("vec"), "split", F.col("rows__n").alias("n"))
            self.tally = materialize(ready, "counted", ["split"])
        return self.tally.filter(F.col("split").isin(*names)).drop("split")

    def within_reach(self, k: int, *names: str) -> DataFrame:
        """(key, y_true, vec) of the rows of some splits that can be among the ``k`` nearest of anything.

        Rows of equal features are equally far from everything, so of these only the ``k`` smallest keys count.
        The rank limit runs before the shuffle.
        """
        if (k, names) not in self.nearby:
            columns = [F.col(f"`{c}`") for c in (*self.categorical, *self.numeric)]
            place = F.row_number().over(W.partitionBy(*columns).orderBy(self.key))
            first = self.part(*names).select(self.key, "y_true", *columns, place.alias("rows__place")).filter(F.col("rows__place") <= k)
            ready = P.assembled(first.drop("rows__place"), self.prep)
            self.nearby[k, names] = materialize(ready.select(self.key, "y_true", vector_to_array("features").alias("vec")), "within-reach")
        return self.nearby[k, names]


def prepare_dataset(
    df: DataFrame, key: str, target: str = TARGET_COLUMN, group: str = GROUP_COLUMN, seed: int = 42
) -> Dataset:
    """Rename, code the target, split 60/20/20, add the group and fit the preparation."""
    coded = B.with_group(B.coded_target(B.spaced_names(df), target), group)
    rows = D.split_60_20_20(spread(coded.drop(target)), key, "y_true", seed, stored=True)
    features = [c for c in rows.columns if c not in (key, "y_true", "grp", "split")]
    categorical, numeric = P.column_roles(rows, features)
    prep = P.fit_preparation(rows.filter("split = 'train'"), categorical, numeric)
    return Dataset(rows, key, features, categorical, numeric, prep)


def score_candidates(
    data: Dataset, jobs: Sequence[tuple[int, str, dict]], parallelism: int = 4
) -> DataFrame:
    """(cand, fitness, metrics, error) of many candidates.

    All logistic candidates are fitted in the same passes over the training rows, all neighbour candidates of one
    distance share one search at the largest k, and all forests grow from one table of grouped rows. Candidates that the
    model sees as the same are fitted once. A failing candidate keeps its error and gets fitness -1.
    """
    spark = data.rows.sparkSession
    same: dict[tuple[str, str], list[int]] = {}
    distinct, failed = [], []
    for cand, name, params in jobs:
        try:
            seen = MOD.known_params(name, params) | {k: v for k, v in params.items() if k == "min_samples_split"}
            key = (name, json.dumps(seen, sort_keys=True))
        except ValueError as problem:
            failed.append((cand, str(problem)))
            continue
        if key not in same:
            distinct.append((cand, name, params))
        same.setdefault(key, []).append(cand)
    cells: list[DataFrame] = []
    for names, cells_of in _CELLS.items():
        mine = [j for j in distinct if j[1] in names]
        if mine:
            found, wrong = cells_of(data, mine, parallelism)
            cells += found
            failed += wrong
    twins = [(c, first) for first, *others in same.values() for c in others]
    errors = dict(failed)
    failed += [(c, errors[first]) for c, first in twins if first in errors]
    columns = ["cand", "fitness", "recall", "specificity", "f1", "accuracy", "gap"]
    bad = spark.createDataFrame(failed, "cand bigint, error string").select(
        "cand", F.lit(-1.0).alias("fitness"), *[F.lit(None).cast("double").alias(c) for c in columns[2:]], "error"
    )
    if not cells:
        return bad
    good = M.fairness_of_cells(reduce(DataFrame.unionByName, cells), ["cand"]).select(*columns)
    if twins:
        every = [(first, c) for first, *others in same.values() for c in (first, *others)]
        named = spark.createDataFrame(every, "cand bigint, twin bigint")
        good = good.join(F.broadcast(named), "cand").select(F.col("twin").alias("cand"), *columns[1:])
    return good.withColumn("error", F.lit(None).cast("string")).unionByName(bad)


Cells = tuple[list[DataFrame], list[tuple[int, str]]]


def _logistic_cells(data: Dataset, jobs: Sequence[tuple[int, str, dict]], parallelism: int) -> Cells:
    """Confusion counts per (cand, group) on the validation rows, and the candidates that cannot be fitted."""
    train = data.counted("train")
    width = train.select(F.size("vec").alias("n")).first()
    if width is None or width["n"] > LB.MOST_WIDTH:
        return _single_cells(data, jobs, parallelism)
    sizes = train.groupBy("y_true").agg(F.sum("n").alias("n")).where("y_true IS NOT NULL").collect()
    counts = {r["y_true"]: r["n"] for r in sizes}
    total = max(1, sum(counts.values()))
    fits, failed = [], []
    for cand, _, params in jobs:
        c = float(params.get("C", 1.0))
        if c <= 0:
            failed.append((cand, f"C must be positive: {c}"))
            continue
        balanced = params.get("class_weight") == "balanced"
        weights = tuple(total / (len(counts) * counts[y]) if balanced and y in counts else 1.0 for y in (0, 1))
        fits.append((cand, LB.LogisticJob(params.get("penalty", "l2"), 1.0 / (c * total), weights, int(params.get("max_iter", 1000)))))
    if not fits:
        return [], failed
    try:
        LB.fit_all(train, "y_true", "vec", [job for _, job in fits], "n")
    except (ArithmeticError, ValueError) as problem:
        return [], failed + [(cand, str(problem)) for cand, _ in fits]
    coefs = np.stack([job.accepted for _, job in fits])
    found = LB.confusion_cells(data.counted("val"), "y_true", "vec", "grp", coefs, DEFAULT_THRESHOLD, "n")
    names = _named_places(data, [cand for cand, _ in fits])
    return [found.withColumnRenamed("cand", "place").join(names, "place").select("cand", "grp", "tp", "fp", "fn", "tn")], failed


def _named_places(data: Dataset, cands: Sequence[int]) -> DataFrame:
    """(place, cand) of a handful of candidates, broadcast."""
    return F.broadcast(data.rows.sparkSession.createDataFrame(list(enumerate(cands)), "place bigint, cand bigint"))


def _neighbor_cells(data: Dataset, jobs: Sequence[tuple[int, str, dict]], parallelism: int) -> Cells:
    by_distance: dict[int, list[tuple[int, str, int]]] = {}
    failed, cells = [], []
    for cand, _, params in jobs:
        weights, k = params.get("weights", "uniform"), int(params.get("n_neighbors", 5))
        if weights not in ("uniform", "distance") or k < 1:
            failed.append((cand, f"Unsupported weights: {weights}" if k >= 1 else f"n_neighbors must be positive: {k}"))
            continue
        by_distance.setdefault(int(params.get("p", 2)), []).append((cand, weights, k))
    # rows with equal vectors have the same neighbours: each vector is searched for once and weighs as many rows as have it
    name = F.md5(F.to_json("vec"))
    rows = data.counted("val").groupBy("vec", "y_true", "grp").agg(F.sum("n").alias("n")).withColumn(data.key, name)
    rows = materialize(rows, "neighbour-queries") if by_distance else rows
    for p, candidates in by_distance.items():
        most = max(k for _, _, k in candidates)
        try:
            asked = rows.select(data.key, "vec").dropDuplicates([data.key])
            found = N.nearest(data.within_reach(most, "train"), asked, data.key, "vec", "y_true", most, p)
        except ValueError as problem:
            failed += [(cand, str(problem)) for cand, _, _ in candidates]
            continue
        long = N.votes(found, data.key, candidates).join(rows.select(data.key, "y_true", "grp", "n"), data.key)
        said, true = R.decide(), F.col("y_true")
        counts = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
        sums = [F.sum(F.when((true == y) & (said == h), F.col("n")).otherwise(0)).alias(c) for c, (y, h) in counts.items()]
        cells.append(long.groupBy("cand", "grp").agg(*sums))
    return cells, failed


def _forest_cells(data: Dataset, jobs: Sequence[tuple[int, str, dict]], parallelism: int) -> Cells:
    train = data.counted("train")
    sizes = train.filter("y_true IS NOT NULL").groupBy("y_true").agg(F.sum("n").alias("n")).collect()
    counts = {r["y_true"]: r["n"] for r in sizes}
    total = sum(counts.values())
    grown, failed = [], []
    for cand, name, params in jobs:
        depth = params.get("max_depth")
        balanced = params.get("class_weight", "balanced") == "balanced"
        job = FB.ForestJob(
            trees=int(params.get("n_estimators", 100)),
            max_depth=None if depth in (None, "none") else int(depth),
            min_split=int(params.get("min_samples_split", 2)),
            min_leaf=int(params.get("min_samples_leaf", 1)),
            share=params.get("max_features", "sqrt"),
            weights=tuple(total / (len(counts) * counts[y]) if balanced and y in counts else 1.0 for y in (0, 1)),
            seed=int(params.get("random_state", 42)),
            drawn_cuts=name == MOD.EXTRA,
        )
        if job.trees < 1:
            failed.append((cand, f"n_estimators must be positive: {job.trees}"))
        else:
            grown.append((cand, job))
    if not grown:
        return [], failed
    try:
        return [FB.confusion_cells(train, data.counted("val"), "y_true", "vec", "grp", grown, DEFAULT_THRESHOLD, "n")], failed
    except ValueError as problem:
        return [], failed + [(cand, str(problem)) for cand, _ in grown]


_CELLS = {(MOD.LOGISTIC,): _logistic_cells, (MOD.NEIGHBORS,): _neighbor_cells, (MOD.FOREST, MOD.EXTRA): _forest_cells}


def validation_counts(data: Dataset, name: str, params: dict) -> DataFrame:
    """Confusion counts and rates of one candidate on the validation rows."""
    cells, failed = next(f for names, f in _CELLS.items() if name in names)(data, [(0, name, params)], 1)
    if failed:
        raise ValueError(failed[0][1])
    return M.with_rates(cells[0].agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]))


def grid_search(
    data: Dataset, grids: Mapping[str, tuple[str, Mapping, Mapping[str, Sequence]]], parallelism: int = 4
) -> DataFrame:
    """Every parameter combination of every model, with its metrics on the validation rows.

    ``grids`` maps a shown name to (model, fixed parameters, lists of values). Points are numbered in the order of
    the sorted names, ``place`` over all models.
    """
    import itertools

    jobs, meta = [], []
    for shown, (name, fixed, grid) in grids.items():
        keys = sorted(grid)
        for point, values in enumerate(itertools.product(*[grid[k] for k in keys])):
            params = dict(zip(keys, values))
            jobs.append((len(jobs), name, {**fixed, **params}))
            meta.append((len(meta), shown, point, json.dumps(params, ensure_ascii=False)))
    names = data.rows.sparkSession.createDataFrame(meta, "cand bigint, model string, point int, params string")
    return names.join(score_candidates(data, jobs, parallelism), "cand").withColumn("place", F.col("cand"))


def run_search(
    data: Dataset,
    spaces: Mapping[str, Sequence[tuple]],
    experiments: Sequence[Mapping],
    parallelism: int = 4,
    score: Callable[[Sequence[tuple[int, str, dict]]], DataFrame] | None = None,
) -> DataFrame:
    """Evolutionary search over models and experiment settings.

    Each generation is scored in one job for all experiments, by ``score`` or else by ``score_candidates``. A candidate whose
    parameters were scored before is looked up, not fitted again. The population is at most a few individuals per
    experiment, so it is the driver's to loop over.
    """
    spark: SparkSession = data.rows.sparkSession
    score = score or (lambda jobs: score_candidates(data, jobs, parallelism))
    genes = E.gene_table(spark, spaces)
    config = spark.createDataFrame(
        [(e["name"], str(e["seed"]), float(e["cx_prob"]), float(e["mut_prob"])) for e in experiments],
        "experiment string, seed string, cx_prob double, mut_prob double",
    )
    slots = spark.createDataFrame(
        [
            (m, e["name"], str(e["seed"]), i, int(e["pop_size"]))
            for m in spaces
            for e in experiments
            for i in range(e["pop_size"])
        ],
        "model string, experiment string, seed string, cand bigint, pop_size bigint",
    )
    kinds = {(m, g[0]): g[1] for m, gs in spaces.items() for g in gs}
    generations = {e["name"]: int(e["generations"]) for e in experiments}
    memo: dict[tuple[str, str], tuple] = {}
    history: list[tuple] = []
    population = E.initial_population(slots, genes)
    for gen in range(max(generations.values())):
        alive = [e for e, g in generations.items() if gen < g]
        members: dict[tuple, dict] = {}
        for r in population.filter(F.col("experiment").isin(*alive)).collect():
            kind = kinds[(r["model"], r["gene"])]
            value = r["cat"] if kind == "cat" else int(r["num"]) if kind == "int" else r["num"]
            members.setdefault((r["model"], r["experiment"], r["cand"]), {})[r["gene"]] = value
        if not members:
            break
        wanted = {}
        for (model, _, _), params in members.items():
            wanted.setdefault((model, json.dumps(params, sort_keys=True)), params)
        fresh = [k for k in wanted if k not in memo]
        if fresh:
            scores = score([(i, k[0], wanted[k]) for i, k in enumerate(fresh)])
            for r in scores.collect():
                memo[fresh[r["cand"]]] = tuple(r[c] for c in ("fitness", "recall", "specificity", "f1", "gap", "error"))
        rows = []
        for (model, experiment, cand), params in members.items():
            text = json.dumps(params, sort_keys=True)
            rows.append((model, experiment, gen, cand, text, *memo[(model, text)]))
        history += rows
        fitness = spark.createDataFrame(
            [(r[0], r[1], r[3], r[5]) for r in rows], "model string, experiment string, cand bigint, fitness double"
        )
        children = slots.filter("cand >= 1").withColumnRenamed("cand", "slot")
        # A generation is tiny; rebuilding it from rows keeps the plan from growing with every step.
        step = E.next_generation(population, fitness, children, genes, config, gen + 1)
        population = spark.createDataFrame(step.collect(), step.schema)
    return spark.createDataFrame(
        history,
        "model string, experiment string, generation int, cand bigint, params string, fitness double, "
        "recall double, specificity double, f1 double, gap double, error string",
    )


def export_best(data: Dataset, history: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(ranking, test metrics): the best experiment of each model ranked by fitness; the first is refitted and saved in ``path``.

    Of equal candidates the earliest generation, then the first in the population counts; of equal models the first name.
    """
    order = [-F.col("generation"), -F.col("cand")]
    per_run = S.best_by(history.filter("error IS NULL"), ["model", "experiment"], F.col("fitness"), *order)
    ranking = S.ranking(S.best_experiment(per_run), "model")
    best = ranking.filter("place = 1").first()
    fitted, chosen, test = final_model(data, best["model"], json.loads(best["params"]))
    row = chosen.first().asDict()
    MOD.save_artifact(fitted, path, row["threshold"], data.features, test.first().asDict(), [row])
    return ranking, test


def head_scorer(vectors: DataFrame, key: str, parallelism: int = 4) -> Callable[[Sequence[tuple[int, str, dict]]], DataFrame]:
    """Scores heads over frozen vectors (key, embedding, y_true): threshold from validation, fitness from test rows.

    Genes: hidden units, whether the rarer class is repeated up to the size of the other, and the epochs, which bound the iterations.
    Genes of a trained image network (learning rate, batch, dropout, unfrozen layers) have no counterpart in a head.
    """
    parts = materialize(D.stratified_split(vectors, key, "y_true", 0.15, 0.15), "vectors", ["split"])
    train, rest = parts.filter("split = 'train'"), parts.filter("split <> 'train'")

    def one(job: tuple[int, str, dict]) -> DataFrame:
        cand, _, params = job
        epochs = int(params["frozen_epochs"]) + int(params["fine_tune_epochs"])
        head = MOD.fit_head(train, "embedding", "y_true", int(params["dense_units"]), 42, 10 * epochs, params["use_class_weight"] == "true")
        return MOD.score_head(head, rest, "embedding").select(F.lit(cand).cast("bigint").alias("cand"), "split", "y_true", "y_prob")

    def score(jobs: Sequence[tuple[int, str, dict]]) -> DataFrame:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            long = materialize(reduce(DataFrame.unionByName, pool.map(one, jobs)), "head-scores")
        best = T.weighted_recall(long.filter("split = 'val'"), ["cand"]).select("cand", "threshold")
        test = long.filter("split = 'test'").join(F.broadcast(best), "cand")
        counts = M.with_rates(M.confusion_counts(test, ["cand"], R.decide_float("y_prob", F.col("threshold"))), floored=True)
        both = counts.join(C.areas(test, ["cand"]), "cand")
        empty = F.lit(None).cast("string").alias("error")
        return both.select("cand", R.image_fitness().alias("fitness"), "recall", "specificity", "f1", F.lit(None).cast("double").alias("gap"), empty)

    return score


def final_model(data: Dataset, name: str, params: dict) -> tuple[MOD.FittedModel, DataFrame, DataFrame]:
    """Threshold from validation, refit on train and validation, metrics on the test rows.

    Returns the refitted model, the chosen validation threshold row and the test metrics.
    """
    first = MOD.fit(name, params, data.part("train"), data.prep, data.key)
    chosen = T.recall_first(first.score(data.part("val")).select("y_true", "y_prob"), [])
    picked = data.rows.sparkSession.createDataFrame(chosen.collect(), chosen.schema)
    threshold = picked.first()["threshold"]
    both = data.part("train", "val")
    prep = P.fit_preparation(both, data.categorical, data.numeric)
    final = MOD.fit(name, params, both, prep, data.key)
    test = final.score(data.part("test")).select("y_true", "y_prob")
    counts = M.with_rates(M.confusion_counts(test, [], R.decide("y_prob", threshold)))
    return final, picked, counts.withColumn("threshold", F.lit(threshold))
