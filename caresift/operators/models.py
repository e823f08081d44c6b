"""Classifiers on Spark ML: fitting by name and parameters, scoring, artifacts."""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.ml import Model
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caresift.functions.constants import DEFAULT_THRESHOLD, TARGET_CODES
from caresift.functions.draws import uniform
from caresift.operators.forest_batch import ForestJob, KeptForest, kept_forest
from caresift.operators.neighbors import nearest, vote
from caresift.operators.prep import Preparation, assembled
from caresift.operators.split import with_class_weight
from caresift.session import materialize

FOREST, EXTRA, LOGISTIC, NEIGHBORS = (
    "RandomForestClassifier",
    "ExtraTreesClassifier",
    "LogisticRegression",
    "KNeighborsClassifier",
)
KNOWN = {
    FOREST: {"n_estimators", "max_depth", "min_samples_leaf", "max_features", "class_weight", "random_state"},
    EXTRA: {"n_estimators", "max_depth", "min_samples_leaf", "max_features", "class_weight", "random_state"},
    LOGISTIC: {"C", "penalty", "class_weight", "max_iter"},
    NEIGHBORS: {"n_neighbors", "weights", "p"},
}
#: Deepest tree Spark ML grows.
MAX_DEPTH = 30


@dataclass
class FittedModel:
    """A fitted classifier with the preparation it was fitted on."""

    name: str
    params: dict
    prep: Preparation
    model: Model | KeptForest | None = None
    train: DataFrame | None = None
    key: str = "case_key"
    label: str = "y_true"

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with the positive-class probability in ``y_prob``."""
        ready = assembled(df, self.prep)
        if self.name == NEIGHBORS:
            vectors = ready.withColumn("vec", vector_to_array("features"))
            found = nearest(
                self.train,
                vectors,
                self.key,
                "vec",
                self.label,
                int(self.params.get("n_neighbors", 5)),
                int(self.params.get("p", 2)),
            )
            return df.join(vote(found, self.key, self.params.get("weights", "uniform")), self.key, "left")
        if isinstance(self.model, KeptForest):
            return ready.withColumn("y_prob", self.model.probability("features")).drop("features")
        scored = self.model.transform(ready)
        return scored.withColumn("y_prob", positive_probability()).drop(
            "features", "rawPrediction", "probability", "prediction"
        )


def positive_probability():
    return vector_to_array(F.col("probability"))[1]


def known_params(name: str, params: dict) -> dict:
    """The parameters the model understands; others are dropped."""
    if name not in KNOWN:
        raise ValueError(f"Unsupported model: {name}")
    return {k: v for k, v in params.items() if k in KNOWN[name]}


def _jittered(df: DataFrame, prep: Preparation, key: str, seed: int) -> DataFrame:
    """Numeric features moved by up to a tenth of a deviation, drawn per row and feature."""
    moved = {}
    for c in prep.numeric:
        step = (uniform(seed, F.col(key), c) - 0.5) * F.lit(0.2 * prep.scales[c])
        moved[c] = F.col(f"`{c}`").cast("double") + step
    return df.withColumns(moved)


def _counted_rows(train: DataFrame, prep: Preparation, label: str) -> DataFrame:
    """(label, vec, rows__n): rows of equal inputs and label are one, counted before they are prepared. Stored."""
    columns = [F.col(f"`{c}`") for c in (*prep.categorical, *prep.numeric)]
    counted = train.groupBy(label, *columns).agg(F.count("*").alias("rows__n"))
    return materialize(assembled(counted, prep).select(label, vector_to_array("features").alias("vec"), "rows__n"), "counted-rows")


def _class_sizes(counted: DataFrame, label: str) -> dict:
    return {r[label]: r["n"] for r in counted.groupBy(label).agg(F.sum("rows__n").alias("n")).collect()}


def _logistic(params: dict, train: DataFrame, prep: Preparation, label: str, balanced: bool) -> LogisticRegressionModel:
    """Fitted on equal rows as one, weighted by their number: the same objective. With balanced classes, null labels are left out."""
    counted = _counted_rows(train, prep, label)
    sizes = _class_sizes(counted, label)
    if balanced:
        counted, sizes = counted.filter(F.col(label).isNotNull()), {y: n for y, n in sizes.items() if y is not None}
    total, weight = sum(sizes.values()), F.col("rows__n").cast("double")
    if balanced:
        of_class = F.lit(0.0)
        for y, n in sizes.items():
            of_class = F.when(F.col(label) == y, F.lit(total / (len(sizes) * n))).otherwise(of_class)
        weight = weight * of_class
    learner = LogisticRegression(
        labelCol=label,
        weightCol="weight",
        regParam=1.0 / (float(params.get("C", 1.0)) * max(total, 1)),
        elasticNetParam=1.0 if params.get("penalty", "l2") == "l1" else 0.0,
        maxIter=int(params.get("max_iter", 1000)),
        standardization=False,
    )
    return learner.fit(counted.select(label, array_to_vector("vec").alias("features"), weight.alias("weight")))


def _grouped_forest(params: dict, train: DataFrame, prep: Preparation, label: str, balanced: bool) -> KeptForest | None:
    """A forest from counts of equal rows, which are counted before they are prepared; None if these are too many.

    A bootstrap draws a Poisson number for every group, its count being the mean: the sum of its rows' own numbers.
    """
    share = params.get("max_features", "sqrt")
    share = {"all": None, "auto": "sqrt", "onethird": 1 / 3}.get(share, share)
    if share not in (None, "sqrt", "log2") and not (str(share).replace(".", "", 1).isdigit() and 0 < float(share) <= 1):
        return None
    ready = _counted_rows(train.filter(F.col(label).isNotNull()), prep, label)
    sizes = _class_sizes(ready, label)
    total, depth = sum(sizes.values()), params.get("max_depth", MAX_DEPTH)
    job = ForestJob(
        trees=int(params.get("n_estimators", 100)),
        max_depth=MAX_DEPTH if depth in (None, "none") else min(int(depth), MAX_DEPTH),
        min_leaf=int(params.get("min_samples_leaf", 1)),
        share=share,
        weights=tuple(total / (len(sizes) * sizes[y]) if balanced and y in sizes else 1.0 for y in (0, 1)),
        seed=int(params.get("random_state", 42)),
        spark_rules=True,
    )
    return kept_forest(ready, label, "vec", job, "rows__n")


def fit(
    name: str,
    params: dict,
    train: DataFrame,
    prep: Preparation,
    key: str = "case_key",
    label: str = "y_true",
) -> FittedModel:
    """Fit a model by name. Extra-trees is approximated: whole-sample trees on
    jittered features with coarse bins, since Spark ML has no random split points."""
    given = dict(params)
    params = known_params(name, params)
    depth = params.get("max_depth", MAX_DEPTH)
    balanced_default = name in (FOREST, EXTRA)
    balanced = params.get("class_weight", "balanced" if balanced_default else "none") == "balanced"
    if name == FOREST:
        grown = _grouped_forest(params, train, prep, label, balanced)
        if grown is not None:
            return FittedModel(name, given, prep, grown, None, key, label)
    if name == LOGISTIC:
        return FittedModel(name, given, prep, _logistic(params, train, prep, label, balanced), None, key, label)
    rows = _jittered(train, prep, key, int(params.get("random_state", 42))) if name == EXTRA else train
    ready = assembled(rows, prep)
    if name == NEIGHBORS:
        vectors = ready.select(key, label, vector_to_array("features").alias("vec"))
        return FittedModel(name, given, prep, None, vectors, key, label)
    columns = [label, "features"]
    if balanced:
        ready = with_class_weight(ready, label)
        columns.append("weight")
    ready = ready.select(*columns)
    weight = {"weightCol": "weight"} if balanced else {}
    depth = MAX_DEPTH if depth in (None, "none") else min(int(depth), MAX_DEPTH)
    share = params.get("max_features", "sqrt")
    learner = RandomForestClassifier(
        labelCol=label,
        numTrees=int(params.get("n_estimators", 100)),
        maxDepth=depth,
        minInstancesPerNode=int(params.get("min_samples_leaf", 1)),
        featureSubsetStrategy=str(share),
        bootstrap=name == FOREST,
        maxBins=32 if name == FOREST else 16,
        seed=int(params.get("random_state", 42)),
        **weight,
    )
    return FittedModel(name, given, prep, learner.fit(ready), None, key, label)


def fit_trees(params: dict, train: DataFrame, prep: Preparation, key: str = "case_key", label: str = "y_true") -> FittedModel:
    """Forest trees that each see all rows and look for the best cut; without draws, one tree is the usual decision tree."""
    ready = with_class_weight(assembled(train, prep), label).select(label, "features", "weight")
    learner = RandomForestClassifier(
        labelCol=label,
        weightCol="weight",
        numTrees=int(params.get("n_estimators", 1)),
        maxDepth=min(int(params.get("max_depth", MAX_DEPTH)), MAX_DEPTH),
        minInstancesPerNode=int(params.get("min_samples_leaf", 1)),
        featureSubsetStrategy=str(params.get("max_features", "all")),
        bootstrap=False,
        seed=int(params.get("random_state", 42)),
    )
    return FittedModel(FOREST, dict(params), prep, learner.fit(ready), None, key, label)


def try_fit_score(name, params, train, test, prep, key="case_key", label="y_true"):
    """(scored, None), or (None, error text) when the candidate cannot be fitted."""
    try:
        return fit(name, params, train, prep, key, label).score(test), None
    except Exception as problem:  # noqa: BLE001 - any failing candidate is reported, not raised
        return None, str(problem).splitlines()[0]


def fit_many(jobs: Sequence[tuple[str, dict]], train, test, prep, key="case_key", label="y_true", parallelism: int = 4):
    """Independent fits submitted side by side; results keep the order of ``jobs``."""
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(lambda j: try_fit_score(j[0], j[1], train, test, prep, key, label), jobs))


def fit_head(
    df: DataFrame, vector: str, label: str, hidden: int | None = None, seed: int = 42, max_iter: int = 50, balanced: bool = False
) -> Model:
    """A small head over frozen vectors: logistic, or one hidden layer when ``hidden`` is given.

    With ``balanced`` the classes weigh the same: by weights in the logistic head, by repeating rows of the rarer
    class in the other, which knows no weights.
    """
    columns = [F.col(label).cast("double").alias("label"), array_to_vector(F.col(vector).cast("array<double>")).alias("features")]
    ready = df.filter(F.col(label).isNotNull()).select(*columns)
    if hidden is None:
        weight = {"weightCol": "weight"} if balanced else {}
        return LogisticRegression(maxIter=max_iter, regParam=1e-3, **weight).fit(with_class_weight(ready, "label") if balanced else ready)
    if balanced:
        sizes = {r["label"]: r["n"] for r in ready.groupBy("label").agg(F.count("*").alias("n")).collect()}
        rarer = min(sizes, key=sizes.get)
        times = F.when(F.col("label") == rarer, round(max(sizes.values()) / sizes[rarer])).otherwise(1)
        ready = ready.withColumn("again", F.explode(F.sequence(F.lit(1), times))).drop("again")
    width = ready.select(F.size(vector_to_array("features")).alias("n")).first()["n"]
    return MultilayerPerceptronClassifier(layers=[width, hidden, 2], maxIter=max_iter, seed=seed).fit(ready)


def save_head(model: Model, path: str, threshold: float, details: dict) -> None:
    """A vector head and what is known of it in one folder."""
    model.write().overwrite().save(f"{path}/head")
    meta = {"kind": type(model).__name__, "best_threshold": threshold, **details}
    SparkSession.active().createDataFrame([(json.dumps(meta),)], "metadata string").write.mode("overwrite").parquet(f"{path}/metadata")


def load_head(path: str) -> tuple[Model, dict]:
    meta = json.loads(SparkSession.active().read.parquet(f"{path}/metadata").first()["metadata"])
    meta.setdefault("best_threshold", DEFAULT_THRESHOLD)
    kinds = {k.__name__: k for k in (LogisticRegressionModel, MultilayerPerceptronClassificationModel)}
    return kinds[meta["kind"]].load(f"{path}/head"), meta


def score_head(model: Model, df: DataFrame, vector: str) -> DataFrame:
    ready = df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))
    scored = model.transform(ready).withColumn("y_prob", positive_probability().cast("float"))
    return scored.drop("features", "rawPrediction", "probability", "prediction")


def save_artifact(
    fitted: FittedModel, path: str, threshold: float, feature_columns: Sequence[str], metrics: dict, validation: Sequence[dict] = ()
) -> None:
    """Model, preparation, threshold, columns, parameters, codes of the target and metrics in one folder.

    ``validation`` are the rows that the threshold was chosen by.
    """
    spark = SparkSession.active()
    if fitted.name == NEIGHBORS:
        fitted.train.write.mode("overwrite").parquet(f"{path}/train")
    elif isinstance(fitted.model, KeptForest):
        fitted.model.save(f"{path}/model")
    else:
        fitted.model.write().overwrite().save(f"{path}/model")
    meta = {
        "model_name": fitted.name,
        "model_kind": type(fitted.model).__name__,
        "threshold": threshold,
        "feature_columns": list(feature_columns),
        "selected_params": fitted.params,
        "validation_summary": list(validation),
        "test_metrics": metrics,
        "target_mapping": TARGET_CODES,
        "preparation": asdict(fitted.prep),
        "key": fitted.key,
        "label": fitted.label,
    }
    spark.createDataFrame([(json.dumps(meta, ensure_ascii=False),)], "metadata string").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/metadata")


def load_artifact(path: str) -> tuple[FittedModel, dict]:
    """The fitted model and its metadata; a missing threshold is 0.5."""
    spark = SparkSession.active()
    meta = json.loads(spark.read.parquet(f"{path}/metadata").first()["metadata"])
    meta.setdefault("threshold", DEFAULT_THRESHOLD)
    name = meta["model_name"]
    fitted = FittedModel(
        name, meta["selected_params"], Preparation(**meta["preparation"]), key=meta["key"], label=meta["label"]
    )
    if name == NEIGHBORS:
        fitted.train = spark.read.parquet(f"{path}/train")
    elif name == LOGISTIC:
        fitted.model = LogisticRegressionModel.load(f"{path}/model")
    elif meta.get("model_kind") == KeptForest.__name__:
        fitted.model = KeptForest.load(f"{path}/model")
    else:
        fitted.model = RandomForestClassificationModel.load(f"{path}/model")
    return fitted, meta
