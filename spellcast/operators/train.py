"""Training: classifier families, random search by average precision, importances."""

from __future__ import annotations

import itertools
import json
import random
import time
from collections.abc import Callable
from multiprocessing.pool import ThreadPool
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as C
from pyspark.ml.feature import Imputer, StandardScaler, StandardScalerModel, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spellcast.operators import levels
from spellcast.operators.evaluate import auc_ap, score_table
from spellcast.operators.sampling import SEED, stratified_split, with_weights
from spellcast.session import checkpointed


@dataclass(frozen=True)
class Family:
    """A classifier family: constructor, search space, and how it is prepared."""

    make: Callable[[], object]
    grid: dict[str, list]
    n_iter: int
    scaled: bool = False
    weights: str | None = "balanced"
    validated: bool = False


# Search spaces and iteration numbers per family. ``C`` (logistic) is turned
# into a ridge penalty; options MLlib has no counterpart for are left out.
FAMILIES: dict[str, Family] = {
    "LogisticRegression": Family(
        lambda: C.LogisticRegression(maxIter=100), {"C": [0.01, 0.1, 1.0, 10.0]}, 10, scaled=True
    ),
    "RandomForestClassifier": Family(
        lambda: C.RandomForestClassifier(seed=SEED),
        {"numTrees": [58], "maxDepth": [8], "minInstancesPerNode": [25529],
         "featureSubsetStrategy": ["sqrt", "log2"]}, 5,
    ),
    "DecisionTreeClassifier": Family(
        lambda: C.DecisionTreeClassifier(seed=SEED),
        {"maxDepth": [3, 5, 7, 10], "minInstancesPerNode": [50, 100, 500, 1000]}, 10,
    ),
    "GaussianNB": Family(lambda: C.NaiveBayes(modelType="gaussian"), {}, 0, scaled=True, weights=None),
    # Stands in for the three external boosters.
    "GBTClassifier": Family(
        lambda: C.GBTClassifier(seed=SEED),
        {"maxIter": [608], "maxDepth": [3], "stepSize": [0.087], "subsamplingRate": [0.764],
         "featureSubsetStrategy": ["0.902"]}, 20, weights="scale", validated=True,
    ),
}


@dataclass
class Fitted:
    name: str
    features: list[str]
    model: PipelineModel | None = None
    params: dict = field(default_factory=dict)
    log: list[dict] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)
    error: str | None = None


def _pipeline(family: Family, features: list[str], params: dict, rows: int, target: str, encoder: levels.LevelEncoder | None = None) -> Pipeline:
    """Preparation and classifier. Numbers come first in the model's vector, then the levels.

    The sparse vectors of levels are scaled without centring, which would fill them; the model is
    the same, as its intercept takes up the difference.
    """
    coded = encoder.vectors if encoder else []
    numbers, coded = [f for f in features if f not in coded], [f for f in coded if f in features]
    stages = [VectorSizeHint(inputCol=f, size=n, handleInvalid="optimistic") for f, n in (encoder.widths(coded) if encoder else [])]
    if family.scaled:  # these models have no place for missing values: the training median stands in
        filled = [f"_filled_{f}" for f in numbers]
        stages += [
            Imputer(inputCols=numbers, outputCols=filled, strategy="median"),
            VectorAssembler(inputCols=filled, outputCol="_numbers", handleInvalid="keep"),
            StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
        ]
        parts = ["_scaled"]
        if coded:
            stages += [
                VectorAssembler(inputCols=coded, outputCol="_levels"),
                StandardScaler(inputCol="_levels", outputCol="_scaled_levels", withMean=False, withStd=True),
            ]
            parts.append("_scaled_levels")
    else:
        parts = numbers + coded
    stages.append(VectorAssembler(inputCols=parts, outputCol="_inputs", handleInvalid="keep"))
    clf = family.make()
    settings = {k: v for k, v in params.items() if k != "C"}
    if "C" in params:
        settings["regParam"] = 1.0 / (params["C"] * max(rows, 1))
    settings |= {"featuresCol": "_inputs", "labelCol": target}
    if family.weights:
        settings["weightCol"] = "weight"
    clf.setParams(**settings)
    return Pipeline(stages=[*stages, clf])


def without_summary(model: PipelineModel) -> PipelineModel:
    """The model without its training summary, which holds the session: where that has observed a frame, it cannot go to tasks."""
    clf = model.stages[-1]
    if getattr(clf, "hasSummary", False):
        clf._java_obj.setSummary(SparkSession.active().sparkContext._jvm.scala.Option.empty())
    return model


def scalers(model: PipelineModel) -> list[StandardScalerModel]:
    """The scalers of numbers and of levels, in that order, where the family has them."""
    return [stage for stage in model.stages if isinstance(stage, StandardScalerModel)]


def predict(model: PipelineModel, df: DataFrame, out: str = "prob") -> DataFrame:
    """Add the probability of the positive class, NULL where there is none, and drop working columns."""
    prob = vector_to_array("probability")[1]
    scored = model.transform(df).withColumn(out, F.when(~F.isnan(prob), prob))
    return scored.select(*df.columns, out)


def average_precision(model: PipelineModel, df: DataFrame, target: str) -> float:
    scores = score_table(predict(model, df.withColumn("_all", F.lit(1))), ["_all"], target=target)
    row = auc_ap(scores, ["_all"]).first()
    return (row.average_precision or 0.0) if row else 0.0


def grid_points(grid: dict[str, list], n_iter: int, seed: int = SEED) -> list[dict]:
    """``n_iter`` distinct points of the grid, all of them if there are fewer."""
    points = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    return points if len(points) <= n_iter else random.Random(seed).sample(points, n_iter)


PATIENCE = 20  # fixed value: rounds without improvement after which boosting stops


def best_round(losses: list[float], patience: int = PATIENCE) -> int:
    """Rounds to keep: the one of least loss before ``patience`` rounds in a row bring no less."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def truncated(model: C.GBTClassificationModel, rounds: int) -> C.GBTClassificationModel:
    """The boosted model of the first ``rounds`` trees, with the same settings."""
    old = model._java_obj
    gateway, trees, weights = SparkSession.active().sparkContext._gateway, old.trees(), old.treeWeights()
    kept = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    shares = gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        kept[i], shares[i] = trees[i], weights[i]
    new = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(old.uid(), kept, shares, old.numFeatures(), old.numClasses())
    return model._from_java(new.copy(old.extractParamMap()))


def early_stopped(model: PipelineModel, held: DataFrame, target: str, patience: int = PATIENCE) -> tuple[PipelineModel, list[float]]:
    """A boosted model cut after its best round on held-out rows, and the loss of every round.

    The margins after each tree are running sums over the trees of a row, so one pass over the held-out
    rows gives the loss of all rounds.
    """
    boosted, prepared = model.stages[-1], PipelineModel(model.stages[:-1]).transform(held.withColumn(target, F.col(target).cast("double")))
    losses = list(boosted.evaluateEachIteration(prepared))
    rounds = best_round(losses, patience)
    if rounds < len(losses):
        model = PipelineModel([*model.stages[:-1], truncated(boosted, rounds)])
    return model, losses


def search(points: list[dict], fit: Callable[[dict], PipelineModel], judge: Callable[[PipelineModel], float], parallelism: int) -> list[dict]:
    """Fit and judge every point, some at a time; the log is in the order of the points.

    Each fit runs in a scheduler pool of its own, which shares the executors fairly between them
    where the session's scheduler is FAIR.
    """

    def one(at: int) -> dict:
        SparkSession.active().sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{at % parallelism}")
        t0 = time.time()
        model = fit(points[at])
        seconds = time.time() - t0
        return {"params": points[at], "pr_auc_score": judge(model), "train_time_s": seconds}

    if parallelism <= 1 or len(points) < 2:
        return [one(i) for i in range(len(points))]
    with ThreadPool(min(parallelism, len(points))) as pool:
        return pool.map(inheritable_thread_target(one), range(len(points)), chunksize=1)


def tune(
    name: str, train: DataFrame, features: list[str], target: str, key: list[str],
    val: DataFrame | None = None, overrides: dict | None = None, encoder: levels.LevelEncoder | None = None, parallelism: int = 4,
) -> Fitted:
    """Random search on one stratified 80/20 split by average precision, then a full refit.

    ``encoder`` tells which features are vectors of levels; they stand after the others.
    ``overrides`` replaces grid entries (``{param: [values]}``). Falls back to the base
    model when the search fails. The training columns, read by every fit, are materialised
    once; with undersampling they are a small part of the data. ``parallelism`` points are
    fitted at a time. Boosted models are cut after their best round on ``val``.
    """
    family = FAMILIES[name]
    if encoder:
        features = [f for f in features if f not in encoder.vectors] + [f for f in encoder.vectors if f in features]
    out = Fitted(name, features)
    grid = family.grid | (overrides or {})
    train = train.select(*key, *features, target)
    train = with_weights(train, target, family.weights) if family.weights else train
    train = checkpointed(train)
    rows = train.count()

    def fit(params: dict, on: DataFrame) -> PipelineModel:
        return without_summary(_pipeline(family, features, params, rows, target, encoder).fit(on))

    def final(params: dict) -> PipelineModel:
        model = fit(params, train)
        if family.validated and val is not None:
            held = val.select(*features, target).where(F.col(target).isNotNull())
            model, out.losses = early_stopped(model, with_weights(held, target, family.weights) if family.weights else held, target)
        return model

    points = grid_points(grid, family.n_iter) if grid else []
    try:
        if len(points) > 1:
            marked = checkpointed(stratified_split(train, key, target))
            fit_rows, test_rows = marked.where(~F.col("is_test")), marked.where("is_test")
            out.log = search(points, lambda p: fit(p, fit_rows), lambda m: average_precision(m, test_rows, target), parallelism)
            out.params = max(out.log, key=lambda r: r["pr_auc_score"])["params"]
        elif points:
            out.params = points[0]
        out.model = final(out.params)
    except Exception as e:  # the search failed: plain fit with default parameters
        out.error, out.params, out.log = str(e), {}, []
        out.model = final({})
    return out


def fit_all(
    names: list[str], train: DataFrame, features: list[str], target: str, key: list[str],
    val: DataFrame | None = None, overrides: dict[str, dict] | None = None, encoder: levels.LevelEncoder | None = None,
) -> dict[str, Fitted]:
    """Fit each family; one failure does not stop the others."""
    fitted = {}
    for name in names:
        try:
            fitted[name] = tune(name, train, features, target, key, val, (overrides or {}).get(name), encoder)
        except Exception as e:
            fitted[name] = Fitted(name, features, error=str(e))
    return fitted


def tuning_log(spark: SparkSession, fitted: Fitted, head: int | None = None) -> DataFrame:
    """The search history by rank; one row per tried point."""
    ranked = sorted(fitted.log, key=lambda r: -r["pr_auc_score"])
    rows = [
        (fitted.name, json.dumps(r["params"]), float(r["pr_auc_score"]), i + 1, float(r["train_time_s"]))
        for i, r in enumerate(ranked)
    ]
    schema = "model string, params string, pr_auc_score double, rank int, train_time_s double"
    df = spark.createDataFrame(rows, schema).orderBy("rank")
    return df.limit(head) if head else df


def feature_importance(spark: SparkSession, fitted: Fitted, encoder: levels.LevelEncoder | None = None) -> DataFrame:
    """Tree gain or absolute coefficient per feature, and per level of an encoded column, largest first."""
    clf = fitted.model.stages[-1]
    encoder = encoder or levels.fit_encoder(spark.range(0), [])
    if hasattr(clf, "featureImportances"):
        values = clf.featureImportances.toArray()
    elif hasattr(clf, "coefficients"):
        values = abs(clf.coefficients.toArray())
    else:
        values = [0.0] * sum(width for _, width in encoder.widths(fitted.features))
    named = levels.named_positions(encoder, fitted.features, values, spark)
    return named.select(F.lit(fitted.name).alias("model"), "feature", F.col("value").alias("importance")).orderBy(
        F.desc("importance"), "feature"
    )


def selection_metadata(
    project: str, features: list[str], target: str, models: list[str], ratio: float, undersample_ratio: float | None, timestamp: str,
    errors: dict[str, str] | None = None,
) -> dict:
    """What a training run selected, the content of its metadata file."""
    return {
        "project_name": project, "selected_features": features, "target": target,
        "selected_models": models, "imbalance_ratio": ratio, "undersample_ratio": undersample_ratio,
        "training_timestamp": timestamp, "errors": errors or {},
    }
