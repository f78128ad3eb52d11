"""Risk detector and real-or-synthetic discriminators, on Spark ML."""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgap.fixed_values import MODEL_NUTRIENTS, N_TREES, SEED
from labelgap.functions.scoring import risk_advice, risk_band, risk_verdict
from labelgap.operators import trees
from labelgap.operators.correlation import complete_rows
from labelgap.operators.drift import PROVENANCE
from labelgap.operators.evaluation import (
    accuracy,
    auroc,
    class_report,
    confusion_matrix,
    discriminator_verdict,
    f1_score,
    rank_models,
    roc_points,
)
from labelgap.operators.joins import broadcast_if_small
from labelgap.operators.sampling import balanced_sample, mark_split, split_train_test
from labelgap.operators.synthesis import augment, balance_minority
from labelgap.session import set_checkpoint_dir, written

_log = logging.getLogger(__name__)

# Forests keep the node of every row (``cacheNodeIds``); the grown trees are else sent to all tasks at every level.
MAX_DEPTH = 20
MAX_BINS = 64
# From so many rows on, a forest's trees are shared out over fits that run at once, each on as few partitions as hold no more rows than below.
SHARE_TREES_FROM = 50_000
ROWS_PER_PARTITION = 500_000
# From so many rows on, the trees of discriminators grow over blocks of binned rows: kept as objects, rows would not fit and go to disk at every level.
BLOCKS_FROM = 500_000
BOOSTED_DEPTH = 3
BOOSTING_STEP = 0.1
_SEEDS_APART = 1_000_003


def _assembled(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    doubles = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in features if c not in keep])
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(doubles)


def class_weights(df: DataFrame, target: str = "target") -> DataFrame:
    """``(target, n, weight)`` with weight ``rows / (classes * n)``."""
    sizes = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    whole = sizes.agg((F.sum("n") / F.count(F.lit(1))).alias("mean")).scalar()
    return sizes.withColumn("weight", whole / F.col("n"))


def _with_weight(df: DataFrame, target: str, output: str) -> DataFrame:
    weights = broadcast_if_small(class_weights(df, target).select(F.col(target), F.col("weight").alias(output)))
    return df.join(weights, target)


class JoinedForest(Model):
    """Forests that were fitted apart on the same rows. Their trees are one forest: each has one vote."""

    def __init__(self, parts: Sequence[Model]):
        super().__init__()
        self.parts = list(parts)

    @property
    def getNumTrees(self) -> int:
        return sum(part.getNumTrees for part in self.parts)

    @property
    def featureImportances(self) -> DenseVector:
        return Vectors.dense(sum(part.featureImportances.toArray() * part.getNumTrees for part in self.parts) / self.getNumTrees)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        votes = [f"_votes_{i}" for i in range(len(self.parts))]
        voted = dataset
        for part, column in zip(self.parts, votes):
            names = {part.rawPredictionCol: column, part.probabilityCol: "", part.predictionCol: ""}  # no column for an empty name
            voted = part.copy(names).transform(voted)
        arrays = [vector_to_array(c) for c in votes]
        sums = F.array(*[sum((a[k] for a in arrays), F.lit(0.0)) / self.getNumTrees for k in range(self.parts[0].numClasses)])
        shared = voted.withColumn("_shares", sums).withColumn("probability", array_to_vector("_shares"))
        first = F.array_position("_shares", F.array_max("_shares")) - 1  # the first class of those with most votes
        return shared.withColumn("prediction", first.cast("double")).drop("_shares", *votes)


@contextmanager
def _training(train: DataFrame, features: Sequence[str], target: str, keep: Sequence[str] = ()) -> Iterator[DataFrame]:
    """``features`` and ``label``, kept on as many partitions as there are cores at most.

    At every level of a forest each partition sends the counts of all its nodes, so the work is nodes times partitions; nodes grow with the rows.
    """
    rows = _assembled(train, features, [target, *keep]).select("features", *keep, F.col(target).cast("double").alias("label"))
    rows = rows.coalesce(train.sparkSession.sparkContext.defaultParallelism)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)  # read several times; recomputed from the source if lost
    try:
        yield rows
    finally:
        rows.unpersist()


def _fit_forest(forest: RandomForestClassifier, rows: DataFrame) -> Model:
    """One fit of all trees, or many of some trees each that run at once on fewer partitions, so that the cores are busy but few partitions count each node."""
    n_rows, n_trees = rows.count(), forest.getNumTrees()
    partitions = math.ceil(n_rows / ROWS_PER_PARTITION)
    n_fits = min(n_trees, rows.sparkSession.sparkContext.defaultParallelism // max(1, partitions))
    if n_rows < SHARE_TREES_FROM or n_fits < 2:
        return forest.fit(rows)
    shared = written(rows, "training")  # kept rows would draw all fits to the executors that hold them

    def fit(i: int) -> Model:
        trees = n_trees // n_fits + (i < n_trees % n_fits)
        return forest.copy({forest.numTrees: trees, forest.seed: forest.getSeed() + i * _SEEDS_APART}).fit(shared.coalesce(partitions))

    with ThreadPool(n_fits) as pool:
        return JoinedForest(pool.map(inheritable_thread_target(fit), range(n_fits)))


def train_detector(
    train: DataFrame,
    features: Sequence[str],
    target: str = "target",
    n_trees: int = N_TREES,
    seed: int = SEED,
    balanced: bool = False,
    max_depth: int = MAX_DEPTH,
    max_bins: int = MAX_BINS,
) -> Model:
    """Random forest; ``balanced`` weights each class by the inverse of its size.

    ``max_bins`` is the number of cut points tried per feature; codes of categories are numbers to it.
    """
    set_checkpoint_dir(train.sparkSession)  # iterative fits cut their lineage there
    forest = RandomForestClassifier(
        numTrees=n_trees, maxDepth=max_depth, maxBins=max_bins, featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True
    )
    complete = complete_rows(train, [*features, target])
    if not balanced:
        with _training(complete, features, target) as rows:
            return _fit_forest(forest, rows)
    with _training(_with_weight(complete, target, "_weight"), features, target, ["_weight"]) as rows:
        return _fit_forest(forest.setWeightCol("_weight"), rows)


def predict(model: Model, df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, the probability of class 1 as ``score``, and the predicted class."""
    scored = model.transform(_assembled(df, features, keep))
    return scored.select(
        *keep,
        F.element_at(vector_to_array("probability"), 2).alias("score"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def score_products(model: Model, df: DataFrame, features: Sequence[str] = MODEL_NUTRIENTS, keep: Sequence[str] = ()) -> DataFrame:
    """Risk in percent, its band, verdict and advice for every row."""
    scored = predict(model, df, features, [*keep, *[f for f in features if f not in keep]])
    risk = scored.withColumn("risk_score", F.col("score") * 100).withColumn("band", risk_band(F.col("risk_score")))
    return risk.select(
        *keep, *[f for f in features if f not in keep], "risk_score", "band",
        risk_verdict(F.col("band")).alias("verdict"), risk_advice(F.col("band")).alias("advice"),
    )


def feature_importance(spark: SparkSession, model: Model, features: Sequence[str], k: int | None = 3) -> DataFrame:
    """Features by importance, the ``k`` strongest."""
    rows = sorted(zip(features, model.featureImportances.toArray().tolist()), key=lambda r: (-r[1], r[0]))
    ranked = [(i, name, value) for i, (name, value) in enumerate(rows[:k], 1)]
    return spark.createDataFrame(ranked, "rank int, feature string, importance double")


def evaluate(model: Model, test: DataFrame, features: Sequence[str], target: str = "target", good: float = 0.8) -> DataFrame:
    """One row: accuracy, F1 of the risk class, and whether the accuracy is good."""
    scored = written(predict(model, test, features, [target]), "predictions")  # the model goes to the tasks of one job only
    found = accuracy(scored, target).first()["accuracy"], f1_score(scored, target).first()["f1"]
    rows = [(*found, found[0] is not None and found[0] > good)]
    return test.sparkSession.createDataFrame(rows, "accuracy double, f1 double, is_good boolean")


def augmentation_effect(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    target: str = "target",
    n_trees: int = N_TREES,
    seed: int = SEED,
    on_synth_error: str = "baseline",
) -> DataFrame:
    """Does balancing the risk class with synthetic rows raise its F1?

    Both forests are tested on the same stratified fifth of the real rows. If
    the synthesis fails, its row repeats the baseline and names the error.
    """
    spark = df.sparkSession
    data = complete_rows(df.select(key, *features, target), [*features, target])
    train, test = split_train_test(data, key, 0.2, seed, stratify=target)
    base = evaluate(train_detector(train, features, target, n_trees, seed, balanced=True), test, features, target).first()
    result, error, added = base, None, 0
    try:
        synthetic = balance_minority(train, features, target, 1, seed)
        if synthetic is not None:
            added = synthetic.count()
            grown = augment(train.select(*features, target), synthetic)
            model = train_detector(grown, features, target, n_trees, seed)
            result = evaluate(model, test, features, target).first()
    except Exception as failure:  # a failed synthesis must not lose the baseline
        if on_synth_error != "baseline":
            raise
        _log.warning("synthesis failed, the baseline is reported twice: %s", failure)
        error = f"{type(failure).__name__}: {failure}"
    rows = [
        ("baseline", 0, base["accuracy"], base["f1"], False, None),
        ("augmented", added, result["accuracy"], result["f1"], result["f1"] > base["f1"], error),
    ]
    return spark.createDataFrame(
        rows, "experiment string, n_synthetic long, accuracy double, f1 double, f1_improved boolean, error string"
    )


# -- discriminators ----------------------------------------------------------------


LOGISTIC, FOREST, BOOSTING = "Logistic Regression", "Random Forest", "Gradient Boosting"


def _logistic(n_rows: int) -> LogisticRegression:
    return LogisticRegression(maxIter=1000, regParam=1.0 / n_rows, standardization=False)


def _discriminators(n_rows: int, n_trees: int, seed: int, max_bins: int):
    return {
        LOGISTIC: _logistic(n_rows),
        FOREST: RandomForestClassifier(
            numTrees=n_trees, maxDepth=MAX_DEPTH, maxBins=max_bins, featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True
        ),
        BOOSTING: GBTClassifier(maxIter=n_trees, maxDepth=BOOSTED_DEPTH, stepSize=BOOSTING_STEP, maxBins=max_bins, seed=seed),
    }


def _said(name: str, model: Model, test: DataFrame, features: Sequence[str], side: str) -> DataFrame:
    return predict(model, test, features, [side]).select(
        F.lit(name).alias("model"), F.col(side).cast("int").alias("label"), "score", "prediction"
    )


def discriminator_predictions(
    df: DataFrame,
    columns: Sequence[str],
    key: str,
    side: str = PROVENANCE,
    n_trees: int = N_TREES,
    seed: int = SEED,
    max_bins: int = MAX_BINS,
) -> tuple[DataFrame, DataFrame]:
    """What three models that try to tell the sides apart say of the test rows, and how the forest ranks the columns.

    Predictions are ``(model, label, score, prediction)``, written once. Sides are first brought to
    equal size, then 30 % of each class is held out.
    """
    features = [c for c in columns if c in df.columns]
    spark = df.sparkSession
    set_checkpoint_dir(spark)
    is_large = max_bins <= trees.MAX_BINS and df.count() >= BLOCKS_FROM
    sample = balanced_sample(df.select(key, side, *features), side, key, seed)
    if is_large:
        return _large_predictions(complete_rows(written(sample, "sample"), features), features, key, side, n_trees, seed, max_bins)
    train, test = split_train_test(complete_rows(sample, features), key, 0.3, seed, stratify=side)
    with _training(train, features, side) as rows:
        estimators = _discriminators(max(1, rows.count()), n_trees, seed, max_bins)

        def fit(estimator) -> Model:
            return _fit_forest(estimator, rows) if isinstance(estimator, RandomForestClassifier) else estimator.fit(rows)

        with ThreadPool(len(estimators)) as pool:  # at once: boosting goes tree after tree and leaves cores idle
            models = dict(zip(estimators, pool.map(inheritable_thread_target(fit), estimators.values())))
    predictions = reduce(DataFrame.union, [_said(name, model, test, features, side) for name, model in models.items()])
    return written(predictions, "predictions"), feature_importance(spark, models[FOREST], features, None)


def _large_predictions(
    complete: DataFrame, features: Sequence[str], key: str, side: str, n_trees: int, seed: int, max_bins: int
) -> tuple[DataFrame, DataFrame]:
    """The same models over rows of any number. Digests are taken once and the parts are written; trees grow over blocks of binned rows."""
    spark = complete.sparkSession
    split = written(mark_split(complete, key, 0.3, seed, side, "_is_test").select(side, *features, "_is_test"), "split")
    train, test = split.filter("NOT _is_test"), split.filter("_is_test")
    n_rows = max(1, train.count())
    edges = trees.bin_edges(train, features, max_bins)
    blocks, n_features = trees.written_blocks(train, features, side, edges), len(features)
    rows = _assembled(train, features, [side]).select("features", F.col(side).cast("double").alias("label"))
    fits = {
        LOGISTIC: lambda: _logistic(n_rows).fit(rows.coalesce(spark.sparkContext.defaultParallelism)),
        FOREST: lambda: trees.fit_forest(blocks, n_features, math.ceil(math.sqrt(n_features)), n_trees, MAX_DEPTH, max_bins, seed),
        BOOSTING: lambda: trees.fit_boosting(blocks, n_features, n_trees, BOOSTED_DEPTH, BOOSTING_STEP, max_bins, seed),
    }
    with ThreadPool(len(fits)) as pool:
        models = dict(zip(fits, pool.map(inheritable_thread_target(lambda fit: fit()), fits.values())))
    linear = _said(LOGISTIC, models.pop(LOGISTIC), test, features, side)
    predictions = linear.union(trees.predictions(test, models, features, side, edges))
    return written(predictions, "predictions"), feature_importance(spark, models[FOREST], features, None)


def discriminator_results(predictions: DataFrame) -> dict[str, DataFrame]:
    """AUROC per model (nearest to 0.5 first), the verdict, and the details of the first model."""
    results = rank_models(written(auroc(predictions, by=["model"]), "auroc"))  # a row per model, read by most of what follows
    best = results.select("model").limit(1)
    chosen = predictions.join(F.broadcast(best), "model", "left_semi")  # one row
    return {
        "auroc": results,
        "verdict": discriminator_verdict(results),
        "confusion": confusion_matrix(chosen),
        "report": class_report(chosen),
        "roc": roc_points(predictions, by=["model"]),
    }
