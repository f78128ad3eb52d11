"""Trees over blocks of binned rows, against Spark ML and brute force."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from labelgap.operators import detector, evaluation, trees
from labelgap.operators.drift import PROVENANCE

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """Three columns of few values; where both of the first are high, most rows are synthetic. Some rows are not complete, and some come twice."""
    rng = np.random.default_rng(3)
    a, b, c = rng.integers(0, 40, 6000) / 4, rng.integers(0, 12, 6000) - 6.0, rng.integers(0, 30, 6000) * 1.0
    synthetic = rng.random(6000) < np.where((a > 5) & (b < 3), 0.8, 0.25)
    found = [(i, int(s), float(x), float(y), float(z)) for i, (s, x, y, z) in enumerate(zip(synthetic, a, b, c))]
    found += [(6000 + i, *r[1:]) for i, r in enumerate(found[:300])]
    found += [(7000, 0, None, 1.0, 1.0), (7001, 1, 1.0, float("nan"), 1.0)]
    return spark.createDataFrame(found, f"id long, {PROVENANCE} int, a double, b double, c double").repartition(5).cache()


@pytest.fixture
def in_blocks(monkeypatch):
    monkeypatch.setattr(detector, "BLOCKS_FROM", 0)
    monkeypatch.setattr(trees, "BLOCK_ROWS", 500)
    monkeypatch.setattr(trees, "LOCAL_ROWS", 700)


def _scores(predictions, model):
    return sorted((r.label, round(r.score, 6), r.prediction) for r in predictions.filter(F.col("model") == model).collect())


def test_discriminators_of_large_tables(spark, rows, in_blocks, monkeypatch):
    """The same models as Spark ML fits, without its forests and boosted trees: these keep rows as objects and read them at every level."""
    with monkeypatch.context() as small:
        small.setattr(detector, "BLOCKS_FROM", 10**9)
        wanted, ranked = detector.discriminator_predictions(rows, FEATURES, "id", n_trees=12)

    def not_fitted(*_):
        raise AssertionError("rows are kept as objects")

    for kind in (RandomForestClassifier, GBTClassifier):
        monkeypatch.setattr(kind, "fit", not_fitted)
    found, importance = detector.discriminator_predictions(rows, FEATURES, "id", n_trees=12)
    assert found.schema.simpleString() == wanted.schema.simpleString()
    for model in (detector.LOGISTIC, detector.BOOSTING):  # nothing is drawn there
        assert np.allclose(_scores(found, model), _scores(wanted, model), atol=2e-5)
    of = lambda predictions: {r.model: r.auroc for r in evaluation.auroc(predictions, by=["model"]).collect()}
    assert of(found) == pytest.approx(of(wanted), abs=0.02)
    assert {r.feature: r.importance for r in importance.collect()} == pytest.approx({r.feature: r.importance for r in ranked.collect()}, abs=0.12)


def test_forest_draws_and_stops(spark, rows, in_blocks):
    """Whatever is grown over all blocks and whatever by one task, each tree has drawn as many rows as there are, and ends in leaves of the depth or of one kind."""
    complete = rows.na.drop()
    edges = trees.bin_edges(complete, FEATURES, 64)
    blocks = trees.written_blocks(complete, FEATURES, PROVENANCE, edges)
    held = list(trees._blocks(blocks.toArrow().to_batches()))
    assert sum(int(b.n_0.sum() + b.n_1.sum()) for b in held) == 6300 and len({b.key for b in held}) == len(held) > 3
    values = {tuple(c) for c in np.concatenate([b.bins for b in held], axis=1).T.tolist()}
    assert len(values) == complete.select(*FEATURES).distinct().count()  # few values: each is a bin
    for depth in (1, 6):
        forest = trees.fit_forest(blocks, 3, 2, 4, depth, 64, seed=5)
        for tree in forest.trees:
            assert _depth(tree) <= depth and len(tree.feature) <= 2 ** (depth + 1) - 1
            inner = np.flatnonzero(tree.feature >= 0)
            assert sorted([0, *tree.left[inner], *(tree.left[inner] + 1)]) == list(range(len(tree.feature)))  # each node has one parent
            assert (tree.gain[inner] > 0).all() and ((tree.value >= 0) & (tree.value <= 1)).all()
    assert forest.featureImportances.toArray().sum() == pytest.approx(1)
    again = trees.fit_forest(blocks, 3, 2, 4, depth, 64, seed=5)
    assert all(np.array_equal(x, y) for one, other in zip(forest.trees, again.trees) for x, y in zip(one, other))


def _depth(tree, node=0):
    return 0 if tree.feature[node] < 0 else 1 + max(_depth(tree, tree.left[node] + i) for i in (0, 1))


def test_local_tree_takes_the_best_cuts():
    rng = np.random.default_rng(8)
    bins, w = rng.integers(0, 5, (3, 400)).astype(np.uint8), rng.integers(1, 4, 400)
    v = rng.binomial(w, np.where(bins[1] > 2, 0.9, 0.2))
    tree = trees.grow(bins, w, v, 20, 3, 5, np.random.default_rng(1))

    def gini_gain(f, cut):
        low = bins[f] <= cut
        impurity = lambda m: 0.0 if not w[m].sum() else 2 * v[m].sum() * (w[m].sum() - v[m].sum()) / w[m].sum()  # noqa: E731  times the rows
        return impurity(w > 0) - impurity(low) - impurity(~low)

    gains = {(f, cut): gini_gain(f, cut) for f in range(3) for cut in range(4)}
    assert max(gains, key=gains.get) == (tree.feature[0], tree.cut[0]) and 2 * tree.gain[0] == pytest.approx(max(gains.values()))
    # With all features at each node, rows end by their bins: each cell of equal rows says its own class.
    said = tree.value[trees.route(tree, bins)] > 0.5
    for cell in {tuple(c) for c in bins.T.tolist()}:
        same = (bins.T == cell).all(axis=1)
        assert set(said[same]) == {bool(v[same].sum() / w[same].sum() > 0.5)}


def test_nothing_to_split(spark, in_blocks):
    alike = spark.range(200).select("id", (F.col("id") % 2).cast("int").alias(PROVENANCE), F.lit(1.0).alias("a"), F.lit(-0.5).alias("b"))
    found, importance = detector.discriminator_predictions(alike, ["a", "b"], "id", n_trees=2)
    assert found.count() == 180 and found.filter("score BETWEEN 0 AND 1").count() == 180
    assert {r.importance for r in importance.collect()} == {0.0}
