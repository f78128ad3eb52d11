"""Synthesis, detector training, augmentation experiment and scoring."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgap.fixed_values import DETECTOR_FEATURES, MODEL_NUTRIENTS
from labelgap.functions.language import risk_target
from labelgap.operators import detector, features, synthesis
from labelgap.operators.correlation import complete_rows
from labelgap.operators.joins import enrich_if_absent
from labelgap.operators.sampling import ROW_ID, split_train_test, with_row_id
from labelgap.plans.config import Config, kept, stage

_log = logging.getLogger(__name__)


def training_table(merged: DataFrame, labels: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """Complete rows of the detector features, the category as a code, and the target."""
    df = enrich_if_absent(merged, labels) if labels is not None else merged
    kept = [key] if key else []
    named = df.select(*kept, *DETECTOR_FEATURES, risk_target(F.col("language_case")).alias("target"))
    complete = complete_rows(named, [*DETECTOR_FEATURES, "target"])
    encoder = features.fit_encoder([complete], ["category_top"])
    return features.apply_encoder(complete, encoder, ["category_top"])


def synthesis_and_detector(
    merged: DataFrame, labels: DataFrame | None = None, config: Config | None = None, on_synth_error: str = "baseline",
    generate: Callable[..., DataFrame] = synthesis.generate,
) -> dict:
    """Synthetic rows, the augmented table, the detector trained on it, its quality and strongest features.

    If making the synthetic rows fails, in the fit or later in a task of ``generate``, the detector is trained on the real rows alone, and ``error`` says why.
    """
    config = config or Config()
    spark = merged.sparkSession
    real = training_table(merged, labels)
    error = None
    try:
        model = synthesis.fit_synthesizer(real, DETECTOR_FEATURES)
        synthetic = generate(spark, model, config.n_synthetic, config.seed)
        synthetic = kept(synthetic, config, "synthetic")  # what fails in generating fails here
        augmented = synthesis.augment(real, synthetic)
    except Exception as failure:  # go on with the real rows alone
        if on_synth_error != "baseline":
            raise
        _log.warning("synthesis failed, training on real rows only: %s", failure)
        synthetic, augmented, error = None, real.withColumn("is_synthetic", F.lit(0)), f"{type(failure).__name__}: {failure}"
    augmented = stage(augmented, config, "augmented")

    train, test = split_train_test(with_row_id(augmented), ROW_ID, config.test_size, config.seed)
    forest = detector.train_detector(train, DETECTOR_FEATURES, "target", config.n_trees, config.seed)
    return {
        "synthetic": synthetic,
        "augmented": augmented,
        "error": error,
        "model": forest,
        "quality": detector.evaluate(forest, test, DETECTOR_FEATURES),
        "importance": detector.feature_importance(spark, forest, DETECTOR_FEATURES),
    }


def effect_of_augmentation(merged: DataFrame, labels: DataFrame | None = None, config: Config | None = None) -> DataFrame:
    config = config or Config()
    numbered = with_row_id(training_table(merged, labels))
    return detector.augmentation_effect(numbered, DETECTOR_FEATURES, ROW_ID, "target", config.n_trees, config.seed)


def detector_model(merged: DataFrame, labels: DataFrame | None = None, config: Config | None = None) -> Model:
    """The scoring model: nutrients only, trained on all rows."""
    config = config or Config()
    df = enrich_if_absent(merged, labels) if labels is not None else merged
    named = df.select(*MODEL_NUTRIENTS, risk_target(F.col("language_case")).alias("target"))
    return detector.train_detector(named, MODEL_NUTRIENTS, "target", config.n_trees, config.seed)


def risk_scores(model: Model, products: DataFrame, key: str = "code") -> DataFrame:
    """Scores of all products; one that lacks a nutrient has a null score and band."""
    complete = complete_rows(products, MODEL_NUTRIENTS)
    scored = detector.score_products(model, complete, MODEL_NUTRIENTS, [key])
    lacking = reduce(or_, [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in MODEL_NUTRIENTS])
    return scored.unionByName(products.filter(lacking).select(key, *MODEL_NUTRIENTS), allowMissingColumns=True)
