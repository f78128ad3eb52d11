"""From raw products to scaled and encoded train and test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgap.fixed_values import NUTRIENT_SOURCES
from labelgap.operators import cleaning, features, population
from labelgap.operators.sampling import mark_split
from labelgap.plans.chain import Done, Stage, run_stages
from labelgap.plans.config import Config, kept, stage


def select_products(products: DataFrame, config: Config) -> DataFrame:
    kept = population.filter_by_tag(products, "countries_tags", config.broad_pattern)
    return population.project_available(kept)[0]


def nutrient_table(raw: DataFrame, config: Config) -> DataFrame:
    """Nutrients filled, keys cleaned, tags as text."""
    found = cleaning.add_nutrients(raw)
    if config.impute_by is not None:
        group = config.impute_by
        grouped = cleaning.add_top_category(found, group, "_group", config.compat)
        absent = {c: F.nullif(F.col(c), F.lit(0.0)) for c in NUTRIENT_SOURCES}  # 0 stands for absent
        found = cleaning.impute_group_mean(grouped.withColumns(absent), list(NUTRIENT_SOURCES), "_group").drop("_group")
    if config.clip is not None:
        found = cleaning.clip_range(found, config.clip)
    filled = cleaning.fill_categorical(cleaning.fill_numeric(found))
    return cleaning.tags_as_text(cleaning.clean_key(filled))


def categorical_table(preprocessed: DataFrame, config: Config) -> DataFrame:
    """Top category, allergen and label flags, cleaned grade."""
    df = cleaning.add_top_category(preprocessed, compat=config.compat)
    df = cleaning.add_label_flags(cleaning.add_allergen_flags(df))
    return cleaning.fill_grade(df)


def raw_table(products: DataFrame, config: Config) -> DataFrame:
    raw = select_products(products, config)
    if config.sparse_share is None:
        return raw
    return cleaning.drop_sparse_columns(raw, config.sparse_share, [c for c in raw.columns if c != "nutriments"])


def split_table(categorical: DataFrame, config: Config) -> DataFrame:
    """Features and key of every product, and whether it is for testing."""
    roles = features.feature_roles(categorical)
    return mark_split(categorical.select(*roles.features, *roles.ids), roles.ids, config.test_size, config.seed)


def _part(marked: DataFrame, is_test: bool) -> DataFrame:
    return marked.filter("is_test" if is_test else "NOT is_test").drop("is_test")


def preprocess(products: DataFrame, config: Config | None = None) -> dict[str, DataFrame]:
    """All stages by name. A stage that fails ends the chain with its error.

    Up to the split this is one projection over one scan. The table that is split and the split
    itself are written, to the output or else to the shared folder, so that no fit runs the chain again.
    """
    config = config or Config()
    spark = products.sparkSession
    raw = stage(raw_table(products, config), config, "raw")
    preprocessed = stage(nutrient_table(raw, config), config, "preprocessed")
    categorical = kept(categorical_table(preprocessed, config), config, "categorical")

    roles = features.feature_roles(categorical)
    marked = kept(split_table(categorical, config), config, "split")  # read by every fit
    train, test = (_part(marked, is_test) for is_test in (False, True))
    scaler = features.fit_scaler(train, roles.continuous, config.scaler)
    train, test = features.apply_scaler(train, scaler), features.apply_scaler(test, scaler)
    train, test, encoder = features.encode_categorical(train, test, roles.categorical)
    tables = features.artifact_tables(spark, scaler, encoder, roles)
    if config.output is not None:
        features.save_artifacts(tables, f"{config.output}/artifacts")
    return {
        "raw": raw,
        "preprocessed": preprocessed,
        "categorical": categorical,
        "train": stage(train, config, "train"),
        "test": stage(test, config, "test"),
        **tables,
    }


def preprocessing_stages(config: Config) -> list[Stage]:
    """The stages of ``preprocess``, each with the settings it depends on."""
    spark = lambda table: table.sparkSession
    roles = lambda marked: features.feature_roles(marked.drop("is_test"))

    def scaler(marked: DataFrame) -> DataFrame:
        fitted = features.fit_scaler(_part(marked, False), roles(marked).continuous, config.scaler)
        return features.scaler_table(spark(marked), fitted)

    def encoder(marked: DataFrame) -> DataFrame:
        return features.fit_encoder([_part(marked, False), _part(marked, True)], roles(marked).categorical)

    def scaled(is_test: bool):
        def build(marked: DataFrame, params: DataFrame, codes: DataFrame) -> DataFrame:
            part = features.apply_scaler(_part(marked, is_test), features.scaler_of(params))
            return features.apply_encoder(part, codes, roles(marked).categorical)

        return build

    clip = {c: list(bounds) for c, bounds in (config.clip or {}).items()}
    return [
        Stage("raw", lambda source: raw_table(source, config), ["products"], {"pattern": config.broad_pattern, "sparse_share": config.sparse_share}),
        Stage("preprocessed", lambda raw: nutrient_table(raw, config), ["raw"], {"impute_by": config.impute_by, "clip": clip, "compat": config.compat}),
        Stage("categorical", lambda table: categorical_table(table, config), ["preprocessed"], {"compat": config.compat}),
        Stage("split", lambda table: split_table(table, config), ["categorical"], {"test_size": config.test_size, "seed": config.seed}),
        Stage("scaler_params", scaler, ["split"], {"scaler": config.scaler}),
        Stage("encoder_map", encoder, ["split"]),
        Stage("feature_roles", lambda marked: roles(marked).to_frame(spark(marked)), ["split"]),
        Stage("train", scaled(False), ["split", "scaler_params", "encoder_map"]),
        Stage("test", scaled(True), ["split", "scaler_params", "encoder_map"]),
    ]


def preprocess_chain(products: DataFrame, folder: str, config: Config | None = None, fingerprint: str | None = None) -> dict[str, Done]:
    """``preprocess`` as a chain that goes on where it stopped; see ``run_stages``.

    A rerun with another scaler makes the scaler's parameters and the two scaled tables again and finds the rest made.
    ``fingerprint`` stands for the products where ``source_fingerprint`` can't tell that they changed.
    """
    stages = preprocessing_stages(config or Config())
    return run_stages(products.sparkSession, stages, folder, {"products": products}, {"products": fingerprint} if fingerprint else None)
