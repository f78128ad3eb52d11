"""Language gap per category, and the join with the nutrient table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgap.fixed_values import NUTRIENT_SOURCES
from labelgap.functions.language import (
    entries_before_unnamed,
    language_case,
    presence_in_array,
    presence_in_struct,
    presence_in_text,
)
from labelgap.operators import cleaning, frequency, joins, population
from labelgap.plans.chain import Done, Stage, run_stages
from labelgap.plans.config import Config, stage


def add_language_case(df: DataFrame, text: str = "ingredients_text", config: Config | None = None) -> DataFrame:
    """Presence of the domestic and the export language, and the case, for any form of the text column.

    Without the column the frame is returned as it is.
    """
    config = config or Config()
    if text not in df.columns:
        return df
    kind = df.schema[text].dataType
    if isinstance(kind, T.ArrayType):
        # The entries that count are a column of their own, so they are picked once per row.
        df = df.withColumn("_seen", entries_before_unnamed(F.col(text)) if config.compat else F.col(text))
        domestic, export = presence_in_array(
            F.col("_seen"), config.domestic_codes, config.export_codes, config.domestic_script, stop_at_unnamed=False
        )
    elif isinstance(kind, T.StructType):
        domestic, export = presence_in_struct(F.col(text), config.domestic_codes, config.export_codes)
    else:
        domestic, export = presence_in_text(F.col(text), config.domestic_script)
    marked = df.withColumns({"has_ingredients_ko": domestic, "has_ingredients_en": export}).drop("_seen")
    return marked.withColumn("language_case", language_case(F.col("has_ingredients_ko"), F.col("has_ingredients_en")))


def gap_analysis(products: DataFrame, config: Config | None = None) -> DataFrame:
    """Products of the strict population with language case and display group. No shuffle."""
    config = config or Config()
    return stage(gap_table(products, config), config, "gap")


def gap_table(products: DataFrame, config: Config) -> DataFrame:
    kept = population.filter_by_tag(products, "countries_tags", config.strict_pattern)
    return cleaning.add_category_group(add_language_case(kept, config=config), compat=config.compat)


def gap_tables(gap: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """Case distribution, cross-tab of the largest categories, its percentages, and the gap ratio."""
    top = frequency.top_categories(frequency.case_crosstab(gap), k)
    return {
        "cases": frequency.frequency_table(gap, "language_case"),
        "categories": frequency.frequency_table(gap, "category_top", 15),
        "crosstab": top,
        "percent": frequency.crosstab_percent(top),
        "gap_ratio": frequency.gap_ratio(top),
    }


def merge_nutrients(gap: DataFrame, preprocessed: DataFrame, config: Config | None = None) -> DataFrame:
    """Nutrient columns joined to the gap result by code."""
    merged = joins.left_join(gap, preprocessed, "code", list(NUTRIENT_SOURCES))
    return stage(merged, config or Config(), "merged")


def gap_chain(
    products: DataFrame, nutrients: DataFrame, folder: str, config: Config | None = None, fingerprints: dict[str, str] | None = None
) -> dict[str, Done]:
    """Gap table, its tables per category, and the join with the nutrients, as a chain that goes on where it stopped; see ``run_stages``.

    ``fingerprints`` may stand for ``products`` and ``nutrients``.
    """
    config = config or Config()
    settings = {
        "pattern": config.strict_pattern, "domestic": list(config.domestic_codes), "export": list(config.export_codes), "script": config.domestic_script,
        "compat": config.compat,
    }
    tables = lambda name: lambda gap: gap_tables(gap)[name]
    stages = [
        Stage("gap", lambda source: gap_table(source, config), ["products"], settings),
        *[Stage(name, tables(name), ["gap"], {"k": 10}) for name in ("cases", "categories", "crosstab", "percent", "gap_ratio")],
        Stage("merged", lambda gap, right: joins.left_join(gap, right, "code", list(NUTRIENT_SOURCES)), ["gap", "nutrients"]),
    ]
    return run_stages(products.sparkSession, stages, folder, {"products": products, "nutrients": nutrients}, fingerprints)
