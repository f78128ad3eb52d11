"""Missing values, keys, tag texts and the documented cleaning options."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgap.fixed_values import (
    ALLERGEN_PATTERNS,
    FILLED_CATEGORICAL_COLUMNS,
    LABEL_PATTERNS,
    MISSING,
    NUTRIENT_MARK,
    NUTRIENT_SOURCES,
    PHYSICAL_RANGES,
    SPARSE_COLUMN_SHARE,
    TAG_COLUMNS,
)
from labelgap.functions.nutrients import nutrient_columns, usable_entries
from labelgap.functions.tags import (
    allergen_flags,
    first_name,
    first_name_text,
    group_of,
    joined_tags,
    label_flags,
    tags_to_text,
    top_category,
    top_category_text,
)
from labelgap.functions.text import normalise_key
from labelgap.operators.joins import broadcast_if_small
from labelgap.session import written
from labelgap.operators.population import ensure_columns, null_shares


def add_nutrients(
    df: DataFrame,
    nutriments: str = "nutriments",
    sources: Mapping[str, Sequence[str]] = NUTRIENT_SOURCES,
    name_field: str = "name",
    value_field: str = "100g",
) -> DataFrame:
    """Append one column per nutrient. The usable entries are a column of their own, so they are formed once per row."""
    entries = usable_entries(F.col(nutriments), name_field, value_field)
    return df.withColumn("_entries", entries).withColumns(nutrient_columns(F.col("_entries"), sources)).drop("_entries")


def fill_numeric(df: DataFrame, columns: Sequence[str] | None = None, value: float = 0.0) -> DataFrame:
    """Null and NaN to ``value``; by default in every nutrient column."""
    columns = [c for c in df.columns if NUTRIENT_MARK in c] if columns is None else list(columns)
    return df.na.fill(value, subset=columns) if columns else df


def fill_categorical(
    df: DataFrame, columns: Sequence[str] = FILLED_CATEGORICAL_COLUMNS, value: str = MISSING
) -> DataFrame:
    """Null to ``missing`` in the text columns among ``columns``; tag arrays are left to ``tags_as_text``."""
    texts = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    return df.na.fill(value, subset=texts) if texts else df


def clean_key(df: DataFrame, key: str = "code") -> DataFrame:
    return df.withColumn(key, normalise_key(F.col(key)))


def tags_as_text(df: DataFrame, columns: Sequence[str] = TAG_COLUMNS) -> DataFrame:
    """Tag arrays to comma text and any other column among ``columns`` to text."""
    changed = {}
    for name in columns:
        if name not in df.columns:
            continue
        kind = df.schema[name].dataType
        if isinstance(kind, T.ArrayType):
            tags = F.col(name)
            if not isinstance(kind.elementType, T.StringType):
                tags = F.transform(tags, lambda t: t.cast("string"))
            changed[name] = tags_to_text(tags)
        else:
            changed[name] = F.coalesce(F.col(name).cast("string"), F.lit(MISSING))
    return df.withColumns(changed) if changed else df


def _is_array(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.ArrayType)


def add_top_category(
    df: DataFrame, tags: str = "categories_tags", output: str = "category_top", compat: bool = True
) -> DataFrame:
    """First category tag, or ``missing`` for every row when there is no such column."""
    if tags not in df.columns:
        return df.withColumn(output, F.lit(MISSING))
    pick = top_category if _is_array(df, tags) else top_category_text
    return df.withColumn(output, pick(F.col(tags), compat))


def add_category_group(
    df: DataFrame, tags: str = "categories_tags", output: str = "category_top", compat: bool = True
) -> DataFrame:
    """Display group of the first category tag. The name is a column of its own, so it is formed once per row."""
    name = (first_name if _is_array(df, tags) else first_name_text)(F.col(tags), compat)
    return df.withColumn("_name", name).withColumn(output, group_of(F.col("_name"))).drop("_name")


def _add_flags(df, tags, patterns, flags):
    if tags not in df.columns:
        return ensure_columns(df, {name: False for name in patterns})
    text = joined_tags(F.col(tags)) if _is_array(df, tags) else F.col(tags)
    return df.withColumns(flags(text, patterns))


def add_allergen_flags(
    df: DataFrame, tags: str = "allergens_tags", patterns: Mapping[str, str] = ALLERGEN_PATTERNS
) -> DataFrame:
    return _add_flags(df, tags, patterns, allergen_flags)


def add_label_flags(
    df: DataFrame, tags: str = "labels_tags", patterns: Mapping[str, str] = LABEL_PATTERNS
) -> DataFrame:
    return _add_flags(df, tags, patterns, label_flags)


def fill_grade(df: DataFrame, grade: str = "nutriscore_grade") -> DataFrame:
    """Grade with ``missing`` for null, and a column of ``missing`` where there is none."""
    return ensure_columns(df, {grade: MISSING}).na.fill(MISSING, subset=[grade])


# The next three are described for the data but off by default in the pipeline.


def drop_sparse_columns(
    df: DataFrame, share: float = SPARSE_COLUMN_SHARE, columns: Sequence[str] | None = None
) -> DataFrame:
    """Drop the columns whose null share reaches ``share``. Runs one aggregate job."""
    columns = list(df.columns if columns is None else columns)
    shares = null_shares(df, columns).first()
    return df.drop(*[c for c in columns if shares[c] is not None and shares[c] >= share])


def impute_group_mean(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """Null and NaN to the mean of the row's group, then to the mean of the column.

    The means come from partial aggregates and are joined back, so no group is
    gathered in one task however large it is.
    """
    present = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    valued = df.withColumns(present)
    # Sums and counts are taken once, written, and give the group means and the overall means.
    sums = valued.groupBy(group).agg(*[f(c).alias(f"_{f.__name__}_{c}") for c in columns for f in (F.sum, F.count)])
    sums = written(sums, "sums").withColumnRenamed(group, "_of_group")
    overall = sums.agg(*[F.try_divide(F.sum(f"_sum_{c}"), F.sum(f"_count_{c}")).alias(f"_overall_{c}") for c in columns])
    means = sums.select("_of_group", *[F.try_divide(F.col(f"_sum_{c}"), F.col(f"_count_{c}")).alias(f"_mean_{c}") for c in columns])
    joined = valued.join(broadcast_if_small(means), F.col(group).eqNullSafe(F.col("_of_group")), "left").join(F.broadcast(overall))  # one row
    filled = {c: F.coalesce(F.col(c), F.col(f"_mean_{c}"), F.col(f"_overall_{c}")) for c in columns}
    return joined.withColumns(filled).select(*df.columns)


def clip_range(df: DataFrame, ranges: Mapping[str, tuple[float, float]] = PHYSICAL_RANGES) -> DataFrame:
    """Clip columns into their range; null stays null."""
    clipped = {
        c: F.when(F.col(c).isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), F.col(c))))
        for c, (low, high) in ranges.items()
        if c in df.columns
    }
    return df.withColumns(clipped) if clipped else df
