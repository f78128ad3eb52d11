"""Population filter, projection and profile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgap.fixed_values import BROAD_MARKET_PATTERN, PRODUCT_COLUMNS
from labelgap.functions.tags import tag_matches


def _matches(df: DataFrame, tags: str, pattern: str) -> Column:
    if isinstance(df.schema[tags].dataType, T.ArrayType):
        return tag_matches(F.col(tags), pattern)
    return F.coalesce(F.lower(F.col(tags).cast("string")).rlike(pattern), F.lit(False))


def filter_by_tag(df: DataFrame, tags: str = "countries_tags", pattern: str = BROAD_MARKET_PATTERN) -> DataFrame:
    """Rows with a tag that matches; works on a tag array and on its text form."""
    return df.filter(_matches(df, tags, pattern))


def filter_selectivity(
    df: DataFrame, tags: str = "countries_tags", pattern: str = BROAD_MARKET_PATTERN
) -> DataFrame:
    """Kept rows, all rows and the kept share in percent, in one pass."""
    counted = df.agg(F.count_if(_matches(df, tags, pattern)).alias("kept"), F.count(F.lit(1)).alias("total"))
    return counted.withColumn("kept_pct", F.when(F.col("total") > 0, F.col("kept") / F.col("total") * 100))


def project_available(df: DataFrame, wanted: Sequence[str] = PRODUCT_COLUMNS) -> tuple[DataFrame, list[str]]:
    """The wanted columns that exist, and the names of those that do not."""
    present = [c for c in wanted if c in df.columns]
    return df.select(*present), [c for c in wanted if c not in df.columns]


def ensure_columns(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add each absent column with its default."""
    absent = {name: F.lit(value) for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df


def null_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the null share of each column; NaN counts as null."""
    kinds = dict(df.dtypes)

    def is_missing(name):
        missing = F.col(name).isNull()
        return missing | F.isnan(name) if kinds[name] in ("double", "float") else missing

    return df.agg(*[F.avg(F.coalesce(is_missing(c), F.lit(True)).cast("int")).alias(c) for c in columns])


def null_profile(df: DataFrame, skip: Sequence[str] = ("nutriments",)) -> DataFrame:
    """``(column, null_pct)`` of every column that holds nulls."""
    columns = [c for c in df.columns if c not in skip]
    shares = null_shares(df, columns)
    return (
        shares.unpivot([], columns, "column", "share")
        .filter(F.col("share") > 0)
        .select("column", (F.col("share") * 100).alias("null_pct"))
    )
