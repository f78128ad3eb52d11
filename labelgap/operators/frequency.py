"""Frequency tables and the category-by-case cross-tab."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgap.fixed_values import CASE_GAP, LANGUAGE_CASES


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count(column).alias("n_distinct"))


def frequency_table(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """``(column, n, pct)``, most frequent first, ties by value; nulls count in the total only."""
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    table = counts.withColumn("pct", F.col("n") / total * 100).orderBy(F.desc("n"), column)
    return table.limit(k) if k is not None else table


def flag_rates(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """``(flag, n, pct)`` of every boolean column, in one pass."""
    totals = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(f)).alias(f) for f in flags])
    return totals.unpivot(["_rows"], list(flags), "flag", "n").select(
        "flag", "n", F.when(F.col("_rows") > 0, F.col("n") / F.col("_rows") * 100).alias("pct")
    )


def case_crosstab(
    df: DataFrame, category: str = "category_top", case: str = "language_case", cases: Sequence[str] = LANGUAGE_CASES
) -> DataFrame:
    """One row per category, one zero-filled count per case, and the row total.

    Rows are folded to one count per category and case before the shuffle, and
    the fixed case list needs no job to find the columns.
    """
    folded = df.filter(F.col(category).isNotNull()).groupBy(category, case).agg(F.count(F.lit(1)).alias("_n"))
    counts = [F.sum(F.when(F.col(case) == c, F.col("_n")).otherwise(0)).alias(c) for c in cases]
    return folded.groupBy(category).agg(*counts, F.sum("_n").alias("total"))


def top_categories(crosstab: DataFrame, k: int = 10, category: str = "category_top") -> DataFrame:
    """The ``k`` largest categories in rank order, ties by name."""
    return crosstab.orderBy(F.desc("total"), category).limit(k)


def _case_sum(cases):
    return sum((F.col(f"`{c}`") for c in cases), F.lit(0))


def crosstab_percent(crosstab: DataFrame, cases: Sequence[str] = LANGUAGE_CASES) -> DataFrame:
    """Counts as percentages of the row."""
    return crosstab.withColumns({c: F.col(f"`{c}`") / _case_sum(cases) * 100 for c in cases})


def gap_ratio(crosstab: DataFrame, category: str = "category_top", gap_case: str = CASE_GAP) -> DataFrame:
    """Share of the gap case per category in percent, highest first; 0 when the case has no column."""
    gap = F.col(f"`{gap_case}`") if gap_case in crosstab.columns else F.lit(0)
    return crosstab.select(category, "total", (gap / F.col("total") * 100).alias("gap_pct")).orderBy(
        F.desc("gap_pct"), category
    )
