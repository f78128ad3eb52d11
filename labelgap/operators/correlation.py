"""Pearson correlations of both sides and their differences."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelgap.fixed_values import KEY_PAIRS
from labelgap.functions import stats
from labelgap.operators.drift import PROVENANCE
from labelgap.operators.joins import broadcast_if_small
from labelgap.operators.prefix import running_totals
from labelgap.operators.sampling import ROW_ID, with_row_id
from labelgap.session import written


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without null or NaN in ``columns``."""
    return df.na.drop(subset=list(columns))


def _sides(columns, side):
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return {
        "original": complete & (F.col(side) == 0),
        "synthetic": complete & (F.col(side) == 1),
    }


def _correlation(a: str, b: str, condition: Column) -> Column:
    x, y = (F.when(condition, F.col(c).cast("double")) for c in (a, b))
    if a == b:
        return F.when(F.stddev_samp(x) > 0, F.lit(1.0))
    return stats.correlation(x, y)


def correlation_differences(df: DataFrame, columns: Sequence[str], side: str = PROVENANCE) -> DataFrame:
    """``(var_a, var_b, original, synthetic, difference)`` for every ordered pair.

    Both matrices come from one aggregate without a shuffle of rows; a row
    counts only if all its columns are present. A constant column has no
    correlation.
    """
    sides = _sides(columns, side)
    pairs = [(a, a) for a in columns] + list(combinations(columns, 2))
    wide = df.agg(
        *[_correlation(a, b, cond).alias(f"{name}_{i}") for i, (a, b) in enumerate(pairs) for name, cond in sides.items()]
    )
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(
                F.struct(
                    F.lit(x).alias("var_a"),
                    F.lit(y).alias("var_b"),
                    F.col(f"original_{i}").alias("original"),
                    F.col(f"synthetic_{i}").alias("synthetic"),
                )
            )
    matrix = wide.select(F.inline(F.array(*cells)))
    return matrix.withColumn("difference", F.col("original") - F.col("synthetic"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(var_a, var_b, r)`` of one frame after dropping incomplete rows."""
    both = correlation_differences(df.withColumn("_side", F.lit(0)), columns, "_side")
    return both.select("var_a", "var_b", F.col("original").alias("r"))


def key_pair_comparison(
    df: DataFrame,
    columns: Sequence[str],
    pairs: Sequence[tuple[str, str]] = KEY_PAIRS,
    side: str = PROVENANCE,
) -> DataFrame:
    """The named pairs with the absolute difference; a pair with an unknown column is skipped with a warning."""
    return key_pairs_of(correlation_differences(df, columns, side), columns, pairs)


def key_pairs_of(matrix: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[str, str]] = KEY_PAIRS) -> DataFrame:
    """The named pairs out of correlation differences that are there already."""
    wanted = [p for p in pairs if p[0] in columns and p[1] in columns]
    if len(wanted) < len(pairs):
        warnings.warn(f"skipped, not in the data: {[p for p in pairs if p not in wanted]}", stacklevel=3)
    if not wanted:
        return matrix.limit(0).select(F.lit("").alias("variable_pair"), "original", "synthetic", "difference")
    names = F.concat_ws(" - ", "var_a", "var_b")
    return matrix.filter(names.isin([f"{a} - {b}" for a, b in wanted])).select(
        names.alias("variable_pair"), "original", "synthetic", F.abs("difference").alias("difference")
    )


def rank_correlations(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Spearman correlations per group: ``*by, var_a, var_b, n_rows, r``, a row per unordered pair.

    Only rows count that have all values. Equal values share their middle rank, so a value that most rows have, an exact zero say, is one tie.
    The rows are made long once, all columns get their ranks in one join with the table of distinct values, and one aggregate
    of products over the regrouped rows gives all pairs. A constant column has no correlation.
    """
    by, columns = list(by), list(columns)
    doubles = [F.col(c).cast("double").alias(c) for c in columns]
    rows = with_row_id(complete_rows(df, columns).select(*by, *doubles))  # each row is put together again by its number
    values = F.array(*[F.struct(F.lit(i).alias("place"), (F.col(c) + F.lit(0.0)).alias("value")) for i, c in enumerate(columns)])
    long = rows.select(*by, ROW_ID, F.inline(values))
    counts = written(long.groupBy(*by, "place", "value").agg(F.count(F.lit(1)).alias("n")), "values")
    totals = running_totals(counts, "value", ["n"], [*by, "place"])
    # Ranks less their mean: products of these lose no digits.
    middle = F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2 - (F.col("total_n") + 1) / 2
    ranks = written(totals.select(*by, "place", "value", middle.alias("rank")), "ranks")
    ranked = long.join(broadcast_if_small(ranks), [*by, "place", "value"])
    ordered = F.array_sort(F.collect_list(F.struct("place", "rank")))
    again = ranked.groupBy(ROW_ID, *by).agg(F.transform(ordered, lambda x: x["rank"]).alias("ranks"))
    product = lambda i, j: F.sum(F.get("ranks", F.lit(i)) * F.get("ranks", F.lit(j)))
    pairs = list(combinations(range(len(columns)), 2))
    squares = [product(i, i).alias(f"s{i}") for i in range(len(columns))]
    sums = again.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *squares, *[product(i, j).alias(f"p{i}_{j}") for i, j in pairs])
    cells = [
        F.struct(
            F.lit(columns[i]).alias("var_a"), F.lit(columns[j]).alias("var_b"), F.try_divide(F.col(f"p{i}_{j}"), F.sqrt(F.col(f"s{i}") * F.col(f"s{j}"))).alias("r")
        )
        for i, j in pairs
    ]
    return sums.select(*by, "n_rows", F.inline(F.array(*cells))).select(*by, "var_a", "var_b", "n_rows", "r")
