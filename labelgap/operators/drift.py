"""Do two samples, original and synthetic, come from the same distribution?

Both sides live in one frame and are told apart by a 0/1 column. Every
statistic is computed for all variables at once: the frame is unpivoted to
(variable, side, value) and aggregated by variable.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelgap.fixed_values import AUROC_BANDS, CORRELATION_BANDS, PSI_BANDS, PSI_BINS, PSI_EMPTY_SHARE
from labelgap.functions import stats
from labelgap.operators.prefix import running_totals
from labelgap.session import shuffle_width, written

PROVENANCE = "is_synthetic"


def label_sides(original: DataFrame, synthetic: DataFrame, side: str = PROVENANCE) -> DataFrame:
    """Bag union of both sides by column name, with the side as a column."""
    return original.withColumn(side, F.lit(0)).unionByName(synthetic.withColumn(side, F.lit(1)))


def take_side(df: DataFrame, synthetic: bool, side: str = PROVENANCE) -> DataFrame:
    return df.filter(F.col(side) == int(synthetic)).drop(side)


def long_form(columns: Sequence[str]) -> Column:
    """``(variable, value)`` rows out of columns of one type.

    Unlike ``unpivot`` this generator lets branches of a plan share their shuffle.
    """
    return F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("value")) for c in columns]))


def side_values(df: DataFrame, columns: Sequence[str], side: str = PROVENANCE) -> DataFrame:
    """``(variable, value, n_original, n_synthetic)``, one row per value that is neither null nor NaN.

    Variables the frame does not have are skipped.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        raise ValueError(f"none of the variables exists: {list(columns)}")
    doubles = df.select((F.col(side) == 1).alias("_synthetic"), *[F.col(c).cast("double").alias(c) for c in present])
    return (
        doubles.select("_synthetic", long_form(present))
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .select(
            "variable",
            (F.col("value") + F.lit(0.0)).alias("value"),  # -0.0 becomes 0.0
            F.when(F.col("_synthetic"), 0).otherwise(1).cast("long").alias("n_original"),
            F.when(F.col("_synthetic"), 1).otherwise(0).cast("long").alias("n_synthetic"),
        )
    )


def value_counts(values: DataFrame) -> DataFrame:
    """One row per distinct value; frequent values are folded before the shuffle."""
    return values.groupBy("variable", "value").agg(
        F.sum("n_original").alias("n_original"), F.sum("n_synthetic").alias("n_synthetic")
    )


def distribution_distances(counts: DataFrame, buckets: int | None = None) -> DataFrame:
    """KS statistic and Wasserstein-1 distance per variable, from one pass of running totals."""
    totals = running_totals(
        counts, "value", ["n_original", "n_synthetic"], by=["variable"], following=["value"], buckets=buckets
    )
    gap = F.abs(
        F.col("cum_n_original") / F.col("total_n_original") - F.col("cum_n_synthetic") / F.col("total_n_synthetic")
    )
    both = totals.filter((F.col("total_n_original") > 0) & (F.col("total_n_synthetic") > 0))
    return both.groupBy("variable").agg(
        F.max("total_n_original").alias("n_original"),
        F.max("total_n_synthetic").alias("n_synthetic"),
        F.max(gap).alias("ks_statistic"),
        F.coalesce(F.sum(gap * (F.col("next_value") - F.col("value"))), F.lit(0.0)).alias("wasserstein"),
    )


def _spread(distances: DataFrame, method: str) -> DataFrame:
    """An exact p-value may take long, so each variable's is a task of its own."""
    return distances.repartition(shuffle_width(distances.sparkSession), "variable") if method == "exact" else distances


def ks_test(df: DataFrame, columns: Sequence[str], side: str = PROVENANCE, method: str = "limit") -> DataFrame:
    """KS statistic and its two-sided p-value per variable; see ``stats.ks_pvalue`` for ``method``."""
    distances = _spread(distribution_distances(value_counts(side_values(df, columns, side))), method)
    p = stats.ks_pvalue(F.col("ks_statistic"), F.col("n_original"), F.col("n_synthetic"), method)
    return distances.select("variable", "n_original", "n_synthetic", "ks_statistic", p.alias("ks_pvalue"))


def wasserstein(df: DataFrame, columns: Sequence[str], side: str = PROVENANCE) -> DataFrame:
    return distribution_distances(value_counts(side_values(df, columns, side))).select("variable", "wasserstein")


def _value_ranges(values: DataFrame) -> DataFrame:
    return values.groupBy("variable").agg(
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.sum("n_original").alias("rows_original"),
        F.sum("n_synthetic").alias("rows_synthetic"),
    )


def _bin(bins: int) -> Column:
    # Edges are low + i * step; a value on an edge belongs to the upper bin, the maximum to the last one.
    step = (F.col("high") - F.col("low")) / bins
    return sum(((F.lit(float(i)) * step + F.col("low")) <= F.col("value")).cast("int") for i in range(1, bins)) + 1


def psi_of(values: DataFrame, bins: int = PSI_BINS, empty_share: float = PSI_EMPTY_SHARE) -> DataFrame:
    """Population stability index per variable over equal-width bins of the joint range.

    A bin empty on both sides adds nothing, so only occupied bins are formed.
    """
    ranges = _value_ranges(values)
    binned = (
        values.join(F.broadcast(ranges), "variable")  # one row per variable
        .groupBy("variable", "low", "high", "rows_original", "rows_synthetic", _bin(bins).alias("bin"))
        .agg(F.sum("n_original").alias("n_original"), F.sum("n_synthetic").alias("n_synthetic"))
    )
    share = lambda n, rows: F.when(F.col(n) == 0, F.lit(empty_share)).otherwise(
        F.try_divide(F.col(n).cast("double"), F.col(rows))
    )
    p, q = share("n_original", "rows_original"), share("n_synthetic", "rows_synthetic")
    per_variable = binned.groupBy("variable").agg(
        F.sum((p - q) * F.ln(p / q)).alias("sum"),
        F.first("low").alias("low"),
        F.first("high").alias("high"),
        F.first("rows_original").alias("rows_original"),
        F.first("rows_synthetic").alias("rows_synthetic"),
    )
    empty = (F.col("rows_original") == 0) | (F.col("rows_synthetic") == 0)
    return per_variable.select(
        "variable",
        F.when(empty, F.lit(float("nan"))).when(F.col("low") == F.col("high"), 0.0).otherwise(F.col("sum")).alias("psi"),
    )


def psi(
    df: DataFrame, columns: Sequence[str], side: str = PROVENANCE, bins: int = PSI_BINS
) -> DataFrame:
    return psi_of(side_values(df, columns, side), bins)


def _side_moments(weight: str) -> tuple[Column, Column]:
    """Mean and sample standard deviation of ``value`` with whole-number weights."""
    value, n = F.col("value"), F.col(weight)
    mean = F.try_divide(F.sum(value * n), F.sum(n))
    return mean, F.sum(n)


def moments(counts: DataFrame) -> DataFrame:
    """Mean and sample standard deviation per side, and their absolute differences, from values with their counts."""
    sides = {"original": "n_original", "synthetic": "n_synthetic"}
    means = counts.groupBy("variable").agg(
        *[f.alias(f"{s}_{name}") for s, n in sides.items() for name, f in zip(("mean", "rows"), _side_moments(n))]
    )
    spread = counts.join(F.broadcast(means), "variable")  # a row per variable
    found = spread.groupBy("variable").agg(*[F.first(f"{s}_mean").alias(f"{s}_mean") for s in sides], *[
        F.sqrt(F.try_divide(F.sum(F.col(n) * F.pow(F.col("value") - F.col(f"{s}_mean"), 2)), F.nullif(F.first(f"{s}_rows") - 1, F.lit(0)))).alias(f"{s}_std")
        for s, n in sides.items()
    ])
    return found.withColumns(
        {
            "mean_diff": F.abs(F.col("original_mean") - F.col("synthetic_mean")),
            "std_diff": F.abs(F.col("original_std") - F.col("synthetic_std")),
        }
    )


def moment_differences(df: DataFrame, columns: Sequence[str], side: str = PROVENANCE) -> DataFrame:
    return moments(value_counts(side_values(df, columns, side)))


def statistical_report(df: DataFrame, columns: Sequence[str], side: str = PROVENANCE, method: str = "limit") -> DataFrame:
    """All statistics, one row per variable that has values on both sides.

    All statistics come from one table of distinct values, which is written, so the rows are
    read and shuffled once. Variables the frame lacks are named in a warning.
    """
    missing = [c for c in columns if c not in df.columns]
    if missing:
        warnings.warn(f"skipped, not in the data: {missing}", stacklevel=2)
    return report_of(written(value_counts(side_values(df, columns, side)), "counts"), method)


def report_of(counts: DataFrame, method: str = "limit") -> DataFrame:
    """``statistical_report`` out of the distinct values with their counts."""
    p = stats.ks_pvalue(F.col("ks_statistic"), F.col("n_original"), F.col("n_synthetic"), method)
    distances = _spread(distribution_distances(counts), method).withColumn("ks_pvalue", p)
    return (
        distances.join(F.broadcast(psi_of(counts)), "variable")  # one row per variable each
        .join(F.broadcast(moments(counts)), "variable")
        .select(
            "variable", "ks_statistic", "ks_pvalue", "wasserstein", "psi", "original_mean", "synthetic_mean",
            "original_std", "synthetic_std", "mean_diff", "std_diff",
        )
    )


def skipped_variables(counts: DataFrame, wanted: Sequence[str], original: Sequence[str], synthetic: Sequence[str]) -> DataFrame:
    """``variable, reason``: a row per wanted variable that no report covers, for want of a column or of values on a side."""
    spark = counts.sparkSession
    lacking = {c: "not in the original" if c not in original else "not in the synthetic" for c in wanted if c not in original or c not in synthetic}
    if len(lacking) == len(wanted):
        return spark.createDataFrame(list(lacking.items()), "variable string, reason string")
    asked = spark.createDataFrame([(c, lacking.get(c)) for c in wanted], "variable string, lacks string")
    totals = counts.groupBy("variable").agg(F.sum("n_original").alias("n_original"), F.sum("n_synthetic").alias("n_synthetic"))
    reason = F.coalesce(
        F.col("lacks"),
        F.when(F.coalesce("n_original", F.lit(0)) == 0, "no values in the original").when(F.coalesce("n_synthetic", F.lit(0)) == 0, "no values in the synthetic"),
    )
    return asked.join(F.broadcast(totals), "variable", "left").select("variable", reason.alias("reason")).filter("reason IS NOT NULL")  # a row per variable


def report_summary(report: DataFrame, digits: int = 4) -> DataFrame:
    names = ["ks_statistic", "ks_pvalue", "wasserstein", "psi"]
    return report.select("variable", *[F.round(c, digits).alias(c) for c in names if c in report.columns])


# -- acceptance bands ---------------------------------------------------------


def _band(value: Column, limits: tuple[float, float], names: tuple[str, str, str]) -> Column:
    # A value on the upper limit is still in the middle band.
    low, high = limits
    return F.when(value < low, names[0]).when(value <= high, names[1]).otherwise(names[2])


def psi_band(value: Column) -> Column:
    return _band(value, PSI_BANDS, ("very stable", "slight drift", "large drift"))


def correlation_band(difference: Column) -> Column:
    return _band(difference, CORRELATION_BANDS, ("well kept", "partly kept", "much changed"))


def auroc_verdict(mean_auroc: Column) -> Column:
    low, high = AUROC_BANDS
    return F.when(mean_auroc < low, "very similar").when(mean_auroc < high, "fairly similar").otherwise("distinguishable")
