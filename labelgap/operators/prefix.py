"""Running totals over a global order, without one task seeing all rows.

A window ordered over the whole table runs in a single task. Here the rows
are cut into value ranges first: totals run inside each range, and the sum of
the earlier ranges is added from a table with one row per range.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgap.session import shuffle_width

_SAMPLE_PER_BUCKET = 20


def _numeric_cuts(rows: DataFrame, order: str, measures: Sequence[str], by: Sequence[str], buckets: int) -> DataFrame:
    shares = [i / buckets for i in range(1, buckets)]
    cuts = F.percentile_approx(order, shares, max(1000, 10 * buckets)) if shares else F.array().cast("array<double>")
    # Taking the totals here reads the same columns as the running sums do, so both share one shuffle.
    return rows.groupBy(*by).agg(cuts.alias("_cuts"), *[F.sum(m).alias(f"total_{m}") for m in measures])


def _text_cuts(rows: DataFrame, order: str, by: Sequence[str], buckets: int) -> DataFrame:
    # Any increasing list of cuts gives the same totals. One value per hash class is a
    # draw of a fixed number of values that keeps the ranges even, whatever the values begin with.
    marked = rows.withColumn("_digest", F.xxhash64(order))
    classes = F.pmod("_digest", F.lit(_SAMPLE_PER_BUCKET * buckets)).alias("_class")
    drawn = marked.groupBy(*by, classes).agg(F.min("_digest").alias("_digest")).select(*by, "_digest")
    sample = marked.join(F.broadcast(drawn), [*by, "_digest"], "left_semi")  # 20 numbers per range and group
    spread = F.filter("_drawn", lambda _, i: i % F.lit(_SAMPLE_PER_BUCKET) == _SAMPLE_PER_BUCKET - 1)
    return sample.groupBy(*by).agg(F.array_sort(F.collect_list(order)).alias("_drawn")).select(*by, spread.alias("_cuts"))


def running_totals(
    rows: DataFrame,
    order: str,
    measures: Sequence[str],
    by: Sequence[str] = (),
    following: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Add ``cum_<m>`` per measure, ``total_<m>`` for a numeric order, and ``next_<c>`` per column of ``following``.

    ``rows`` holds one row per ``by`` and ``order`` value, without nulls in ``order``;
    aggregate before calling. ``by`` must name few groups (variables, sides),
    since the range table has ``buckets`` rows for each. A text ``order`` gives no ``total_<m>``.
    """
    by = list(by)
    buckets = buckets or shuffle_width(rows.sparkSession)
    is_text = isinstance(rows.schema[order].dataType, T.StringType)
    cuts = _text_cuts(rows, order, by, buckets) if is_text else _numeric_cuts(rows, order, measures, by, buckets)

    # Two short searches instead of one long one: first over every step-th cut, then between two of these.
    step = max(1, math.isqrt(buckets))
    cuts = cuts.withColumn("_coarse", F.filter("_cuts", lambda _, i: (i + 1) % F.lit(step) == 0))
    if by:
        placed = rows.join(F.broadcast(cuts), by)  # one row per group
    else:
        one = rows.withColumn("_one", cuts.select(F.struct("*")).scalar())
        placed = one.select(*rows.columns, "_one.*")
    coarse = F.size(F.filter("_coarse", lambda c: c < F.col(order)))
    bucket = coarse
    if step > 1:
        near = F.slice("_cuts", coarse * step + 1, F.lit(step - 1))
        bucket = coarse * step + F.size(F.filter(near, lambda c: c < F.col(order)))
    placed = placed.withColumn("_bucket", bucket).drop("_cuts", "_coarse")

    totals = [] if is_text else [F.max(f"total_{m}").alias(f"total_{m}") for m in measures]
    ranges = placed.groupBy(*by, "_bucket").agg(
        *[F.sum(m).alias(f"_sum_{m}") for m in measures], *totals, *[F.min_by(c, order).alias(f"_first_{c}") for c in following]
    )
    along = Window.partitionBy(*by).orderBy("_bucket")

    def before(measure: str) -> Column:
        if is_text:
            return F.coalesce(F.sum(f"_sum_{measure}").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        # The total less this and the later ranges: reading the total here, too, keeps both uses of the cuts alike.
        return F.col(f"total_{measure}") - F.sum(f"_sum_{measure}").over(along.rowsBetween(0, Window.unboundedFollowing))

    offsets = ranges.select(
        *by,
        "_bucket",
        *[before(m).alias(f"_before_{m}") for m in measures],
        *[F.lead(f"_first_{c}").over(along).alias(f"_first_{c}") for c in following],
    )

    inside = Window.partitionBy(*by, "_bucket").orderBy(order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = placed.join(F.broadcast(offsets), [*by, "_bucket"])  # one row per group and range
    added = {f"cum_{m}": F.sum(m).over(upto) + F.col(f"_before_{m}") for m in measures}
    added |= {f"next_{c}": F.coalesce(F.lead(c).over(inside), F.col(f"_first_{c}")) for c in following}
    return joined.withColumns(added).drop("_bucket", *[f"_before_{m}" for m in measures], *[f"_first_{c}" for c in following])
