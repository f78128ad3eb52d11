"""Joins on a normalised key, with size-checked broadcasts and hot keys split off."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgap.fixed_values import NULL_KEY_TEXT
from labelgap.functions.text import normalise_key
from labelgap.session import written
from labelgap.sources.buckets import BucketedTable

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
#: Rows of one key that are joined in one task; a key with more is spread over as many parts as it takes.
HOT_KEY_ROWS = 5_000_000


def _row_bytes(df: DataFrame) -> Column:
    size = F.lit(0).cast("long")
    for field in df.schema:
        if isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
            size = size + 8
        else:
            text = F.col(f"`{field.name}`")
            text = text if isinstance(field.dataType, T.StringType) else F.to_json(F.struct(text))
            size = size + F.coalesce(F.octet_length(text), F.lit(0)) + 16
    return size


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a side before it is broadcast: one aggregate, no rows are moved."""
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df)).alias("bytes")).first()
    return found["rows"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Broadcast hint for a side measured to be small; any other side is left to a shuffled join."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """``key, parts`` of every key with more than ``min_rows`` rows: as many parts as keep each below it."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > min_rows).select(key, F.ceil(F.col("_rows") / F.lit(min_rows)).cast("int").alias("parts"))


def _salted_left_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Spread the rows of each hot key over its parts, and repeat its right rows for each part.

    Rows are numbered as they are read from the written left side, before anything moves them: rows that are
    exact copies are spread, too, and a row has the same part however often it is read.
    """
    hot = broadcast_if_small(hot)
    turn = F.pmod(F.col("_turn"), F.coalesce("parts", F.lit(1)))
    numbered = left.withColumn("_turn", F.monotonically_increasing_id())
    salted = numbered.join(hot, key, "left").withColumn("_salt", turn.cast("int")).drop("parts", "_turn")
    parts = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    repeated = right.join(hot, key, "left").withColumn("_salt", F.explode(parts)).drop("parts")
    return salted.join(repeated, [key, "_salt"], "left").drop("_salt")


def _share_buckets(left: DataFrame | BucketedTable, right: DataFrame | BucketedTable, key: str) -> bool:
    both = isinstance(left, BucketedTable) and isinstance(right, BucketedTable)
    return both and left.key == right.key == key and left.buckets == right.buckets


def _bucketed_join(left: BucketedTable, right: BucketedTable, columns: Sequence[str] | None) -> DataFrame:
    """Bucket next to bucket, without a shuffle; hot and keyless rows of the left take a way of their own."""
    if right.hot is not None:
        raise ValueError("hot keys may be set apart on the left side only")
    key = left.key
    taken = [c for c in (columns if columns is not None else right.columns) if c in right.columns and c != key]
    found = right.keyed.select(key, *taken)
    joined = left.keyed.drop(*taken).join(found, key, "left")
    if left.hot is not None:
        hot = left.hot.drop(*taken)
        joined = joined.unionByName(_salted_left_join(hot, found, key, written(hot_keys(hot, key, HOT_KEY_ROWS), "hot")).select(*joined.columns))
    return joined.unionByName(left.keyless.drop(*taken), allowMissingColumns=True)


def left_join(
    left: DataFrame | BucketedTable,
    right: DataFrame | BucketedTable,
    key: str = "code",
    columns: Sequence[str] | None = None,
    null_keys: str = "never",
    hot_key_rows: int | None = None,
) -> DataFrame:
    """Left equi-join on a normalised key.

    Keys are turned to stripped text on both sides. A null key matches nothing;
    with ``null_keys='match'`` null keys become one text, and the right side's rows of that text are
    brought down to the distinct ones, so that the nulls of the left meet each of them once. Only the key and those of ``columns``
    that exist are taken from the right, and a column the left side already has under such a name is
    replaced, so no suffixes arise.

    Two tables in equally many buckets of the key are joined without a shuffle, and null keys never match there.
    The rest shuffles on the key, and Spark splits partitions that grow too large. With
    ``hot_key_rows`` the left keys are counted first, and keys with more rows than that are spread over parts, whatever
    their number.
    """
    if null_keys not in ("match", "never"):
        raise ValueError(f"unknown null_keys: {null_keys}")
    if null_keys == "never" and _share_buckets(left, right, key):
        return _bucketed_join(left, right, columns)
    left, right = (t.frame() if isinstance(t, BucketedTable) else t for t in (left, right))
    null_text = NULL_KEY_TEXT if null_keys == "match" else None
    taken = [c for c in (columns if columns is not None else right.columns) if c in right.columns and c != key]
    left = left.drop(*taken).withColumn(key, normalise_key(F.col(key), null_text))
    right = right.select(normalise_key(F.col(key), null_text).alias(key), *taken)

    if null_keys == "never":
        # Null keys match nothing: they stay out of the shuffle instead of meeting in one task.
        keyed = _join_split(left.filter(F.col(key).isNotNull()), right, key, hot_key_rows)
        return keyed.unionByName(left.filter(F.col(key).isNull()), allowMissingColumns=True)
    nulls = F.col(key) == NULL_KEY_TEXT
    right = right.filter(~nulls).unionByName(right.filter(nulls).distinct())
    return _join_split(left, right, key, hot_key_rows)


def _join_split(left: DataFrame, right: DataFrame, key: str, hot_key_rows: int | None) -> DataFrame:
    if hot_key_rows is None:
        return left.join(right, key, "left")
    columns = [*left.columns, *[c for c in right.columns if c != key]]
    left = written(left, "left")
    return _salted_left_join(left, right, key, written(hot_keys(left, key, hot_key_rows), "hot")).select(*columns)


def enrich_if_absent(
    df: DataFrame | BucketedTable, labels: DataFrame | BucketedTable, column: str = "language_case", columns: Sequence[str] = ("language_case", "category_top"),
    key: str = "code", null_keys: str = "never",
) -> DataFrame:
    """Join the label columns only where the data do not carry them yet."""
    if column in df.columns:
        return df.frame() if isinstance(df, BucketedTable) else df
    return left_join(df, labels, key, columns, null_keys)


def join_audit(df: DataFrame, column: str = "energy_100g") -> DataFrame:
    """Rows, matched rows, and zero and positive values of a joined column."""
    value = F.col(column)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(value).alias("n_matched"),
        F.count_if(value == 0).alias("n_zero"),
        F.count_if(value > 0).alias("n_positive"),
    )
