"""Stages kept in buckets of their normalised key, so that joins on it need no shuffle.

The rows are shuffled once, when the stage is written; each join of two such stages then reads bucket next to bucket. Rows that would make
one bucket too large are kept beside the buckets: those without a key, and on request those of hot keys.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgap.functions.text import normalise_key
from labelgap.session import shuffle_width

_LAYOUT = "key string, buckets int, table_schema string, has_hot boolean"


@dataclass(frozen=True)
class BucketedTable:
    """``keyed`` is in buckets of ``key``; ``keyless`` holds the rows without one, ``hot`` those of hot keys, if any were set apart."""

    key: str
    buckets: int
    keyed: DataFrame
    keyless: DataFrame
    hot: DataFrame | None = None

    @property
    def columns(self) -> list[str]:
        return self.keyed.columns

    @property
    def sparkSession(self) -> SparkSession:  # noqa: N802, as a frame has it
        return self.keyed.sparkSession

    def frame(self) -> DataFrame:
        """All rows, in no buckets."""
        rows = self.keyed.unionByName(self.keyless)
        return rows if self.hot is None else rows.unionByName(self.hot)


def _table_name(path: str) -> str:
    return f"labelgap_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def write_bucketed(df: DataFrame, path: str, key: str = "code", buckets: int | None = None, hot_key_rows: int | None = None) -> BucketedTable:
    """Write a stage in buckets of its normalised key, replacing what lies there.

    Tables that are to be joined must have the same number of buckets; the default is the number of shuffle partitions.
    With ``hot_key_rows`` the keys are counted first, and the rows of those with more are kept beside the buckets; such a table can
    only be the left side of a join.
    """
    from labelgap.operators.joins import broadcast_if_small, hot_keys  # joins read this module's tables

    spark = df.sparkSession
    buckets = buckets or shuffle_width(spark)
    rows = df.withColumn(key, normalise_key(F.col(key), None))
    keyed = rows.filter(F.col(key).isNotNull())
    if hot_key_rows is not None:
        hot = hot_keys(rows, key, hot_key_rows).select(key)
        hot.write.mode("overwrite").parquet(f"{path}/hot_keys")
        few = broadcast_if_small(spark.read.schema(hot.schema).parquet(f"{path}/hot_keys"))
        keyed.join(few, key, "left_semi").write.mode("overwrite").parquet(f"{path}/hot")
        keyed = keyed.join(few, key, "left_anti")
    rows.filter(F.col(key).isNull()).write.mode("overwrite").parquet(f"{path}/keyless")
    # Dealt by the key first, each bucket is one file, whatever the number of tasks.
    writer = keyed.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
    writer.option("path", f"{path}/data").saveAsTable(_table_name(path))
    layout = [(key, buckets, rows.schema.json(), hot_key_rows is not None)]
    spark.createDataFrame(layout, _LAYOUT).coalesce(1).write.mode("overwrite").json(f"{path}/layout")
    return read_bucketed(spark, path)


def read_bucketed(spark: SparkSession, path: str) -> BucketedTable:
    """Open a stage that ``write_bucketed`` wrote, in this session or an earlier one."""
    layout = spark.read.schema(_LAYOUT).json(f"{path}/layout").first()
    schema = T.StructType.fromJson(json.loads(layout["table_schema"]))
    name, key = _table_name(path), layout["key"].replace("`", "``")
    if not spark.catalog.tableExists(name):
        # Files know nothing of their buckets; the session's catalog does.
        columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
        place = f"{path}/data".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {layout['buckets']} BUCKETS LOCATION '{place}'")
    part = lambda folder: spark.read.schema(schema).parquet(f"{path}/{folder}")
    return BucketedTable(layout["key"], layout["buckets"], spark.table(name), part("keyless"), part("hot") if layout["has_hot"] else None)

