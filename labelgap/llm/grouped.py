"""Groups of rows in a task that reads them in order, and large groups cut into pairs of chunks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chunk_pairs(rows: DataFrame, key: str, member: Column, count: Column, chunk_rows: int) -> DataFrame:
    """Deal the rows of each group out so that any two meet in exactly one small group.

    A group of ``count`` rows has ``ceil(count / chunk_rows)`` chunks, drawn by a hash
    of ``member``; a row goes to one group per pair of its own with any chunk. Adds
    ``chunk``, and ``low`` and ``high``, the two chunks that meet. Rows come out
    partitioned and sorted by ``key, low, high``: the work of a huge group is spread over tasks.
    """
    chunks = F.ceil(count / F.lit(chunk_rows)).cast("int")
    with_chunk = rows.withColumn("_chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64(member), F.col("_chunks")).cast("int"))
    dealt = with_chunk.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    dealt = dealt.withColumn("low", F.least("chunk", "_other")).withColumn("high", F.greatest("chunk", "_other")).drop("_chunks", "_other")
    return dealt.repartition(key, "low", "high").sortWithinPartitions(key, "low", "high")


def one_by_one(column: pa.Array) -> Iterator:
    """The values of a column one by one: a batch of texts never stands as Python objects as a whole."""
    return (value.as_py() for value in column)


def groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The consecutive rows that agree in ``keys``, one table each, from rows sorted by them."""
    held: list[pa.Table] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [table.column(k).to_numpy() for k in keys]
        change = np.zeros(table.num_rows, dtype=bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), table.num_rows]
        for start, end in zip(starts, starts[1:]):
            key = tuple(column[start] for column in columns)
            if held and key != held_key:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(start, end - start))
            held_key = key
    if held:
        yield pa.concat_tables(held)
