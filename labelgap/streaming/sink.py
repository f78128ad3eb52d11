"""A sink for micro-batches whose rows count exactly once, over any number of restarts.

A batch writes every output into a folder of its own number and after that, as the last thing, its commit. A batch that was
cut off is run again under the same number and overwrites what it left; one whose commit is there is not run again. What
is read through ``committed_rows`` never shows part of a batch, nor one output without the other.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgap.operators.joins import broadcast_if_small
from labelgap.session import folder_names

BATCH = "batch"
_COMMIT = "output string, n_rows long"


def _commits(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/sink"


def committed_sink(
    prepare: Callable[[DataFrame], DataFrame], outputs: Mapping[str, Callable[[DataFrame], DataFrame]], checkpoint: str
) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch``.

    ``outputs`` maps each output folder to what it gets of the prepared batch. Commits lie in the stream's own checkpoint folder: whoever
    removes that to begin anew removes them, too, and the rows of the old run no longer count.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        commit = f"{_commits(checkpoint)}/{BATCH}={batch_id}"
        if any(name.startswith("part-") for name in folder_names(spark, commit)):
            return  # all was written and committed, and the stream ended before it took note
        prepared = prepare(batch).persist(StorageLevel.MEMORY_AND_DISK)  # read by every output
        try:
            rows = []
            for folder, take in outputs.items():
                taken, place = take(prepared), f"{folder.rstrip('/')}/{BATCH}={batch_id}"
                taken.write.mode("overwrite").parquet(place)
                rows.append((folder.rstrip("/"), spark.read.schema(taken.schema).parquet(place).count()))
        finally:
            prepared.unpersist()
        # One file: it is there whole when its job is committed, or not at all.
        spark.createDataFrame(rows, _COMMIT).coalesce(1).write.mode("overwrite").json(commit)

    return write


def commits(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``batch, output, n_rows``: what is committed, a row per batch and output."""
    schema = f"{_COMMIT}, {BATCH} long"
    if not folder_names(spark, _commits(checkpoint)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(_commits(checkpoint))


def committed_rows(spark: SparkSession, folder: str, checkpoint: str) -> DataFrame:
    """The rows of one output that are committed, with the number of their batch. Raises ``FileNotFoundError`` before the first batch."""
    if not folder_names(spark, folder):
        raise FileNotFoundError(f"no batch was written to {folder}")
    whole = commits(spark, checkpoint).filter(F.col("output") == folder.rstrip("/")).select(BATCH)
    rows = spark.read.parquet(folder).withColumn(BATCH, F.col(BATCH).cast("long"))
    return rows.join(broadcast_if_small(whole), BATCH, "left_semi")
