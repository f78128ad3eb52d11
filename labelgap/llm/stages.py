"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgap.session import scratch_folder


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder for one intermediate table, which lives as long as the application; see ``scratch_folder``."""
    return scratch_folder(spark, f"llm-{name}")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several jobs read, and go on from the written table.

    This cuts the lineage: a lost executor costs the tasks it was running,
    and not the work that led to the table.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing will read again."""
    hadoop = df.sparkSession._jsc.hadoopConfiguration()
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)


def numbered_texts(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names: other columns may have any names, and are not read."""
    return df.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
