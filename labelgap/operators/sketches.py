"""Distinct counts and frequent values over data that grows file by file.

Every file gets a sketch of each kind once, which is kept. Sketches of any files add up, so a total over all stages of a growing table reads
one small row per file, and only new files are read for themselves. Results are estimates with stated bounds.
"""

from __future__ import annotations

import math
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgap.session import folder_names

#: Logarithm of the registers of a distinct-count sketch.
LOG_REGISTERS = 12
#: Values that a sketch of frequent values keeps; with fewer values in the data its counts are exact.
TRACKED = 4_096


def sketch_files(df: DataFrame, column: str, log_registers: int = LOG_REGISTERS, tracked: int = TRACKED) -> DataFrame:
    """``file, column, n_rows, n_values, distinct, frequent``: a row per file that ``df`` reads, with its sketches of the column as text.

    Nulls are counted as rows, and are no values. Rows are folded inside each task, so a file of any size costs one row per task that reads part of it.
    """
    rows = df.select(F.input_file_name().alias("file"), F.col(f"`{column}`").cast("string").alias("value"))
    return rows.groupBy("file").agg(
        F.lit(column).alias("column"), F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_values"),
        F.hll_sketch_agg("value", log_registers).alias("distinct"),
        F.expr(f"approx_top_k_accumulate(value, {tracked}) FILTER (WHERE value IS NOT NULL)").alias("frequent"),
    )


def read_sketches(spark: SparkSession, store: str) -> DataFrame | None:
    """The sketches kept in ``store``, or None if there are none yet."""
    return spark.read.parquet(store) if any(name.startswith("part-") for name in folder_names(spark, store)) else None


def update_sketches(spark: SparkSession, source: str, store: str, column: str, log_registers: int = LOG_REGISTERS, tracked: int = TRACKED) -> int:
    """Sketch the files of a Parquet folder that ``store`` doesn't have yet for this column, and keep them there; gives their number.

    Files are told by their path: one that was changed in place counts as known. Files without rows have no sketch and are looked at again.
    """
    table = spark.read.parquet(source)
    kept = read_sketches(spark, store)
    known = set() if kept is None else {unquote(r["file"]) for r in kept.filter(F.col("column") == column).select("file").collect()}  # a path per file, as Spark's own listing
    new = [unquote(f) for f in table.inputFiles() if unquote(f) not in known]
    if new:
        part = spark.read.schema(table.schema).parquet(*new)
        sketch_files(part, column, log_registers, tracked).write.mode("append").parquet(store)
    return len(new)


def distinct_estimate(sketches: DataFrame, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """``column, n_rows, n_values, n_distinct, low, high``: over all files, with bounds that hold with three standard errors."""
    error = 3 * 1.04 / math.sqrt(2**log_registers)
    merged = sketches.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct")
    )
    return merged.withColumns({"low": F.floor(F.col("n_distinct") * (1 - error)), "high": F.ceil(F.col("n_distinct") * (1 + error))})


def frequent_values(sketches: DataFrame, k: int, tracked: int = TRACKED) -> DataFrame:
    """``column, value, n, most_off``: the ``k`` most frequent values over all files, whose counts are too high by ``most_off`` at most."""
    estimate = F.expr(f"approx_top_k_estimate(approx_top_k_combine(frequent, {tracked}), {k})")
    merged = sketches.groupBy("column").agg(F.sum("n_values").alias("n_values"), estimate.alias("top"))
    # The sketch's own bound: 3.5 over the size of its table, of which three quarters may be filled.
    off = F.ceil(F.col("n_values") * F.lit(3.5 * 0.75 / tracked))
    return merged.select("column", F.inline("top"), off.alias("most_off")).select("column", F.col("item").alias("value"), F.col("count").alias("n"), "most_off")
