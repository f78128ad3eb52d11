"""Sketches per file that add up, against exact counts."""

from pyspark.sql import functions as F

from labelgap.operators import sketches


def _table(spark, path, first, n):
    # A third of all rows have one value; the others have many.
    value = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 101 == 0, None).otherwise(F.concat(F.lit("v"), (F.col("id") * 7919) % 20_011))
    spark.range(first, first + n).select("id", value.alias("v")).repartition(3).write.mode("append").parquet(path)


def test_estimates_over_growing_files(spark, tmp_path):
    path, store, column = str(tmp_path / "t"), str(tmp_path / "store"), "v"
    for lot in range(3):
        _table(spark, path, lot * 30_000, 30_000)
    assert sketches.read_sketches(spark, store) is None
    n_files = len(spark.read.parquet(path).inputFiles())
    assert sketches.update_sketches(spark, path, store, column) == n_files
    assert sketches.update_sketches(spark, path, store, column) == 0
    spark.range(10).select("id", F.lit("late").alias("v")).coalesce(1).write.mode("append").parquet(path)
    assert sketches.update_sketches(spark, path, store, column) == 1
    kept, whole = sketches.read_sketches(spark, store), spark.read.parquet(path)
    found, exact = sketches.distinct_estimate(kept).first(), whole.agg(F.count(F.lit(1)), F.count("v"), F.count_distinct("v")).first()
    assert (found.n_rows, found.n_values) == (exact[0], exact[1]) and found.low <= exact[2] <= found.high and found.high - found.low < 0.12 * exact[2]
    counts = {r.v: r.n for r in whole.groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()}
    top = sketches.frequent_values(kept, 3).collect()
    assert top[0].value == "hot" and all(counts[r.value] <= r.n <= counts[r.value] + r.most_off for r in top)


def test_few_values_are_exact(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.when(F.col("id") % 10 != 0, F.col("id") % 7).alias("a.b")).repartition(5).write.parquet(path)
    made = sketches.sketch_files(spark.read.parquet(path), "a.b")
    assert made.count() == 5
    expected = {}
    for i in range(1000):
        if i % 10:
            expected[str(i % 7)] = expected.get(str(i % 7), 0) + 1
    assert {r.value: r.n for r in sketches.frequent_values(made, 50).collect()} == expected
    assert sketches.distinct_estimate(made).first()[1:4] == (1000, 900, 7)


def test_no_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([], "v string").write.parquet(path)
    sketches.update_sketches(spark, path, str(tmp_path / "store"), "v")
    kept = sketches.read_sketches(spark, str(tmp_path / "store"))
    assert kept is None or kept.count() == 0
