"""Stages in buckets of their key: the same rows as the plain join, without a shuffle."""

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from labelgap import plans
from labelgap.operators import joins
from labelgap.sources import BucketedTable, read_bucketed, write_bucketed

LEFT = "code string, language_case string, `odd name` int, energy_100g double"
RIGHT = "code string, energy_100g double, fat_100g double, tags array<string>"


@pytest.fixture(scope="module")
def sides(spark):
    left = [(f" {i % 60}\t" if i % 7 else None, f"case {i % 3}", i, -1.0) for i in range(300)] + [("hot ", "case", i, 0.0) for i in range(500)]
    right = [(str(i) if i % 9 else None, float(i), None if i % 4 else 1.0, ["x"]) for i in range(90)] + [("hot", 7.0, 8.0, []), ("5", -5.0, None, None)]
    return spark.createDataFrame(left, LEFT).repartition(5), spark.createDataFrame(right, RIGHT).repartition(3)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot_key_rows", [None, 100])
def test_join_of_buckets(spark, sides, tmp_path, no_broadcast, hot_key_rows):
    left, right = sides
    one = write_bucketed(left, str(tmp_path / "left's"), buckets=6, hot_key_rows=hot_key_rows)
    two = write_bucketed(right, str(tmp_path / "right"), buckets=6)
    joined = joins.left_join(one, two, "code", ["energy_100g", "fat_100g", "absent"])
    assert _rows(joined) == _rows(joins.left_join(left, right, "code", ["energy_100g", "fat_100g", "absent"]))
    if hot_key_rows is None:
        assert "Exchange" not in _plan(joined) and "SortMergeJoin" in _plan(joined)
        joined.collect()
        assert "Exchange" not in _plan(joined)  # nor after the plan was adapted
    else:
        assert one.hot.select("code").distinct().collect()[0][0] == "hot" and one.keyed.filter("code = 'hot'").count() == 0
        with pytest.raises(ValueError):
            joins.left_join(two, one, "code")
    assert _rows(one.frame()) == _rows(left.withColumn("code", F.regexp_replace("code", r"\s", "")))


def test_other_buckets_are_joined_all_the_same(spark, sides, tmp_path):
    left, right = sides
    one, two = write_bucketed(left, str(tmp_path / "left"), buckets=6), write_bucketed(right, str(tmp_path / "right"), buckets=4)
    expected = _rows(joins.left_join(left, right, "code", ["fat_100g"]))
    assert _rows(joins.left_join(one, two, "code", ["fat_100g"])) == expected
    assert _rows(joins.left_join(one, right, "code", ["fat_100g"])) == expected
    matched = joins.left_join(one, two, "code", ["fat_100g"], null_keys="match")
    assert _rows(matched) == _rows(joins.left_join(left, right, "code", ["fat_100g"], null_keys="match"))


def test_buckets_outlive_the_session(spark, sides, tmp_path, no_broadcast):
    left, right = sides
    for name, df in (("left", left), ("right", right)):
        write_bucketed(df, str(tmp_path / name), buckets=5)
    for table in [t.name for t in spark.catalog.listTables() if t.name.startswith("labelgap_")]:
        spark.sql(f"DROP TABLE {table}")  # what a new session knows: nothing
    one, two = (read_bucketed(spark, str(tmp_path / name)) for name in ("left", "right"))
    joined = joins.left_join(one, two, "code", ["fat_100g"])
    assert "Exchange" not in _plan(joined) and _rows(joined) == _rows(joins.left_join(left, right, "code", ["fat_100g"]))
    assert isinstance(one, BucketedTable) and isinstance(one.sparkSession, SparkSession)


def test_written_again_and_empty(spark, sides, tmp_path):
    left, right = sides
    path = str(tmp_path / "left")
    write_bucketed(left, path, buckets=3, hot_key_rows=100)
    again = write_bucketed(left.limit(0), path, buckets=3)
    assert again.frame().count() == 0 and again.hot is None
    assert joins.left_join(again, write_bucketed(right, str(tmp_path / "right"), buckets=3), "code").count() == 0


def test_the_join_sites_take_buckets(spark, tmp_path, no_broadcast):
    gap = spark.createDataFrame(
        [(str(i), "Gap (내수용)" if i % 2 else "English Only", "Snacks", [("main", f"Snack {i}")]) for i in range(40)],
        "code string, language_case string, category_top string, product_name array<struct<lang:string,text:string>>",
    )
    columns = ["energy_100g", "fat_100g", "saturated_fat_100g", "carbohydrates_100g", "sugars_100g", "proteins_100g", "sodium_100g", "salt_100g"]
    nutrients = spark.range(40).select(F.col("id").cast("string").alias("code"), *[(F.col("id") % 7).cast("double").alias(c) for c in columns], F.lit("milk").alias("allergens_tags"))
    one, two = write_bucketed(gap, str(tmp_path / "gap"), buckets=4), write_bucketed(nutrients, str(tmp_path / "nutrients"), buckets=4)
    merged = plans.merge_nutrients(one, two)
    assert "Exchange" not in _plan(merged) and _rows(merged) == _rows(plans.merge_nutrients(gap, nutrients))
    enriched = joins.enrich_if_absent(two, one)
    assert "Exchange" not in _plan(enriched) and _rows(enriched) == _rows(joins.enrich_if_absent(nutrients, gap))
    assert plans.draft_labels(one, two)["labels"].count() == 5
    assert plans.detector_model(two, labels=one, config=plans.Config(n_trees=2)).getNumTrees == 2
