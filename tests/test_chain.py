"""Chains that go on where they stopped."""

import time

import pytest
from pyspark.sql import functions as F

from labelgap import plans
from labelgap.plans import chain
from labelgap.session import folder_names, scratch_folder, scratch_scope, written

SCHEMA = "code string, categories_tags array<string>, countries_tags array<string>, nutriments array<struct<name:string,`100g`:float>>"


@pytest.fixture
def source(spark, tmp_path):
    rows = [
        (f"p{i}", ["en:snacks"] if i % 2 else None, ["en:south-korea"] if i % 5 else ["en:france"], [("energy-kcal", 100.0 + i), ("fat", float(i % 9))])
        for i in range(200)
    ]
    path = str(tmp_path / "products")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return path


def _counting(spark, path):
    """The products, and an accumulator of how many of them were read."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.read.parquet(path)
    return df.mapInArrow(count, df.schema), read


def test_a_killed_stage_goes_on(spark, source, tmp_path, monkeypatch):
    from labelgap.plans import preprocessing

    folder = str(tmp_path / "chain")
    real, failing = preprocessing.categorical_table, [True]

    def killed(table, config):
        broken = F.udf(lambda code: 1 / 0 if failing[0] and code.endswith("7") else code, "string")  # fails in a task, after rows were written
        return real(table, config).withColumn("code", broken("code"))

    monkeypatch.setattr(preprocessing, "categorical_table", killed)
    products, read = _counting(spark, source)
    with pytest.raises(plans.StageFailed) as failure:
        plans.preprocess_chain(products, folder)
    assert failure.value.stage == "categorical" and failure.value.__cause__ is not None
    assert read.value == 200
    assert sorted(folder_names(spark, folder)) == ["categorical", "preprocessed", "raw"]

    failing[0] = False
    products, read = _counting(spark, source)
    done = plans.preprocess_chain(products, folder)
    assert read.value == 0  # the source was not read again
    assert [name for name, stage in done.items() if stage.found] == ["raw", "preprocessed"]
    assert {n: s.n_rows for n, s in done.items()} == {n: s.table.count() for n, s in done.items()}
    assert (done["train"].n_rows, done["test"].n_rows) == (128, 32)

    again = plans.preprocess_chain(products, folder)
    assert all(stage.found for stage in again.values()) and read.value == 0
    report = {r.stage: (r.n_rows, r.found) for r in plans.stage_report(spark, again).collect()}
    assert report["split"] == (160, True) and len(report) == 9


def test_chain_agrees_with_the_plain_job(spark, source, tmp_path):
    products = spark.read.parquet(source)
    config = plans.Config(scaler="minmax", clip={"energy_100g": (0.0, 250.0)})
    plain = plans.preprocess(products, config)
    done = plans.preprocess_chain(products, str(tmp_path / "chain"), config)
    for name in ("raw", "preprocessed", "categorical", "train", "test", "scaler_params", "encoder_map", "feature_roles"):
        assert sorted(map(str, done[name].table.collect())) == sorted(map(str, plain[name].collect())), name


def test_only_what_depends_on_a_change_is_made_again(spark, source, tmp_path):
    folder, products = str(tmp_path / "chain"), spark.read.parquet(source)
    first = plans.preprocess_chain(products, folder)
    other = plans.preprocess_chain(products, folder, plans.Config(scaler="minmax"))
    assert [n for n, s in other.items() if not s.found] == ["scaler_params", "train", "test"]
    assert other["scaler_params"].table.first()["kind"] == "minmax"
    assert folder_names(spark, f"{folder}/train") == [other["train"].fingerprint]  # the old table is gone
    assert first["train"].fingerprint != other["train"].fingerprint

    time.sleep(1.1)  # times of change may be whole seconds
    spark.createDataFrame([("new", None, ["en:kr"], [])], SCHEMA).write.mode("append").parquet(source)
    grown = plans.preprocess_chain(spark.read.parquet(source), folder, plans.Config(scaler="minmax"))
    assert not any(stage.found for stage in grown.values()) and grown["raw"].n_rows == 161


def test_a_table_without_manifest_counts_for_nothing(spark, source, tmp_path):
    folder, products = str(tmp_path / "chain"), spark.read.parquet(source)
    stages = [plans.Stage("all", lambda df: df, ["products"]), plans.Stage("few", lambda df: df.limit(3), ["all"])]
    done = plans.run_stages(spark, stages, folder, {"products": products})
    assert [s.n_rows for s in done.values()] == [200, 3]
    chain.remove_folder(spark, f"{folder}/few/{done['few'].fingerprint}/manifest")
    spark.range(1).write.mode("overwrite").parquet(f"{folder}/few/{done['few'].fingerprint}/data")
    again = plans.run_stages(spark, stages, folder, {"products": products})
    assert [s.found for s in again.values()] == [True, False] and again["few"].table.count() == 3


def test_fingerprints(spark, source, tmp_path):
    df = spark.read.parquet(source)
    assert plans.source_fingerprint(df) == plans.source_fingerprint(df.filter("code = 'p1'"))
    assert plans.source_fingerprint(df) != plans.source_fingerprint(df.select("code"))
    with pytest.raises(ValueError):
        plans.source_fingerprint(spark.range(3))
    stage = [plans.Stage("numbers", lambda n: n, ["n"])]
    one = plans.run_stages(spark, stage, str(tmp_path / "n"), {"n": spark.range(3)}, {"n": "three"})
    two = plans.run_stages(spark, stage, str(tmp_path / "n"), {"n": spark.range(4)}, {"n": "four"}, keep_old=True)
    assert (one["numbers"].n_rows, two["numbers"].n_rows, len(folder_names(spark, str(tmp_path / "n" / "numbers")))) == (3, 4, 2)


def test_empty_source(spark, tmp_path):
    path = str(tmp_path / "empty")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    done = plans.preprocess_chain(spark.read.parquet(path), str(tmp_path / "chain"))
    assert {s.n_rows for n, s in done.items() if n not in ("scaler_params", "feature_roles")} == {0}


def test_scratch_tables_end_with_their_scope(spark):
    with scratch_scope(spark):
        table = written(spark.range(5), "five")
        inside = table.inputFiles()[0].rpartition("/")[0]
        assert table.count() == 5 and folder_names(spark, inside)
    assert folder_names(spark, inside) == []
    outside = scratch_folder(spark, "x")
    assert spark.sparkContext.applicationId in outside and scratch_folder(spark, "x") != outside


def test_validation_reads_each_table_once(spark, tmp_path):
    rows = [(float(i % 13), float(i % 7) * 3, None if i % 3 else 1.0, float(i)) for i in range(600)]
    columns = "energy_100g double, fat_100g double, sugars_100g double, extra double"
    for name, taken in (("original", rows[:400]), ("synthetic", [(*r[:2], None, r[3]) for r in rows[400:]])):
        spark.createDataFrame(taken, columns).write.parquet(str(tmp_path / name))
    original, read_original = _counting(spark, str(tmp_path / "original"))
    synthetic, read_synthetic = _counting(spark, str(tmp_path / "synthetic"))
    wanted = ["energy_100g", "fat_100g", "sugars_100g", "proteins_100g"]
    results = plans.validate(original, synthetic.drop("extra"), [*wanted, "extra"], plans.Config(n_trees=3), [("energy_100g", "fat_100g")])
    tables = {name: table.collect() for name, table in results.items()}
    assert (read_original.value, read_synthetic.value) == (400, 200)
    assert {r.variable for r in tables["statistics"]} == {"energy_100g", "fat_100g"}
    assert {r.variable: r.reason for r in tables["skipped"]} == {
        "sugars_100g": "no values in the synthetic", "proteins_100g": "not in the original", "extra": "not in the synthetic",
    }
    assert len(tables["correlations"]) == 4 and len(tables["key_pairs"]) == 1

