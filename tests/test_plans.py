"""The composed jobs on a small product table, from source to report."""

import pytest
from pyspark.sql import functions as F

from labelgap import plans
from labelgap.operators.detector import evaluate
from labelgap.fixed_values import MODEL_NUTRIENTS

SCHEMA = (
    "code string, product_name array<struct<lang:string,text:string>>, brands string, categories_tags array<string>, "
    "countries_tags array<string>, allergens_tags array<string>, labels_tags array<string>, nutriscore_grade string, "
    "nutriments array<struct<name:string,`100g`:float>>, ingredients_text array<struct<lang:string,text:string>>"
)


@pytest.fixture(scope="module")
def products(spark):
    rows = []
    for i in range(160):
        gap = i % 4 == 0
        rows.append((
            f" {i}\n" if i != 7 else None,
            [("main", f"Snack {i}")],
            "b",
            ["en:snacks"] if i % 2 == 0 else None,
            ["en:south-korea"] if i % 8 != 5 else ["en:ukraine"],
            ["en:milk"] if i % 3 == 0 else [],
            None,
            None if i % 5 == 0 else "a",
            [("energy-kcal", 400.0 + i if gap else 100.0 + i), ("fat", 30.0 + i % 7 if gap else float(i % 9)), ("sugars", float(i % 11))],
            [("ko", "과자")] if gap else [("en", "chips")],
        ))
    return spark.createDataFrame(rows, SCHEMA).cache()


def test_preprocess(spark, products, tmp_path):
    config = plans.Config(output=str(tmp_path / "out"))
    tables = plans.preprocess(products, config)
    assert tables["raw"].count() == 160  # the broad filter also takes a tag with kr inside
    assert tables["preprocessed"].filter("code = 'None'").count() == 1
    row = tables["categorical"].filter("code = '0'").first()
    assert (row["category_top"], row["has_milk"], row["nutriscore_grade"], row["labels_tags"]) == ("snacks", True, "missing", "missing")
    assert (tables["train"].count(), tables["test"].count()) == (128, 32)
    assert dict(tables["train"].dtypes)["category_top"] == "int"
    assert abs(tables["train"].agg(F.avg("energy_100g")).first()[0]) < 1e-9
    saved = spark.read.parquet(f"{config.output}/artifacts/encoder_map")
    assert {r["value"] for r in saved.filter("column = 'category_top'").collect()} == {"snacks", "missing"}


def test_documented_options(products):
    config = plans.Config(sparse_share=0.7, impute_by="categories_tags", clip={"energy_100g": (0.0, 450.0)}, scaler="minmax")
    tables = plans.preprocess(products, config)
    assert "labels_tags" not in tables["raw"].columns
    assert tables["preprocessed"].agg(F.max("energy_100g")).first()[0] == 450.0
    assert tables["train"].agg(F.min("fat_100g"), F.max("fat_100g")).first() == (0.0, 1.0)


def test_gap_to_labels(spark, products, tmp_path):
    config = plans.Config(output=str(tmp_path / "out"), n_trees=5, n_synthetic=100)
    preprocessed = plans.preprocess(products, config)["preprocessed"]
    gap = plans.gap_analysis(products, config)
    assert gap.count() == 140
    tables = plans.gap_tables(gap)
    assert {r["language_case"]: r["n"] for r in tables["cases"].collect()} == {"Gap (내수용)": 40, "English Only": 100}
    assert tables["gap_ratio"].first()["category_top"] == "Snacks" and tables["gap_ratio"].first()["gap_pct"] == 50.0

    merged = plans.merge_nutrients(gap, preprocessed, config)
    assert merged.count() == 140
    assert merged.filter("energy_100g is null").count() == merged.filter("code is null").count() == 1  # a null code matches nothing

    result = plans.synthesis_and_detector(merged, config=config)
    assert result["synthetic"].count() == 100 and result["augmented"].filter("is_synthetic = 1").count() == 100
    assert result["quality"].first()["accuracy"] > 0.8 and result["importance"].count() == 3

    validation = plans.validate(
        result["augmented"].filter("is_synthetic = 0"), result["augmented"].filter("is_synthetic = 1"),
        config=plans.Config(n_trees=3, output=str(tmp_path / "validation")),
    )
    assert validation["statistics"].count() == 5 and validation["key_pairs"].count() == 3 and validation["auroc"].count() == 3
    assert spark.read.csv(f"{tmp_path}/validation/auroc", header=True).count() == 3

    drafts = plans.draft_labels(gap, preprocessed, config=config)
    assert drafts["labels"].count() == 5 and drafts["failed"].count() == 0 and drafts["rejected"].count() == 0
    report = plans.report_labels(drafts["labels"], config)
    assert report["report"].count() == 3 and report["cards"].count() == 5
    assert report["flat"].first()["product_name_en"].startswith("Snack ")


def test_scoring_and_effect(products):
    config = plans.Config(n_trees=5)
    preprocessed = plans.preprocess(products, config)["preprocessed"]
    merged = plans.merge_nutrients(plans.gap_analysis(products, config), preprocessed, config)
    model = plans.detector_model(merged, config=config)
    scored = plans.risk_scores(model, merged)
    assert scored.filter("band = 'high'").count() == 40
    assert plans.effect_of_augmentation(merged, config=config).count() == 2


def test_labels_join_only_when_absent(products):
    config = plans.Config(n_trees=3)
    gap = plans.gap_analysis(products, config)
    preprocessed = plans.preprocess(products, config)["preprocessed"]
    model = plans.detector_model(preprocessed, labels=gap, config=config)
    assert evaluate(model, preprocessed.withColumn("target", F.lit(0)), MODEL_NUTRIENTS).first()["accuracy"] > 0.5


def test_other_text_forms(spark):
    from labelgap.plans.gap import add_language_case

    struct = spark.createDataFrame([(("ko", "x"),)], "ingredients_text struct<lang:string,text:string>")
    assert add_language_case(struct).first()["language_case"] == "Gap (내수용)"
    plain = spark.createDataFrame([("과자 chips",)], "ingredients_text string")
    assert add_language_case(plain).first()["language_case"] == "Compliant (수출/글로벌용)"
    none = spark.createDataFrame([(1,)], "x int")
    assert add_language_case(none).columns == ["x"]


def test_command_line(spark, products, tmp_path):
    from labelgap.__main__ import main

    source, out = str(tmp_path / "products"), str(tmp_path / "out")
    products.write.parquet(source)
    main(["preprocess", "--input", str(tmp_path / "absent"), source, "--output", out])
    main(["gap", "--input", source, "--output", out])
    main(["merge", "--gap", f"{out}/gap", "--preprocessed", f"{out}/preprocessed", "--output", out])
    main(["draft-labels", "--gap", f"{out}/gap", "--preprocessed", f"{out}/preprocessed", "--output", out])
    assert spark.read.csv(f"{out}/gap_gap_ratio", header=True).first()["category_top"] == "Snacks"
    assert spark.read.parquet(f"{out}/merged").count() == 140
    assert spark.read.parquet(f"{out}/labels").count() == 5
