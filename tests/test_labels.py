"""Label content from prompt to flat file."""

import json
import random
import textwrap

import pytest
from pyspark.sql import functions as F

from labelgap.fixed_values import PROMPT_TEMPLATE
from labelgap.operators import label_content
from labelgap.sources import read_csv_table, read_first_existing, read_label_json, write_csv_table, write_json_lines

LABELS = [
    {
        "product_name_en": "Rice Cracker & Co", "serving_size": "30g", "calories_per_serving": "102 kcal",
        "nutrition_facts": {"total_fat": "3.9g", "includes_added_sugars": "0g"},
        "allergen_statement": "Contains: Milk, Soy (from 'Cream')", "marketing_claims": ["No Flavors", "No Salt"],
        "original_code": "1",
    },
    {
        "product_name_en": "과자", "serving_size": "30g", "calories_per_serving": "73.5 kcal",
        "nutrition_facts": {"total_fat": "4.8g", "includes_x_syrups": "0g", "sodium": "28.5mg"},
        "allergen_statement": "Contains: Gluten", "marketing_claims": [], "original_code": "2",
    },
]


@pytest.fixture
def labels(spark, tmp_path):
    path = tmp_path / "labels.json"
    path.write_text(json.dumps(LABELS, indent=2, ensure_ascii=False), encoding="utf-8")
    return read_label_json(spark, str(path))


def test_flatten_and_write(spark, labels, tmp_path):
    flat = label_content.lists_as_text(label_content.flatten_json(labels))
    names = ["total_fat", "includes_added_sugars", "includes_x_syrups", "sodium"]
    assert set(flat.columns) == set(LABELS[0]) - {"nutrition_facts"} | {f"nutrition_facts.{n}" for n in names}
    rows = {r["original_code"]: r for r in flat.collect()}
    assert rows["1"]["marketing_claims"] == "['No Flavors', 'No Salt']" and rows["2"]["marketing_claims"] == "[]"
    assert rows["1"]["nutrition_facts.includes_x_syrups"] is None and rows["2"]["nutrition_facts.sodium"] == "28.5mg"
    write_csv_table(flat, str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True, escape='"')
    assert {r["allergen_statement"] for r in back.collect()} == {label["allergen_statement"] for label in LABELS}


def test_json_lines_round_trip(spark, labels, tmp_path):
    write_json_lines(labels, str(tmp_path / "lines"))
    text = "".join(r["value"] for r in spark.read.text(str(tmp_path / "lines")).collect())
    assert "과자" in text
    again = spark.read.json(str(tmp_path / "lines"), schema=labels.schema)
    assert {r["product_name_en"] for r in again.collect()} == {"Rice Cracker & Co", "과자"}


def test_csv_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "synthetic.csv"
    path.write_text(
        "energy_100g,fat_100g,sugars_100g,proteins_100g,sodium_100g,category_top,target\n1.5,2,3,4,5,6,1\n", encoding="utf-8-sig"
    )
    assert tuple(read_csv_table(spark, str(path)).first()) == (1.5, 2.0, 3.0, 4.0, 5.0, 6, 1)


def test_first_existing_path(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "b"))
    assert read_first_existing(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).count() == 3
    with pytest.raises(FileNotFoundError):
        read_first_existing(spark, [str(tmp_path / "a"), str(tmp_path / "c")])


def test_report_and_cards(labels):
    report = label_content.label_report(labels, k=1)
    assert report.columns[0] == "original_code" and [r["original_code"] for r in report.collect()] == ["1"]
    card = {r["original_code"]: r for r in label_content.label_card(labels).collect()}["2"]
    assert (card["calories"], card["sodium"], card["protein"]) == ("73.5", "28.5mg", "0g")
    wrapped = label_content.wrap_statement(label_content.label_card(labels)).orderBy("original_code").first()
    assert all(len(line) <= 40 for line in wrapped["statement_lines"])
    assert " ".join(wrapped["statement_lines"]) == LABELS[0]["allergen_statement"]


FACTS = (
    '{"Energy": "2 kcal", "Fat": "12.0g", "Saturated Fat": "0.0g", "Carbs": "1.5g", "Sugars": "0.0g", "Protein": "0.0g", "Sodium": "500mg"}'
)
PROMPT = PROMPT_TEMPLATE.replace("<<name>>", "Chips").replace("<<nutrition>>", FACTS).replace("<<allergens>>", "milk, tree nuts")


def test_wrapping_is_that_of_the_library(spark):
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice(["a", "word", "longer-word", "x" * rnd.randrange(1, 60), "tab\tbed", "two\nlines", "semi-detached-house"]) for _ in range(rnd.randrange(40))) for _ in range(80)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, ""])], "i int, allergen_statement string")
    found = {r["i"]: r["statement_lines"] for r in label_content.wrap_statement(rows).collect()}
    for i, t in enumerate(texts):
        assert "".join(found[i]).replace(" ", "") == "".join(t.split())
        assert all(len(line) <= 40 for line in found[i])
        if not any(len(w) > 40 for w in t.split()):
            assert found[i] == textwrap.wrap(" ".join(t.split()), width=40)
    assert found[80] == found[81] == []


def test_wrapping_is_one_pass_over_the_text(spark):
    text = " ".join(["word"] * 40_000)  # a fold over words that copies its lines takes minutes
    long = "y" * 40 + " " + "x" * 90 + " semi-detached ab"
    rows = spark.createDataFrame([(0, text), (1, long), (2, "ab " + "z" * 50), (3, "v" * 39 + " " + "w" * 41)], "i int, allergen_statement string")
    wrapped = label_content.wrap_statement(rows)
    assert "aggregate(" not in wrapped._jdf.queryExecution().optimizedPlan().toString()
    found = {r["i"]: r["statement_lines"] for r in wrapped.collect()}
    assert found[0] == [" ".join(["word"] * 8)] * 5000
    assert found[1] == ["y" * 40, " " + "x" * 39, "x" * 40, "x" * 11 + " semi-detached ab"]
    assert found[2] == ["ab " + "z" * 37, "z" * 13]
    assert found[3] == ["v" * 39, "w" * 40, "w"]


def test_prompt(spark):
    df = spark.createDataFrame(
        [("1", "Chips", 2.5, 12.0, 0.0, 1.5, 0.5, "en:milk,en:tree-nuts")],
        "code string, product_name string, energy_100g double, fat_100g double, saturated_fat_100g double, "
        "carbohydrates_100g double, sodium_100g double, allergens_tags string",
    ).withColumns({"sugars_100g": F.lit(0.0), "proteins_100g": F.lit(0.0)})
    assert label_content.add_prompt(df).first()["prompt"] == PROMPT
    bare = label_content.add_prompt(df.select("code")).first()["prompt"]
    assert "Original Name: Unknown Snack" in bare and '"Sodium": "0mg"' in bare and "Unknown (Infer from name)" in bare


def test_completion_failures_are_kept_apart(spark):
    df = spark.createDataFrame([(str(i), "bad" if i == 3 else f"p{i}") for i in range(6)], "code string, prompt string")

    def complete(prompts):
        if "bad" in prompts:
            raise RuntimeError("refused")
        return ['```json\n{"product_name_en": "' + p + '"}\n```' if p != "p4" else "sorry" for p in prompts]

    done = label_content.complete_labels(df, complete)
    assert {r["code"]: r["error"] for r in done.filter("error is not null").collect()} == {"3": "RuntimeError: refused"}
    many = label_content.complete_labels(spark.createDataFrame([(str(i), f"p{i}") for i in range(40)], "code string, prompt string"), complete)
    assert many.filter("error is null").count() == 40
    good, bad = label_content.parse_labels(done.filter("error is null"))
    assert {(r["original_code"], r["product_name_en"]) for r in good.collect()} == {(i, f"p{i}") for i in "0125"}
    assert [tuple(r) for r in bad.collect()] == [("4", "sorry")]


def test_template_completion():
    label = json.loads(label_content.template_completion([PROMPT])[0].strip("`").removeprefix("json"))
    assert label["product_name_en"] == "Chips" and label["nutrition_facts"]["sodium"] == "500mg"
    assert label["allergen_statement"] == "Contains: milk, tree nuts"


def test_candidates(spark):
    rows = [("3", "Gap (내수용)", "Snacks", 1.0), ("1", "Gap (내수용)", "Snacks", 2.0), ("2", "Gap (내수용)", "Snacks", 0.0),
            ("4", "English Only", "Snacks", 5.0), ("5", "Gap (내수용)", "Sauces", 5.0)]
    df = spark.createDataFrame(rows, "code string, language_case string, category_top string, energy_100g double")
    assert [r["code"] for r in label_content.label_candidates(df).collect()] == ["1", "3"]
    assert label_content.label_candidates(df, k=1).count() == 1
