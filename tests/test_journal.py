"""Completions are paid for once, whatever becomes of the job that asked for them."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from labelgap import plans
from labelgap.operators import journal, label_content


def _counting(folder, answer):
    """Answers prompts, and leaves a file per prompt sent."""
    os.makedirs(folder, exist_ok=True)

    def complete(prompts):
        texts = []
        for p in prompts:
            with open(os.path.join(folder, f"{os.getpid()}-{len(os.listdir(folder))}-{os.urandom(4).hex()}"), "w") as out:
                out.write(p)
            texts.append(answer(p))
        return texts

    return complete


def _sent(folder):
    return sorted(open(f).read() for f in glob.glob(f"{folder}/*"))


def _asked(spark, n):
    return spark.createDataFrame([(i, f"prompt {i % 70}") for i in range(n)] + [(-1, None)], "code long, prompt string").repartition(4)


def test_equal_prompts_are_sent_once(spark, tmp_path):
    path, log = str(tmp_path / "journal"), str(tmp_path / "log")
    found = journal.complete_once(_asked(spark, 100), path, _counting(log, str.upper), per_task=10).collect()
    assert len(found) == 101 and {r.text for r in found if r.code >= 0} == {f"PROMPT {i}" for i in range(70)}
    assert [(r.text, r.error) for r in found if r.code == -1] == [(None, "no prompt")]
    assert _sent(log) == sorted(f"prompt {i}" for i in range(70))
    again = journal.complete_once(_asked(spark, 200), path, _counting(log, str.upper), per_task=10)
    assert again.count() == 201 and len(_sent(log)) == 70
    other = journal.complete_once(_asked(spark, 5), path, _counting(log, str.lower), model="other").collect()
    assert len(_sent(log)) == 75 and {r.text for r in other} == {f"prompt {i}" for i in range(5)} | {None}


def test_a_lost_job_keeps_what_it_paid_for(spark, tmp_path):
    path, log = str(tmp_path / "journal"), str(tmp_path / "log")
    flag = tmp_path / "broken"
    flag.write_text("")

    def answer(prompt):
        if prompt == "prompt 42" and flag.exists():
            os._exit(1)  # the worker dies, and with it the job
        return prompt.upper()

    with pytest.raises(Exception):
        journal.complete_once(_asked(spark, 70), path, _counting(log, answer), per_task=2)
    kept = {r.text for r in journal.answers(spark, path).collect()}
    first = _sent(log)
    assert "PROMPT 42" not in kept and kept
    flag.unlink()
    found = journal.complete_once(_asked(spark, 70), path, _counting(log, answer), per_task=2)
    assert {r.text for r in found.collect()} == {f"PROMPT {i}" for i in range(70)} | {None}
    second = _sent(log)[:]
    for p in first:
        second.remove(p)
    assert not {p.upper() for p in second} & kept  # nothing that was in the journal is sent again
    assert len(second) == 70 - len(kept)
    # What was paid and lost was in the hands of tasks that had not ended, two prompts each.
    assert len(first) - len(kept) <= 2 * 9


def test_failures_are_asked_again(spark, tmp_path):
    path = str(tmp_path / "journal")

    def some(prompts):
        if any(p == "prompt 3" for p in prompts):
            raise ValueError("no answer")
        return list(prompts)

    found = {r.code: r for r in journal.complete_once(_asked(spark, 6), path, some).collect()}
    assert found[3].error == "ValueError: no answer" and found[3].text is None and found[4].error is None
    healed = {r.code: r for r in journal.complete_once(_asked(spark, 6), path, list).collect()}
    assert (healed[3].text, healed[3].error) == ("prompt 3", None)
    assert journal.read_journal(spark, path).count() == 7


def test_nothing_to_ask(spark, tmp_path):
    empty = spark.createDataFrame([], "code long, prompt string")
    assert journal.complete_once(empty, str(tmp_path / "journal"), list).count() == 0
    assert journal.answers(spark, str(tmp_path / "journal")).count() == 0


def test_labels_from_columns_are_those_of_the_prompt(spark):
    rows = [("1", 'Crisp "Thin"\t\\', 512.5, 30.25, 0.5, "en:milk,en:soy-beans"), ("2", None, 0.0, 1e-5, None, None), ("3", "과자 é", 1e7, 123456789.0, float("nan"), "missing")]
    df = spark.createDataFrame(rows, "code string, product_name string, energy_100g double, fat_100g double, sodium_100g double, allergens_tags string")
    for compat in (True, False):
        direct = {r.code: r.text for r in label_content.template_labels(df, compat=compat).collect()}
        prompted = label_content.complete_labels(label_content.add_prompt(df, compat), label_content.template_completion)
        assert direct == {r.code: r.text for r in prompted.collect()}
        assert all(json.loads(t.strip("`").removeprefix("json"))["serving_size"] == "100g" for t in direct.values())


def test_drafts_by_journal(spark, tmp_path):
    gap = spark.createDataFrame([(str(i), "Gap (내수용)", "Snacks", f"Snack {i}") for i in range(4)], "code string, language_case string, category_top string, product_name string")
    right = gap.select("code", *[F.lit(5.0).alias(c) for c in ("energy_100g", "fat_100g", "saturated_fat_100g", "carbohydrates_100g", "sugars_100g", "proteins_100g", "sodium_100g")], F.lit("en:milk").alias("allergens_tags"))
    log = str(tmp_path / "log")
    complete = _counting(log, lambda p: label_content.template_completion([p])[0])
    for _ in range(2):
        drafts = plans.draft_labels(gap, right, complete, journal=str(tmp_path / "journal"))
        assert drafts["labels"].count() == 4 and drafts["failed"].count() == 0
    assert len(_sent(log)) == 4
    assert sorted(map(str, plans.draft_labels(gap, right)["labels"].collect())) == sorted(map(str, drafts["labels"].collect()))


def test_a_prompt_is_formed_once(spark, tmp_path):
    formed = spark.sparkContext.accumulator(0)

    def form(i):
        formed.add(1)
        return f"prompt {i % 10}"

    rows = spark.range(40).select(F.col("id").alias("code"), F.udf(form, "string")("id").alias("prompt"))
    found = journal.complete_once(rows, str(tmp_path / "formed"), lambda prompts: list(prompts))
    assert {(r["code"], r["text"]) for r in found.collect()} == {(i, f"prompt {i % 10}") for i in range(40)}
    assert formed.value == 40
