"""The registered queries on whole tables, and the pipeline against its stages by hand."""

import os
import re

import pytest

import corpus_pipeline
from labelgap.llm import registry
from labelgap.llm.queries import table
from oracle import connect, differences

FOLDER = os.environ.get("LABELGAP_TEST_TABLES", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")
registry.load()


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, name):
    assert differences(connect(FOLDER), registry.QUERIES[name](spark, FOLDER), registry.ORACLES[name]) == []


def test_one_query_per_operator():
    numbers = [int(m[1]) for name in registry.QUERIES if (m := re.match(r"op(\d+)_", name))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in registry.QUERIES


@pytest.mark.parametrize("name, key, source", [
    ("op1_license_diagonals", "doc_id", "documents"), ("op2_context_trees", "doc_id", "documents"), ("op3_prefix_bpe", "doc_id", "documents"),
    ("op5_path_ratios", "page_id", "pages"), ("op6_classifier_chain", "doc_id", "documents"), ("op9_token_file", "doc_id", "documents"), ("op13_source_schedule", "doc_id", "documents"),
])
def test_query_covers_its_table(spark, name, key, source):
    found = sorted(r[0] for r in registry.QUERIES[name](spark, FOLDER).select(key).collect())
    assert found == sorted(r[0] for r in table(spark, FOLDER, source).select(key).collect())


def test_pipeline(spark):
    docs = table(spark, FOLDER, "documents")
    kept = {r[0] for r in corpus_pipeline.run(spark, FOLDER).select("doc_id").collect()}
    toxic = {r[0] for r in registry.QUERIES["op6_classifier_chain"](spark, FOLDER).filter("is_toxic").select("doc_id").collect()}
    rest = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in toxic}

    def shingles(text):
        w = text.encode().lower().split()
        return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = {i: shingles(t) for i, t in rest.items()}
    least = {i: i for i in rest}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in range(20):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    clean = {i for i in rest if least[i] == i}
    leaks = {r[0] for r in registry.QUERIES["op4_contaminated"](spark, FOLDER).select("doc_id").collect()}
    assert kept == clean - leaks
    assert leaks and toxic and len(clean) < len(rest)


def test_stages_keep_odd_rows(spark):
    rows = [(1, "one two three four five six", "en", "s", 10), (1, "one two three four five six", "en", "s", 10), (2, None, None, None, None),
            (3, "", "en", "s", 0), (None, "no id", "en", "s", 5), (4, "One two three four five six", "en", "s", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, FOLDER)
        if name != "tokens":
            assert after.columns == docs.columns
        if name == "near_duplicates":
            assert sorted((r.doc_id for r in after.collect()), key=str) == [1, 2, 3, None]
        docs = after
    assert sorted((r.doc_id for r in docs.collect()), key=str) == [1, 2, 3, None]
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, FOLDER)
    assert empty.count() == 0
