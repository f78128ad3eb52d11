"""From raw documents to token ids: toxic, repeated and contaminated documents go, the rest is encoded.

Each stage takes the documents the one before it kept, and is written as Parquet before the next reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgap.llm.decontaminate import contaminated
from labelgap.llm.minhash import near_duplicates
from labelgap.llm.prefix_bpe import encoding_digests
from labelgap.llm.queries import CATEGORIES, MULTI_RANKS, TOXIC_FROM, quality_and_toxicity, table
from labelgap.llm.registry import query
from labelgap.llm.stages import staged
from labelgap.llm.toxicity import probability, train


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is below the threshold; a null text is kept."""
    chain = train(docs, quality_and_toxicity(spark, sf_dir), CATEGORIES)
    return docs.filter(probability(chain, CATEGORIES[-1])(F.col("text")) < TOXIC_FROM)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id; of rows with one id, one."""
    kept = near_duplicates(docs).filter("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("kept_id")).distinct()
    first = docs.filter("doc_id IS NOT NULL").join(kept, F.col("doc_id") == F.col("kept_id"), "left_semi").dropDuplicates(["doc_id"])
    return first.unionByName(docs.filter("doc_id IS NULL"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("found_id")).distinct()
    return docs.join(found, F.col("doc_id") == F.col("found_id"), "left_anti")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes they decode to."""
    return encoding_digests(docs, MULTI_RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("benchmark", without_benchmark),
    ("tokens", encoded),
]

#: A fitted model, similarities of sets and a tokenizer decide; tests hold the rows against a brute-force version.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
