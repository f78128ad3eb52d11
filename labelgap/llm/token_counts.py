"""Token counts of a corpus for every context limit, from an exact histogram of lengths."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgap.llm.pieces import in_slices
from labelgap.llm.prefix_bpe import read_ranks
from labelgap.llm.stages import numbered_texts, staged
from labelgap.llm.worker import kept
from labelgap.operators.prefix import running_totals


def _encoding(path: str, pattern: str):
    import tiktoken

    return kept(
        ("token_counts", path, pattern),
        lambda: tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={}),
    )


def encoded_lengths(df: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Tokens of each whole text: ``doc_id, n_tokens``; a null text has none."""

    def run(batches):
        for batch in batches:
            encode = _encoding(path, pattern).encode_ordinary
            lengths = [len(encode(text)) if text else 0 for part in in_slices(batch.column(1).to_pylist()) for text in part]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], ["doc_id", "n_tokens"])

    return numbered_texts(df, id_column, text_column).mapInArrow(run, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row per length that occurs, with what the sums over longer documents answer.

    ``n_tokens, n_docs, docs_at_least, tokens_at_least, total_docs,
    total_tokens, truncated_tokens``: the last is the corpus size when every
    document is cut at ``n_tokens``. Lengths are counted before anything is
    ordered, so one hot length costs a row per task; the sums run in value
    ranges and not in one task. No documents give no rows.
    """
    counts = lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")).withColumn("n_sum", F.col("n_tokens") * F.col("n_docs"))
    # The running totals read the counts more than once; the texts are encoded once.
    totals = running_totals(staged(counts, "lengths"), "n_tokens", ["n_docs", "n_sum"])
    docs = F.col("total_n_docs") - F.col("cum_n_docs") + F.col("n_docs")
    tokens = F.col("total_n_sum") - F.col("cum_n_sum") + F.col("n_sum")
    return totals.select(
        "n_tokens",
        "n_docs",
        docs.alias("docs_at_least"),
        tokens.alias("tokens_at_least"),
        F.col("total_n_docs").alias("total_docs"),
        F.col("total_n_sum").alias("total_tokens"),
        (F.col("total_n_sum") - tokens + docs * F.col("n_tokens")).alias("truncated_tokens"),
    )


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """Corpus size under each context limit, also those between lengths: ``context_limit, truncated_tokens``."""
    longer = [F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_docs")).alias(str(limit)) for limit in limits]
    one = histogram.agg(*longer)
    rows = F.array(*[F.struct(F.lit(limit).cast("long").alias("context_limit"), F.coalesce(F.col(f"`{limit}`"), F.lit(0)).alias("truncated_tokens")) for limit in limits])
    return one.select(F.inline(rows))


def length_quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """The least length that at least this share of the documents doesn't exceed: ``share, n_tokens``."""
    upto = F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")
    least = [F.min(F.when(upto >= F.lit(share) * F.col("total_docs"), F.col("n_tokens"))).alias(f"q{i}") for i, share in enumerate(shares)]
    rows = F.array(*[F.struct(F.lit(share).alias("share"), F.col(f"q{i}").alias("n_tokens")) for i, share in enumerate(shares)])
    return histogram.agg(*least).select(F.inline(rows))
