"""Texts that hold passages of a benchmark, also edited or paraphrased ones.

All runs of three words of the corpus are joined with the seeds of the benchmark: those runs of its items that are rare there.
A run that many items have, such as the opening of a kind of question, tells none of them from the others and is no seed. How many
texts hold a run doesn't matter, so a passage is found in any number of copies. Every
seed that a text shares with an item places the item in the text. Where the text around such places holds enough of the item's words at all, a
Smith-Waterman alignment of their words tells how much of the item is there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelgap.llm.grams import gram_rows
from labelgap.llm.grouped import one_by_one
from labelgap.llm.stages import numbered_texts, staged
from labelgap.llm.words import NO_LETTERS, WordHasher
from labelgap.operators.joins import broadcast_if_small

SEED_WORDS = 3
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
#: Score, as a share of the item's own length, from which a text counts as contaminated.
LEAST_SHARE = 0.5
#: Items that may have a run for it to be rare.
RARE_ITEMS = 100
#: Items that are sought in one reading of a text; for more the text is read again.
ITEMS_AT_ONCE = 64


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment of two lists of word hashes: its score, and the first and last word of it in the text (-1: none)."""
    n = len(text)
    along = GAP * np.arange(n + 1)
    above, begun = np.zeros(n + 1), np.arange(n + 1)
    best = (0.0, -1, -1)
    for word in item:
        step = np.where(text == word, MATCH, MISMATCH)
        score, start = np.zeros(n + 1), np.arange(n + 1)
        diagonal = above[:-1] + step
        better = diagonal > score[1:]
        score[1:][better], start[1:][better] = diagonal[better], begun[:-1][better]
        down = above + GAP
        better = down > score
        score[better], start[better] = down[better], begun[better]
        # A gap along the row: the best earlier cell, less the way from it.
        lifted = score - along
        running = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == running, np.arange(n + 1), 0))
        across = running + along
        better = across > score
        score[better], start[better] = across[better], start[source[better]]
        top = int(score.argmax())
        if score[top] > best[0]:
            best = (float(score[top]), int(start[top]), top - 1)
        above, begun = score, start
    return best


def may_reach(item: np.ndarray, text: np.ndarray, least: float) -> bool:
    """Whether an alignment can score ``least``; never false if one does, and much cheaper than to align.

    Such an alignment matches at least ``least`` words, and what it matches beyond that bounds its edits and so its length.
    """
    if np.isin(item, text).sum() * MATCH < least:
        return False
    matched = np.concatenate([[0], np.cumsum(np.isin(text, item))])
    longest = len(item) + int((MATCH * len(item) - least) / -max(MISMATCH, GAP)) + 1
    most = matched[-1] if len(text) <= longest else (matched[longest:] - matched[:-longest]).max()
    return bool(most * MATCH >= least)


def seeds(items: DataFrame, least_share: float = LEAST_SHARE, rare_items: int = RARE_ITEMS) -> DataFrame:
    """``item_id, item_place, gram``: the runs by which each item is sought, out of all its runs.

    These are the runs that at most ``rare_items`` items have. Where the other runs alone cover so much of an item that a
    text with nothing but them reaches ``least_share``, all of its runs are seeds.
    """
    common = items.groupBy("gram").agg(F.count_distinct("item_id").alias("n_items")).filter(F.col("n_items") > rare_items).select("gram", F.lit(True).alias("is_common"))
    marked = staged(items.join(broadcast_if_small(staged(common, "common")), "gram", "left"), "marked")
    covered = marked.filter("is_common").select("item_id", F.explode(F.sequence(F.col("item_place"), F.col("item_place") + (SEED_WORDS - 1))).alias("word"))
    covered = covered.groupBy("item_id").agg(F.count_distinct("word").alias("n_common"))
    lengths = marked.groupBy("item_id").agg((F.max("item_place") + SEED_WORDS).alias("n_words"))
    mostly = covered.join(lengths, "item_id").filter(F.col("n_common") >= F.lit(least_share) * F.col("n_words")).select("item_id", F.lit(True).alias("is_mostly"))
    chosen = marked.join(broadcast_if_small(staged(mostly, "mostly")), "item_id", "left").filter("is_common IS NULL OR is_mostly")
    return chosen.select("item_id", "item_place", "gram")


def seeded_pairs(texts: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, offsets``: every text and item that share a seed, and the places of the item in the text that these stand for."""
    hits = gram_rows(texts, SEED_WORDS, NO_LETTERS).join(broadcast_if_small(items), "gram")
    # Of all the places where a text and an item meet only their offsets matter, and each offset once.
    placed = hits.select("doc_id", "item_id", (F.col("place") - F.col("item_place")).alias("offset")).distinct()
    return placed.groupBy("doc_id", "item_id").agg(F.collect_list("offset").alias("offsets"))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, least_share: float = LEAST_SHARE, id_column: str = "doc_id", text_column: str = "text",
    rare_items: int = RARE_ITEMS,
) -> DataFrame:
    """Texts that hold an item or a good part of it: ``doc_id, item_id, score, share, first_word, last_word``.

    ``score`` is that of the best alignment, ``share`` that score over the item's number of words.
    A text is compared with the items it shares a seed with, see ``seeds``: a passage of which no seed is left whole is not found.
    An item of fewer than three words, or with a null id or text, is not looked for. A null text
    holds nothing, and a row with a null id is not reported. Rows with one id are one
    document, whose best row counts. Empty tables give an empty result.
    """
    texts = numbered_texts(docs, id_column, text_column).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    tests = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("item")).dropna()
    # Equal items are sought once and named again at the end.
    same = tests.groupBy("item").agg(F.min("item_id").alias("first_id"))
    distinct_items = same.select(F.col("first_id").alias("item_id"), "item")
    all_runs = staged(gram_rows(distinct_items, SEED_WORDS, NO_LETTERS, "item_id", "item").toDF("item_id", "item_place", "gram"), "items")
    pairs = seeded_pairs(texts, staged(seeds(all_runs, least_share, rare_items), "seeds"))
    named = pairs.join(broadcast_if_small(distinct_items), "item_id")
    # A row per text and lot of items: no text is repeated for each of its items, and no row grows with the benchmark.
    lots = F.call_function("div", F.count(F.lit(1)).over(Window.partitionBy("doc_id")) - 1, F.lit(ITEMS_AT_ONCE)) + 1
    dealt = named.withColumn("lots", lots).withColumn("lot", F.pmod(F.xxhash64("item_id"), F.col("lots")))
    sought = staged(dealt.groupBy("doc_id", "lot").agg(F.collect_list(F.struct("item_id", "offsets", "item")).alias("sought")), "candidates")
    whole = texts.join(broadcast_if_small(sought.select("doc_id").distinct()), "doc_id", "left_semi")
    joined = whole.join(sought, "doc_id").select("doc_id", "text", "sought")

    def run(batches):
        hasher = WordHasher(NO_LETTERS)

        def words(text):
            return np.concatenate([np.zeros(0, np.uint64), *[hashes for _, hashes in hasher.texts([text])]])

        for batch in batches:
            rows, known = [], {}
            for doc_id, text, pairs in zip(*map(one_by_one, batch.columns)):
                own = words(text)
                for pair in pairs:
                    item_id = pair["item_id"]
                    if item_id not in known:
                        known[item_id] = words(pair["item"])
                    item = known[item_id]
                    n = len(item)
                    best = (0.0, -1, -1)
                    ordered = np.unique(np.array(pair["offsets"]))
                    # Offsets closer than an item are one region, with half an item around it.
                    cuts = np.flatnonzero(np.diff(ordered) > n) + 1
                    for near in np.split(ordered, cuts):
                        start, end = max(0, int(near[0]) - n // 2), min(len(own), int(near[-1]) + n + n // 2)
                        if not may_reach(item, own[start:end], least_share * n):
                            continue
                        score, first, final = align(item, own[start:end])
                        if score > best[0]:
                            best = (score, first + start, final + start)
                    if best[0] >= least_share * n:
                        rows.append((doc_id, item_id, best[0], best[0] / n, best[1], best[2]))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], fields)

    fields = ["doc_id", "found_id", "score", "share", "first_word", "last_word"]
    found = joined.mapInArrow(run, "doc_id long, found_id long, score double, share double, first_word long, last_word long")
    best = found.groupBy("doc_id", "found_id").agg(F.max_by(F.struct("score", "share", "first_word", "last_word"), "score").alias("best"))
    names = tests.join(same, "item").select(F.col("first_id").alias("found_id"), "item_id").distinct()
    return best.join(names, "found_id").select("doc_id", "item_id", "best.*")
