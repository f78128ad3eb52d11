"""A mix of sources by a schedule of low discrepancy over blocks of equal size.

Every source gets a target of words by its weight, at most three times what it has. Its documents, shuffled by a digest, form a stream
that is cut into blocks of equal size; passes over the stream repeat it. The mix is a list of slots. Slot ``i`` has
the van der Corput point of ``i``, the bits of ``i`` mirrored; the point falls into one source's stretch of the cumulative
weights, counted in blocks, and the ``k``-th slot of a source takes its ``k``-th block. In every stretch of the mix each source is then
present by its weight, up to a few blocks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelgap.llm.stages import staged
from labelgap.operators.joins import broadcast_if_small
from labelgap.operators.prefix import running_totals

BLOCK_WORDS = 1024
MOST_PASSES = 3
#: Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
SEED = 13

#: Rows made from one row at once where a count is unfolded; more go over several tasks.
_UNFOLDED = 65_536
#: Copies of one row that are placed side by side.
_COPIES = 1_000


@dataclass(frozen=True)
class Mix:
    """``sources`` with their targets, ``documents`` with their places, ``slots`` of the schedule, and ``pieces``: what each slot takes."""

    sources: DataFrame
    documents: DataFrame
    slots: DataFrame
    pieces: DataFrame


def sized(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """``doc_id, source, size``: the words of each whole text; a null text has none."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            sizes = [len(t.split()) if t else 0 for t in texts]  # bytes are split at the six ASCII blanks only
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), pa.array(sizes, pa.int64())], ["doc_id", "source", "size"])

    named = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{source_column}`").cast("string").alias("source"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    return named.mapInArrow(run, "doc_id long, source string, size long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_passes: int = MOST_PASSES) -> DataFrame:
    """``source, source_no, source_size, n_rows, weight, target``: a row per source, in code-point order and null last.

    The targets share out all words by weight. A source whose share is above ``most_passes`` times its size stops there, and what it leaves goes
    to the others by weight until none is above: these are the sources with the least size per weight, found by one running
    total in that order. Any number of sources is fine; nothing of them is collected.
    """
    found = staged(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")), "sources")
    named = found.filter("source IS NOT NULL").withColumn("one", F.lit(1).cast("long"))
    ranked = running_totals(named, "source", ["one"]).withColumn("source_no", F.col("cum_one") - 1)
    columns = ["source", "source_no", "source_size", "n_rows"]
    last = found.filter("source IS NULL").withColumn("source_no", F.coalesce(named.agg(F.sum("one")).scalar(), F.lit(0)))
    numbered = ranked.select(*columns).unionByName(last.select(*columns))
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    rows = numbered.withColumn("weight", weight).withColumn("most", most_passes * F.col("source_size"))
    rows = staged(rows.withColumn("ratio", F.col("most") / F.col("weight")), "sources")

    totals = rows.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    words, all_weights = totals["words"] or 0, totals["weights"] or 0
    ratios = staged(rows.groupBy("ratio").agg(F.sum("most").alias("most"), F.sum("weight").alias("weight")), "ratios")
    along = running_totals(ratios, "ratio", ["most", "weight"])
    level = (F.lit(words) - (F.col("cum_most") - F.col("most"))) / (F.lit(all_weights) - (F.col("cum_weight") - F.col("weight")))
    full = along.filter(F.col("ratio") <= level).agg(F.max("ratio").alias("ratio"), F.sum("most").alias("most"), F.sum("weight").alias("weight")).first()
    stopped, taken, used = (-1.0, 0, 0) if full["ratio"] is None else (full["ratio"], full["most"], full["weight"])
    level = (words - taken) / (all_weights - used) if all_weights > used else 0.0
    target = F.when(F.col("ratio") <= F.lit(stopped), F.col("most").cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return staged(rows.withColumn("target", target).drop("most", "ratio"), "targets")


def _placed(sizes: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """``doc_id, size, source_no, start``: where each document with words begins in its source's shuffled stream.

    The order is that of an md5 digest. Sums run inside cells of one digest prefix, and a cell's first place is a sum over the cells
    before it; a source has about the square root of all rows as cells. Equal rows are counted first, placed up
    to a thousand at a time and unfolded at the end.
    """
    n_rows = sources.agg(F.sum("n_rows")).first()[0] or 0
    prefix = max(1, round(math.log(max(n_rows, 1), 16) / 2))
    by_source = broadcast_if_small(sources.select(F.col("source").alias("_source"), "source_no"))
    counted = sizes.filter("size > 0").groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n"))
    known = counted.join(by_source, F.col("source").eqNullSafe(F.col("_source"))).select("source_no", "doc_id", "size", "n")
    dealt = known.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("n") - 1, F.lit(_COPIES)))))
    digest = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size"), F.col("part"), F.lit(seed)))
    dealt = dealt.withColumn("digest", digest).withColumn("copies", F.least(F.lit(_COPIES), F.col("n") - F.col("part") * _COPIES))
    dealt = staged(dealt.select("source_no", "doc_id", "size", "copies", "digest", F.substring("digest", 1, prefix).alias("cell")), "shuffled")

    words = F.col("size") * F.col("copies")
    cells = dealt.groupBy("source_no", "cell").agg(F.sum(words).alias("words"))
    before = F.sum("words").over(Window.partitionBy("source_no").orderBy("cell")) - F.col("words")
    cells = cells.select("source_no", "cell", before.alias("before"))
    inside = F.sum(words).over(Window.partitionBy("source_no", "cell").orderBy("digest", "doc_id").rowsBetween(Window.unboundedPreceding, 0)) - words
    placed = dealt.withColumn("inside", inside).join(cells, ["source_no", "cell"])
    copy = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    return copy.select("doc_id", "size", "source_no", (F.col("before") + F.col("inside") + F.col("copy") * F.col("size")).alias("start"))


def mirrored(number: Column, bits: int) -> Column:
    """The number whose ``bits`` binary digits stand in reverse order: the van der Corput point times two to the ``bits``."""
    return F.conv(F.reverse(F.lpad(F.bin(number), bits, "0")), 2, 10).cast("long")


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``slot, source_no, pass, block, upto``: the slots of the mix in order, and the block each takes.

    A source's target in whole words is passes over all its blocks and a rest; ``upto`` is the place in the stream where the pass ends.
    Stretches of the cumulative weights are as long as the source has slots. Mirroring bits is its own inverse, so the
    slots of a stretch are listed, not searched: mirrored, its points are the slots. Slot numbers grow with
    the mix; numbers whose point lies behind the last stretch are left out.
    """
    ceil_div = lambda a: F.call_function("div", a + (block_words - 1), F.lit(block_words))
    rows = sources.filter("source_size > 0").select("source_no", "source_size", F.floor(F.col("target") + 0.5).alias("words"))
    rows = rows.withColumn("n_blocks", ceil_div(F.col("source_size"))).withColumn("passes", F.call_function("div", "words", "source_size"))
    rest = F.col("words") - F.col("passes") * F.col("source_size")
    rows = staged(rows.withColumn("n_slots", F.col("passes") * F.col("n_blocks") + ceil_div(rest)).filter("n_slots > 0"), "slots")
    stretches = running_totals(rows, "source_no", ["n_slots"]).withColumn("first", F.col("cum_n_slots") - F.col("n_slots"))
    n_slots = rows.agg(F.sum("n_slots")).first()[0] or 0
    bits = max(1, (max(n_slots, 1) - 1).bit_length())

    lots = F.sequence(F.col("first"), F.col("cum_n_slots") - 1, F.lit(_UNFOLDED).cast("long"))
    lots = stretches.select("source_no", "source_size", "words", "n_blocks", "cum_n_slots", F.explode(lots).alias("lot"))
    lots = lots.repartition("source_no", "lot")
    point = F.explode(F.sequence(F.col("lot"), F.least(F.col("cum_n_slots"), F.col("lot") + _UNFOLDED) - 1))
    slots = lots.select("source_no", "source_size", "words", "n_blocks", point.alias("point"))
    # Ranks run inside stretches of the mix, and a stretch begins with the number of the source's earlier slots.
    slots = slots.withColumn("slot", mirrored(F.col("point"), bits)).withColumn("lap", F.shiftright("slot", bits // 2))
    counts = slots.groupBy("source_no", "lap").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("source_no").orderBy("lap")) - F.col("n")
    counts = counts.select("source_no", "lap", earlier.alias("earlier"))
    inside = F.row_number().over(Window.partitionBy("source_no", "lap").orderBy("slot")) - 1
    ranked = slots.withColumn("inside", inside).join(counts, ["source_no", "lap"]).withColumn("rank", F.col("earlier") + F.col("inside"))
    turn = F.call_function("div", "rank", "n_blocks")
    end = F.least("source_size", F.col("words") - turn * F.col("source_size"))
    return ranked.select("slot", "source_no", turn.alias("pass"), (F.col("rank") % F.col("n_blocks")).alias("block"), end.alias("upto"))


def mix(
    docs: DataFrame, block_words: int = BLOCK_WORDS, weights: tuple[int, ...] = WEIGHTS, most_passes: int = MOST_PASSES, seed: int = SEED,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> Mix:
    """The mix of all documents. ``pieces`` holds ``source_no, start, doc_id, size, slot, pass, block, first_word, n_words``.

    A slot reads its pieces by ``start``; a document that the mix doesn't take has a null slot and no words. ``source_no`` and ``start`` name a document,
    also where ids repeat or are null. A text without words is in no block. What a source gives is its target to the
    word, so nothing exceeds ``most_passes`` times its size. The same rows give the same mix, however they are partitioned.
    """
    sizes = staged(sized(docs, id_column, text_column, source_column), "sizes")
    sources = source_targets(sizes, weights, most_passes)
    placed = _placed(sizes, sources, seed)
    slots = schedule(sources, block_words)
    to_block = lambda place: F.call_function("div", place, F.lit(block_words))
    blocks = F.sequence(to_block(F.col("start")), to_block(F.col("start") + F.col("size") - 1))
    cut = placed.withColumn("block", F.explode(blocks)).join(slots, ["source_no", "block"], "left")
    low = F.greatest("start", F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words, F.coalesce("upto", F.lit(0)))
    pieces = cut.select(
        "source_no", "start", "doc_id", "size", "slot", "pass", "block", (low - F.col("start")).alias("first_word"),
        F.greatest(high - low, F.lit(0).cast("long")).alias("n_words"),
    )
    return Mix(sources, sizes, slots, pieces)


def taken_words(made: Mix) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: a row per document, with the words that the mix takes from it, repeats counted."""
    taken = made.pieces.groupBy("source_no", "start", "doc_id", "size").agg(F.sum("n_words").alias("taken"))
    facts = broadcast_if_small(made.sources.select("source", "source_no", "source_size", "target"))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    some = taken.join(facts, "source_no").select(*columns)
    empty = made.documents.filter("size = 0").withColumnRenamed("source", "_source")
    none = empty.join(facts, F.col("_source").eqNullSafe(F.col("source"))).withColumn("taken", F.lit(0).cast("long"))
    return some.unionByName(none.select(*columns))
