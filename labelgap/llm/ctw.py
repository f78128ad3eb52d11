"""Code lengths of texts by context-tree weighting over bytes.

A byte is eight binary decisions; each decision has a tree of contexts, the
bytes before it from none to ``order``. In every node a Krichevsky-Trofimov
estimate predicts the decision from how it fell there before, and the tree mixes
the estimates of all depths: a node weighs its own estimate against what the
nodes below it say by how well either would have coded the learning texts.

The counts come from all learning texts and have no bound but that of the corpus, so they are tables
and are never sent whole to a task. Texts are dealt into blocks of a fixed size. A block names the runs of
bytes and the words that it holds, each once, with its own counts of them. These are dealt into blocks of the
vocabulary, which sum the counts of the deepest nodes. Spark grows the tree from there to the root by
grouping, and what was found about a run or a word goes back to the blocks of texts that
named it. A task holds one block and its answers. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelgap.llm.pieces import in_slices
from labelgap.llm.stages import staged, text_bytes
from labelgap.llm.words import BLANKS, WordHasher, mixed

#: Bytes of context in the deepest nodes.
ORDER = 5
#: Bytes of text in a block.
BLOCK_BYTES = 32 << 20
#: Distinct runs of all its blocks that a task gathers before it passes them on.
MOST_RUNS = 6_000_000
#: Bytes of text whose runs are arrays at once.
_SLICE = 1 << 19
#: Numbers and counts that are held apart before they are merged.
_APART = 1 << 21
#: Stands behind a text; no UTF-8 text holds this byte, so the model gives the texts' ends their share.
_END = b"\xff"


def _log_gamma(x, ln):
    """Of numbers from a half on, columns or arrays: Stirling's series at x + 8, carried back."""
    z = x + 8
    series = (z - 0.5) * ln(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z)
    product = x
    for i in range(1, 8):
        product = product * (x + i)
    return series - ln(product)


def _log_estimate(zeros, ones, ln):
    """Log of the Krichevsky-Trofimov probability of some decisions in any order."""
    return _log_gamma(zeros + 0.5, ln) + _log_gamma(ones + 0.5, ln) - _log_gamma(zeros + ones + 1.0, ln) - math.log(math.pi)


def _leaves(grams: np.ndarray, n: np.ndarray):
    """For each of the eight decisions on the last byte of sorted runs: the nodes with their counts, each run's node and its bit.

    A node is its context, eight bits on, and the bits of the byte so far led by a one.
    """
    context, byte = grams >> 8, grams & 0xFF
    for at in range(8):
        node = context << 8 | 1 << at | byte >> (8 - at)
        bit = byte >> (7 - at) & 1
        first = np.flatnonzero(np.diff(node, prepend=-1))
        zeros, ones = (np.add.reduceat(n * (bit == b), first) if len(first) else n for b in (0, 1))
        yield node[first], zeros.astype(np.float64), ones.astype(np.float64), np.cumsum(np.diff(node, prepend=-1) != 0) - 1, bit


def _upper(node: np.ndarray, order: int) -> np.ndarray:
    """The same decision in the context that is a byte shorter."""
    return node & ((1 << (8 * order)) - 1)


def paths(nodes: DataFrame, order: int) -> DataFrame:
    """What the tree says above its deepest nodes: ``settled`` and ``left``, so that the probability of a one in a deepest
    node is ``settled + left * its own estimate``.

    ``nodes`` are those one byte above the deepest: ``vocabulary, context, node, zeros, ones, below``, the last
    being the log of the probability that the deepest nodes give to all that was learnt there.
    """
    depth = order - 1
    levels: list[DataFrame] = []
    while True:
        zeros, ones = F.col("zeros").cast("double"), F.col("ones").cast("double")
        own = nodes.withColumn("own", _log_estimate(zeros, ones, F.ln))
        high, low = F.greatest("own", "below"), F.least("own", "below")
        weighted = high + F.log1p(F.exp(low - high)) - math.log(2)
        # What the node's own estimate weighs against the nodes below.
        share = 1 / (1 + F.exp(F.least(F.lit(700.0), F.col("below") - F.col("own"))))
        levels.insert(0, staged(own.withColumns({"weighted": weighted, "share": share}).drop("own", "below"), "tree"))
        if not depth:
            break
        depth -= 1
        shorter = F.col("context").bitwiseAND(F.lit((1 << (8 * depth)) - 1)).alias("context")
        nodes = levels[0].groupBy(shorter, "node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below"))

    estimate = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
    path = levels[0].withColumns({"settled": F.col("share") * estimate, "left": 1 - F.col("share")})
    for depth in range(1, order):
        above = path.select(F.col("context").alias("upper"), "node", F.col("settled").alias("settled_above"), F.col("left").alias("left_above"))
        if depth <= 2:
            above = F.broadcast(above)  # at most 255 * 256 rows of four numbers
        upper = F.col("context").bitwiseAND(F.lit((1 << (8 * (depth - 1))) - 1))
        here = levels[depth].withColumn("upper", upper).join(above, ["upper", "node"])
        settled = F.col("settled_above") + F.col("left_above") * F.col("share") * estimate
        path = here.withColumns({"settled": settled, "left": F.col("left_above") * (1 - F.col("share"))})
    return path.select("vocabulary", "context", "node", "settled", "left")


# What the blocks of the vocabulary tell about its words, in the place of a context.
_TOKENS, _DISTINCT, _ENDS = -1, -2, -3


def _lowered(text: str | None) -> bytes:
    return text.encode().lower() if text else b""


def _runs_of(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All runs of ``order + 1`` bytes that end in a text or with its end, with zeros before its first byte; and how many each text has."""
    lead = b"\0" * order
    data = np.frombuffer(b"".join([lead + t + _END for t in texts]), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    found = np.zeros(max(len(data) - order, 0), dtype=np.uint64)
    for i in range(order + 1 if len(found) else 0):
        found = (found << np.uint64(8)) | data[i : i + len(found)]
    keep = np.ones(len(found), dtype=bool)
    # The runs that end in the next text's lead belong to none.
    ends = np.cumsum(lengths + order)[:-1] - order
    keep[(ends[:, None] + np.arange(order)).ravel()] = False
    return found[keep].astype(np.int64), lengths


def _text_slices(texts: pa.Array | pa.ChunkedArray):
    """Consecutive lists of texts of about ``_SLICE`` bytes; a longer text stands alone."""
    sizes = pc.binary_length(texts).to_pylist()
    for part in in_slices(range(len(texts)), _SLICE, lambda i: sizes[i] or 0):
        yield texts.slice(part.start, len(part)).to_pylist()


def _merged(values: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the sums of their counts."""
    whole = np.concatenate([np.zeros(0, np.int64), *values])
    order = np.argsort(whole)
    whole = whole[order]
    first = np.flatnonzero(np.concatenate([whole[:1] == whole[:1], whole[1:] != whole[:-1]]))
    n = np.concatenate([np.zeros(0, np.int64), *counts])[order]
    return whole[first], np.add.reduceat(n, first) if len(first) else n


# Columns of packs and answers are compressed arrays: a pack holds what one block of texts and one of the vocabulary share.
def _pack(data: bytes | np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data if isinstance(data, bytes) else data.tobytes())


def _unpack(data: bytes, kind=None):
    plain = zstandard.ZstdDecompressor().decompress(data)
    return plain if kind is None else np.frombuffer(plain, kind)


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=np.int64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.int64))


_PACK = {"vocabulary": pa.int32(), "block": pa.int64(), "n_texts": pa.int64(), **dict.fromkeys(("words", "counts", "grams", "gram_counts"), pa.binary())}
_ANSWER = {"block": pa.int64(), **dict.fromkeys(("words", "counts", "grams", "codes"), pa.binary())}


def _batch(rows: list[tuple], fields: dict) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields.values())], list(fields))


class _Counted:
    """Distinct numbers and how often they were learnt, from many small lists."""

    def __init__(self):
        self.values: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, values: np.ndarray, learns: bool) -> None:
        distinct, n = np.unique(values, return_counts=True)
        self.values.append(distinct)
        self.counts.append(n if learns else np.zeros(len(n), np.int64))
        self.size += len(distinct)
        if self.size > _APART:
            self.values, self.counts = ([x] for x in _merged(self.values, self.counts))
            self.size = len(self.values[0]) // 2

    def packs(self, home, n_vocabulary: int) -> list[tuple[bytes, bytes]]:
        """The numbers that are at home in each block of the vocabulary, and their counts."""
        values, counts = _merged(self.values, self.counts)
        where = (mixed(home(values).astype(np.uint64)) % np.uint64(n_vocabulary)).astype(np.int64)
        order = np.argsort(where, kind="stable")
        cuts = np.searchsorted(where[order], np.arange(1, n_vocabulary))
        return [(_pack_sorted(v), _pack(c)) for v, c in zip(np.split(values[order], cuts), np.split(counts[order], cuts))]


class _Gathered:
    """Words and runs of a block of texts, and how many learning texts it has."""

    def __init__(self):
        self.words, self.grams, self.texts = _Counted(), _Counted(), 0


def _gather(n_vocabulary: int, order: int):
    """What each block of texts holds, by block of the vocabulary. A run is at home with all runs that differ in the first byte only."""

    def run(batches):
        found: dict[int, _Gathered] = {}
        hasher = WordHasher(BLANKS)

        def told():
            for block in list(found):
                own = found.pop(block)
                words = own.words.packs(lambda w: w, n_vocabulary)
                grams = own.grams.packs(lambda g: _upper(g, order) >> 8, n_vocabulary)
                rows = [(v, block, own.texts * (v == 0), *words[v], *grams[v]) for v in range(n_vocabulary)]
                for at in range(0, len(rows), 64):
                    yield _batch(rows[at : at + 64], _PACK)

        for batch in batches:
            blocks, learns, texts = batch.column(0).to_numpy(), np.array(batch.column(1).to_pylist(), dtype=bool), batch.column(2)
            for block in np.unique(blocks).tolist():
                own = found.setdefault(block, _Gathered())
                for learning in (True, False):
                    rows = np.flatnonzero((blocks == block) & (learns == learning))
                    own.texts += len(rows) * learning
                    for part in _text_slices(texts.take(pa.array(rows))):
                        for _, hashes in hasher.texts(part):
                            own.words.add(hashes.astype(np.int64), learning)
                        own.grams.add(_runs_of([_lowered(t) for t in part], order)[0], learning)
            if sum(own.grams.size for own in found.values()) > MOST_RUNS:
                yield from told()  # a block may be told about in several packs
        yield from told()

    return run


def _of_packs(packs: pa.Table, values: str, counts: str) -> tuple[np.ndarray, np.ndarray]:
    return _merged([_unpack_sorted(v) for v in packs.column(values).to_pylist()], [_unpack(c, np.int64) for c in packs.column(counts).to_pylist()])


def _asked(order: int):
    """The nodes above the deepest ones of a block of the vocabulary, and the size of its learnt words."""

    def of(packs: pa.Table) -> pa.Table:
        vocabulary = packs.column("vocabulary")[0].as_py()
        words = _of_packs(packs, "words", "counts")[1]
        told = [(_TOKENS, int(words.sum())), (_DISTINCT, int((words > 0).sum())), (_ENDS, sum(packs.column("n_texts").to_pylist()))]
        columns = [[np.array([t[0] for t in told])], [np.zeros(3, np.int64)], [np.array([t[1] for t in told])], [np.zeros(3, np.int64)], [np.zeros(3)]]
        for node, zeros, ones, _, _ in _leaves(*_of_packs(packs, "grams", "gram_counts")):
            upper, where = np.unique(_upper(node, order), return_inverse=True)
            sums = [np.bincount(where, x, len(upper)) for x in (zeros, ones, _log_estimate(zeros, ones, np.log))]
            for column, values in zip(columns, (upper >> 8, upper & 0xFF, sums[0].astype(np.int64), sums[1].astype(np.int64), sums[2])):
                column.append(values)
        context, node, zeros, ones, below = map(np.concatenate, columns)
        return pa.table({
            "vocabulary": pa.array(np.full(len(context), vocabulary, np.int32)), "context": context, "node": node.astype(np.int32),
            "zeros": zeros, "ones": ones, "below": below,
        })

    return of


def _told(order: int):
    """For every block of texts that asked this block of the vocabulary: its words' counts and its runs' codes."""

    def of(packs: pa.Table, above: pa.Table) -> pa.Table:
        words, word_counts = _of_packs(packs, "words", "counts")
        grams, gram_counts = _of_packs(packs, "grams", "gram_counts")
        key = above.column("context").to_numpy() << 8 | above.column("node").to_numpy().astype(np.int64)
        by_key = np.argsort(key)
        key, settled, left = key[by_key], above.column("settled").to_numpy()[by_key], above.column("left").to_numpy()[by_key]
        codes = np.zeros(len(grams))
        for node, zeros, ones, own, bit in _leaves(grams, gram_counts):
            at = np.searchsorted(key, _upper(node, order))
            one = (settled[at] + left[at] * (ones + 0.5) / (zeros + ones + 1))[own]
            codes += np.log10(np.where(bit == 1, one, 1 - one))
        rows = []
        for block, packed_words, packed_grams in zip(*(packs.column(c).to_pylist() for c in ("block", "words", "grams"))):
            n = word_counts[np.searchsorted(words, _unpack_sorted(packed_words))]
            code = codes[np.searchsorted(grams, _unpack_sorted(packed_grams))].astype(np.float32)
            rows.append((block, packed_words, _pack(n), packed_grams, _pack(code)))
        return pa.Table.from_batches([_batch(rows, _ANSWER)])

    return of


def _scored(order: int, tokens: int, distinct: int, ends: int):
    """Scores of a block's texts from the answers it got."""
    train_tokens = tokens + ends
    whole = train_tokens + distinct + (ends > 0) + 1
    end_score = math.log10((ends + 1) / whole)

    def of(texts: pa.Table, told: pa.Table) -> pa.Table:
        hasher = WordHasher(BLANKS)

        def table(values: str, numbers: str, kind) -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([np.zeros(0, np.int64), *[_unpack_sorted(v.as_py()) for v in told.column(values)]])
            by_key = np.argsort(keys)
            found = np.concatenate([np.zeros(0, kind), *[_unpack(x.as_py(), kind) for x in told.column(numbers)]])
            return keys[by_key], found[by_key]

        def looked_up(values: np.ndarray, keys: np.ndarray, numbers: np.ndarray) -> np.ndarray:
            coded = pa.array(values).dictionary_encode()  # a search for each distinct value only
            return numbers[np.searchsorted(keys, coded.dictionary.to_numpy())].astype(np.float64)[coded.indices.to_numpy()]

        words, grams = table("words", "counts", np.int64), table("grams", "codes", np.float32)
        n_tokens, n_known, base, score = ([np.zeros(0)] for _ in range(4))
        for part in _text_slices(texts.column("text")):
            for counts, hashes in hasher.texts(part):
                found = looked_up(hashes.astype(np.int64), *words)
                owner = np.repeat(np.arange(len(counts)), counts)
                n_tokens.append(counts + 1)
                n_known.append(np.bincount(owner, found > 0, len(counts)) + (ends > 0))
                base.append(np.bincount(owner, np.log10((found + 1) / whole), len(counts)) + end_score)
            found, lengths = _runs_of([_lowered(t) for t in part], order)
            # Every text has a run at least, that at its end.
            score.append(np.add.reduceat(looked_up(found, *grams), np.cumsum(lengths) - lengths))
        numbers = [np.concatenate(x) for x in (n_tokens, n_known, base, score)]
        symbols = np.array([s or 0 for s in pc.binary_length(texts.column("text")).to_pylist()], np.int64) + 1
        return pa.table({
            "doc_id": texts.column("doc_id"), "held_out": pa.array([not x for x in texts.column("learns").to_pylist()], pa.bool_()),
            "n_tokens": numbers[0].astype(np.int64), "n_known": numbers[1].astype(np.int64),
            "train_tokens": np.full(texts.num_rows, train_tokens, np.int64), "base_score": numbers[2], "score": numbers[3],
            "bits_per_byte": -numbers[3] / (math.log10(2) * symbols),
        })

    return of


def score_texts(
    df: DataFrame, learns: Column, order: int = ORDER, block_bytes: int = BLOCK_BYTES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Log10 probability of every whole text, from a model of the texts where ``learns`` holds.

    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``. Both models read the text with A-Z in lower
    case. ``score`` is the context tree's, over all its bytes and its end, and ``bits_per_byte`` the code length that this is, over the bytes and the end. ``base_score`` is that of words and an
    end, each counted once more than it was learnt. A null text is an empty one; a row for which ``learns`` is null is held out. A null id stays
    null and repeated rows are texts of their own. An empty table gives an empty result.
    """
    text = F.col(f"`{text_column}`").cast("string")
    # A block is part of one stretch of one file, so that gathering its units moves no text; input that isn't
    # read from files is one stretch.
    texts = df.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(learns, F.lit(False)).alias("learns"),
        F.xxhash64(F.input_file_name(), F.input_file_block_start()).alias("stretch"),
    )
    sizes = texts.groupBy("stretch").agg(F.sum(text_bytes(F.col("text"))).alias("size")).agg(F.max("size").alias("most"), F.sum("size").alias("all")).first()
    parts = max(1, math.ceil((sizes["most"] or 0) / block_bytes))
    n_vocabulary = max(1, math.ceil((sizes["all"] or 0) / block_bytes))
    texts = texts.withColumn("block", F.xxhash64("stretch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)))).drop("stretch")

    pack = "vocabulary int, block long, n_texts long, words binary, counts binary, grams binary, gram_counts binary"
    packs = staged(texts.select("block", "learns", "text").mapInArrow(_gather(n_vocabulary, order), pack), "packs")
    node = "vocabulary int, context long, node int, zeros long, ones long, below double"
    asked = staged(packs.groupBy("vocabulary").applyInArrow(_asked(order), node), "asked")
    told = {r["context"]: r["n"] for r in asked.filter("node = 0").groupBy("context").agg(F.sum("zeros").alias("n")).collect()}  # three rows
    # A context of this length is in one block of the vocabulary only.
    above = paths(asked.filter("node > 0"), order)
    answers = packs.groupBy("vocabulary").cogroup(above.groupBy("vocabulary")).applyInArrow(
        _told(order), "block long, words binary, counts binary, grams binary, codes binary"
    )
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    scored = _scored(order, told.get(_TOKENS, 0), told.get(_DISTINCT, 0), told.get(_ENDS, 0))
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scored, schema)
