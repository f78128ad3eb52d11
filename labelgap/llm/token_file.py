"""Token ids in byte-aligned variable-length coding, in document order.

A block holds the ids of consecutive documents. Its ids are ranked by how
often they occur in it, so that the frequent ones take one byte. Lengths and
bytes are kept apart: a control byte holds the lengths of four ranks (two bits
each, length less one), the data bytes hold the ranks, low byte first. Blocks
are rows of Parquet files, so that Spark's committer handles lost tasks and
any file system will do. Reading back looks each control byte up in a table
of lengths and gathers the bytes with numpy; nothing loops over ids.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelgap.llm.pieces import PieceIds, Splitter, in_slices
from labelgap.llm.stages import numbered_texts
from labelgap.llm.worker import kept
from labelgap.operators.prefix import running_totals

#: Ids after which a block is closed; a longer document makes a longer block.
BLOCK_IDS = 1 << 19
#: Ids below which ranks are looked up by id.
TABLE_IDS = 1 << 20
#: Bytes of a row group, so that a reader holds a few blocks at a time.
ROW_GROUP_BYTES = 8 << 20

_BLOCK_SCHEMA = (
    "first_id long, first_tie long, sequence long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, ranked binary, control binary, data binary"
)
_LENGTHS_OF = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def pack(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Ranked ids, control bytes and data bytes of some ids."""
    ids = ids.astype(np.uint32, copy=False)
    if len(ids) and ids.max() < TABLE_IDS:  # a table by id costs less than a sort
        counts = np.bincount(ids)
        values = np.flatnonzero(counts).astype(np.uint32)
        order = np.argsort(-counts[values], kind="stable")
        rank_of = np.zeros(len(counts), np.uint32)
        rank_of[values[order]] = np.arange(len(values), dtype=np.uint32)
        ranks = rank_of[ids]
    else:
        values, inverse, counts = np.unique(ids, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        rank_of = np.empty(len(values), np.uint32)
        rank_of[order] = np.arange(len(values), dtype=np.uint32)
        ranks = rank_of[inverse]
    lengths = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ids) // 4) * 4, np.uint8)
    padded[: len(ids)] = lengths - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    columns = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = columns[np.arange(4) < lengths[:, None]]
    return values[order].astype("<u4").tobytes(), control.tobytes(), data.tobytes()


def unpack(ranked: bytes, control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ids again."""
    lengths = _LENGTHS_OF[np.frombuffer(control, np.uint8)].ravel()[:n]
    starts = np.cumsum(lengths) - lengths
    stored = np.frombuffer(data + b"\0\0\0", np.uint8)
    ranks = stored[starts].astype(np.uint32)
    for i in (1, 2, 3):
        longer = np.flatnonzero(lengths > i)
        if not len(longer):
            break
        ranks[longer] |= stored[starts[longer] + i].astype(np.uint32) << np.uint32(8 * i)
    return np.frombuffer(ranked, "<u4")[ranks] if n else np.zeros(0, np.uint32)


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class ByteLevelPieces:
    """Pieces of texts, and their ids by the model of a tokenizers file, as the library finds them.

    The library first cuts a text at its special tokens, then splits what is between by the pattern, writes the bytes of a piece as characters and
    hands that to its model. The first steps are done here, once for equal pieces; only the model is called. The strings of special
    tokens give their ids, unless ``special_tokens`` is off: then they are text like any other.
    """

    def __init__(self, path: str, pattern: str, special_tokens: bool = True):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        added = tokenizer.get_added_tokens_decoder()
        if tokenizer.normalizer is not None or any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError(f"not a plain byte-level tokenizer: {path}")
        self._model, self._characters, self._split = tokenizer.model, byte_characters(), Splitter(pattern).pieces
        # An added token that isn't special counts whether they are wanted or not.
        self._special = {t.content: i for i, t in added.items() if special_tokens or not t.special}
        longest_first = sorted(self._special, key=len, reverse=True)
        self._at_special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split if self._special else None

    def pieces(self, text: str) -> list[str]:
        if not any(token in text for token in self._special):
            return self._split(text)
        parts = self._at_special(text)
        # No run of the pattern's pieces equals a special token as a whole, so the string itself may stand for it.
        return [piece for i, part in enumerate(parts) for piece in ([part] if i % 2 else self._split(part))]

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in order, and how many each has."""
        ids: list[int] = []
        lengths = np.empty(len(pieces), np.int64)
        tokenize, characters, special = self._model.tokenize, self._characters, self._special
        for i, piece in enumerate(pieces):
            if piece in special:
                found = [special[piece]]
            else:
                found = [token.id for token in tokenize(piece.encode().decode("latin-1").translate(characters))]
            ids += found
            lengths[i] = len(found)
        return np.array(ids, np.uint32), lengths


def _pieces(path: str, pattern: str, special_tokens: bool) -> PieceIds:
    def build():
        level = ByteLevelPieces(path, pattern, special_tokens)
        return PieceIds(level.pieces, level.encode)

    return kept(("token_file", path, pattern, special_tokens), build)


def write_token_file(
    df: DataFrame, out: str, tokenizer_path: str, pattern: str, end_id: int = 2, block_ids: int = BLOCK_IDS,
    id_column: str = "doc_id", text_column: str = "text", special_tokens: bool = True,
) -> None:
    """Encode whole texts, end each with ``end_id``, and write them in ascending order of the id.

    The tokenizer is a byte-level one that splits by ``pattern``. The strings of its special tokens in a text give
    their ids, as in the library; ``special_tokens=False`` takes them as ordinary text.
    A null text is an empty one. Rows with a null id stand first; rows with one id
    are ordered by a hash of their text, so equal ids of any number are split over tasks, too.
    No rows give an empty file.
    """

    def run(batches):
        sequence, rows, size = 0, [], 0

        def block():
            ids = np.concatenate([r[2] for r in rows])
            ranked, control, data = pack(ids)
            lengths = [len(r[2]) for r in rows]
            values = [[rows[0][0]], [rows[0][1]], [sequence], [len(ids)], [[r[0] for r in rows]], [lengths], [ranked], [control], [data]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, _ARROW_TYPES)], _ARROW_NAMES)

        end = np.uint32(end_id)
        for batch in batches:
            doc_ids, ties, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            at = 0
            for part in in_slices(texts):
                for found in _pieces(tokenizer_path, pattern, special_tokens).ids(part):
                    rows.append((doc_ids[at], ties[at], np.append(found, end)))
                    size += len(found) + 1
                    at += 1
                    if size >= block_ids:
                        yield block()
                        sequence, rows, size = sequence + 1, [], 0
        if rows:
            yield block()

    texts = numbered_texts(df, id_column, text_column).select("doc_id", F.xxhash64("text").alias("tie"), "text")
    # The order is taken over small rows' keys; a task then sorts its own range only.
    in_order = texts.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    blocks = in_order.mapInArrow(run, _BLOCK_SCHEMA)
    blocks.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).option("compression", "uncompressed").parquet(out)


_ARROW_NAMES = [part.split()[0] for part in _BLOCK_SCHEMA.split(", ")]
_ARROW_TYPES = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2 + [pa.binary()] * 3


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a token file: ``doc_id, start, ids array<bigint>``; see ``read_token_digests`` for a lighter form."""

    def of(ids: np.ndarray):
        return ids.tolist()

    return _documents(spark, path, of, "ids array<bigint>", pa.list_(pa.int64()))


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from its ids as they are read back.

    ``start`` counts the ids of all documents before it; the checksum is that of the
    ids as little-endian unsigned 32-bit integers.
    """
    return _documents(spark, path, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), "ids_crc32 long", pa.int64())


def _documents(spark: SparkSession, path: str, of, column: str, kind: pa.DataType) -> DataFrame:
    blocks = spark.read.parquet(path)
    name = column.split()[0]

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                first, tie, sequence, n, docs, lengths, ranked, control, data = (batch.column(i)[row].as_py() for i in range(9))
                ids = unpack(ranked, control, data, n)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                found = [of(ids[a:b]) for a, b in zip(starts, ends)]
                k = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first] * k, pa.int64()), pa.array([tie] * k, pa.int64()), pa.array([sequence] * k, pa.int64()),
                     pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(found, kind)],
                    ["first_id", "first_tie", "sequence", "doc_id", "inside", "n_tokens", name],
                )

    schema = f"first_id long, first_tie long, sequence long, doc_id long, inside long, n_tokens long, {column}"
    documents = blocks.mapInArrow(run, schema)
    # Ids before each block: first over the blocks' first ids in value ranges, then among blocks that begin with one id.
    first = F.coalesce("first_id", F.lit(-(2**63)))
    sizes = blocks.select(first.alias("first"), "first_tie", "sequence", "n_ids")
    by_first = running_totals(sizes.groupBy("first").agg(F.sum("n_ids").alias("n_ids")), "first", ["n_ids"])
    before = by_first.select("first", (F.col("cum_n_ids") - F.col("n_ids")).alias("before"))
    ties = Window.partitionBy("first").orderBy("first_tie", "sequence").rowsBetween(Window.unboundedPreceding, -1)
    among = sizes.select("first", "first_tie", "sequence", F.coalesce(F.sum("n_ids").over(ties), F.lit(0)).alias("among"))
    starts = among.join(before, "first").select("first", "first_tie", "sequence", (F.col("before") + F.col("among")).alias("block_start"))
    joined = documents.withColumn("first", first).join(starts, ["first", "first_tie", "sequence"])
    return joined.select("doc_id", (F.col("block_start") + F.col("inside")).alias("start"), "n_tokens", name)
