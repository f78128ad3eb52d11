"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece exactly one token can stand last: the one that is
a stable neighbour of the last token of the shorter prefix before it. Two
tokens are stable neighbours if the merges, run over their joined bytes, give
back these two. With one token stored per byte, the ids of a prefix are read
off backwards, an append only adds entries, and an edit keeps all entries
before it.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import MutableSequence, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from labelgap.llm.pieces import PieceIds, Splitter, in_slices
from labelgap.llm.stages import numbered_texts
from labelgap.llm.worker import kept

#: Answers about pairs of tokens that a worker keeps before it starts anew.
REMEMBERED_PAIRS = 170_000
#: Pieces that a worker remembers; its tasks of other stages pay for them, too.
REMEMBERED_PIECES = 150_000

def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a rank file (base64 token, blank, rank)."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


class PrefixBpe:
    """Encoder over the ranks of a byte-level vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.split = Splitter(pattern)
        # All tokens that end at a byte, found in one pass over a piece; bytes stand for themselves as characters.
        self._endings = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._endings.add_word(token.decode("latin-1"), (rank, len(token)))
        self._endings.make_automaton()
        self._stable: dict[int, bool] = {}
        self._base = max(self.tokens, default=0) + 1  # a pair of tokens as one number: before * base + token
        self._halves: dict[int, tuple[int, int, bool] | None] = {}

    def _parts(self, data: bytes, least: int = 1) -> tuple[list[bytes], list[int]]:
        """What the merges leave, run down to ``least`` parts, and their ranks: the pair of lowest rank first, the leftmost of equals."""
        parts, done = [data[i : i + 1] for i in range(len(data))], []
        while len(parts) > least:
            ranked = [(self.ranks[pair], i) for i in range(len(parts) - 1) if (pair := parts[i] + parts[i + 1]) in self.ranks]
            if not ranked:
                break
            rank, i = min(ranked)
            done.append(rank)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts, done

    def merged(self, data: bytes) -> list[int]:
        """Ids by running the merges themselves."""
        return [self.ranks[part] for part in self._parts(data)[0]]

    def halves(self, token: int) -> tuple[int, int, bool] | None:
        """The two tokens that merge into this one, a byte twice itself, and whether the merges up to it rise in rank.

        None if the merges don't lead to it.
        """
        if token not in self._halves:
            data = self.tokens[token]
            parts, done = ([data, data], []) if len(data) == 1 else self._parts(data, 2)
            rising = all(a <= b for a, b in zip(done, [*done[1:], token])) and all(part in self.ranks for part in parts)
            self._halves[token] = (*[self.ranks.get(part, -1) for part in parts], rising) if len(parts) == 2 else None
        return self._halves[token]

    def _stays(self, before: int, token: int) -> bool:
        one, other = before < 0 or self.halves(before), self.halves(token)
        if one is None or other is None:
            return False
        if before < 0:
            return True
        tokens, ranks, halves = self.tokens, self.ranks, self.halves
        if not (one[2] and other[2]):
            return self.merged(tokens[before] + tokens[token]) == [before, token]
        # Back in time, the last merge first: none of those still to come may have had a lower rank than one across the cut.
        limit = self._base
        while True:
            left, right = tokens[before], tokens[token]
            if ranks.get(left + right, limit) < limit:
                return False
            if len(left) > 1 and (len(right) == 1 or before > token):
                limit, before = before, halves(before)[1]
            elif len(right) > 1:
                limit, token = token + 1, halves(token)[0]  # of equal ranks the one across the cut is the left one, and first
            else:
                return True

    def stable(self, before: int, token: int) -> bool:
        """Whether the two tokens stay as they are when they meet; ``before`` is -1 at the start of a piece."""
        pair = before * self._base + token
        known = self._stable.get(pair)
        if known is None:
            known = self._stays(before, token)
            if len(self._stable) >= REMEMBERED_PAIRS:
                self._stable.clear()
            self._stable[pair] = known
        return known

    def extend(self, data: bytes, last: MutableSequence[int]) -> None:
        """Add the last tokens of the prefixes of ``data`` that ``last`` doesn't have yet."""
        answers, base, done = self._stable, self._base, len(last)
        for at, (token, size) in self._endings.iter(data.decode("latin-1")):
            if at < done:  # this prefix has its token
                continue
            start = at + 1 - size
            before = last[start - 1] if start else -1
            good = answers.get(before * base + token)
            if good or good is None and self.stable(before, token):
                last.append(token)
                done += 1
        if done < len(data):
            raise ValueError("the vocabulary lacks a byte")

    def read_off(self, data: bytes, last: Sequence[int]) -> list[int]:
        """Ids of a piece from the last tokens of its prefixes."""
        whole = self.ranks.get(data)
        if whole is not None:  # a piece that is a token is never split, even if no merge leads to it
            return [whole]
        ids, end = [], len(data)
        while end:
            ids.append(last[end - 1])
            end -= len(self.tokens[ids[-1]])
        return ids[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        if data in self.ranks:
            return [self.ranks[data]]
        last: list[int] = []
        self.extend(data, last)
        return self.read_off(data, last)

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.split.pieces(text) for i in self.encode_piece(piece.encode())]

    def decode(self, ids) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


class EditableEncoding:
    """A text whose ids follow appends and edits without encoding it anew.

    Per piece it stores the last token of every byte prefix. An append goes
    back two pieces, because a contraction can join them, and reuses their
    stored prefixes as far as the bytes agree. An edit splits anew from two
    pieces before it until a cut falls on an old cut again.
    """

    def __init__(self, bpe: PrefixBpe, text: str = ""):
        self.bpe = bpe
        self.text = ""
        self._pieces: list[tuple[str, bytes, array]] = []
        self._starts: list[int] = []
        #: Bytes whose last token was computed so far; tells how much an edit reused.
        self.computed = 0
        self.append(text)

    def _prepared(self, piece: str, old: tuple[str, bytes, array] | None) -> tuple[str, bytes, array]:
        data, last = piece.encode(), array("i")
        if old is not None:
            same = 0
            while same < min(len(data), len(old[1])) and data[same] == old[1][same]:
                same += 1
            last = old[2][:same]
        self.computed += len(data) - len(last)
        self.bpe.extend(data, last)
        return piece, data, last

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in place of the characters from ``start`` to before ``end``."""
        shift = len(new) - (end - start)
        text = self.text[:start] + new + self.text[end:]
        first = 0
        while first < len(self._starts) and self._starts[first] + len(self._pieces[first][0]) < start:
            first += 1
        first = max(0, first - 2)
        at = self._starts[first] if first < len(self._starts) else 0
        later = {s + shift: i for i, s in enumerate(self._starts) if s >= end + 1}
        pieces, starts, rest = [], [], len(self._pieces)
        old = {s: self._pieces[i] for i, s in enumerate(self._starts) if i >= first}
        for place, piece in self.bpe.split.placed(text, at):
            if place in later and place > start + len(new):
                rest = later[place]
                break
            starts.append(place)
            pieces.append(self._prepared(piece, old.get(place)))
        self._starts[first:] = starts + [s + shift for s in self._starts[rest:]]
        self._pieces[first:] = pieces + self._pieces[rest:]
        self.text = text

    @property
    def ids(self) -> list[int]:
        return [i for _, data, last in self._pieces for i in self.bpe.read_off(data, last)]


def loaded(path: str, pattern: str) -> tuple[PrefixBpe, PieceIds]:
    """The encoder of a worker; all its tasks share what it has learnt about pieces and pairs."""

    def build():
        bpe = PrefixBpe(read_ranks(path), pattern)

        def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            found = [bpe.encode_piece(piece.encode()) for piece in pieces]
            return np.array([i for ids in found for i in ids], dtype=np.uint32), np.fromiter(map(len, found), np.int64, len(found))

        return bpe, PieceIds(bpe.split.pieces, encode, REMEMBERED_PIECES)

    return kept(("prefix_bpe", path, pattern), build)


def encode_texts(df: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids of each text: ``doc_id, ids array<int>``.

    A null text is an empty one and has no ids. A null id stays null, and
    repeated rows stay as they are.
    """

    def run(batches):
        for batch in batches:
            texts, done = batch.column(1).to_pylist(), 0
            for part in in_slices(texts):
                ids = loaded(path, pattern)[1].ids(part)
                values = pa.array(np.concatenate(ids).astype(np.int32), pa.int32())
                offsets = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(part)), pa.ListArray.from_arrays(offsets, values)], ["doc_id", "ids"])
                done += len(part)

    return numbered_texts(df, id_column, text_column).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Bytes of each list of ids: ``doc_id, data binary``; a null list has none."""

    def run(batches):
        for batch in batches:
            bpe = loaded(path, pattern)[0]
            data = [bpe.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def encoding_digests(df: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode each text, decode its ids, and keep digests: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    One pass without a shuffle; a row costs its own text, and nothing larger
    leaves the task. Null and repeated rows are treated as in ``encode_texts``.
    """

    def run(batches):
        for batch in batches:
            bpe, pieces = loaded(path, pattern)
            tokens, names = _tables(path, pattern)
            counts, of_ids, of_bytes = [], [], []
            for part in in_slices(batch.column(1).to_pylist()):
                for found in pieces.ids(part):
                    ids = found.tolist()
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest())
                    of_bytes.append(hashlib.sha256(b"".join([tokens[i] for i in ids])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return numbered_texts(df, id_column, text_column).mapInArrow(run, schema)


def _tables(path: str, pattern: str) -> tuple[list[bytes], list[str]]:
    def build():
        tokens = loaded(path, pattern)[0].tokens
        size = max(tokens, default=-1) + 1
        return [tokens.get(i, b"") for i in range(size)], [str(i) for i in range(size)]

    return kept(("prefix_bpe_tables", path, pattern), build)
