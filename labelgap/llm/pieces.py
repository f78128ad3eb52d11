"""Texts as pieces whose ids are remembered.

A byte-level tokenizer splits a text by a pattern and never merges across the
cuts, so the ids of a text are those of its pieces in order. Most pieces of a
corpus repeat; each worker encodes a piece once and keeps its ids.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import regex

#: Pieces a worker remembers at once, and their characters; beyond either it forgets all but the frequent ones.
REMEMBERED_PIECES = 900_000
REMEMBERED_CHARACTERS = 24 << 20


# Code points that the pattern library's tables have as letters or numbers and those of the
# tokenizers whose ids are to be met, which are older, have not.
LATER_CHARACTERS = """
    558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7
    10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF
    18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96
    1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479
    3D000-3FC3F
"""
_LATER = regex.compile("[" + "".join("-".join(rf"\U{int(c, 16):08X}" for c in r.split("-")) for r in LATER_CHARACTERS.split()) + "]")


# The usual pattern, and what its classes are among the first 256 characters, where most texts stay.
USUAL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LETTERS, _NUMBERS, _SPACES = r"A-Za-zªµºÀ-ÖØ-öø-ÿ", r"0-9²³¹¼-¾", r"\t-\r \x85\xa0"
_LATIN_PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)


class Splitter:
    """The pieces of texts by a pattern, as the tokenizers find them."""

    def __init__(self, pattern: str):
        self._pattern = regex.compile(pattern)
        self._latin = re.compile(_LATIN_PATTERN).findall if pattern == USUAL_PATTERN else None

    def pieces(self, text: str) -> list[str]:
        if self._latin is not None:
            try:
                text.encode("latin-1")
                return self._latin(text)  # plain character sets are found twice as fast
            except UnicodeEncodeError:
                pass
        if text.isascii() or not _LATER.search(text):
            return self._pattern.findall(text)
        return [piece for _, piece in self.placed(text)]

    def placed(self, text: str, start: int = 0) -> Iterator[tuple[int, str]]:
        """Places and pieces from ``start`` on, which is the start of a piece."""
        # A private character is neither letter nor number nor white space.
        plain = text if text.isascii() else _LATER.sub("\ue000", text)
        for match in self._pattern.finditer(plain, start):
            yield match.start(), text[match.start() : match.end()]


class _Numbered(dict):
    """Gives every new key the next number, and keeps the keys that are new."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number


class PieceIds:
    """Ids of texts by way of their pieces.

    ``split`` gives the pieces of a text; ``encode`` gives, for a list of pieces, all their ids
    in order and how many each has. Beyond ``most`` pieces they are forgotten, except those that came again, the most frequent
    first and at most half as many; a worker lives on, and holds what is remembered while it runs the tasks of other stages.
    """

    def __init__(
        self, split: Callable[[str], list[str]], encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = REMEMBERED_PIECES
    ):
        self._split, self._encode, self._most = split, encode, most
        self._numbers = _Numbered()
        self._characters = 0
        self._ids, self._starts, self._lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._uses = np.zeros(0, np.int32)

    def _forget(self) -> None:
        sizes = np.fromiter(map(len, self._numbers), np.int64, len(self._numbers))
        order = np.argsort(-self._uses, kind="stable")[: self._most // 2]
        order = order[(self._uses[order] > 1) & (np.cumsum(sizes[order]) <= REMEMBERED_CHARACTERS // 2)]
        keep = np.zeros(len(sizes), bool)
        keep[order] = True
        pieces = list(itertools.compress(self._numbers, keep.tolist()))
        self._numbers = _Numbered()
        self._numbers.update(zip(pieces, range(len(pieces))))
        self._characters = int(sizes[keep].sum())
        self._ids = self._ids[np.repeat(keep, self._lengths)]
        self._lengths = self._lengths[keep]
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._uses = self._uses[keep] // 2  # what is no longer used goes in the end

    def ids(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Ids of each text; a missing text is an empty one."""
        if len(self._numbers) > self._most or self._characters > REMEMBERED_CHARACTERS:
            self._forget()
        number = self._numbers.__getitem__
        found = [list(map(number, self._split(text))) if text else [] for text in texts]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        pieces = np.fromiter((p for text in found for p in text), np.int64, int(counts.sum()))
        new = self._numbers.new
        if new:
            self._numbers.new = []
            self._characters += sum(map(len, new))
            ids, lengths = self._encode(new)
            self._starts = np.concatenate([self._starts, len(self._ids) + np.cumsum(lengths) - lengths])
            self._lengths = np.concatenate([self._lengths, lengths])
            self._ids = np.concatenate([self._ids, ids.astype(np.uint32)])
            self._uses = np.concatenate([self._uses, np.zeros(len(new), np.int32)])
        self._uses += np.bincount(pieces, minlength=len(self._uses)).astype(np.int32)
        lengths = self._lengths[pieces]
        ends = np.cumsum(lengths)
        whole = self._ids[np.repeat(self._starts[pieces] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate([[0], ends])[np.cumsum(counts)]
        return np.split(whole, cuts[:-1])


def in_slices(values: list, limit: int = 1 << 20, size: Callable = len):
    """Consecutive slices of a list whose sizes sum to about ``limit``; a larger value stands alone."""
    start, total = 0, 0
    for i, value in enumerate(values):
        n = size(value) if value is not None else 0
        if i > start and total + n > limit:
            yield values[start:i]
            start, total = i, 0
        total += n
    if start < len(values):
        yield values[start:]
