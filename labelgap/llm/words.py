"""Words of texts as 64-bit hashes, and the hashes of runs of words, with numpy over many texts at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes between words; every other byte belongs to a word. A-Z are lower-cased first, so that no capital is left.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
NO_LETTERS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

#: Bytes that are hashed at once; longer texts are cut between words.
SLICE_BYTES = 1 << 18

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_NEXT_WORD = np.uint64(0xA0761D6478BD642F)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, np.uint64(base))
    factors[0] = 1
    return np.multiply.accumulate(factors)


class WordHasher:
    """Hashes of the words between some separator bytes."""

    def __init__(self, separators: bytes):
        self.is_word = np.ones(256, dtype=bool)
        self.is_word[list(separators)] = False
        self.values = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)
        self._up = self._down = np.ones(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._up) < n:
            self._up, self._down = _powers(_BASE, n), _powers(_INVERSE, n)

    def of_bytes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the words in some bytes."""
        inside = np.zeros(len(data) + 2, dtype=np.int8)
        inside[1:-1] = self.is_word[data]
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self._up[: len(data)], out=sums[1:])
        # The sum over a word, brought back to its first byte, doesn't depend on where the word stands.
        hashes = (sums[ends] - sums[starts]) * self._down[starts]
        return starts, mixed(hashes + (ends - starts).astype(np.uint64) * _STEP)

    def _cut(self, text: bytes) -> Iterator[bytes]:
        """Parts of about a slice that end between words; a single word is never cut."""
        at = 0
        while len(text) - at > SLICE_BYTES:
            end = at + SLICE_BYTES
            while end < len(text) and self.is_word[text[end]]:
                end += 1
            yield text[at:end]
            at = end
        yield text[at:]

    def texts(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For consecutive texts: the number of words of each, and the hashes of all their words in order."""
        held, size = [], 0
        for text in texts:
            raw = text.encode().lower() if text else b""  # lower() of bytes changes A-Z alone
            if len(raw) > SLICE_BYTES:
                if held:
                    yield self._together(held)
                    held, size = [], 0
                found = np.concatenate([self.of_bytes(np.frombuffer(part, np.uint8))[1] for part in self._cut(raw)])
                yield np.array([len(found)]), found
                continue
            if size + len(raw) > SLICE_BYTES:
                yield self._together(held)
                held, size = [], 0
            held.append(raw)
            size += len(raw) + 1
        if held:
            yield self._together(held)

    def _together(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        starts, hashes = self.of_bytes(np.frombuffer(b" ".join(texts), np.uint8))  # a blank separates words of either kind
        ends = np.cumsum([len(t) + 1 for t in texts])
        return np.diff(np.searchsorted(starts, ends), prepend=0), hashes


def runs(counts: np.ndarray, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside each text: how many each text has, and the hashes in order."""
    n = len(hashes) - k + 1
    per_text = np.maximum(counts - k + 1, 0)
    if n <= 0:
        return per_text, np.zeros(0, np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total = total * _NEXT_WORD + hashes[j : j + n]
    ends = np.cumsum(counts)
    # A run is dropped if its last word belongs to another text than its first.
    owner = np.repeat(np.arange(len(counts)), counts)
    whole = owner[:n] == owner[k - 1 :]
    assert len(ends) == 0 or ends[-1] == len(hashes)
    return per_text, mixed(total[whole])


def distinct_runs(counts: np.ndarray, hashes: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct runs of each text; a text of fewer words is one run, one without words has none."""
    per_text, found = runs(counts, hashes, k)
    at, word = 0, 0
    for n, words in zip(per_text.tolist(), counts.tolist()):
        if n:
            yield np.unique(found[at : at + n])
        elif words:
            total = np.array([words], dtype=np.uint64) * _STEP
            for h in hashes[word : word + words]:
                total = total * _NEXT_WORD + h
            yield mixed(total)
        else:
            yield np.zeros(0, np.uint64)
        at += n
        word += words
