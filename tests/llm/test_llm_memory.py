"""What a worker holds at once, and what it keeps, over rows made here."""

import random
import string
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from labelgap.llm import minhash, prefix_bpe, toxicity
from labelgap.llm.queries import MULTI_RANKS
from labelgap.llm.words import BLANKS, WordHasher


class _Frame:
    """Stands for a frame and keeps the functions given to it."""

    def __init__(self):
        self.given = []

    def select(self, *_):
        return self

    def mapInArrow(self, function, _):
        self.given.append(function)
        raise StopIteration


def _function(call):
    frame = _Frame()
    with pytest.raises(StopIteration):
        call(frame)
    return frame.given[0]


def _peak_mb(call) -> float:
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def _text(n: int, seed: int) -> str:
    return "".join(random.Random(seed).choices(string.ascii_letters + "    ", k=n))


def test_words_are_hashed_in_small_slices():
    texts = [_text(200_000, i) for i in range(12)]
    assert _peak_mb(lambda: sum(len(h) for _, h in WordHasher(BLANKS).texts(texts))) < 20  # 38 with slices of 1 MB


def test_sketches_never_hold_a_batch_as_objects(monkeypatch):
    monkeypatch.setattr(minhash, "numbered_texts", lambda df, *_: df)
    run = _function(minhash.sketches)
    # One text many times: decoded one by one it is a few kB at a time, decoded together 30 MB.
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(600)), "text": pa.array([_text(50_000, 0)] * 600)})
    assert _peak_mb(lambda: list(run([batch]))) < 24


def test_equal_runs_are_counted_together_early():
    run = _function(lambda frame: toxicity._associated(frame, 2, 10))
    text, n = _text(100_000, 1), 30
    marks = pa.array(np.arange(n, dtype=np.int32) % 2)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([text] * n), marks, marks], ["doc_id", "text", "y0", "y1"])
    found = []
    assert _peak_mb(lambda: found.extend(run([batch]))) < 80
    table = pa.Table.from_batches(found).to_pydict()
    assert sorted(np.array(table["run"]).astype(np.uint64)) == np.unique(toxicity.byte_runs(text)).tolist()
    assert set(table["n"]) == {n} and set(table["n0"]) == {n // 2}


def test_remembered_pieces_stay_few():
    bpe, pieces = prefix_bpe.loaded(MULTI_RANKS, public_tokenizers.PATTERN)
    texts = [" ".join(map(str, range(at, at + 20_000))) for at in range(1_000_000, 1_300_000, 20_000)]
    for text in texts:
        found = pieces.ids([text])[0].tolist()
    assert len(pieces._numbers) < 200_000  # all 300,000 before
    assert found == bpe.encode(texts[-1])
    assert pieces.ids(texts[:1])[0].tolist() == bpe.encode(texts[0])  # forgotten meanwhile
