"""Near-duplicate operators against brute force on small tables."""

import random

import numpy as np
import pytest

from labelgap.llm import minhash, vector_groups
from labelgap.llm.components import components
from labelgap.llm.words import BLANKS, NO_LETTERS, WordHasher, distinct_runs, runs

DOCS = "doc_id long, text string, a long, b long, bins string, component long"


def _groups(ids, linked):
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least


def test_components(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rnd.randrange(100, 400), rnd.randrange(100, 400)) for _ in range(150)]
    edges += [(1000, i) for i in range(1001, 1300)] + [(7, 7), (5, 4), (4, 5)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = [(a, b) for a, b in edges if a != b]
    assert found == _groups({x for e in linked for x in e}, linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_know_words_only():
    hasher = WordHasher(BLANKS)
    texts = ["The cat\tsat", "THE  cat\n sat ", "É é", None, "", "thecat sat", "\x00 \xa0"]
    split = []
    for counts, hashes in hasher.texts(texts):
        split += np.split(hashes, np.cumsum(counts)[:-1])
    assert [len(s) for s in split] == [3, 3, 2, 0, 0, 2, 2]
    assert (split[0] == split[1]).all() and split[2][0] != split[2][1] and split[5][1] == split[0][2]
    counts, hashes = next(WordHasher(NO_LETTERS).texts(["a-b_c 1.É"]))
    assert counts.tolist() == [5]


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(3000))
    whole = next(WordHasher(BLANKS).texts([text]))[1]
    monkeypatch.setattr("labelgap.llm.words.SLICE_BYTES", 1000)
    parts = list(WordHasher(BLANKS).texts(["x", text, "y z"]))
    assert [c.tolist() for c, _ in parts] == [[1], [3000], [2]]
    assert (parts[1][1] == whole).all()


def test_runs_stay_inside_texts():
    counts, hashes = next(WordHasher(BLANKS).texts(["a b c", "a", "", "b c a b c"]))
    per_text, found = runs(counts, hashes, 2)
    assert per_text.tolist() == [2, 0, 0, 4] and len(found) == 6
    assert found[1] == found[2] and found[0] == found[4]
    assert [len(s) for s in distinct_runs(counts, hashes, 2)] == [2, 1, 0, 3]


def _shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def _near(rows):
    sets = {}
    for i, text in rows:
        if i is not None:
            sets.setdefault(i, set()).add(frozenset(_shingles(text)))
    flat = [(i, s) for i, all_ in sets.items() for s in all_ if s]
    linked = [
        (a, b) for n, (a, s) in enumerate(flat) for b, t in flat[:n] if a != b and 100 * len(s & t) >= 75 * len(s | t)
    ]
    return _groups(sets, linked)


def _documents():
    """Copies, chains of edits whose ends differ, short and empty texts, and texts that share much but not enough."""
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    rows, i = [], 0
    for _ in range(12):
        text = [rnd.choice(words) for _ in range(rnd.choice([3, 7, 40, 120]))]
        for _ in range(rnd.randrange(1, 14)):
            rows.append((i * 7 % 1009, " ".join(text)))
            i += 1
            if rnd.random() < 0.7:
                text[rnd.randrange(len(text))] = rnd.choice(words)
    common = [rnd.choice(words) for _ in range(60)]
    for _ in range(25):
        rows.append((i * 7 % 1009, " ".join(common + [rnd.choice(words) for _ in range(rnd.randrange(10, 40))])))
        i += 1
    base = [rnd.choice(words) for _ in range(150)]
    for _ in range(60):
        edited = list(base)
        for _ in range(rnd.randrange(0, 12)):
            edited[rnd.randrange(150)] = rnd.choice(words)
        rows.append((i * 7 % 1009, " ".join(edited)))
        i += 1
    rows += [(2000, ""), (2001, None), (2002, " \n "), (2003, "ONE Two"), (2004, "one\ttwo"), (2005, "one")]
    rows += [rows[0], rows[0], (2006, rows[5][1]), (2006, rows[30][1])]
    return rows


def test_near_duplicates(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK_ROWS", 8)  # large buckets meet in pairs of chunks
    rows = _documents()
    data = [(i, t, 1, 2, "b", 3) for i, t in rows] + [(None, rows[0][1], 1, 2, "b", 3)]
    found = minhash.near_duplicates(spark.createDataFrame(data, DOCS).repartition(3)).collect()
    least = _near(rows)
    assert len(found) == len(data)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept) == (least[r.doc_id], least[r.doc_id] == r.doc_id), r
    sizes = {r.doc_id: r.n_shingles for r in found if r.doc_id != 2006}
    assert sizes == {i: len(_shingles(t)) for i, t in [*rows, (None, rows[0][1])] if i != 2006}


def test_estimate_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    for size in (4, 8, 40, 160, 600):
        for _ in range(50):
            union = rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2)
            common = -(-3 * size // 4)
            middle = common + (size - common) // 2
            a = np.unique(union[:middle])
            b = np.unique(np.concatenate([union[:common], union[middle:]]))
            bins = [minhash.fine_bins(x)[None] for x in (a, b)]
            assert minhash.likely_similar(*bins, np.array([len(a)]), np.array([len(b)]), 75)[0]


def test_densified_bins_agree_as_the_sets_do():
    rng = np.random.default_rng(2)
    agree = []
    for _ in range(300):
        union = np.unique(rng.integers(0, 2**64, 8, dtype=np.uint64))
        agree.append((minhash.bins_of(union[:6]) == minhash.bins_of(union)).mean())
    assert abs(np.mean(agree) - 0.75) < 0.02


def test_no_documents(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    assert minhash.near_duplicates(spark.createDataFrame([(1, None, 0, 0, "", 0)], DOCS)).collect()[0].kept


VECTORS = "vec_id long, embedding array<float>, copies long, place long, cell string, dim int"


def _vectors():
    rng = np.random.default_rng(5)
    rows, i = [], 0
    for _ in range(40):
        centre = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 12))):
            rows.append((i * 11 % 1201, (centre + rng.standard_normal(16) * rng.choice([0.02, 0.2, 0.3])).astype(np.float32).tolist()))
            i += 1
    rows += [(3000 + n, [2 * x for x in rows[0][1]]) for n in range(30)] + [(3100 + n, rows[1][1]) for n in range(30)]
    rows += [(4000, None), (4001, []), (4002, [0.0] * 16), (4003, [float("nan")] + [1.0] * 15), (4004, [None] + [1.0] * 15)]
    rows += [(4005, [float("inf")] + [1.0] * 15), (4006, [1.0, 1.0]), (4007, [1.0, 0.99]), (4008, [1.0])]
    return rows


def _brute_vectors(rows, cosine):
    usable = {i: np.array(v, dtype=np.float64) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    linked = []
    for a, x in usable.items():
        for b, y in usable.items():
            if a < b and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= cosine:
                linked.append((a, b))
    number = dict.fromkeys((i for i, _ in rows), 0)
    for a, b in linked:
        number[a] += 1
        number[b] += 1
    return number, _groups(number, linked)


@pytest.mark.parametrize("cell_rows, chunk_rows", [(200, 1024), (20, 1024), (200, 10)])
def test_vector_groups(spark, monkeypatch, cell_rows, chunk_rows):
    monkeypatch.setattr(vector_groups, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(vector_groups, "CHUNK_ROWS", chunk_rows)
    rows = _vectors()
    data = [(i, v, 1, 2, "c", 3) for i, v in rows]
    data += [data[0], (None, rows[0][1], 1, 2, "c", 3)]  # a repeated row counts once
    found = vector_groups.vector_groups(spark.createDataFrame(data, VECTORS).repartition(3)).collect()
    number, least = _brute_vectors(rows, 0.9)
    known = {r.vec_id: r for r in found}
    assert len(found) == len(rows) + 1 and known[None].n_links == 0 and known[None].kept
    for i in number:
        assert (known[i].n_links, known[i].component_id, known[i].kept) == (number[i], least[i], least[i] == i)


def test_collision_count_is_calibrated():
    signs, tables = vector_groups.signs_and_tables(51_200, 0.9)
    assert signs == 8 and tables < 60
    assert 20 <= vector_groups.least_collisions() <= 28
    rng = np.random.default_rng(6)
    # Pairs at a cosine of 0.9 reach the count.
    spread = np.sqrt(0.2)
    hits = (np.abs(rng.standard_normal((20_000, vector_groups.COUNTED)) * spread) <= vector_groups.WINDOW * spread).sum(axis=1)
    assert (hits < vector_groups.least_collisions()).mean() < 1e-3


def test_very_large_and_small_vectors(spark):
    rows = [(1, [1e-200, 0.0]), (2, [2e-200, 1e-202]), (3, [0.0, 1e-200]), (4, [1e200, 1.0]), (5, [5e-324, 0.0]), (6, [1e308, -1e308]), (7, [-1e-300, 1e-300])]
    frame = spark.createDataFrame([(i, v, 1, 2, "c", 3) for i, v in rows], VECTORS.replace("array<float>", "array<double>"))
    found = {r.vec_id: (r.n_links, r.component_id) for r in vector_groups.vector_groups(frame).collect()}
    assert found == {1: (3, 1), 2: (3, 1), 4: (3, 1), 5: (3, 1), 3: (0, 3), 6: (0, 6), 7: (0, 7)}


def test_no_vectors(spark):
    assert vector_groups.vector_groups(spark.createDataFrame([], VECTORS)).count() == 0
    only = vector_groups.vector_groups(spark.createDataFrame([(1, None, 0, 0, "", 0)], VECTORS)).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in only] == [(1, 0, 1, True)]
