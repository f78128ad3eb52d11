"""Whitening, filter audit and source mix against brute force on small tables."""

import itertools
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelgap.llm import filter_audit, source_mix, whitening

# -- whitening ---------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, component int, n long, whitened string"


def _matrix(seed, size, rows):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((rows, size)) * np.exp(-3 * np.arange(size) / size)
    return np.cov(x.T, bias=True)


@pytest.mark.parametrize("size, rows", [(1, 10), (2, 30), (17, 200), (64, 500), (64, 30)])
def test_counts_are_those_of_the_spectrum(size, rows):
    matrix = np.atleast_2d(_matrix(1, size, rows))
    values = np.linalg.eigvalsh(matrix)
    for shift in np.linspace(-0.1, values[-1] * 1.1, 25):
        assert whitening.eigenvalues_above(matrix, shift) == (values > shift).sum()


@pytest.mark.parametrize("size, rows", [(1, 10), (5, 40), (64, 500), (64, 30), (120, 2000)])
def test_leading_eigenpairs(size, rows):
    matrix = np.atleast_2d(_matrix(2, size, rows))
    values, vectors = whitening.leading_eigenpairs(matrix, 32)
    expected, basis = np.linalg.eigh(matrix)
    expected, basis = expected[::-1], basis[:, ::-1]
    assert len(values) == min(32, size, rows - 1)
    assert np.abs(values - expected[: len(values)]).max() <= 1e-13 * expected[0]
    assert np.abs(np.abs((vectors * basis[:, : len(values)]).sum(axis=0)) - 1).max() < 1e-10


def test_equal_and_close_eigenvalues():
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    spectrum = np.array([5.0] * 3 + [5 - 1e-12, 4, 4, 3] + [1.0] * 20 + [0.0] * 13)
    matrix = turn * spectrum @ turn.T
    values, vectors = whitening.leading_eigenpairs((matrix + matrix.T) / 2, 32)
    assert len(values) == 27 and np.abs(values - spectrum[:27]).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(27)).max() < 1e-8
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-8
    assert whitening.leading_eigenpairs(np.zeros((4, 4)), 3)[0].size == 0


def _vectors():
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(6) * [3, 2, 1, 1, 0.5, 0.2]).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(40)] + [rows[3], (None, rows[4][1])]
    odd = [(900, None), (901, []), (902, [None] + [1.0] * 5), (903, [float("nan")] * 6), (904, [float("inf")] + [0.0] * 5), (905, [1.0, 2.0])]
    return rows, odd


def test_whiten(spark):
    rows, odd = _vectors()
    data = [(i, v, 7, 8, "x") for i, v in rows + odd]
    found = whitening.whiten(spark.createDataFrame(data, VECTORS).repartition(5)).collect()
    assert len(found) == 6 * len(rows)
    x = np.floor(64 * np.array([v for _, v in rows], np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    white = centred @ basis / np.sqrt(values)
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    by_id = {}
    for r in found:
        by_id.setdefault((r.vec_id, r.component), []).append(r)
    sign = {c: np.sign(by_id[0, c][0].whitened * white[0, c - 1]) for c in range(1, 7)}
    for place, (i, _) in enumerate(rows):
        for c in range(1, 7):
            for r in by_id[i, c]:
                assert abs(r.whitened - sign[c] * white[place, c - 1]) < 1e-9 and r.deviation == deviation[place] and r.n == n
                assert abs(r.explained - values[c - 1] / values.sum()) < 1e-12 and r.identity_error < 1e-9
    assert len(by_id[3, 1]) == 2 and (900, 1) not in by_id


def test_whiten_little(spark):
    frame = lambda rows: spark.createDataFrame([(i, v, 0, 0, "") for i, v in rows], VECTORS)
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(frame(rows)).count() == 0
    two = whitening.whiten(frame([(1, [1.0, 2.0]), (2, [2.0, 4.0])])).collect()
    assert [(r.vec_id, r.component, abs(round(r.whitened, 9)), round(r.explained, 9)) for r in sorted(two)] == [(1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0)]
    wide = whitening.whiten(frame([(i, [float(i % 7) * 1e9, 1.0]) for i in range(20)])).collect()
    assert {r.deviation for r in wide} == {None} and len(wide) == 20


def test_moments_keep_sums_exact():
    big = np.array([[2.0**55, -3.0], [2.0**55, 1.0], [2.0, 2.0]])
    moments = whitening.Moments(2)
    moments.add_rows(big[:2])
    moments.add_rows(big[2:])
    assert moments.sums.tolist() == [2**56 + 2, 0] and moments.n == 3


# -- filter audit ----------------------------------------------------------------------


def test_shapley_by_least_squares_is_the_mean_over_orders():
    rnd = random.Random(5)
    removed = [0] + [rnd.randrange(1000) for _ in range(31)]
    for i, row in enumerate(filter_audit.shapley_map()):
        steps = [removed[s | 1 << i] - removed[s] for order in itertools.permutations(range(5))
                 for s in [sum(1 << j for j in order[: order.index(i)])]]
        assert sum(x * v for x, v in zip(row, removed)) == Fraction(sum(steps), 120)


def _audited():
    rnd = random.Random(6)
    long = lambda: " ".join(f"w{rnd.randrange(4000)}" for _ in range(220))
    texts = [long(), "a " * 220, "AB " * 220, long() + " #", long().upper(), "", None, "short", "é É " * 110, "x\x00y\xa0z " * 210]
    rows = []
    for i in range(140):
        rows.append((rnd.choice([i, i, i // 2]), rnd.choice(texts + [long()]), rnd.choice(["s1", "s1", "s2", "", None])))
    rows += [rows[0], rows[0], (None, texts[0], "s2"), (None, texts[0], "s2"), (500, texts[0] * 30, "s3")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 140, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    return rows, labels


def _audit_by_hand(rows, labels):
    import re

    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {f for f, bad in zip("ABCD", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), re.search(r"[#$%&*|]", text),
        )) if bad}
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows):
            fails.add("E")
        docs.append((part or "", fails, i in good, i in toxic))
    out, shapley = {}, {}
    for part in {d[0] for d in docs}:
        for order in itertools.permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                here = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                unique = sum(d[0] == part and d[1] == {f} for d in docs)
                out[part, "".join(order), step] = (
                    f, len(left), len(here), sum(f in d[1] for d in gone), unique, sum(d[2] for d in here), sum(d[3] for d in here),
                )
                gone += here
                shapley[part, f] = shapley.get((part, f), 0) + len(here)
    return {k: (*v, shapley[k[0], v[0]]) for k, v in out.items()}


DOCS = "doc_id long, text string, source string, part string, digest long, failed string, n int"


def test_audit(spark):
    rows, labels = _audited()
    docs = spark.createDataFrame([(*r, "p", 1, "f", 2) for r in rows], DOCS).repartition(4)
    marks = spark.createDataFrame([(*r, "t") for r in labels], "doc_id long, quality int, toxic int, text string")
    found = filter_audit.audit(docs, marks).collect()
    by_hand = _audit_by_hand(rows, labels)
    assert len(found) == len(by_hand) == 600 * 4
    for r in found:
        expected = by_hand[r.part, r.filter_order, r.step]
        assert (r.filter, r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) == expected


def test_audit_of_nothing(spark):
    docs, marks = spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, marks).count() == 0
    one = filter_audit.audit(spark.createDataFrame([(None, None, None, "", 0, "", 0)], DOCS), marks).collect()
    assert len(one) == 600 and {(r.part, r.shapley) for r in one if r.filter == "A"} == {("", 120)}


# -- source mix --------------------------------------------------------------------------


def _targets_by_hand(sizes):
    """Share by weight, stop at three times the size, share the excess among the rest until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: Fraction(i % 3 + 1) for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in stopped]
        left, weights = total - sum(stopped.values()), sum(weight[s] for s in rest)
        target = {s: left * weight[s] / weights for s in rest}
        above = [s for s in rest if target[s] >= 3 * sizes[s]]
        if not above:
            return stopped | target
        stopped |= {s: Fraction(3 * sizes[s]) for s in above}


def _corpus(seed=7):
    rnd = random.Random(seed)
    sources = ["a", "b", "ä", "z", "\U0001f600", "￮", "", None]
    rows = [(i, " ".join(["w"] * rnd.choice([0, 1, 3, 20, 200])), rnd.choice(["a"] * 6 + sources)) for i in range(400)]
    rows += [(1000, "v " * 5000, "b"), (1001, None, "a"), (None, "x y", None), (None, "x y", None), (7, "q", "only")]
    rows += [(1002, "same text", "a")] * 2500  # more copies than are placed side by side
    return rows


SOURCES = "doc_id long, text string, source string, size string, start int, n int"


def test_targets(spark):
    rng = random.Random(8)
    for n in (1, 2, 7, 40):
        rows = [(i, f"s{i % n}" if i % n else None, rng.choice([0, 1, 5, 500, 20_000])) for i in range(3 * n)]
        found = source_mix.source_targets(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()
        sizes = {}
        for _, s, z in rows:
            sizes[s] = sizes.get(s, 0) + z
        by_hand = _targets_by_hand(sizes) if any(sizes.values()) else dict.fromkeys(sizes, 0)
        assert {r.source: r.source_size for r in found} == sizes
        for r in found:
            assert abs(r.target - by_hand[r.source]) <= 1e-9 * max(1, by_hand[r.source])


@pytest.mark.parametrize("block_words", [16, 1024])
def test_mix(spark, block_words):
    rows = _corpus()
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SOURCES)
    made = source_mix.mix(docs.repartition(3), block_words=block_words)
    found = source_mix.taken_words(made).collect()
    key = lambda r: (str(r.doc_id), r.size, r.source_size, r.taken)
    again = source_mix.taken_words(source_mix.mix(docs.repartition(7, "text"), block_words=block_words)).collect()
    assert sorted(map(key, found)) == sorted(map(key, again))
    assert sorted((str(r.doc_id), r.size) for r in found) == sorted((str(i), len((t or "").split())) for i, t, _ in rows)
    targets = {r.source: r for r in made.sources.collect()}
    by_id = {}
    for r in found:
        assert 0 <= r.taken <= 3 * r.size
        by_id.setdefault((r.doc_id, r.source_size), []).append(r)
    for source, facts in targets.items():
        taken = sum(r.taken for r in found if r.target == facts.target and r.source_size == facts.source_size)
        assert abs(taken - facts.target) <= 0.5 + 1e-6, source

    # The pieces of a pass cover each document once, in blocks of one size, and no slot holds two sources.
    pieces = made.pieces.filter("n_words > 0").collect()
    slots = {}
    for p in pieces:
        slots.setdefault(p.slot, []).append(p)
    number = {r.source_no: r for r in targets.values()}
    for held in slots.values():
        assert len({(p.source_no, p["pass"], p.block) for p in held}) == 1
        words = sum(p.n_words for p in held)
        facts = number[held[0].source_no]
        assert words <= block_words
        if words < block_words:  # the last of a pass
            assert (held[0].block + 1) * block_words > min(facts.source_size, facts.target + 0.5 - held[0]["pass"] * facts.source_size)
    # Every stretch of the mix holds the sources by their weights, up to a few blocks.
    order = sorted(slots)
    share = {s: sum(slots[i][0].source_no == s for i in order) / len(order) for s in number}
    for end in range(1, len(order)):
        for s in number:
            have = sum(slots[i][0].source_no == s for i in order[:end]) if end % 37 == 0 else None
            assert have is None or abs(have - share[s] * end) <= 2 + np.log2(len(order))


def test_mirrored_bits(spark):
    found = [r[0] for r in spark.range(16).select(source_mix.mirrored(F.col("id"), 4)).collect()]
    assert found == [int(f"{i:04b}"[::-1], 2) for i in range(16)]


def test_mix_of_nothing(spark):
    assert source_mix.taken_words(source_mix.mix(spark.createDataFrame([], SOURCES))).count() == 0
    none = source_mix.taken_words(source_mix.mix(spark.createDataFrame([(1, None, None, "", 0, 0), (None, " ", "a", "", 0, 0)], SOURCES))).collect()
    assert sorted((r.size, r.source_size, r.target, r.taken) for r in none) == [(0, 0, 0.0, 0)] * 2
