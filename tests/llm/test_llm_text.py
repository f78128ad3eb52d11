"""Scoring, filtering and extracting operators against brute force and held-out rows."""

import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelgap.llm import ctw, decontaminate, html_text, license_scan, toxicity
from labelgap.llm.words import NO_LETTERS, WordHasher

DOCS = "doc_id long, text string, gram long, place int, label string, block long"


def _frame(spark, rows, partitions=3):
    return spark.createDataFrame([(i, t, 1, 2, "l", 3) for i, t in rows], DOCS).repartition(partitions)


# --- licences


def _phrase_places(text):
    words = [w.decode() for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())]
    places = [
        (at, label) for label, phrases in license_scan.PHRASES.items() for phrase in phrases
        for at in range(len(words)) if words[at : at + len(phrase.split())] == phrase.split()
    ]
    return words, places


def test_license_phrases_and_notices(spark):
    mit = license_scan.NOTICES["mit-text"][1]
    edited = mit.replace("free of charge", "entirely free of any charge").replace("granted", "hereby granted")
    texts = [
        None, "", "CC-BY CC BY 4.0 cc  by", "the MIT License mit license MIT licence", "Apache\nLicense, Version 2.0", "GNU General Public License v3, apache license",
        "of the software " * 30, f"intro {edited} outro", mit.upper(), "license mit", "mit " * 50 + "license",
        "gnu general public gnu general public license", "é cc by ß",
    ]
    rows = list(enumerate(texts))
    spans, summary = license_scan.scan(_frame(spark, [*rows, rows[2], (None, "mit license")]))
    found = {r.doc_id: r for r in summary.collect()}
    assert summary.count() == len(rows) + 1  # the repeated row is one
    for i, text in [*rows, (None, "mit license")]:
        words, places = _phrase_places(text)
        at = [p for p, _ in places]
        expected = (len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == expected, text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert "mit-text" in found[7].labels and "mit-text" in found[8].labels and "apache-2.0" not in found[5].labels
    assert found[6].labels == "" and found[9].labels == "" and found[0].score == 0
    by_label = {(r.doc_id, r.label): r for r in spans.collect()}
    assert by_label[8, "mit-text"].first_word == 0 and by_label[8, "mit-text"].n_words == len(mit.split())


def _spans_by_hand(words, sentence, least=0.75):
    """Diagonals, their neighbours, every chain of these, and the best of them, without any shortcut."""
    template = sentence.split()
    runs = len(template) - 1
    places = {}
    for at in range(len(words) - 1):
        for t in range(runs):
            if words[at : at + 2] == template[t : t + 2]:
                places.setdefault(at - t, []).append(at)
    clusters, before = [], None
    for offset in sorted(places):
        if before is None or offset - before > 2:
            clusters.append([])
        clusters[-1].append((min(places[offset]), max(places[offset]), offset, len(places[offset])))
        before = offset
    out = []
    for cluster in clusters:
        found = [[d] for d in cluster]
        frontier = found
        while frontier:
            frontier = [
                c + [d] for c in frontier for d in cluster
                if d[0] > c[-1][1] and d[0] - d[2] > c[-1][1] - c[-1][2] and abs(d[2] - c[-1][2]) <= 2
            ]
            found = found + frontier
        spans = set()
        for last in cluster:  # the chain with most votes that ends here, the shortest of equals, and the diagonal by itself
            ending = [c for c in found if c[-1] == last]
            for c in (max(ending, key=lambda c: (sum(d[3] for d in c), c[0][0])), [last]):
                votes, first = sum(d[3] for d in c), c[0][0]
                spans.add((-min(1.0, votes / max(runs, last[1] - first + 1)), first, last[1]))
        kept = []
        for span in sorted(spans):
            if not kept or (-span[0] >= least and all(span[1] > k[2] or k[1] > span[2] for k in kept)):
                kept.append(span)
        out += kept
    return sorted((first, last + 2 - first, round(-share, 9)) for share, first, last in out)


def test_license_spans_by_hand(spark):
    rnd = random.Random(17)
    sentence = "the fox and the dog and the cow met the fox at noon"
    words = sentence.split()
    texts = [sentence, f"{sentence} the fox and the", f"x {sentence} the dog {sentence}", "the fox " * 12, sentence.replace("met", "and then met"), sentence.replace("dog and", "dog")]
    for _ in range(40):
        text = [rnd.choice(words) for _ in range(rnd.randrange(6))]
        for _ in range(rnd.randrange(1, 3)):
            quoted = list(words)
            for _ in range(rnd.randrange(4)):
                at = rnd.randrange(len(quoted))
                quoted[at : at + rnd.randrange(2)] = [rnd.choice(words)] * rnd.randrange(2)
            text += quoted + [rnd.choice(words) for _ in range(rnd.randrange(4))]
        texts.append(" ".join(text))
    spans, summary = license_scan.scan(_frame(spark, list(enumerate(texts))), phrases={}, notices={"own": [sentence]})
    found = defaultdict(list)
    for r in spans.collect():
        found[r.doc_id].append((r.first_word, r.n_words, round(r.share, 9)))
    scores = {r.doc_id: r.score for r in summary.collect()}
    for i, text in enumerate(texts):
        by_hand = _spans_by_hand(text.split(), sentence)
        assert sorted(found[i]) == [s for s in by_hand if s[2] >= 0.75], text
        assert scores[i] == pytest.approx(max((s[2] for s in by_hand), default=0.0))
    assert found[0] == [(0, 13, 1.0)] and len(found[2]) == 2


@pytest.mark.parametrize("tail", ["", " MIT License" * 6, " MIT License, MIT License, MIT License, MIT License", " released under the" * 5])
def test_a_verbatim_notice_is_never_lost(spark, tail):
    notice = "released under the MIT license"
    for text in (notice + tail, f"intro {tail} {notice} {tail}"):
        spans, summary = license_scan.scan(_frame(spark, [(1, text)]))
        assert "mit-text" in summary.first().labels.split(",") and summary.first().score == 1.0


def test_many_notices_in_one_text(spark):
    notice = license_scan.NOTICES["mit-text"][1]
    spans, _ = license_scan.scan(_frame(spark, [(1, f"{notice} " * 4000)]), notices={"mit-text": [notice]})
    assert spans.filter("label = 'mit-text'").count() == 4000


def test_license_scan_of_nothing(spark):
    assert license_scan.scan(_frame(spark, []))[1].count() == 0


# --- context trees


def _scores_by_hand(rows, learns, order):
    tree = defaultdict(lambda: [0, 0])

    def decisions(text):
        data = b"\0" * order + (text or "").encode().lower() + b"\xff"
        for i in range(order, len(data)):
            for j in range(8):
                yield data[i - order : i], (1 << j) | data[i] >> (8 - j), data[i] >> (7 - j) & 1

    for (_, text), learning in zip(rows, learns):
        for context, node, bit in decisions(text) if learning else ():
            for depth in range(order + 1):
                tree[context[order - depth :], node][bit] += 1

    def estimate(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    below = defaultdict(float)
    for depth in range(order, -1, -1):
        for (context, node), (a, b) in list(tree.items()):
            if len(context) == depth:
                own = estimate(a, b)
                weighted = own if depth == order else np.logaddexp(own, below[context, node]) - math.log(2)
                if depth:
                    below[context[1:], node] += weighted

    def one(context, node):
        for depth in range(order, -1, -1):
            key = context[order - depth :], node
            a, b = tree.get(key, (0, 0))
            own = (b + 0.5) / (a + b + 1)
            if depth == order:
                p = own
            else:
                share = 1 / (1 + math.exp(min(700, below.get(key, 0.0) - estimate(a, b))))
                p = share * own + (1 - share) * p
        return p

    return [sum(math.log10(one(c, n) if b else 1 - one(c, n)) for c, n, b in decisions(text)) for _, text in rows]


@pytest.mark.parametrize("order, block_bytes", [(2, 1 << 24), (5, 400)])
def test_context_trees(spark, order, block_bytes):
    rnd = random.Random(7)
    words = ["The", "cat", "sät", "on", "a", "mat,", "dog\n", "\tÉ"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 25)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n "), (103, "unseen zzz"), rows[0], (None, "the cat")]
    learns = [i is None or i % 7 != 2 for i, _ in rows]
    found = ctw.score_texts(_frame(spark, rows), F.coalesce(F.col("doc_id") % 7 != 2, F.lit(True)), order, block_bytes).collect()
    assert len(found) == len(rows)

    tokens = [[*(t or "").encode().lower().split(), b""] for _, t in rows]
    counts = Counter(w for ws, learning in zip(tokens, learns) if learning for w in ws)
    n, v = sum(counts.values()), len(counts)
    by_hand = _scores_by_hand(rows, learns, order)
    known = {r.doc_id: r for r in found}
    for (i, text), learning, ws, score in zip(rows, learns, tokens, by_hand):
        r = known[i]
        assert r.bits_per_byte == pytest.approx(-r.score * math.log2(10) / (len((text or "").encode()) + 1))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not learning, len(ws), sum(w in counts for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        assert r.score == pytest.approx(score, rel=1e-5, abs=1e-6)


def test_texts_are_gathered_in_small_slices():
    """Eight MB of texts with few distinct runs: what is held at once is that of a slice."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
    texts = [" ".join(rng.choices(words, k=2000)) for _ in range(700)]
    batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(700, np.int64)), pa.array([True] * 700), pa.array(texts)], ["block", "learns", "text"])
    tracemalloc.start()
    try:
        packs = pa.Table.from_batches(list(ctw._gather(1, 2)([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 64 << 20
    counts = Counter(w for text in texts for w in text.split())
    assert sorted(ctw._of_packs(packs, "words", "counts")[1].tolist()) == sorted(counts.values())
    assert ctw._of_packs(packs, "grams", "gram_counts")[1].sum() == sum(len(t) + 1 for t in texts)



def test_code_of_nothing(spark):
    assert ctw.score_texts(_frame(spark, []), F.lit(True)).count() == 0
    only = ctw.score_texts(_frame(spark, [(1, None)]), F.lit(False)).collect()[0]
    assert only.held_out and only.train_tokens == 0 and only.base_score == 0 and only.score == pytest.approx(8 * math.log10(0.5))


# --- benchmark passages


def _edited(words, rnd, share):
    out = []
    for w in words:
        x = rnd.random()
        if x < share / 2:
            out.append(f"new{rnd.randrange(99)}")
        elif x < 0.75 * share:
            continue
        elif x < share:
            out += [w, f"more{rnd.randrange(99)}"]
        else:
            out.append(w)
    return out


def test_contaminated(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(400)] + ["of", "the", "a"] * 60
    items = [[rnd.choice(words) for _ in range(rnd.randrange(12, 50))] for _ in range(20)]
    benchmark = [(i, " ".join(w)) for i, w in enumerate(items)] + [(50, " ".join(items[3])), (51, "two words"), (52, None), (None, "null id item here"), (53, "")]
    rows, planted = [], set()
    for i in range(200):
        text = [rnd.choice(words) for _ in range(rnd.randrange(0, 120))]
        if i % 4 == 0:
            k = rnd.randrange(20)
            at = rnd.randrange(len(text) + 1)
            text[at:at] = _edited(items[k], rnd, rnd.choice([0, 0.1, 0.2]))
            planted.add((i, k))
            if k == 3:
                planted.add((i, 50))
        rows.append((i, ", ".join(text) if i % 3 else " ".join(text).upper()))
    rows += [(900 + i, " ".join(items[5])) for i in range(300)]  # a passage that most texts hold is still found
    planted |= {(900 + i, 5) for i in range(300)}
    rows += [(2000, None), (2001, ""), rows[0], (None, " ".join(items[0]))]
    items_frame = spark.createDataFrame([(i, t, 0) for i, t in benchmark], "item_id long, text string, gram long")
    found = decontaminate.contaminated(_frame(spark, rows), items_frame).collect()
    pairs = [(r.doc_id, r.item_id) for r in found]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == planted
    assert all(0.5 <= r.share <= 1 and r.first_word <= r.last_word for r in found)


def test_edited_passage_is_found_at_any_number_of_copies(spark):
    items = [[f"{name}{i}" for i in range(16)] for name in ("few", "many", "mixed")]
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    edited = [" ".join("other" if i in (4, 11) else w for i, w in enumerate(words)) for words in items]
    rows = [(i, edited[0]) for i in range(30)] + [(100 + i, f"page {i} {edited[1]} end") for i in range(3000)]
    # One whole copy makes the runs of the unedited words known, too, and far rarer than the others.
    rows += [(5000 + i, edited[2]) for i in range(300)] + [(6000, " ".join(items[2]))]
    found = decontaminate.contaminated(_frame(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == (
        {(i, 0) for i in range(30)} | {(100 + i, 1) for i in range(3000)} | {(5000 + i, 2) for i in range(300)} | {(6000, 2)}
    )
    assert all(r.share == (16 if r.doc_id == 6000 else 13) / 16 for r in found)


def test_texts_that_are_not_aligned_hold_no_passage():
    rng = np.random.default_rng(12)
    left_out = 0
    for _ in range(400):
        item, text = rng.integers(0, 12, rng.integers(3, 12)).astype(np.uint64), rng.integers(0, 30, rng.integers(0, 60)).astype(np.uint64)
        for share in (0.3, 0.5, 0.8):
            if not decontaminate.may_reach(item, text, share * len(item)):
                left_out += 1
                assert decontaminate.align(item, text)[0] < share * len(item)
    assert left_out > 100


def test_alignment_by_hand():
    item = np.array([1, 2, 3, 4, 5, 6], dtype=np.uint64)
    align = decontaminate.align
    assert align(item, np.array([9, 9, 1, 2, 3, 4, 5, 6, 9], dtype=np.uint64)) == (6.0, 2, 7)
    assert align(item, np.array([1, 2, 9, 4, 5, 6], dtype=np.uint64)) == (4.5, 0, 5)
    assert align(item, np.array([8, 1, 2, 3, 5, 6], dtype=np.uint64)) == (4.5, 1, 5)
    assert align(item, np.array([1, 2, 3, 7, 4, 5, 6], dtype=np.uint64)) == (5.5, 0, 6)
    assert align(item, np.zeros(0, np.uint64)) == (0.0, -1, -1)
    rng = np.random.default_rng(9)
    for _ in range(60):
        a, b = rng.integers(0, 4, 9).astype(np.uint64), rng.integers(0, 4, 14).astype(np.uint64)
        cells = np.zeros((10, 15))
        for i in range(1, 10):
            for j in range(1, 15):
                step = decontaminate.MATCH if a[i - 1] == b[j - 1] else decontaminate.MISMATCH
                cells[i, j] = max(0, cells[i - 1, j - 1] + step, cells[i - 1, j] + decontaminate.GAP, cells[i, j - 1] + decontaminate.GAP)
        assert align(a, b)[0] == cells.max()


def _word_hashes(text):
    return np.concatenate([np.zeros(0, np.uint64), *[h for _, h in WordHasher(NO_LETTERS).texts([text])]])


@pytest.mark.parametrize("rare_items", [100, 3])
def test_pairs_are_those_of_aligning_all_texts_with_all_items(spark, rare_items):
    rnd = random.Random(21)
    stock = "which of the following is".split()
    word = lambda: f"w{rnd.randrange(400)}"
    items = [(i, " ".join((stock if i % 2 else []) + [word() for _ in range(rnd.randrange(8, 25))])) for i in range(14)]
    items += [(50, " ".join(stock + ["w1", "w2"])), (51, " ".join(stock + ["w3", "w4"]))]  # more than half is stock
    texts = []
    for i in range(200):
        body = [word() for _ in range(rnd.randrange(0, 60))]
        if i % 3 == 0:
            passage = rnd.choice(items)[1].split()
            for _ in range(rnd.choice([0, 1, 2, 4, 6])):
                passage[rnd.randrange(len(passage))] = word()
            at = rnd.randrange(len(body) + 1)
            body[at:at] = passage[rnd.randrange(3) :]
        if i % 4 == 0:
            body += stock
        texts.append((i, " ".join(body)))
    frame = spark.createDataFrame([(i, t, "", 0, 0) for i, t in items], "item_id long, text string, doc_id string, share int, lots int")
    found = {(r.doc_id, r.item_id): r.share for r in decontaminate.contaminated(_frame(spark, texts), frame, rare_items=rare_items).collect()}

    runs = lambda words: {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
    of_item = {i: runs(t.split()) for i, t in items}
    common = {g for g in set().union(*of_item.values()) if sum(g in r for r in of_item.values()) > rare_items}
    expected = {}
    for i, item in items:
        words = item.split()
        covered = {p for at in range(len(words) - 2) if tuple(words[at : at + 3]) in common for p in range(at, at + 3)}
        sought = of_item[i] if len(covered) >= 0.5 * len(words) else of_item[i] - common
        for d, text in texts:
            if sought & runs(text.split()):
                score = decontaminate.align(_word_hashes(item), _word_hashes(text))[0]
                if score >= 0.5 * len(words):
                    expected[d, i] = score / len(words)
    assert found == expected and len(found) > 60
    if rare_items == 3:
        assert common and {i for _, i in found} >= {50, 51}


def test_a_phrase_of_all_items_opens_no_pairs(spark):
    phrase = "choose the one that best completes the sentence"
    items = [(i, f"{phrase} " + " ".join(f"u{i}x{k}" for k in range(12))) for i in range(300)]
    texts = [(i, f"{phrase} " + " ".join(f"t{i}x{k}" for k in range(30))) for i in range(300)] + [(1000 + i, items[i][1]) for i in range(5)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    runs = decontaminate.gram_rows(benchmark, 3, NO_LETTERS, "item_id", "text").toDF("item_id", "item_place", "gram")
    pairs = decontaminate.seeded_pairs(_frame(spark, texts).select("doc_id", "text"), decontaminate.seeds(runs))
    assert {(r.doc_id, r.item_id) for r in pairs.collect()} == {(1000 + i, i) for i in range(5)}
    found = decontaminate.contaminated(_frame(spark, texts), benchmark)
    assert {(r.doc_id, r.item_id, r.share) for r in found.collect()} == {(1000 + i, i, 1.0) for i in range(5)}


def test_no_contamination(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one two three four five")], "item_id long, text string")
    assert decontaminate.contaminated(_frame(spark, [(1, "one two three four five")]), none).count() == 0
    assert decontaminate.contaminated(_frame(spark, []), some).count() == 0


# --- main text of pages

ARTICLE = (
    "<h1>Title &amp; more</h1><div class='byline'>By  me</div><p>First <b>bold</b>ness &eacute;, and so on. It goes on, and on, and on.</p>"
    "<p>Second paragraph;<br>more text here, with commas, and marks!<ul><li>one item</li><li>two</li></ul><p>Short."
)
TEXT = "Title & more By me First boldness é, and so on. It goes on, and on, and on. Second paragraph; more text here, with commas, and marks! one item two Short."
AROUND = (
    "<html><head><title>T</title><style>p{{}}</style><script>var t='</p><p>no</p>';</script></head><body class='has-sidebar'>"
    "<header><a href='/'>Site</a></header><div id='cookie-notice'>We use cookies, a lot, all of them. Do you agree?</div>"
    "<nav><ul><li><a>Home</a></li><li><a>News</a></li></ul></nav><!-- <p>not this</p> -->{}"
    "<aside>Side, bar, text. And more of it, and more.</aside><div class=\"ad box\">Buy now, it is cheap, very cheap!</div>"
    "<section id=comments><article class='comment'><p>I like it, really. It is good, very good, a long long comment.</p></article></section>"
    "<form><label>Your email</label><input></form><footer>&copy; 2020, all of it.</footer></body></html>"
)


@pytest.mark.parametrize("inner", [
    f"<article>{ARTICLE}</article>", f"<main><div class='content'>{ARTICLE}</div></main>", f"<div id='wrap'><div class='post'>{ARTICLE}</div></div>",
    f"<ARTICLE>{ARTICLE.replace('<p>', '<P class=x>')}<div class='ads'>No, no, no.</div></ARTICLE>",
])
def test_main_text(inner):
    assert html_text.main_text(AROUND.format(inner)) == TEXT


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("a < b, 1 <2", "a < b, 1 <2"), ("<p>open", "open"), ("<script>x", ""), ("<!-- x", ""), ("<p", ""),
    ("<article><h1>Only</h1><p><b>One.<br><p>Two</article>", "Only One. Two"), ("<p>&lt;b&gt; &#233;&nbsp;x</p>", "<b> é x"), ("</p></div>x<p></b>y</p>", "x y"),
    ("<nav>menu</nav>", ""), ("<div hidden>no</div><p>yes, yes.</p>", "yes, yes."), ("<p title=\"a > b\">text</p>", "text"), ("<p a=\"b>text", "text"),
])
def test_odd_pages(page, text):
    assert html_text.main_text(page) == text


BODY = "".join(f"<p>This is paragraph {i}, with a few words, some commas, and a full stop. It goes on for a while, too.</p>" for i in range(8))
SOURCES = "<ul>" + "".join(f"<li><a href=/{i}>Source number {i}</a></li>" for i in range(4)) + "</ul>"


def _text(markup):
    return " ".join(re.sub("<[^>]*>", " ", markup).split())


@pytest.mark.parametrize("article", [
    f"<div class=post><p>The lead says what follows, in short, and why.</p><div class=body>{BODY}</div><p>The closing words, at last, and thanks.</p></div>",
    f"<div class=post><h2>A title</h2><p>The lead says what follows, in short.</p><div><div class=body>{BODY}</div></div></div>",
    f"<div><p>The lead says what follows, in short.</p><ul>{BODY.replace('p>', 'li>')}</ul><p>The closing words, at last.</p></div>",
    f"<div><p>The lead says what follows, in short.</p><blockquote>{BODY}</blockquote><p>The closing words, at last.</p></div>",
    f"<article>{BODY}{SOURCES}</article>", f"<div class=post>{BODY}{SOURCES}<p>The closing words, at last, and thanks.</p></div>",
])
def test_whole_article(article):
    assert html_text.main_text(AROUND.format(article)) == _text(article)
    named = article.replace("</p><div", "</p><div class=share><a>Share this, now, with all.</a></div><div")
    assert html_text.main_text(AROUND.format(named)) == _text(article)


def test_unmarked_lists_of_links_around_an_article_stay_out():
    menu = "<div class=top>" + "".join(f"<div><a href=/{i}>Page {i}</a></div>" for i in range(9)) + "</div>"
    assert html_text.main_text(f"<body>{menu}<div class=post>{BODY}</div>{menu}</body>") == _text(BODY)
    assert html_text.main_text(f"<body>{menu}{BODY}{menu}</body>") == _text(BODY)


_PARAGRAPHS = [f"This is paragraph number {i}, which is long enough to count, and has commas." for i in range(8)]
_BODY = "".join(f"<p>{p}</p>" for p in _PARAGRAPHS)
_SIDE = "".join(f"<p>Beside the point {i}, which is long as well, with commas, and dull.</p>" for i in range(12))


@pytest.mark.parametrize("page, extra", [
    (f'<div class="container right-sidebar">{_BODY}</div>', ""),
    (f'<div id="search-results-page"><div class="promo">Buy now!</div>{_BODY}</div>', ""),
    (f'<div class="page menu-closed"><main>{_BODY}</main></div>', ""),
    (f'<div class="page menu-closed"><main>{_BODY}</main><div class="sidebar">{_SIDE}</div></div>', ""),
    (f'<div class="layout sidebar-left"><article>{_BODY}</article></div><div class="related"><article>{_SIDE}</article></div>', None),
    (f'<article><div class="post-header"><h1>Head line</h1></div>{_BODY}</article>', "Head line"),
    (f'<div class="wrap"><div class="post comments-open">{_BODY}</div><div id="comments"><p>Nice, I liked it very much, thank you.</p></div></div>', ""),
    (f'<article>{_BODY}</article><div class="comments">{_SIDE}{_SIDE}</div>', ""),
    (f'<div class="content">{_BODY}</div><div class="sidebar">{_SIDE}</div>', ""),
])
def test_a_name_doesnt_outweigh_the_ratios(page, extra):
    text = html_text.main_text(f"<html><body><nav><a>Home</a></nav>{page}<footer>Imprint</footer></body></html>")
    if extra is None:  # two articles: whichever is taken, it is whole, and the layout's name hides neither
        assert text
    else:
        assert text == " ".join(([extra] if extra else []) + _PARAGRAPHS)


def test_no_paragraph_is_lost_to_a_compound_name():
    page = f'<article>{_BODY}<p class="ad-free">This one, too, belongs here, and is long.</p><p class="ad">Buy now!</p></article>'
    assert html_text.main_text(page) == " ".join(_PARAGRAPHS) + " This one, too, belongs here, and is long."


def test_scores_by_plain_sums():
    rnd = random.Random(31)
    for _ in range(40):
        blocks = [
            html_text.Block("ab, c. " * rnd.randrange(1, 30), rnd.randrange(5), 0, rnd.random() < 0.3, rnd.randrange(0, 40)) for _ in range(rnd.randrange(1, 25))
        ]
        html_text.score_blocks(blocks)
        ratio = []
        for b in blocks:
            peers = [x for x in blocks if x.path == b.path and not x.side]
            chars = sum(len(x.text) for x in peers)
            if b.side or sum(x.linked for x in peers) > html_text.LINK_SHARE * chars:
                ratio.append(0.0)
            else:
                marks = sum(x.text.count(",") + x.text.count(".") for x in peers)
                ratio.append(chars / len(peers) * (1 + marks / len(peers)))
        padded = [0.0, *ratio, 0.0]
        for i, b in enumerate(blocks):
            expected = 0.25 * padded[i] + 0.5 * padded[i + 1] + 0.25 * padded[i + 2] if ratio[i] else 0.0
            assert b.score == pytest.approx(expected)


def test_extract(spark):
    rows = [(1, "u", AROUND.format(f"<article>{ARTICLE}</article>"), "x"), (2, None, None, "x"), (None, "v", "<p>a</p>", None), (1, "u", "", "x")]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(((r.page_id, r.url, r.text, r.n_chars) for r in found), key=str) == sorted(
        [(1, "u", TEXT, len(TEXT)), (2, None, "", 0), (None, "v", "a", 1), (1, "u", "", 0)], key=str
    )


def test_long_pages_take_linear_time():
    page = "<article>" + "<p>Word, word; word.</p><div><span>x</span>" * 20_000
    assert len(html_text.main_text(page)) > 300_000


# --- toxicity


def _labelled(seed, n):
    rnd = random.Random(seed)
    stems, plain = ["idiot", "lostra", "scum"], [f"{a}{b}{c}" for a in ("the", "on", "er") for b in ("tion", "ing", "ed", "ly") for c in ("", "a", "en", "or")]
    rows, labels = [], []
    for i in range(n):
        text = [rnd.choice(plain) for _ in range(rnd.randrange(5, 80))]
        toxic, low = rnd.random() < 0.2, rnd.random() < 0.3
        for _ in range(rnd.randrange(1, 4) if toxic else 0):
            text.insert(rnd.randrange(len(text) + 1), rnd.choice(stems) + rnd.choice(["", "s", "en", "ung"]) + rnd.choice(["", ",", "."]))
        text = [w + "%%%" for w in text] if low else text
        rows.append((i, " ".join(text).capitalize()))
        labels.append((i, int(low), int(toxic)))
    return rows, labels


def test_chain_finds_new_forms_of_stems(spark):
    rows, labels = _labelled(1, 2000)
    fresh = [(10_000 + i, t) for i, t in _labelled(2, 300)[0]]
    truth = {10_000 + i: (low, toxic) for i, low, toxic in _labelled(2, 300)[1]}
    extra = [(1, None, None), (None, 1, 1), labels[0], (99_999, 1, 1)]  # null and repeated labels, a label without text
    frame = spark.createDataFrame([*labels, *extra], "doc_id long, low long, toxic long")
    chain = toxicity.train(_frame(spark, rows), frame, ["low", "toxic"])
    docs = _frame(spark, [*fresh, (20_000, None), (20_001, ""), (20_002, "Lostraheitung! " * 2), (None, "x"), fresh[0]])
    found = toxicity.score(docs, chain).collect()
    assert len(found) == len(fresh) + 5
    scored = {r.doc_id: r for r in found}
    wrong = sum((scored[i].p_toxic >= 0.5) != toxic or (scored[i].p_low >= 0.5) != low for i, (low, toxic) in truth.items())
    assert wrong <= 6
    assert scored[20_000].p_toxic < 0.5 and scored[20_001].p_toxic < 0.5 and scored[20_002].p_toxic >= 0.5
    column = docs.withColumn("p", toxicity.probability(chain, "toxic")(F.col("text"))).collect()
    assert {(r.doc_id, r.p) for r in column} == {(r.doc_id, r.p_toxic) for r in found}


def test_copies_of_a_labelled_id_count_once(spark):
    rows, labels = _labelled(4, 400)
    frame = spark.createDataFrame(labels, "doc_id long, low_quality int, toxic int")
    copies = [(i, t) for i, t in rows[:3] for _ in range(1000)] + [(3, None)] * 50
    sample = toxicity.labelled_sample(_frame(spark, rows + copies), frame, ["low_quality", "toxic"], most=100)
    assert sample.count() == sample.select("doc_id").distinct().count() == 100
    once = toxicity.train(_frame(spark, rows), frame, ["low_quality", "toxic"])
    often = toxicity.train(_frame(spark, rows + copies), frame, ["low_quality", "toxic"])
    assert (once.runs == often.runs).all()
    assert all((a.weights == b.weights).all() and a.constant == b.constant for a, b in zip(once.links, often.links))
    different = toxicity.labelled_sample(_frame(spark, [(1, None), (1, "b"), (1, "a"), (2, None)]), frame, ["toxic"]).select("doc_id", "text")
    again = toxicity.labelled_sample(_frame(spark, [(2, None), (1, "a"), (1, None), (1, "b")]), frame, ["toxic"]).select("doc_id", "text")
    found = {tuple(r) for r in different.collect()}
    assert found == {tuple(r) for r in again.collect()} and found in ({(1, "a"), (2, None)}, {(1, "b"), (2, None)})


def test_later_link_uses_earlier_ones():
    rng = np.random.default_rng(3)
    first = rng.random(2000) < 0.5
    noise = rng.random(2000) < 0.1
    columns = [np.array([0] if f ^ n else [], dtype=np.int64) for f, n in zip(first, noise)]
    labels = np.column_stack([first, first])
    chain = toxicity.fit_chain(np.array([5], np.uint64), columns, labels, ["a", "b"], np.arange(2000) % 5)
    assert chain.links[1].earlier[0] > 0 and len(chain.links[0].earlier) == 0
    p = chain.probabilities(columns)
    assert ((p[:, 1] > 0.5) == first).mean() > 0.85


def _newton(x, y, ridge):
    """The same regression by Newton's method on a dense matrix."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [0.0])
    theta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ theta))
        theta -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (p - y) + penalty @ theta)
    return theta


def test_chain_by_dense_solver():
    rng = np.random.default_rng(8)
    n, k = 300, 6
    x = (rng.random((n, k)) < 0.3).astype(float)
    first = rng.random(n) < 1 / (1 + np.exp(-(x @ [2, -1, 0, 1, 0, 0] - 0.5)))
    second = rng.random(n) < 1 / (1 + np.exp(-(x @ [0, 0, 1, 0, -2, 1] + 2 * first - 1)))
    labels, folds = np.column_stack([first, second]), np.arange(n) % 5
    chain = toxicity.fit_chain(np.arange(k, dtype=np.uint64), [np.flatnonzero(r) for r in x], labels, ["a", "b"], folds, steps=4000)
    outside = np.zeros(n)
    for fold in range(5):
        theta = _newton(x[folds != fold], first[folds != fold], 1.0)
        outside[folds == fold] = 1 / (1 + np.exp(-(x[folds == fold] @ theta[:-1] + theta[-1])))
    one, two = _newton(x, first, 1.0), _newton(np.column_stack([x, outside]), second, 1.0)
    assert np.allclose([*chain.links[0].weights, chain.links[0].constant], one, atol=1e-4)
    assert np.allclose([*chain.links[1].weights, *chain.links[1].earlier, chain.links[1].constant], two, atol=1e-4)
    p = 1 / (1 + np.exp(-(x @ one[:-1] + one[-1])))
    q = 1 / (1 + np.exp(-(np.column_stack([x, p]) @ two[:-1] + two[-1])))
    assert np.allclose(chain.probabilities([np.flatnonzero(r) for r in x]), np.column_stack([p, q]), atol=1e-4)


def test_labels_of_one_kind_and_none(spark):
    docs = _frame(spark, [(i, f"text {i}") for i in range(20)])
    one = toxicity.train(docs, spark.createDataFrame([(i, 0, 0) for i in range(20)], "doc_id long, a int, b int"), ["a", "b"])
    assert toxicity.score(docs, one).filter("p_a > 0.1 OR p_b > 0.1").count() == 0
    none = toxicity.train(docs, spark.createDataFrame([], "doc_id long, a int, b int"), ["a", "b"])
    assert toxicity.score(docs, none).filter("p_a > 0.1 OR p_b > 0.1").count() == 0
    assert toxicity.score(_frame(spark, []), none).count() == 0
