"""Tokenizing operators against the libraries and against plain counting."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from labelgap.llm import queries, token_file
from labelgap.llm.pieces import PieceIds
from labelgap.llm.prefix_bpe import EditableEncoding, PrefixBpe, decode_ids, encode_texts, encoding_digests, loaded, read_ranks
from labelgap.llm.token_counts import encoded_lengths, length_histogram, length_quantiles, truncated_totals

PATTERN = public_tokenizers.PATTERN
EDGE = ["", "a", "  ", " \n", "a  b", "a\n  b", "\n \nx", "it's 'tis we'll", "naïve Ωmega 中文 १२", "<|endoftext|> x", "aa " * 4000, "z" * 3000]
SCHEMA = "doc_id long, ids string, tie string, place int, text string"


def _texts(n=400, seed=1):
    rnd = random.Random(seed)
    return EDGE + ["".join(rnd.choice("abcdehint    \n\n\t'sl.éß中9 ࢏") for _ in range(rnd.randrange(60))) for _ in range(n)]


@pytest.fixture(scope="module")
def encoding():
    bpe, _ = loaded(queries.MULTI_RANKS, PATTERN)
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


@pytest.fixture(scope="module")
def rows(spark):
    """Every text once, some twice, a null text, a null id; columns with names the operators use."""
    data = [(i, "x", "y", 0, t) for i, t in enumerate(_texts())]
    data += [data[3], (9000, None, None, None, None), (None, "x", "y", 1, "no id")]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def test_prefix_bpe_is_exact(encoding):
    bpe, known = loaded(queries.MULTI_RANKS, PATTERN)
    for text in _texts():
        assert bpe.encode(text) == encoding.encode_ordinary(text)
        assert known.ids([text])[0].tolist() == encoding.encode_ordinary(text)
        assert bpe.decode(bpe.encode(text)) == text.encode()


def test_code_points_split_alike(encoding):
    _, known = loaded(queries.MULTI_RANKS, PATTERN)
    for first in range(0, 0x30000, 0x800):
        text = "".join(f" {chr(c)}'d {chr(c)}1{chr(c)}  {chr(c)}\n" for c in range(first, first + 0x800) if not 0xD800 <= c < 0xE000)
        assert known.ids([text])[0].tolist() == encoding.encode_ordinary(text), hex(first)


def test_remembered_pieces_are_forgotten(monkeypatch, encoding):
    _, known = loaded(queries.MULTI_RANKS, PATTERN)
    monkeypatch.setattr("labelgap.llm.pieces.REMEMBERED_PIECES", 20)
    texts = [*_texts(), None, ""]
    for first in range(0, len(texts), 7):
        some = texts[first : first + 7]
        assert [ids.tolist() for ids in known.ids(some)] == [encoding.encode_ordinary(t or "") for t in some]


def test_frequent_pieces_stay_remembered():
    asked = Counter()

    def encode(new):
        asked.update(new)
        return np.array([len(p) for p in new], np.uint32), np.ones(len(new), np.int64)

    known = PieceIds(str.split, encode, 1000)
    for at in range(0, 20_000, 100):
        pieces = [f"often{i}" + "x" * i for i in range(50)] + [f"rare{'y' * (at % 7)}{i}" for i in range(at, at + 100)]
        assert known.ids([" ".join(pieces), None])[0].tolist() == [len(p) for p in pieces]
        assert len(known._numbers) <= 1200
    assert max(asked.values()) == 1  # the frequent ones were asked for 20 times when all were forgotten


def test_long_pieces_are_forgotten(monkeypatch):
    monkeypatch.setattr("labelgap.llm.pieces.REMEMBERED_CHARACTERS", 1000)
    known = PieceIds(str.split, lambda new: (np.array([len(p) for p in new], np.uint32), np.ones(len(new), np.int64)), 1000)
    for n in range(300, 400):
        text = f"{'a' * 300} {'b' * n} {'a' * 300} c c"
        assert known.ids([text])[0].tolist() == [300, n, 300, 1, 1]
        assert known._characters == sum(map(len, known._numbers)) <= 1000 + 2 * n


def test_pairs_are_told_without_running_their_merges(monkeypatch, encoding):
    bpe = PrefixBpe(read_ranks(queries.MULTI_RANKS), PATTERN)
    monkeypatch.setattr(bpe, "merged", None)
    for text in _texts():
        assert bpe.encode(text) == encoding.encode_ordinary(text)


@pytest.mark.parametrize("seed", range(60))
def test_pairs_are_stable_as_by_their_merges(seed):
    """Vocabularies whose merges rise in rank, and any others, with tokens that no merges lead to."""
    rnd = random.Random(seed)
    made = [b"a", b"b", b"c"]
    for _ in range(40):
        new = rnd.choice(made) + rnd.choice(made) if seed % 3 else bytes(rnd.choices(b"abc", k=rnd.randrange(2, 6)))
        if new not in made and len(new) < 14:
            made.append(new)
    if seed % 3 == 2:
        rnd.shuffle(made)
    bpe = PrefixBpe({token: rank for rank, token in enumerate(made)}, PATTERN)
    for token, data in bpe.tokens.items():
        assert bpe.stable(-1, token) == (bpe.merged(data) == [token])
        for before, first in bpe.tokens.items():
            assert bpe.stable(before, token) == (bpe.merged(first + data) == [before, token]), (first, data)


def test_every_prefix_has_its_last_token(encoding):
    bpe, _ = loaded(queries.MULTI_RANKS, PATTERN)
    data, last = "internationalisation".encode(), []
    bpe.extend(data, last)
    for end in range(1, len(data) + 1):
        assert bpe.read_off(data[:end], last[:end]) == encoding.encode_ordinary(data[:end].decode())


def test_appends_and_edits_are_exact_and_reuse():
    bpe, _ = loaded(queries.MULTI_RANKS, PATTERN)
    rnd = random.Random(2)
    computed = total = 0
    for _ in range(150):
        editable = EditableEncoding(bpe, "".join(rnd.choice("abcdehint   \n'slvre9é") for _ in range(300)))
        for _ in range(6):
            start = rnd.choice([len(editable.text), rnd.randrange(len(editable.text) + 1)])
            before = editable.computed
            editable.replace(start, start + rnd.randrange(4), "".join(rnd.choice("ab '\nlt") for _ in range(rnd.randrange(4))))
            computed, total = computed + editable.computed - before, total + len(editable.text.encode())
            assert editable.ids == bpe.encode(editable.text)
    assert computed < 0.1 * total


def test_digests(rows, encoding):
    found = sorted(encoding_digests(rows, queries.MULTI_RANKS, PATTERN).collect(), key=str)
    expected = []
    for r in rows.collect():
        ids = encoding.encode_ordinary(r.text or "")
        expected.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted((tuple(f) for f in found), key=str) == sorted(expected, key=str)


def test_ids_round_trip(rows):
    ids = encode_texts(rows, queries.MULTI_RANKS, PATTERN)
    data = {(r.doc_id, bytes(r.data)) for r in decode_ids(ids, queries.MULTI_RANKS, PATTERN).collect()}
    assert data == {(r.doc_id, (r.text or "").encode()) for r in rows.collect()}


def test_histogram(rows):
    lengths = encoded_lengths(rows, queries.BYTE_RANKS, PATTERN)
    n = np.array([r.n_tokens for r in lengths.collect()])
    histogram = length_histogram(lengths)
    found = {r.n_tokens: r for r in histogram.collect()}
    assert set(found) == set(n.tolist())
    for length, r in found.items():
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == ((n == length).sum(), (n >= length).sum(), n[n >= length].sum())
        assert (r.total_docs, r.total_tokens, r.truncated_tokens) == (len(n), n.sum(), np.minimum(n, length).sum())
    limits = [0, 1, 7, 100, 10**6]
    assert {r.context_limit: r.truncated_tokens for r in truncated_totals(histogram, limits).collect()} == {m: np.minimum(n, m).sum() for m in limits}
    shares = [0.0, 0.1, 0.5, 0.99, 1.0]
    expected = {s: int(np.sort(n)[max(0, int(np.ceil(s * len(n))) - 1)]) for s in shares}
    assert {r.share: r.n_tokens for r in length_quantiles(histogram, shares).collect()} == expected


def test_pack_is_lossless():
    rng = np.random.default_rng(0)
    for ids in (np.zeros(0), np.array([7]), rng.integers(0, 300, 1001), rng.integers(0, 70_000, 200_003), rng.integers(0, 2**32, 5000)):
        ids = ids.astype(np.uint32)
        ranked, control, data = token_file.pack(ids)
        assert len(control) == -(-len(ids) // 4)
        assert (token_file.unpack(ranked, control, data, len(ids)) == ids).all()
    common = np.array([50_000] * 90 + [3] * 10, np.uint32)
    assert len(token_file.pack(common)[2]) == 100  # frequent ids take a byte


@pytest.mark.parametrize("block_ids", [50, 1 << 19])
def test_token_file(spark, rows, tmp_path, block_ids):
    out = str(tmp_path / "tokens")
    token_file.write_token_file(rows, out, queries.BYTE_TOKENIZER, PATTERN, block_ids=block_ids)
    library = Tokenizer.from_file(queries.BYTE_TOKENIZER)
    own = {(r.doc_id, tuple(library.encode(r.text or "", add_special_tokens=False).ids + [2])) for r in rows.collect()}
    read = token_file.read_token_file(spark, out).collect()
    assert {(r.doc_id, tuple(r.ids)) for r in read} == own and len(read) == rows.count()
    in_order = sorted(read, key=lambda r: r.start)
    ids = [r.doc_id if r.doc_id is not None else -1 for r in in_order]
    assert ids == sorted(ids)
    assert [r.start for r in in_order] == np.cumsum([0, *[r.n_tokens for r in in_order]])[:-1].tolist()
    sums = {(r.doc_id, r.start): r.ids_crc32 for r in token_file.read_token_digests(spark, out).collect()}
    assert sums == {(r.doc_id, r.start): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in read}


SPECIAL = [
    "hello <|endoftext|> world", "<|endoftext|>", "<|endoftext|><|endoftext|>", "a  <|endoftext|>  b\n<|endoftext|>", "<|endoftext|> c", "<|endof<|endoftext|>text|>",
    "x<|endoftext|", "é  <|endoftext|>ü 你好 <|endoftext|> \U0001f600", "no more ", "", "\x00\xad\u0301 \t\n",
]


@pytest.mark.parametrize("special", [True, False])
def test_special_tokens_are_those_of_the_library(spark, tmp_path, special):
    out = str(tmp_path / "tokens")
    frame = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string")
    token_file.write_token_file(frame, out, queries.BYTE_TOKENIZER, PATTERN, special_tokens=special)
    library = Tokenizer.from_file(queries.BYTE_TOKENIZER)
    library.encode_special_tokens = not special
    found = {r.doc_id: list(r.ids) for r in token_file.read_token_file(spark, out).collect()}
    assert found == {i: [*library.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(SPECIAL)}
    assert (found[0] == [31373, 220, 50256, 995, 2]) == special


def test_byte_characters():
    from tokenizers import pre_tokenizers

    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    characters = token_file.byte_characters()
    for text in ("".join(map(chr, range(0x250))), "\u2028你\U0001f600\ue000"):
        assert text.encode().decode("latin-1").translate(characters) == level.pre_tokenize_str(text)[0][0]
    assert len(set(characters.values())) == 256 and set(characters.values()) == set(pre_tokenizers.ByteLevel.alphabet())


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    out = str(tmp_path / "tokens")
    token_file.write_token_file(none, out, queries.BYTE_TOKENIZER, PATTERN)
    assert token_file.read_token_digests(spark, out).count() == 0
    assert encoding_digests(none, queries.MULTI_RANKS, PATTERN).count() == 0
    assert length_histogram(encoded_lengths(none, queries.BYTE_RANKS, PATTERN)).count() == 0
