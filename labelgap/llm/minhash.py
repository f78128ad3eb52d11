"""Near-duplicate texts by one-permutation hashing.

Every distinct run of five words is hashed once; the top bits choose one of 128
bins and the least hash in a bin is its value. An empty bin takes the value of
the first full bin in a random order of its own (optimal densification), so
that two texts agree in a bin with the probability of their similarity. Four bins
make a band; texts that agree in a band are candidates. In each bucket every
text is linked to the least one only, a star, so a bucket of n texts costs n
candidates. A star is confirmed on the full sets. Only buckets whose texts are
not all connected after that are looked at pair by pair, in chunks inside tasks,
and only pairs of different components that may be similar by finer bins leave them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgap.llm.components import components
from labelgap.llm.grouped import chunk_pairs, groups, one_by_one
from labelgap.llm.stages import numbered_texts, staged, unstage
from labelgap.llm.words import BLANKS, WordHasher, distinct_runs, mixed

BINS = 128
ROWS_PER_BAND = 4
#: Bins by which the similarity of a candidate is estimated before its texts are fetched; these are never filled up.
FINE_BINS = 512
#: Texts of one bucket that meet in one task when a bucket is searched pair by pair.
CHUNK_ROWS = 1024

_DONORS = np.argsort(mixed(np.arange(BINS * BINS, dtype=np.uint64) + np.uint64(1)).reshape(BINS, BINS), axis=1)


def _firsts(shingles: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted distinct hashes, the bins that have any and the least hash of each."""
    index = (shingles >> np.uint64(64 - bins.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(index, prepend=-1))  # sorted: the first of a bin is its least
    return index[first], shingles[first]


def bins_of(shingles: np.ndarray) -> np.ndarray:
    """The densified bins of sorted distinct hashes (not none)."""
    index, least = _firsts(shingles, BINS)
    values = np.zeros(BINS, dtype=np.uint64)
    full = np.zeros(BINS, dtype=bool)
    values[index], full[index] = least, True
    if not full.all():
        empty = np.flatnonzero(~full)
        order = _DONORS[empty]
        values[empty] = values[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
    return values


def _bands(values: np.ndarray, rows: int) -> np.ndarray:
    key = np.arange(len(values) // rows, dtype=np.uint64) + np.uint64(1)
    for column in values.reshape(-1, rows).T:
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key


def fine_bins(shingles: np.ndarray) -> np.ndarray:
    """A byte per fine bin: 0 if it is empty, else one that its least hash determines."""
    index, least = _firsts(shingles, FINE_BINS)
    marks = np.zeros(FINE_BINS, dtype=np.uint8)
    marks[index] = least % np.uint64(255) + np.uint64(1)
    return marks


def likely_similar(left: np.ndarray, right: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs may reach the similarity, from rows of fine bins and the sizes of the sets.

    The bins that either text fills are a draw without replacement from the union, of which a bin in
    which both agree shows a common run. A pair at the threshold stays five standard deviations below its share
    with a probability of less than one in a million.
    """
    share = percent / 100
    filled = ((left | right) > 0).sum(axis=1)
    equal = ((left == right) & (left > 0)).sum(axis=1)
    union = (sizes_a + sizes_b) / (1 + share)
    spread = np.sqrt(filled * share * (1 - share) * np.clip(1 - filled / union, 0, 1))
    sized = 100 * np.minimum(sizes_a, sizes_b) >= percent * np.maximum(sizes_a, sizes_b)
    return sized & (equal >= share * filled - 5 * spread - 1)


_SKETCH = "doc_id long, n_shingles long, digest_a long, digest_b long, bands array<bigint>, bins binary"


def sketches(df: DataFrame, k: int = 5, rows_per_band: int = ROWS_PER_BAND, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: size and digest of the set of runs, the keys of its bands, and its fine bins."""

    def run(batches):
        hasher = WordHasher(BLANKS)
        for batch in batches:
            sizes, a, b, bands, bins = [], [], [], [], []
            for counts, hashes in hasher.texts(one_by_one(batch.column(1))):
                for shingles in distinct_runs(counts, hashes, k):
                    sizes.append(len(shingles))
                    a.append(int(shingles.sum(dtype=np.uint64).astype(np.int64)))
                    b.append(int(mixed(shingles).sum(dtype=np.uint64).astype(np.int64)))
                    if len(shingles):
                        values = bins_of(shingles)
                        bands.append(_bands(values, rows_per_band).astype(np.int64))
                        bins.append(fine_bins(shingles).tobytes())
                    else:
                        bands.append(np.zeros(0, np.int64))
                        bins.append(b"")
            offsets = pa.array(np.cumsum([0, *map(len, bands)]), pa.int32())
            keys = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int64), *bands]), pa.int64()))
            columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, a, b)), keys, pa.array(bins, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest_a", "digest_b", "bands", "bins"])

    return numbered_texts(df, id_column, text_column).mapInArrow(run, _SKETCH)


def _rows_of_bins(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, FINE_BINS)


def _likely(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs that may reach the similarity by their sizes and fine bins."""
    side = texts.select("doc_id", "n_shingles", "bins")
    joined = pairs.join(side.toDF("a", "n_a", "bins_a"), "a").join(side.toDF("b", "n_b", "bins_b"), "b")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                sizes = (batch.column(i).to_numpy() for i in (2, 3))
                good = likely_similar(_rows_of_bins(batch.column(4)), _rows_of_bins(batch.column(5)), *sizes, percent)
                yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good))

    return joined.select("a", "b", "n_a", "n_b", "bins_a", "bins_b").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    first, second = texts.toDF("a", "text_a"), texts.toDF("b", "text_b")
    joined = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")

    def run(batches):
        hasher, last_id, last_set = WordHasher(BLANKS), None, None

        def whole(text):
            found = list(hasher.texts([text]))
            return next(distinct_runs(*found[0], k))

        for batch in batches:
            good = []
            for _, b, text_a, text_b in zip(*map(one_by_one, batch.columns)):
                if b != last_id:  # the rows of one star's centre come together
                    last_id, last_text, last_set = b, text_b, whole(text_b)
                elif text_b != last_text:
                    last_text, last_set = text_b, whole(text_b)
                own = whole(text_a)
                common = len(np.intersect1d(own, last_set, assume_unique=True))
                good.append(100 * common >= percent * (len(own) + len(last_set) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return joined.mapInArrow(run, "a long, b long")


def _rest(members: DataFrame, reached: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a bucket, as far as they may be similar."""
    labelled = members.join(reached.toDF("doc_id", "component"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    open_buckets = (
        labelled.groupBy("band").agg(F.min("component").alias("low_c"), F.max("component").alias("high_c"), F.count(F.lit(1)).alias("n_members"))
        .filter("low_c != high_c").select("band", "n_members")
    )
    rows = labelled.join(open_buckets, "band").join(texts.select("doc_id", "n_shingles", "bins", "bands"), "doc_id")
    dealt = chunk_pairs(rows, "band", F.col("doc_id"), F.col("n_members"), CHUNK_ROWS)

    def run(batches):
        for table in groups(batches, ["band", "low", "high"]):
            ids, labels, sizes, chunk = (table.column(c).to_numpy() for c in ("doc_id", "component", "n_shingles", "chunk"))
            bins = _rows_of_bins(table.column("bins"))
            bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            earlier = bands[:, : int(np.argmax(bands[0] == table.column("band")[0].as_py()))]
            low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
            left, right = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
            for at in range(0, len(left), 32):
                part = left[at : at + 32, None]
                good = (labels[part] != labels[right]) & (ids[part] != ids[right])
                if low == high:
                    good &= ids[part] < ids[right]
                good &= 100 * np.minimum(sizes[part], sizes[right]) >= percent * np.maximum(sizes[part], sizes[right])
                i, j = np.nonzero(good)
                i, j = left[at + i], right[j]
                enough = [likely_similar(bins[i[s:e]], bins[j[s:e]], sizes[i[s:e]], sizes[j[s:e]], percent) for s, e in zip(range(0, len(i), 4096), range(4096, len(i) + 4096, 4096))]
                enough = np.concatenate([np.zeros(0, bool), *enough])
                i, j = i[enough], j[enough]
                # A pair that shares several buckets is named in the first of them.
                first = ~(earlier[i] == earlier[j]).any(axis=1)
                a, b = ids[i[first]], ids[j[first]]
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])

    return dealt.select("band", "low", "high", "chunk", "doc_id", "component", "n_shingles", "bins", "bands").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(
    df: DataFrame, k: int = 5, percent: int = 75, rows_per_band: int = ROWS_PER_BAND, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Groups of texts whose sets of ``k``-word runs are similar: ``doc_id, n_shingles, component_id, kept``.

    Two texts are linked if ``100 * |intersection| >= percent * |union|``; groups are what links
    connect. A text of fewer words is one run; a null text, or one without words, has an empty set and
    is linked with nothing. Equal sets are one class from the start and only its least id goes on,
    so a group of copies of any size costs a row per task. Rows with one id are one document; a
    row with a null id is linked with nothing, has a null component, and is kept. An empty table
    gives an empty result. With 32 bands of four bins a pair at the threshold is missed with a probability of 5e-6.
    """
    sketch = staged(sketches(df, k, rows_per_band, id_column, text_column), "sketches")
    present = sketch.filter("doc_id IS NOT NULL AND n_shingles > 0")
    digest = ["digest_a", "digest_b", "n_shingles"]
    classes = present.groupBy(*digest).agg(F.min("doc_id").alias("doc_id"))
    firsts = present.join(classes, [*digest, "doc_id"]).dropDuplicates([*digest, "doc_id"])

    placed = firsts.select("doc_id", F.explode("bands").alias("band"))
    buckets = placed.groupBy("band").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("greatest")).filter("centre != greatest")
    members = staged(placed.join(buckets.select("band", "centre"), "band"), "members")

    involved = members.select("doc_id").distinct()
    sides = staged(firsts.select("doc_id", "n_shingles", "bins", "bands").join(involved, "doc_id", "left_semi"), "sides")
    texts = numbered_texts(df, id_column, text_column).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    texts = staged(texts.join(involved, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]), "texts")

    stars = members.filter("doc_id != centre").select(F.col("doc_id").alias("a"), F.col("centre").alias("b")).distinct()
    links = staged(_confirmed(_likely(stars, sides, percent), texts, k, percent).distinct(), "links")
    own = staged(present.select("doc_id", *digest).join(classes.withColumnRenamed("doc_id", "first_id"), digest), "own")
    # An id whose rows have different sets connects their classes.
    several = own.groupBy("doc_id").agg(F.min("first_id").alias("b"), F.max("first_id").alias("greatest")).filter("b != greatest")
    links = links.unionByName(own.join(several, "doc_id").select(F.col("first_id").alias("a"), "b"))
    reached = components(links)
    rest = staged(_rest(members, reached, sides, percent), "rest")
    if not rest.isEmpty():
        more = staged(_confirmed(rest, texts, k, percent).distinct(), "links")
        reached = components(links.unionByName(more))
    for table in (members, sides, texts, rest):  # the result needs none of them
        unstage(table)

    grouped = own.join(reached.toDF("first_id", "component"), "first_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "first_id").alias("component_id")
    )
    alone = sketch.filter("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return grouped.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
