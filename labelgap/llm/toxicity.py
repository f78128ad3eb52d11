"""Toxicity of texts by a chain of linear classifiers.

Categories are predicted one after the other. Each link of the chain is a
logistic regression over the runs of five bytes that a text holds, and over the
probabilities the earlier links gave. While a link is fitted, these earlier
probabilities are out of fold: each row's come from models that did not see it,
so a later link learns how far an earlier one is to be trusted on new texts.
Runs of bytes, not words, let a stem count in forms that no labelled text has.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgap.llm.stages import numbered_texts, staged

#: Bytes of a feature.
RUN_BYTES = 5
#: Labelled ids that a chain is fitted on, the first by a hash, with one row each; the driver holds their chosen features.
MAX_LABELLED = 20_000
#: Features kept per category, by the strength of their association with it.
FEATURES_PER_CATEGORY = 1_000
#: Labelled texts that must hold a feature.
LEAST_TEXTS = 5
FOLDS = 5
_MASK_BITS = 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes looked at together; a longer text is taken in overlapping parts.
_PART_BYTES = 1 << 22
#: Runs that are gathered before equal ones are counted together.
_MERGED_AT = 1 << 19


def byte_runs(text: str | None) -> np.ndarray:
    """Every run of five bytes of a text in lower case between blanks, as numbers; repeated runs stay."""
    data = np.frombuffer(b" " + text.encode().lower() + b" " if text else b"", np.uint8)
    n = len(data) - RUN_BYTES + 1
    found = np.zeros(max(n, 0), dtype=np.uint64)
    for i in range(RUN_BYTES if n > 0 else 0):
        found = (found << np.uint64(8)) | data[i : i + n]
    return found


def _slots(runs: np.ndarray) -> np.ndarray:
    return (runs * _SPREAD >> np.uint64(64 - _MASK_BITS)).astype(np.int64)


class Chosen:
    """Finds the chosen runs of a text: a bit table leaves few positions for the exact search."""

    def __init__(self, runs: np.ndarray):
        self.runs = runs
        self.mask = np.zeros(1 << _MASK_BITS, dtype=bool)
        self.mask[_slots(runs)] = True

    def columns(self, text: str | None) -> np.ndarray:
        """Positions among the chosen runs of those the text holds, each once."""
        found = [np.zeros(0, np.int64)]
        text = text or ""
        for at in range(0, max(len(text), 1), _PART_BYTES):
            part = byte_runs(text[max(0, at - RUN_BYTES) : at + _PART_BYTES])
            if len(self.runs) and len(part):
                part = part[self.mask[_slots(part)]]
                place = np.minimum(np.searchsorted(self.runs, part), len(self.runs) - 1)
                found.append(place[self.runs[place] == part])
        return np.unique(np.concatenate(found))


@dataclass
class Link:
    """One logistic regression: weights of the chosen runs, of the earlier links' probabilities, and the constant."""

    category: str
    weights: np.ndarray
    earlier: np.ndarray
    constant: float


@dataclass
class Chain:
    runs: np.ndarray
    links: list[Link]

    def probabilities(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """A row per text and a column per category."""
        found = np.zeros((len(columns), len(self.links)))
        flat = np.concatenate([np.zeros(0, np.int64), *columns])
        row = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
        for i, link in enumerate(self.links):
            found[:, i] = _probability(link.constant + found[:, :i] @ link.earlier + np.bincount(row, link.weights[flat], len(columns)))
        return found


def _probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-odds))


def _fit(row: np.ndarray, column: np.ndarray, n_columns: int, earlier: np.ndarray, y: np.ndarray, ridge: float, steps: int):
    """Logistic regression with a ridge, by accelerated gradient steps; ``row`` and ``column`` name the ones of a sparse matrix."""
    n, k = earlier.shape
    base = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    theta = np.zeros(n_columns + k + 1)
    theta[-1] = np.log(base / (1 - base))
    if n == 0 or y.min() == y.max():
        return theta

    def scores(t):
        return np.bincount(row, t[column], n) + earlier @ t[n_columns:-1] + t[-1]

    def back(r):
        return np.concatenate([np.bincount(column, r[row], n_columns), earlier.T @ r, [r.sum()]])

    direction = np.ones(len(theta))
    for _ in range(20):  # the largest curvature, which sets the step
        direction = back(scores(direction))
        size = np.linalg.norm(direction)
        direction /= size
    step = 1 / (0.25 * size * 1.05 + ridge)
    point, previous = theta.copy(), theta
    for i in range(steps):
        gradient = back(_probability(scores(point)) - y)
        gradient[:-1] += ridge * point[:-1]
        theta = point - step * gradient
        point = theta + i / (i + 3) * (theta - previous)
        previous = theta
    return theta


def fit_chain(
    runs: np.ndarray, columns: list[np.ndarray], labels: np.ndarray, categories: Sequence[str], folds: np.ndarray,
    ridge: float = 1.0, steps: int = 300,
) -> Chain:
    """Fit the links in order; ``labels`` has a column per category, ``folds`` a number from 0 per row."""
    flat = np.concatenate([np.zeros(0, np.int64), *columns])
    row = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    n = len(columns)
    earlier = np.zeros((n, 0))
    links = []
    for i, category in enumerate(categories):
        y = labels[:, i].astype(float) if n else np.zeros(0)
        theta = _fit(row, flat, len(runs), earlier, y, ridge, steps) if n else np.zeros(len(runs) + i + 1) - np.eye(1, len(runs) + i + 1, len(runs) + i)[0] * 13
        links.append(Link(category, theta[: len(runs)], theta[len(runs) : -1], float(theta[-1])))
        outside = np.zeros(n)
        for fold in np.unique(folds):
            seen = folds != fold
            inner = seen[row]
            renumbered = np.cumsum(seen) - 1
            part = _fit(renumbered[row[inner]], flat[inner], len(runs), earlier[seen], y[seen], ridge, steps) if seen.any() else theta
            score = np.bincount(row, part[: len(runs)][flat], n) + earlier @ part[len(runs) : -1] + part[-1]
            outside[~seen] = _probability(score[~seen])
        earlier = np.column_stack([earlier, outside])
    return Chain(runs, links)


def labelled_sample(docs: DataFrame, labels: DataFrame, categories: Sequence[str], most: int = MAX_LABELLED) -> DataFrame:
    """Texts of a bounded draw of labelled ids, with 0 or 1 per category: ``doc_id, text, <category>...``.

    Rows with a null id or label don't count; an id labelled twice takes the greater label. Of rows with one id
    one counts, whose text is the first by its hash; a null text only if there is no other.
    """
    flags = [F.max(F.col(f"`{c}`").cast("int")).alias(f"y{i}") for i, c in enumerate(categories)]
    valid = labels.withColumn("doc_id", F.col("doc_id").cast("long")).dropna(subset=["doc_id", *categories])
    drawn = valid.groupBy("doc_id").agg(*flags).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # At most ``most`` rows of a few numbers: a broadcast of known size.
    rows = numbered_texts(docs).join(F.broadcast(drawn), "doc_id")
    marks = [f"y{i}" for i in range(len(categories))]
    first = F.min_by("text", F.when(F.col("text").isNotNull(), F.xxhash64("text"))).alias("text")
    return rows.groupBy("doc_id").agg(first, *[F.max(m).alias(m) for m in marks])


def _associated(sample: DataFrame, n_categories: int, per_category: int) -> np.ndarray:
    """The runs most associated with each category, from counts over all texts of the sample."""
    names = ["n", *[f"n{i}" for i in range(n_categories)]]

    def run(batches):
        keys, counts = [], []

        def merged():
            values, where = np.unique(np.concatenate(keys), return_inverse=True)
            columns = [np.bincount(where, np.concatenate([c[:, j] for c in counts]), len(values)) for j in range(len(names))]
            return values, np.column_stack(columns)

        size, limit = 0, _MERGED_AT
        for batch in batches:
            marks = np.column_stack([np.ones(batch.num_rows), *[batch.column(2 + i).to_numpy() for i in range(n_categories)]])
            for text, mark in zip(batch.column(1).to_pylist(), marks):
                own = np.unique(byte_runs(text))
                keys.append(own)
                counts.append(np.broadcast_to(mark, (len(own), len(mark))))
                size += len(own)
                if size > limit:
                    values, sums = merged()
                    keys, counts, size, limit = [values], [sums], 0, max(_MERGED_AT, len(values))
        if keys:
            values, sums = merged()
            for at in range(0, len(values), 1 << 16):
                part = slice(at, at + (1 << 16))
                columns = [pa.array(values[part].astype(np.int64)), *[pa.array(c.astype(np.int64)) for c in sums[part].T]]
                yield pa.RecordBatch.from_arrays(columns, ["run", *names])

    schema = ", ".join(["run long", *[f"{name} long" for name in names]])
    marks = [f"y{i}" for i in range(n_categories)]
    counted = sample.select("doc_id", "text", *marks).mapInArrow(run, schema).groupBy("run").agg(*[F.sum(n).alias(n) for n in names])
    counted = staged(counted.filter(F.col("n") >= LEAST_TEXTS), "runs")
    totals = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(m).alias(m) for m in marks]).first()
    chosen: set[int] = set()
    for i, mark in enumerate(marks):
        if totals["n"] and totals[mark]:
            share = totals[mark] / totals["n"]
            # How far the count in the category is from what the share leads to expect, in standard deviations.
            distance = F.abs(F.col(f"n{i}") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share) + 1)
            best = counted.orderBy(distance.desc(), "run").select("run").limit(per_category)
            chosen |= {r["run"] for r in best.collect()}
    return np.array(sorted(chosen), dtype=np.uint64)


def train(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str], most: int = MAX_LABELLED, per_category: int = FEATURES_PER_CATEGORY,
    ridge: float = 1.0,
) -> Chain:
    """Fit a chain on a bounded draw of labelled texts.

    Features are counted and chosen by Spark jobs over the sample; the driver gets at most
    ``most`` rows with the positions of their chosen features and labels, and fits on these. A category
    without both labels gets a constant link; without any labelled text all probabilities are near 0.
    """
    sample = staged(labelled_sample(docs, labels, categories, most), "sample")
    chosen = Chosen(_associated(sample, len(categories), per_category))

    def run(batches):
        for batch in batches:
            columns = [chosen.columns(text).tolist() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(columns, pa.list_(pa.int32())), *batch.columns[2:]], names)

    marks = [f"y{i}" for i in range(len(categories))]
    names = ["doc_id", "held", *marks]
    kinds = ["doc_id long", "held array<int>", *[f"{m} int" for m in marks]]
    rows = sample.select("doc_id", "text", *marks).mapInArrow(run, ", ".join(kinds)).toArrow()
    ids = rows.column("doc_id").to_numpy()
    order = np.lexsort((ids,))
    held = rows.column("held").to_pylist()
    columns = [np.array(held[i], dtype=np.int64) for i in order]
    y = np.column_stack([rows.column(m).to_numpy() for m in marks])[order]
    folds = (mixed_ids(ids[order]) % np.uint64(FOLDS)).astype(np.int64)
    return fit_chain(chosen.runs, columns, y, categories, folds, ridge)


def mixed_ids(ids: np.ndarray) -> np.ndarray:
    x = ids.astype(np.int64).astype(np.uint64) * _SPREAD
    return x ^ (x >> np.uint64(32))


def score(docs: DataFrame, chain: Chain, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, p_<category>...`` for every row, from its whole text.

    A null or empty text has no features and gets the chain's constants. Repeated rows
    are scored alike; a null id stays null. No shuffle; the model has a fixed size.
    """
    chosen = Chosen(chain.runs)

    def run(batches):
        for batch in batches:
            p = chain.probabilities([chosen.columns(text) for text in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(p[:, i]) for i in range(p.shape[1])]], names)

    names = ["doc_id", *[f"p_{link.category}" for link in chain.links]]
    schema = ", ".join(["doc_id long", *[f"`{n}` double" for n in names[1:]]])
    return numbered_texts(docs, id_column, text_column).mapInArrow(run, schema)


def probability(chain: Chain, category: str):
    """A function of a text column that gives one category's probability, to filter whole rows by."""
    place = [link.category for link in chain.links].index(category)
    chosen = Chosen(chain.runs)

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        p = chain.probabilities([chosen.columns(text) for text in texts])
        return pd.Series(p[:, place])

    return of
