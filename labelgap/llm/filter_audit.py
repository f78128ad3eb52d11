"""What five filters remove together, alone and in every order, from one table of coalitions.

A document is five bits: which filters it fails. The number of documents that a set of filters removes
depends on these bits alone, so a part of the corpus is described by 32 removals, one per coalition. Removals of
a step in any order are differences of two of them. The share of a filter that no order favours (Shapley) is the
solution of least squares over the coalitions: weighted by the Shapley kernel, constrained to sum to what all
filters remove, and solved in rationals.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgap.llm.stages import staged

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 2
MARKUP = b"#$%&*|"

_CAPITALS = bytes(range(65, 91))
_KINDS = ("removed", "good", "toxic")


def text_failures(text: bytes, code_points: int) -> int:
    """Bits 0 to 3 for the filters A to D, those that a text fails by itself."""
    words = text.split()  # bytes are split at the six ASCII blanks only
    few = len(words) < LEAST_WORDS
    repeated = 100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words)
    loud = 100 * (len(text) - len(text.translate(None, _CAPITALS))) > MOST_CAPITALS_PERCENT * code_points
    marked = len(text) != len(text.translate(None, MARKUP))
    return few | repeated << 1 | loud << 2 | marked << 3


def _texts_as_bits(docs: DataFrame, id_column: str, text_column: str, part_column: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            points = pc.utf8_length(texts).to_pylist()
            raw = texts.cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("part"),
                    pa.array([hashlib.sha256(t).digest() for t in raw], pa.binary()),
                    pa.array([text_failures(t, n) for t, n in zip(raw, points)], pa.int32()),
                ],
                ["doc_id", "part", "digest", "failed"],
            )

    whole = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), whole(part_column).alias("part"), whole(text_column).alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, digest binary, failed int")


def failures(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source"
) -> DataFrame:
    """``part, failed, good, toxic, n``: documents by the filters they fail and by their labels.

    A document is ``good`` or ``toxic`` if any row of the labels with its id says so. It fails the last
    filter if the same text, told by its SHA-256, stands under a smaller id anywhere in the table; the least id is an aggregate and comes
    back by a join on text and id, so that a text with millions of copies is no hot key. Rows that are equal in all of this are
    counted before anything is joined. A null id has no label and is neither smaller nor larger than another.
    """

    def counted(some):
        rows = _texts_as_bits(some, id_column, text_column, part_column)
        return rows.groupBy("doc_id", "digest", "part", "failed").agg(F.count(F.lit(1)).alias("n"))

    # The null ids are picked at the scan: each text is read once.
    named, nameless = counted(docs.filter(F.col(f"`{id_column}`").isNotNull())), counted(docs.filter(F.col(f"`{id_column}`").isNull()))
    is_one = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0)))
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    known = known.filter("good = 1 OR toxic = 1")
    labelled = named.join(known, "doc_id", "left").fillna(0, ["good", "toxic"])
    rows = staged(labelled.unionByName(nameless.withColumns({"good": F.lit(0), "toxic": F.lit(0)})), "failures")

    least = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id IS NOT NULL").withColumn("is_first", F.lit(True))
    marked = rows.filter("doc_id IS NOT NULL").join(least, ["digest", "doc_id"], "left")
    copied = F.when(F.col("is_first").isNull(), 1 << 4).otherwise(0)
    marked = marked.withColumn("failed", F.col("failed").bitwiseOR(copied)).drop("is_first")
    marked = marked.unionByName(rows.filter("doc_id IS NULL"))
    return marked.groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))


def coalition_removals(cells: DataFrame, n_filters: int = len(FILTERS)) -> DataFrame:
    """``part, n, removed, good, toxic``: a row per part, with an array of what each coalition of filters removes.

    Entry ``s`` counts the documents that fail any filter whose bit is set in ``s``: all, the good and the toxic ones.
    """
    folded = cells.groupBy("part", "failed").agg(
        F.sum("n").alias("removed"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )
    fails = [F.col("failed").bitwiseAND(s) != 0 for s in range(2**n_filters)]
    arrays = [F.array(*[F.sum(F.when(f, F.col(kind)).otherwise(0)) for f in fails]).alias(kind) for kind in _KINDS]
    return folded.groupBy("part").agg(F.sum("removed").alias("n"), *arrays)


def _solved(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """The exact solution for all right-hand sides at once, by elimination."""
    rows = [[*a, *b] for a, b in zip(matrix, right)]
    size = len(rows)
    for i in range(size):
        pivot = next(r for r in range(i, size) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(size):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [row[size:] for row in rows]


def shapley_map(n_filters: int = len(FILTERS)) -> list[list[Fraction]]:
    """The linear map from coalition removals to Shapley values, a row per filter.

    Minimises the squares of ``removal(s) - sum of the values in s`` over all proper coalitions, weighted by
    ``(m - 1) / (C(m, |s|) |s| (m - |s|))``, under the constraint that the values add up to the removal of all. The normal
    equations with their multiplier are solved in rationals, once for every unit vector of removals.
    """
    m, everything = n_filters, 2**n_filters - 1
    weight = {}
    for s in range(1, everything):
        k = s.bit_count()
        weight[s] = Fraction(m - 1, math.comb(m, k) * k * (m - k))
    holds = [[s >> i & 1 for s in range(everything + 1)] for i in range(m)]
    normal = [[sum((w for s, w in weight.items() if holds[i][s] and holds[j][s]), Fraction()) for j in range(m)] + [Fraction(1)] for i in range(m)]
    normal.append([Fraction(1)] * m + [Fraction()])
    right = [[weight.get(s, Fraction()) * holds[i][s] for s in range(everything + 1)] for i in range(m)]
    right.append([Fraction(int(s == everything)) for s in range(everything + 1)])
    return _solved(normal, right)[:m]


def step_counts(removals: DataFrame, names: str = FILTERS) -> DataFrame:
    """A row per part, order of the filters and step: what the step's filter removes there, and what it has to do with the others.

    ``part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``; the last is the
    filter's removals summed over all orders, the Shapley value times their number.
    """
    m = len(names)
    orders = list(itertools.permutations(range(m)))
    exact = [[x * len(orders) for x in row] for row in shapley_map(m)]
    if any(x.denominator != 1 for row in exact for x in row):
        raise ArithmeticError("summed over all orders, a removal counts a whole number of times")
    factors = np.array([[int(x) for x in row] for row in exact], np.int64)
    everything = 2**m - 1
    own = np.array([i for order in orders for i in order])
    before = np.array([sum(1 << i for i in order[:step]) for order in orders for step in range(m)])
    after = before | 1 << own
    order_names = pa.array(["".join(names[i] for i in order) for order in orders for _ in range(m)])
    steps = pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(orders)))
    filters = pa.array([names[i] for i in own])

    def run(batches):
        for batch in batches:
            for part, n, *arrays in zip(*(batch.column(c).to_pylist() for c in ("part", "n", *_KINDS))):
                removed, good, toxic = (np.array(a, np.int64) for a in arrays)
                here = removed[after] - removed[before]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(own), pa.string()), order_names, steps, filters,
                        pa.array(n - removed[after]), pa.array(here), pa.array(removed[1 << own] - here),
                        pa.array(removed[everything] - removed[everything ^ 1 << own]),
                        pa.array(good[after] - good[before]), pa.array(toxic[after] - toxic[before]), pa.array((factors @ removed)[own]),
                    ],
                    ["part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
                )

    return removals.select("part", "n", *_KINDS).mapInArrow(
        run,
        "part string, filter_order string, step int, filter string, kept long, removed long, redundant long, unique_fails long, "
        "good_lost long, toxic_lost long, shapley long",
    )


def audit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source"
) -> DataFrame:
    """The five filters in all 120 orders, per part of the corpus; see ``step_counts`` for the columns.

    A: fewer than 200 words; B: fewer than 50 distinct words in 100; C: more than 2 capitals A-Z in 100 characters; D: a character of
    markup; E: a text that a smaller id has, too. A null text is an empty one, a null part the part ``''``; rows that
    repeat count each. Other columns are not read. An empty table gives an empty result.
    """
    return step_counts(coalition_removals(failures(docs, labels, id_column, text_column, part_column)))
