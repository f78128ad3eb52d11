"""Synthetic rows that look like the real ones: a Gaussian copula per class.

Fitting keeps, for every class and column, the table of all distinct values and
their running counts, so that a rare value keeps its frequency and a value that holds much of
the mass (an exact zero, say) keeps it. Correlations are those of mid-ranks. A
generated row draws a uniform number per column and looks up the value whose running count it
falls on, by a join over ranges of equal counts. Categories are drawn as the class has them,
independent of the numbers' order. Rows depend on class, number and seed only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgap.fixed_values import CATEGORICAL_FEATURES, N_SYNTHETIC, SEED
from labelgap.functions.stats import correlation, normal_cdf, standard_normal, uniform
from labelgap.operators.drift import long_form
from labelgap.operators.joins import broadcast_if_small
from labelgap.operators.prefix import running_totals
from labelgap.operators.sampling import allocated, group_sizes
from labelgap.session import written

_ROWS_PER_PIECE = 1_000_000
#: Ranges of equal counts per class and column; more distinct values than this share ranges.
_RANGES = 1 << 20
_CATEGORY_STREAM = 1 << 16


@dataclass(frozen=True)
class Synthesizer:
    columns: list[str]
    categories: list[str]
    target: str
    schema: T.StructType
    sizes: DataFrame  # g, n
    distribution: DataFrame  # class, variable, value, n, cum_n, total_n
    mixing: DataFrame  # class, lower triangular matrix


def value_distribution(df: DataFrame, columns: Sequence[str], target: str = "target") -> DataFrame:
    """``(target, variable, value, n, cum_n, total_n)``: every distinct value of each class and its running count."""
    doubles = df.select(target, *[F.col(c).cast("double").alias(c) for c in columns])
    counts = (
        doubles.select(target, long_form(columns))
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(target, "variable", (F.col("value") + F.lit(0.0)).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return running_totals(counts, "value", ["n"], [target, "variable"]).select(target, "variable", "value", "n", "cum_n", "total_n")


def _mixing_matrix(correlations: np.ndarray) -> np.ndarray:
    """Cholesky factor of the nearest usable correlation matrix."""
    matrix = np.where(np.isfinite(correlations), correlations, 0.0)
    np.fill_diagonal(matrix, 1.0)
    values, vectors = np.linalg.eigh(matrix)
    repaired = (vectors * np.maximum(values, 1e-6)) @ vectors.T
    scale = np.sqrt(np.diag(repaired))
    return np.linalg.cholesky(repaired / np.outer(scale, scale))


def _mixing(rows: DataFrame, distribution: DataFrame, numeric: list[str], target: str) -> DataFrame:
    """One lower triangular matrix per class, from Spearman correlations."""
    ranked = rows
    for i, c in enumerate(numeric):
        middle = F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2
        ranks = distribution.filter(F.col("variable") == c).select(target, F.col("value").alias(f"_v{i}"), middle.alias(f"_r{i}"))
        ranked = ranked.withColumn(f"_v{i}", F.col(c).cast("double") + F.lit(0.0)).join(broadcast_if_small(ranks), [target, f"_v{i}"])
    pairs = list(combinations(range(len(numeric)), 2))
    normal = [2 * F.sin(F.lit(math.pi / 6) * correlation(F.col(f"_r{a}"), F.col(f"_r{b}"))) for a, b in pairs]
    found = ranked.groupBy(target).agg(F.count(F.lit(1)).alias("n"), F.array(*normal, F.lit(None).cast("double")).alias("normal"))
    k = len(numeric)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            matrices = []
            for values in frame["normal"]:
                matrix = np.eye(k)
                for (a, b), r in zip(pairs, values):
                    matrix[a, b] = matrix[b, a] = np.nan if r is None else r
                matrices.append(_mixing_matrix(matrix).tolist() if k else [])
            yield pd.DataFrame({"g": frame["g"], "mixing": matrices})

    kind = rows.schema[target].dataType.simpleString()
    return found.select(F.col(target).alias("g"), "normal").mapInPandas(run, f"g {kind}, mixing array<array<double>>")


def fit_synthesizer(
    df: DataFrame, columns: Sequence[str], target: str = "target", categories: Sequence[str] = tuple(CATEGORICAL_FEATURES)
) -> Synthesizer:
    """Rows with a null are left out. ``categories`` are those of the columns whose numbers are codes without an order."""
    columns = list(columns)
    named = [c for c in columns if c in categories]
    rows = written(df.select(*columns, target).na.drop(), "complete")
    sizes = written(group_sizes(rows, target), "sizes")
    if sizes.isEmpty():
        raise ValueError("no complete rows to fit")
    distribution = written(value_distribution(rows, columns, target), "distribution")
    mixing = written(_mixing(rows, distribution, [c for c in columns if c not in named], target), "mixing")
    return Synthesizer(columns, named, target, rows.schema, sizes, distribution, mixing)


def _looked_up(drawn: DataFrame, distribution: DataFrame, target: str) -> DataFrame:
    """The value of each draw (``g, k, variable, u``): the one on whose running count the uniform number falls."""
    table = distribution.withColumnRenamed(target, "g")
    spans = table.groupBy("g", "variable").agg(F.max("total_n").alias("total"), F.least(F.count(F.lit(1)), F.lit(_RANGES)).alias("ranges"))
    spans = broadcast_if_small(written(spans, "spans"))

    def range_of(position: Column) -> Column:
        return F.call_function("div", position * F.col("ranges"), F.col("total"))

    covered = table.join(spans, ["g", "variable"]).select(
        "g", "variable", "value", (F.col("cum_n") - F.col("n")).alias("first"), F.col("cum_n").alias("behind"),
        F.explode(F.sequence(range_of(F.col("cum_n") - F.col("n")), range_of(F.col("cum_n") - 1))).alias("range"),
    )
    placed = drawn.join(spans, ["g", "variable"])
    placed = placed.withColumn("position", F.least(F.floor(F.col("u") * F.col("total")), F.col("total") - 1))
    placed = placed.withColumn("range", range_of(F.col("position")))
    met = placed.join(covered, ["g", "variable", "range"])
    return met.filter((F.col("position") >= F.col("first")) & (F.col("position") < F.col("behind"))).select("g", "k", "variable", "value")


def generate(spark: SparkSession, model: Synthesizer, n: int = N_SYNTHETIC, seed: int = SEED) -> DataFrame:
    """``n`` rows with the class shares of the fitted data."""
    numeric = [c for c in model.columns if c not in model.categories]
    last = F.call_function("div", F.col("drawn") - 1, F.lit(_ROWS_PER_PIECE))
    pieces = allocated(model.sizes, n).filter("drawn > 0").select("g", "drawn", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * _ROWS_PER_PIECE
    rows = pieces.repartition("g", "piece").select(
        "g", F.explode(F.sequence(start, F.least(start + _ROWS_PER_PIECE, F.col("drawn")) - 1)).alias("k")
    )
    row_id = F.xxhash64(F.col("g").cast("string"), "k")
    mixed = rows.join(broadcast_if_small(model.mixing), "g").withColumns(
        {f"z{i}": standard_normal(row_id, seed, i) for i in range(len(numeric))}
    )
    uniforms = {c: uniform(row_id, seed, _CATEGORY_STREAM + i) for i, c in enumerate(model.categories)} | {
        c: normal_cdf(sum((F.col("mixing")[i][j] * F.col(f"z{j}") for j in range(i + 1)), F.lit(0.0))) for i, c in enumerate(numeric)
    }
    draws = F.array(*[F.struct(F.lit(c).alias("variable"), u.alias("u")) for c, u in uniforms.items()])
    drawn = mixed.select("g", "k", F.inline(draws))
    values = _looked_up(drawn, model.distribution, model.target)
    wide = values.groupBy("g", "k").pivot("variable", model.columns).agg(F.first("value"))
    kept = [F.col(c).cast(model.schema[c].dataType).alias(c) for c in model.columns]
    return wide.select(*kept, F.col("g").alias(model.target))


def balance_minority(
    train: DataFrame, columns: Sequence[str], target: str = "target", minority: int = 1, seed: int = SEED
) -> DataFrame | None:
    """Synthetic rows of the minority class that bring it to the size of the other; ``None`` if none are needed."""
    counts = train.agg(
        F.count_if(F.col(target) == minority).alias("few"), F.count_if(F.col(target) != minority).alias("many")
    ).first()
    needed = counts["many"] - counts["few"]
    if needed <= 0:
        return None
    model = fit_synthesizer(train.filter(F.col(target) == minority), columns, target)
    return generate(train.sparkSession, model, needed, seed)


def augment(real: DataFrame, synthetic: DataFrame, side: str = "is_synthetic") -> DataFrame:
    """Bag union by column name; where a row comes from is kept as a column."""
    return real.withColumn(side, F.lit(0)).unionByName(synthetic.withColumn(side, F.lit(1)))
