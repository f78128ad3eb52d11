"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Unit vectors with cosine c lie ``sqrt(2 - 2c)`` apart, so their projections on a
random direction differ by a normal number of that spread. Vectors are dealt into
tables of cells by the signs of several projections, as many as keep cells small and as many
tables as lose hardly a pair at the threshold. The rows of a cell are sorted along one
more projection; the rows in a window around a row are its candidates. For these the
windows of many further projections are tested and the collisions counted; pairs with at least the
count that a pair at the threshold reaches almost surely are verified by their cosine in double precision.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgap.llm.components import components
from labelgap.llm.grouped import chunk_pairs, groups
from labelgap.llm.stages import staged
from labelgap.operators.joins import broadcast_if_small

SEED = 20
#: Rows that a cell has on average; more rows make more cells.
CELL_ROWS = 200
#: Probability that no table holds a pair at the threshold together.
MISSED = 1e-5
#: Projections whose collisions are counted, and half a window in spreads of a pair at the threshold.
COUNTED = 32
WINDOW = 2.0
#: Half of the window along which a cell is sorted, in the same spreads.
SORT_WINDOW = 4.5
CHUNK_ROWS = 1024


def signs_and_tables(rows: int, cosine: float) -> tuple[int, int]:
    """Signs per table for so many rows, and the tables that then lose a pair with probability ``MISSED`` at most."""
    signs = max(1, round(math.log2(max(rows, 1) / CELL_ROWS))) if rows > CELL_ROWS else 1
    same = (1 - math.acos(cosine) / math.pi) ** signs
    return signs, math.ceil(math.log(MISSED) / math.log(1 - same))


def least_collisions(counted: int = COUNTED, window: float = WINDOW, missed: float = MISSED) -> int:
    """The largest count that a pair at the threshold stays below with probability ``missed`` at most."""
    p = math.erf(window / math.sqrt(2))
    below, count = 0.0, 0
    while True:
        below += math.comb(counted, count) * p**count * (1 - p) ** (counted - count)
        if below > missed:
            return count
        count += 1


def _unit(batch_column, dim: int) -> np.ndarray:
    values = batch_column.combine_chunks() if isinstance(batch_column, pa.ChunkedArray) else batch_column
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)  # squares of very large or small numbers would leave the doubles
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _cells(vectors: DataFrame, dim: int, signs: int, tables: int) -> DataFrame:
    """Adds ``codes``: the cell of each vector in every table."""

    def run(batches):
        directions = np.random.default_rng(SEED).standard_normal((dim, tables * signs))
        powers = 1 << np.arange(signs, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            positive = _unit(batch.column("embedding"), dim) @ directions >= 0
            codes = positive.reshape(-1, tables, signs) @ powers
            offsets = pa.array(np.arange(0, codes.size + 1, tables), pa.int32())
            cells = pa.ListArray.from_arrays(offsets, pa.array(codes.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, cells], [*batch.schema.names, "codes"])

    kind = dict(vectors.dtypes)["embedding"]
    return vectors.mapInArrow(run, f"vec_id long, embedding {kind}, copies long, codes array<int>")


def _links(dealt: DataFrame, dim: int, cosine: float) -> DataFrame:
    """Per row and cell: the vectors linked with it here for the first time, and the least vector connected with it here."""
    spread = math.sqrt(2 - 2 * cosine)
    wanted = least_collisions()

    def run(batches):
        rng = np.random.default_rng(SEED + 1)
        directions = rng.standard_normal((dim, COUNTED + 1))
        for table in groups(batches, ["cell", "low", "high"]):
            chunk, ids, copies = (table.column(c).to_numpy() for c in ("chunk", "vec_id", "copies"))
            low, high, place = (table.column(c)[0].as_py() for c in ("low", "high", "place"))
            unit = _unit(table.column("embedding"), dim)
            codes = table.column("codes").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)[:, :place]
            projected = unit @ directions
            order = np.argsort(projected[:, COUNTED], kind="stable")
            along = projected[order, COUNTED]
            ends = np.searchsorted(along, along + SORT_WINDOW * spread, side="right")
            a, b = [], []
            for start in range(0, len(order), 64):
                stop = min(start + 64, len(order))
                # The window above each row; pairs with rows below are met from these.
                i, j = np.nonzero(np.arange(start, int(ends[start:stop].max()))[None, :] < ends[start:stop, None])
                i, j = order[i + start], order[j + start]
                later = projected[i, COUNTED] <= projected[j, COUNTED]
                met = (ids[i] != ids[j]) & later & (np.minimum(chunk[i], chunk[j]) == low) & (np.maximum(chunk[i], chunk[j]) == high)
                i, j = i[met], j[met]
                if not len(i):
                    continue
                hits = np.zeros(len(i), np.uint8)
                for c in range(COUNTED):
                    hits += np.abs(projected[i, c] - projected[j, c]) <= WINDOW * spread
                    if c == COUNTED // 2:  # pairs that can't reach the count any more
                        still = hits + (COUNTED - c - 1) >= wanted
                        i, j, hits = i[still], j[still], hits[still]
                i, j = i[hits >= wanted], j[hits >= wanted]
                # A pair counts in the first table that holds both.
                first = ~(codes[i] == codes[j]).any(axis=1) if place else np.ones(len(i), bool)
                i, j = i[first], j[first]
                close = np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine
                a.append(i[close])
                b.append(j[close])
            i, j = np.concatenate([np.zeros(0, int), *a]), np.concatenate([np.zeros(0, int), *b])
            pairs = np.unique(np.stack([np.minimum(i, j), np.maximum(i, j)]), axis=1)  # equal projections meet from both sides
            i, j = pairs
            if not len(i):
                continue
            number = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
            least = ids.copy()
            while True:  # the least vector connected within the cell
                before = least.copy()
                np.minimum.at(least, i, before[j])
                np.minimum.at(least, j, before[i])
                if (least == before).all():
                    break
            linked = np.flatnonzero(number)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[linked]), pa.array(number[linked].astype(np.int64)), pa.array(least[linked])], ["vec_id", "n_links", "least"]
            )

    columns = ["cell", "low", "high", "chunk", "place", "vec_id", "embedding", "copies", "codes"]
    return dealt.select(*columns).mapInArrow(run, "vec_id long, n_links long, least long")


def vector_groups(df: DataFrame, cosine: float = 0.9, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Links and groups of near-equal vectors: ``vec_id, n_links, component_id, kept``, a row per id and vector.

    Links join vectors of one length whose cosine is at least ``cosine`` (between 0 and 1). A vector that is null, empty or
    zero, or holds a null or a non-finite component, is linked with nothing, and so is a row
    with a null id. Equal vectors are one class from the start, whose copies count as links, so a
    large group of copies costs a row per task. A cell of any size is cut into chunks that meet in
    pairs; the links found in a cell are counted there and are never listed. An empty table gives an empty result.
    """
    vector = F.col(f"`{vector_column}`")
    rows = df.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), vector.alias("embedding"))
    infinite = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (F.size("embedding") > 0) & ~infinite & F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull()
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    # Two hashes stand for a vector; -0.0 hashes as 0.0.
    plain = F.transform("embedding", lambda x: x + F.lit(0).cast("float"))
    digest = [F.xxhash64(plain).alias("digest_a"), F.xxhash64(F.lit(SEED), F.size("embedding"), plain).alias("digest_b")]
    known = staged(rows.select("vec_id", "usable", F.size("embedding").alias("dim"), *digest).distinct(), "vectors")
    keys = ["digest_a", "digest_b", "dim"]
    classes = known.filter("usable").groupBy(*keys).agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    classes = staged(classes, "classes")
    firsts = rows.filter("usable").select("vec_id", "embedding", F.size("embedding").alias("dim"), *digest)
    firsts = firsts.join(classes.withColumnRenamed("first_id", "vec_id"), [*keys, "vec_id"]).dropDuplicates([*keys, "vec_id"])

    found = None
    # Few lengths occur; vectors of different lengths have no cosine.
    for dim, n in [(r["dim"], r["n"]) for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()]:
        signs, tables = signs_and_tables(n, cosine)
        placed = _cells(firsts.filter(F.col("dim") == dim).select("vec_id", "embedding", "copies"), dim, signs, tables)
        placed = placed.select("*", F.posexplode("codes").alias("place", "code"))
        placed = placed.withColumn("cell", F.col("place").cast("long") * F.lit(1 << 32) + F.col("code"))
        sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
        dealt = chunk_pairs(placed.join(broadcast_if_small(staged(sizes, "cells")), "cell"), "cell", F.col("vec_id"), F.col("n_rows"), CHUNK_ROWS)
        links = _links(dealt, dim, cosine)
        found = links if found is None else found.unionByName(links)
    if found is None:
        return known.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = staged(found, "links")
    reached = components(found.select(F.col("vec_id").alias("a"), F.col("least").alias("b")))
    counted = found.groupBy("vec_id").agg(F.sum("n_links").alias("others")).toDF("first_id", "others")
    whole = classes.join(counted, "first_id", "left").join(reached.toDF("first_id", "component"), "first_id", "left").select(
        *keys, (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "first_id").alias("component_id")
    )
    grouped = known.filter("usable").join(whole, keys).select("vec_id", "n_links", "component_id")
    alone = known.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return grouped.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
