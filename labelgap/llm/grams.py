"""All runs of words of all texts as rows, to be joined with a table of known runs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgap.llm.grouped import one_by_one
from labelgap.llm.words import WordHasher, runs
from labelgap.operators.joins import fits_broadcast


def gram_rows(
    texts: DataFrame, k: int, separators: bytes, id_column: str = "doc_id", text_column: str = "text", mark: int | None = None
) -> DataFrame:
    """``doc_id, place, gram``: a row per run of ``k`` words, whose first word is number ``place``.

    With ``mark`` each text also gives one row with that gram and its number of words as
    place, so that texts without any known run are still seen by a join that knows the mark.
    """

    def run(batches):
        hasher = WordHasher(separators)
        for batch in batches:
            ids, at = batch.column(0), 0
            for counts, hashes in hasher.texts(one_by_one(batch.column(1))):
                per_text, found = runs(counts, hashes, k)
                starts = np.cumsum(per_text) - per_text
                places = np.arange(len(found)) - np.repeat(starts, per_text)
                rows = np.repeat(np.arange(at, at + len(counts)), per_text)
                if mark is not None:
                    rows = np.concatenate([rows, np.arange(at, at + len(counts))])
                    places = np.concatenate([places, counts])
                    found = np.concatenate([found.astype(np.int64), np.full(len(counts), mark)])
                at += len(counts)
                for s in range(0, len(rows), 1 << 16):
                    part = slice(s, s + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(rows[part])), pa.array(places[part].astype(np.int32)), pa.array(found[part].astype(np.int64))],
                        ["doc_id", "place", "gram"],
                    )

    columns = texts.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    return columns.mapInArrow(run, f"doc_id {dict(columns.dtypes)['doc_id']}, place int, gram long")


def join_grams(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose gram is known: the known side is broadcast if an aggregate finds it small, else both sides are shuffled."""
    return rows.join(F.broadcast(known) if fits_broadcast(known) else known, "gram")
