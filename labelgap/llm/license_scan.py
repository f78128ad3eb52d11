"""Licences named or quoted in texts, by diagonal voting.

Every run of two words of every text is joined with the places where templates
have the same run. A text that quotes a template agrees with it in many runs whose
places differ by one and the same offset, a diagonal. Votes are counted per diagonal;
neighbouring diagonals are merged where one goes on, in the text and in the template, behind the place where the other ends, as a word put in
or left out moves the rest of a quotation by one; and a merged span is verified by the share of the template that stands in it.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelgap.llm.grams import gram_rows, join_grams
from labelgap.llm.words import NO_LETTERS, WordHasher, runs

RUN_WORDS = 2

# Phrases that name a licence by themselves.
PHRASES = {"gpl": ["gnu general public license"], "apache": ["apache license"], "cc-by": ["cc by"], "mit": ["mit license"]}

# Sentences of well-known licence texts and notices.
NOTICES = {
    "apache-2.0": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
    ],
    "mit-text": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    ],
    "gpl-3.0": ["licensed under the gnu general public license version 3"],
    "gpl-text": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        "you should have received a copy of the gnu general public license along with this program",
    ],
    "lgpl": ["gnu lesser general public license"],
    "agpl": ["gnu affero general public license"],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    ],
    "mpl": ["this source code form is subject to the terms of the mozilla public license"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "cc-by-text": ["this work is licensed under a creative commons attribution", "licensed under cc by 4 0"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "no-warranty": ["the software is provided as is without warranty of any kind express or implied"],
}

#: Share of a template's runs that a span must hold.
LEAST_SHARE = 0.75
#: Offsets up to this far apart are one span.
NEXT_DIAGONAL = 2
_MARK = -0x5DEECE66D


def template_rows(spark, phrases: Mapping[str, Sequence[str]], notices: Mapping[str, Sequence[str]]) -> DataFrame:
    """``gram, template, label, is_base, n_runs, template_place``: a row per place of a run in a template, and the mark of texts."""
    hasher, rows, template = WordHasher(NO_LETTERS), [(_MARK, -1, None, False, 1, 0)], 0
    for is_base, texts in ((True, phrases), (False, notices)):
        for label, sentences in texts.items():
            for sentence in sentences:
                counts, hashes = next(hasher.texts([sentence]))
                found = runs(counts, hashes, RUN_WORDS)[1].astype(np.int64).tolist()
                if not found:
                    raise ValueError(f"a template needs {RUN_WORDS} words: {sentence}")
                rows += [(gram, template, label, is_base, len(found), place) for place, gram in enumerate(found)]
                template += 1
    return spark.createDataFrame(rows, "gram long, template int, label string, is_base boolean, n_runs int, template_place int")


def chains(diagonals: Sequence[tuple[int, int, int, int]], n_runs: int, least_share: float) -> list[tuple[int, int, int, int, float]]:
    """Spans out of neighbouring diagonals ``(first, last, offset, votes)``: ``(first, last, offset, votes, share)``.

    A chain is a list of diagonals that follow each other in text and template, each at most ``NEXT_DIAGONAL`` from the one before. For every
    diagonal the chain with the most votes that ends in it is formed, the shortest of equals. The best by share is a span, and so is every further one
    that reaches ``least_share`` and shares no place with a better one. ``share`` is votes over the runs of the template or the span, whichever has more.
    """
    order = sorted(diagonals)
    best: list[tuple[int, int, int]] = []  # votes, first place, offset of the first place
    for i, (first, last, offset, votes) in enumerate(order):
        found = (votes, first, offset)
        for j in range(i - 1, -1, -1):
            before = order[j]
            if first - before[0] > 2 * n_runs:  # a chain ends with its template, so what is further away can't be in it
                break
            follows = before[1] < first and before[1] - before[2] < first - offset and abs(before[2] - offset) <= NEXT_DIAGONAL
            if follows and (best[j][0] + votes, best[j][1]) > found[:2]:
                found = (best[j][0] + votes, best[j][1], best[j][2])
        best.append(found)
    spans = []
    for (first, last, offset, votes), (all_votes, begin, begin_offset) in zip(order, best):
        spans.append((min(1.0, all_votes / max(n_runs, last - begin + 1)), begin, last, begin_offset, all_votes))
        spans.append((min(1.0, votes / max(n_runs, last - first + 1)), first, last, offset, votes))
    spans.sort(key=lambda s: (-s[0], s[1], s[2]))
    chosen: list[tuple[int, int, int, int, float]] = []  # in order of their places, none over another
    for share, first, last, offset, votes in spans:
        if chosen and share < least_share:
            break
        at = bisect_right(chosen, (last, math.inf))
        if at == 0 or chosen[at - 1][1] < first:
            chosen.insert(at, (first, last, offset, votes, share))
    return chosen


_SPAN = "array<struct<first:int,last:int,offset:int,votes:long,share:double>>"


def _chained(clusters: DataFrame, least_share: float) -> DataFrame:
    """``spans`` in place of the diagonals of each cluster."""

    def run(batches):
        for batch in batches:
            found = []
            for diagonals, n_runs in zip(batch.column("diagonals").to_pylist(), batch.column("n_runs").to_pylist()):
                spans = chains([(d["first"], d["last"], d["offset"], d["votes"]) for d in diagonals], n_runs, least_share)
                found.append([dict(zip(("first", "last", "offset", "votes", "share"), s)) for s in spans])
            kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("offset", pa.int32()), ("votes", pa.int64()), ("share", pa.float64())]))
            kept = [c for c in batch.schema.names if c != "diagonals"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(found, kind)], [*kept, "spans"])

    fields = ", ".join(f"{c} {kind}" for c, kind in clusters.dtypes if c != "diagonals")
    return clusters.mapInArrow(run, f"{fields}, spans {_SPAN}")


def scan(
    df: DataFrame, phrases: Mapping[str, Sequence[str]] = PHRASES, notices: Mapping[str, Sequence[str]] = NOTICES,
    least_share: float = LEAST_SHARE, id_column: str = "doc_id", text_column: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Spans of licence texts, and a summary per text.

    Spans: ``doc_id, text_hash, label, is_base, first_word, n_words, share``; a phrase is a span
    only if all of its runs stand on one diagonal, so it is there word by word. Summary: ``doc_id, n_words, n_base,
    first_word, last_word, base_labels, labels, score``. A null or empty text has no words and no labels.
    Rows with a null id are scanned like others; rows that agree in id and text give one row.
    """
    key = F.struct(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text_column}`")).alias("text_hash")).alias("text_key")
    texts = df.select(key, F.col(f"`{text_column}`").alias("text"))
    grams = gram_rows(texts, RUN_WORDS, NO_LETTERS, "text_key", "text", mark=_MARK)
    known = template_rows(df.sparkSession, phrases, notices)
    hits = join_grams(grams, known).withColumn("offset", F.col("place") - F.col("template_place"))
    # Repeated rows repeat their places: a place votes once.
    voted = hits.groupBy("doc_id", "template", "label", "is_base", "n_runs", "offset").agg(
        F.count_distinct("place").alias("votes"), F.min("place").alias("first"), F.max("place").alias("last")
    )
    # A phrase is looked for word by word, and the mark of a text is no quotation: their diagonals stay apart.
    columns = ["doc_id", "template", "label", "is_base", "n_runs"]
    alone = F.col("is_base") | (F.col("template") < 0)
    share = F.least(F.lit(1.0), F.col("votes") / F.greatest("n_runs", F.col("last") - F.col("first") + 1))
    single = F.array(F.struct("first", "last", "offset", "votes", share.alias("share"))).cast(_SPAN).alias("spans")
    along = Window.partitionBy("doc_id", "template").orderBy("offset")
    apart = F.coalesce(F.col("offset") - F.lag("offset").over(along) > NEXT_DIAGONAL, F.lit(True)) | alone
    diagonal = F.struct("first", "last", "offset", "votes")
    clusters = voted.withColumn("cluster", F.sum(apart.cast("int")).over(along)).groupBy(*columns, "cluster").agg(F.collect_list(diagonal).alias("diagonals"))
    # Most clusters are one diagonal, which needs no chain; the others are those of one text and one template.
    lone = clusters.filter(F.size("diagonals") == 1).select(*columns, F.inline("diagonals")).select(*columns, single)
    several = _chained(clusters.filter(F.size("diagonals") > 1).drop("cluster"), least_share)
    spans = lone.unionByName(several).select(*columns, F.inline("spans"))
    spans = spans.withColumnsRenamed({"first": "first_word"}).withColumn("n_words", F.col("last") - F.col("first_word") + RUN_WORDS)
    is_text = F.col("template") < 0
    good = ~is_text & F.when(F.col("is_base"), F.col("votes") == F.col("n_runs")).otherwise(F.col("share") >= least_share)
    base = good & F.col("is_base")

    def joined(labels):
        return F.array_join(F.array_sort(labels), ",")

    summary = spans.groupBy("doc_id").agg(
        F.max(F.when(is_text, F.col("offset"))).cast("long").alias("n_words"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("offset"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("offset"))).cast("long").alias("last_word"),
        joined(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        joined(F.collect_set(F.when(good, F.col("label")))).alias("labels"),
        F.coalesce(F.max(F.when(~is_text, F.col("share"))), F.lit(0.0)).alias("score"),
    )
    found = spans.filter(good).select("doc_id.doc_id", "doc_id.text_hash", "label", "is_base", F.col("first_word").cast("long").alias("first_word"), "n_words", "share")
    return found, summary.select("doc_id.doc_id", *summary.columns[1:])
