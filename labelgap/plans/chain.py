"""Chains of stages that go on where they stopped.

A stage makes one table out of earlier ones. Its fingerprint covers its name, its parameters and the fingerprints
of what it reads, down to the files of the source, so it changes with anything the table depends on. The table lies in a folder
named by the fingerprint; when it is whole, a manifest is written next to it. A stage whose manifest is there is read and not made again;
the first stage that fails ends the chain, and the next run goes on from the last whole one.
"""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgap.session import folder_names, remove_folder

_log = logging.getLogger(__name__)

_MANIFEST = "stage string, fingerprint string, parameters string, reads string, table_schema string, n_rows long"


@dataclass(frozen=True)
class Stage:
    """``build`` gets the tables named in ``reads``; ``parameters`` are all settings it depends on, as plain values."""

    name: str
    build: Callable[..., DataFrame]
    reads: Sequence[str]
    parameters: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Done:
    """A whole stage: its table, the rows it has, and whether this run found it made."""

    table: DataFrame
    fingerprint: str
    n_rows: int
    found: bool


class StageFailed(RuntimeError):
    """A stage ended with an error, which is the cause; stages before it are whole, none after it was begun."""

    def __init__(self, stage: str):
        super().__init__(f"stage {stage} failed")
        self.stage = stage


def _digest(parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:32]


def source_fingerprint(df: DataFrame) -> str:
    """A digest of the files behind a frame: their paths, sizes and times of change, and the frame's schema.

    The files are looked at in a job, their contents are not read. A frame that stands on no files, or whose expressions change while the
    files stay, needs a fingerprint of the caller's own.
    """
    files = [unquote(f) for f in df.inputFiles()]
    if not files:
        raise ValueError("the source has no files; give a fingerprint of its own")
    listed = df.sparkSession.read.format("binaryFile").load(files).select("path", "modificationTime", "length")
    one = F.xxhash64("path", F.unix_micros("modificationTime"), "length").cast("decimal(20,0)")
    found = listed.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.sum(one).alias("hash")).first()
    return _digest([found["files"], found["bytes"], str(found["hash"]), df.schema.json()])


def _stage_fingerprint(stage: Stage, inputs: Mapping[str, str]) -> str:
    return _digest([stage.name, dict(stage.parameters), [[name, inputs[name]] for name in stage.reads]])


def _read_manifest(spark: SparkSession, place: str):
    """The one row of a manifest, or None: there is none, or its job ended before it was committed."""
    if all(name.startswith(("_", ".")) for name in folder_names(spark, f"{place}/manifest")):
        return None
    return spark.read.schema(_MANIFEST).json(f"{place}/manifest").first()


def _made(spark: SparkSession, stage: Stage, tables: Mapping[str, DataFrame], fingerprint: str, place: str):
    """Write the table and then its manifest. The rows are counted in the footers of what was written."""
    table = stage.build(*[tables[name] for name in stage.reads])
    table.write.mode("overwrite").parquet(f"{place}/data")
    n_rows = spark.read.schema(table.schema).parquet(f"{place}/data").count()
    parameters, reads = json.dumps(dict(stage.parameters), sort_keys=True, ensure_ascii=False), json.dumps(list(stage.reads))
    row = (stage.name, fingerprint, parameters, reads, table.schema.json(), n_rows)
    # One row in one file: it appears whole when its job is committed, or not at all.
    spark.createDataFrame([row], _MANIFEST).coalesce(1).write.mode("overwrite").json(f"{place}/manifest")
    return _read_manifest(spark, place)


def run_stages(
    spark: SparkSession, stages: Sequence[Stage], folder: str, sources: Mapping[str, DataFrame], fingerprints: Mapping[str, str] | None = None,
    keep_old: bool = False,
) -> dict[str, Done]:
    """Make the stages in order, or find them made, below ``folder``.

    ``sources`` are the frames the first stages read by name; ``fingerprints`` states those that ``source_fingerprint`` can't tell. Raises
    ``StageFailed`` at the first stage that fails. When the last stage is whole, tables of other fingerprints are
    removed unless ``keep_old`` is set. One run at a time may use a folder.
    """
    known = {name: (fingerprints or {}).get(name) or source_fingerprint(df) for name, df in sources.items()}
    tables, done = dict(sources), {}
    for stage in stages:
        fingerprint = _stage_fingerprint(stage, known)
        place = f"{folder.rstrip('/')}/{stage.name}/{fingerprint}"
        manifest = _read_manifest(spark, place)
        found = manifest is not None
        if not found:
            _log.info("stage %s: making it", stage.name)
            try:
                manifest = _made(spark, stage, tables, fingerprint, place)
            except Exception as error:
                raise StageFailed(stage.name) from error
        schema = T.StructType.fromJson(json.loads(manifest["table_schema"]))
        table = spark.read.schema(schema).parquet(f"{place}/data")
        known[stage.name], tables[stage.name] = fingerprint, table
        done[stage.name] = Done(table, fingerprint, manifest["n_rows"], found)
    if not keep_old:
        for name, stage in done.items():
            for old in folder_names(spark, f"{folder.rstrip('/')}/{name}"):
                if old != stage.fingerprint:
                    remove_folder(spark, f"{folder.rstrip('/')}/{name}/{old}")
    return done


def stage_report(spark: SparkSession, done: Mapping[str, Done]) -> DataFrame:
    """``stage, n_rows, n_columns, found``: a row per stage."""
    rows = [(name, stage.n_rows, len(stage.table.columns), stage.found) for name, stage in done.items()]
    return spark.createDataFrame(rows, "stage string, n_rows long, n_columns int, found boolean")
