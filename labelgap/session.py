"""Session helpers: a local session for tests and benches, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


LOCAL_FOLDER = os.path.join(tempfile.gettempdir(), "labelgap-checkpoint")


def local_session(
    cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "16g", checkpoint: str = LOCAL_FOLDER
) -> SparkSession:
    """A single-JVM session for tests and the bench, with its shared folder named; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("labelgap")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config(CHECKPOINT_SETTING, checkpoint)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster.

    Only a local session without the setting uses a fixed folder of this
    machine; a cluster session without it is an error, because a machine-local
    folder is lost together with its executor.
    """
    folder = spark.sparkContext.getConf().get(CHECKPOINT_SETTING) or spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder
    if spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        return LOCAL_FOLDER
    raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")


def set_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``checkpoint()`` and iterative fits at the shared folder, unless one is set already."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))


_ROOTS: set[str] = set()
_SCOPES: list[list[str]] = []


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder for a table that lives as long as the application; no two calls give the same one.

    All lie below one folder named by the application, which is removed when the driver's Python ends; inside a ``scratch_scope``
    a place is removed as soon as the scope ends.
    """
    root = f"{checkpoint_dir(spark).rstrip('/')}/labelgap-{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        _ROOTS.add(root)
        atexit.register(_remove_at_exit, spark, root)
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def _remove_at_exit(spark: SparkSession, root: str) -> None:
    if spark.sparkContext._jsc is not None:  # the session may have been stopped before
        remove_folder(spark, root)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables written inside when the block ends.

    Frames made inside read them, so whatever is wanted of these must be written or collected inside, too.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove_folder(spark, path)


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a frame that many jobs will read as Parquet in the shared folder, and go on from there.

    Later jobs read only the columns they need, and a lost executor costs no
    more than the tasks it was running.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote and nothing will read again."""
    place, files = _file_system(spark, path)
    files.delete(place, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    place, files = _file_system(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(place)] if files.exists(place) else []


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
