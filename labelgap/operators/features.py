"""Feature roles, scaling, label encoding and their saved parameters."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgap.fixed_values import CATEGORICAL_FEATURES, FLAG_PREFIXES, ID_COLUMNS, NUTRIENT_MARK
from labelgap.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS
from labelgap.operators.prefix import running_totals
from labelgap.session import written

SCALER_KINDS = ("standard", "minmax")


@dataclass(frozen=True)
class FeatureRoles:
    continuous: list[str]
    categorical: list[str]
    boolean: list[str]
    ids: list[str]

    @property
    def features(self) -> list[str]:
        return self.continuous + self.categorical + self.boolean

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(c, role) for role in ("continuous", "categorical", "boolean", "ids") for c in getattr(self, role)]
        return spark.createDataFrame(rows, "column string, role string")


def feature_roles(
    df: DataFrame,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    ids: Sequence[str] = ID_COLUMNS,
    provenance: str = "is_synthetic",
) -> FeatureRoles:
    """Roles by column name. The provenance column is no feature, though it starts like a flag."""
    flags = [c for c in df.columns if c.startswith(tuple(FLAG_PREFIXES)) and c != provenance]
    return FeatureRoles([c for c in df.columns if NUTRIENT_MARK in c], list(categorical), flags, list(ids))


# -- scaling ---------------------------------------------------------------


@dataclass(frozen=True)
class Scaler:
    """Centre and scale of each column: ``(x - center) / scale``."""

    kind: str
    center: dict[str, float]
    scale: dict[str, float]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(c, self.kind, self.center[c], self.scale[c]) for c in self.center]
        return spark.createDataFrame(rows, "column string, kind string, center double, scale double")


def _is_constant(variance: float, mean: float, n: int) -> bool:
    # A variance within rounding error of a constant column.
    eps = sys.float_info.epsilon
    return variance <= n * eps * variance + (n * mean * eps) ** 2


def fit_scaler(train: DataFrame, columns: Sequence[str], kind: str = "standard") -> Scaler | None:
    """One aggregate over the train rows. Without columns there is no scaler."""
    if kind not in SCALER_KINDS:
        raise ValueError(f"unknown scaler kind: {kind}")
    if not columns:
        return None
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    center, scale = {}, {}
    if kind == "standard":
        parts = [f(v).alias(f"{name}_{i}") for i, v in enumerate(value.values())
                 for name, f in (("mean", F.avg), ("var", F.var_pop), ("n", F.count))]
        found = train.agg(*parts).first()
        for i, c in enumerate(columns):
            mean, variance, n = found[f"mean_{i}"], found[f"var_{i}"], found[f"n_{i}"]
            center[c] = mean if n else float("nan")
            scale[c] = 1.0 if n and _is_constant(variance, mean, n) else (variance**0.5 if n else float("nan"))
    else:
        parts = [f(v).alias(f"{name}_{i}") for i, v in enumerate(value.values())
                 for name, f in (("low", F.min), ("high", F.max))]
        found = train.agg(*parts).first()
        for i, c in enumerate(columns):
            low, high = found[f"low_{i}"], found[f"high_{i}"]
            center[c] = low if low is not None else float("nan")
            spread = high - low if low is not None else float("nan")
            scale[c] = 1.0 if abs(spread) < 10 * sys.float_info.epsilon else spread
    return Scaler(kind, center, scale)


def apply_scaler(df: DataFrame, scaler: Scaler | None) -> DataFrame:
    """A projection; values outside the fitted range are not clipped."""
    if scaler is None:
        return df
    return df.withColumns(
        {c: (F.col(c).cast("double") - F.lit(scaler.center[c])) / F.lit(scaler.scale[c]) for c in scaler.center}
    )


def unscale(df: DataFrame, scaler: Scaler) -> DataFrame:
    return df.withColumns({c: F.col(c) * F.lit(scaler.scale[c]) + F.lit(scaler.center[c]) for c in scaler.center})


def scaled_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation per column, to check a scaling."""
    parts = [f(F.col(c)).alias(f"{c}|{name}") for c in columns for name, f in (("mean", F.avg), ("std", F.stddev_samp))]
    wide = df.agg(*parts)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}|mean`").alias("mean"), F.col(f"`{c}|std`").alias("std"))
        for c in columns
    ])
    return wide.select(F.inline(rows))


# -- label encoding -----------------------------------------------------------


def fit_encoder(frames: Sequence[DataFrame], columns: Sequence[str], buckets: int | None = None) -> DataFrame:
    """``(column, value, code)``: 0-based codes of the distinct values of all frames, in code-point order.

    Values are counted off range by range, so a column with many values needs no single sorting task.
    """
    values = None
    for frame in frames:
        present = [c for c in columns if c in frame.columns]
        if present:
            # All columns of a frame are read in one scan.
            pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in present])
            part = frame.select(F.inline(pairs))
            values = part if values is None else values.union(part)
    if values is None:
        raise ValueError(f"none of the columns exists: {list(columns)}")
    distinct = values.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.lit(1).alias("one"))
    ranked = running_totals(written(distinct, "values"), "value", ["one"], ["column"], buckets=buckets)
    return written(ranked.select("column", "value", (F.col("cum_one") - 1).cast("int").alias("code")), "encoder")


def _small_maps(encoder: DataFrame) -> set[str]:
    """Columns whose map is measured to fit a broadcast, in one job for all columns."""
    size = F.sum(F.octet_length("value") + 24)
    sizes = encoder.groupBy("column").agg(F.count(F.lit(1)).alias("rows"), size.alias("bytes")).collect()  # a row per column
    return {r["column"] for r in sizes if r["rows"] <= BROADCAST_ROWS and r["bytes"] <= BROADCAST_BYTES}


def apply_encoder(df: DataFrame, encoder: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each value by its code; null stays null."""
    return _translate(df, encoder, columns, "value", "code", "string", _small_maps(encoder))


def decode(df: DataFrame, encoder: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The inverse: codes back to values."""
    return _translate(df, encoder, columns, "code", "value", "int", _small_maps(encoder))


def _translate(df, encoder, columns, source, target, kind, small):
    order = df.columns
    for name in [c for c in columns if c in order]:
        table = encoder.filter(F.col("column") == name).select(F.col(source).alias(name), F.col(target).alias("_to"))
        table = F.broadcast(table) if name in small else table
        joined = df.withColumn(name, F.col(name).cast(kind)).join(table, name, "left")
        df = joined.withColumn(name, F.col("_to")).select(*order)
    return df


def encode_categorical(
    train: DataFrame, test: DataFrame, columns: Sequence[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Encode both parts with codes fitted on both, so no test value is unknown."""
    encoder = fit_encoder([train, test], columns)
    small = _small_maps(encoder)
    parts = [_translate(part, encoder, columns, "value", "code", "string", small) for part in (train, test)]
    return parts[0], parts[1], encoder


# -- saved parameters ------------------------------------------------------------


def scaler_table(spark: SparkSession, scaler: Scaler | None) -> DataFrame:
    return scaler.to_frame(spark) if scaler else spark.createDataFrame([], "column string, kind string, center double, scale double")


def artifact_tables(
    spark: SparkSession, scaler: Scaler | None, encoder: DataFrame, roles: FeatureRoles
) -> Mapping[str, DataFrame]:
    """The fitted parameters as tables: scaler, encoder map, feature roles."""
    return {
        "scaler_params": scaler_table(spark, scaler),
        "encoder_map": encoder,
        "feature_roles": roles.to_frame(spark),
    }


def save_artifacts(tables: Mapping[str, DataFrame], folder: str) -> None:
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}")


def load_scaler(spark: SparkSession, folder: str) -> Scaler | None:
    return scaler_of(spark.read.parquet(f"{folder}/scaler_params"))


def scaler_of(params: DataFrame) -> Scaler | None:
    """The scaler that a table of its parameters describes; an empty table stands for none."""
    rows = params.collect()  # one row per feature column
    if not rows:
        return None
    return Scaler(rows[0]["kind"], {r["column"]: r["center"] for r in rows}, {r["column"]: r["scale"] for r in rows})


def load_encoder(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/encoder_map")
