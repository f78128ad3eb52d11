"""Settings of the composed jobs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from labelgap import fixed_values as fixed
from labelgap.session import written


@dataclass(frozen=True)
class Config:
    """``output`` is the folder the stages are written to; without it nothing is written."""

    output: str | None = None
    broad_pattern: str = fixed.BROAD_MARKET_PATTERN
    strict_pattern: str = fixed.STRICT_MARKET_PATTERN
    domestic_codes: Sequence[str] = field(default_factory=lambda: list(fixed.DOMESTIC_CODES))
    export_codes: Sequence[str] = field(default_factory=lambda: list(fixed.EXPORT_CODES))
    domestic_script: str = fixed.DOMESTIC_SCRIPT
    scaler: str = "standard"
    test_size: float = 0.2
    seed: int = fixed.SEED
    n_trees: int = fixed.N_TREES
    n_synthetic: int = fixed.N_SYNTHETIC
    compat: bool = True
    # documented cleaning options, off by default
    sparse_share: float | None = None
    impute_by: str | None = None
    clip: dict[str, tuple[float, float]] | None = None


def stage(df: DataFrame, config: Config, name: str) -> DataFrame:
    """Write a stage and go on from the written table; without an output folder nothing is written."""
    if config.output is None:
        return df
    path = f"{config.output}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def kept(df: DataFrame, config: Config, name: str) -> DataFrame:
    """A stage that is read more than once or must not run twice: written to the output, or else to the shared folder."""
    return written(df, name) if config.output is None else stage(df, config, name)
