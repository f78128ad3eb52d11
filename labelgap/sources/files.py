"""File sources and sinks: parquet, CSV and label JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SYNTHETIC_SCHEMA = T.StructType(
    [
        T.StructField("energy_100g", T.DoubleType()),
        T.StructField("fat_100g", T.DoubleType()),
        T.StructField("sugars_100g", T.DoubleType()),
        T.StructField("proteins_100g", T.DoubleType()),
        T.StructField("sodium_100g", T.DoubleType()),
        T.StructField("category_top", T.IntegerType()),
        T.StructField("target", T.IntegerType()),
    ]
)

# Nutrition facts differ from record to record, hence a map.
LABEL_SCHEMA = T.StructType(
    [
        T.StructField("product_name_en", T.StringType()),
        T.StructField("serving_size", T.StringType()),
        T.StructField("calories_per_serving", T.StringType()),
        T.StructField("nutrition_facts", T.MapType(T.StringType(), T.StringType())),
        T.StructField("allergen_statement", T.StringType()),
        T.StructField("marketing_claims", T.ArrayType(T.StringType())),
        T.StructField("original_code", T.StringType()),
    ]
)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_first_existing(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Read the first of several candidate parquet paths that exists."""
    missing = []
    for path in paths:
        try:
            return spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            missing.append(path)
    raise FileNotFoundError(f"none of these paths can be read: {missing}")


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType = SYNTHETIC_SCHEMA) -> DataFrame:
    """CSV with a header line; a leading byte-order mark is dropped by the reader."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def read_label_json(spark: SparkSession, path: str, schema: T.StructType = LABEL_SCHEMA) -> DataFrame:
    """JSON lines or, for a file holding one array, a multi-line document."""
    return spark.read.json(path, schema=schema, multiLine=True)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv_table(df: DataFrame, path: str) -> None:
    """UTF-8 CSV with a header; no byte-order mark is written. Quotes are doubled, white space around a value stays."""
    df.write.mode("overwrite").csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_json_lines(df: DataFrame, path: str) -> None:
    """One record per line, non-ASCII characters kept as they are."""
    df.write.mode("overwrite").json(path)
