"""CSV and JSON sources that keep what they can't read: each rejected record with its file and the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgap.sources.files import LABEL_SCHEMA, SYNTHETIC_SCHEMA

_RECORD = "_corrupt_record"
_BYTE_ORDER_MARK = "\ufeff"
#: What the parser gives for a field of two quotes, to tell it from an empty field; no character of any text.
_QUOTED_EMPTY = "\ufffe"


def _without_mark(text: Column) -> Column:
    return F.ltrim(text, F.lit(_BYTE_ORDER_MARK))


def _first_reason(reasons: list[Column]) -> Column:
    return F.coalesce(*reasons) if reasons else F.lit(None).cast("string")


def _misfit(name: str, raw: Column, typed: Column, kind: T.DataType) -> Column:
    """Why a value that is there became null."""
    said = F.concat(F.lit(f"{name}: not {kind.simpleString()}: "), F.substring(raw, 1, 40))
    return F.when(raw.isNotNull() & typed.isNull(), said)


def _parted(rows: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    # Generated columns are computed once per row; plain ones would be parsed again on either side of the filter.
    marked = rows.select(F.inline(F.array(F.struct("_good", "_file", "_record", "_reason"))))
    good = marked.filter("_reason IS NULL").select(*[F.col(f"_good.`{f.name}`").alias(f.name) for f in schema])
    bad = marked.filter("_reason IS NOT NULL").select(F.col("_file").alias("file"), F.col("_record").alias("record"), F.col("_reason").alias("reason"))
    return good, bad


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType = SYNTHETIC_SCHEMA, header: bool = True, multi_line: bool = False, line_sep: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected records): ``rejected`` holds ``file, record, reason``.

    A record is rejected if it has too few or too many fields, or a field that is no value of its column's type. Every record is in exactly one
    of the two. Quotes are doubled, an empty field is null, one of two quotes the empty text, and a leading byte-order mark is dropped. ``multi_line`` takes
    quoted line breaks; a file is then read by one task, and without ``line_sep`` the first kind of line break in it counts as the end of a record.
    """
    texts = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema], T.StructField(_RECORD, T.StringType())])
    raw = spark.read.csv(
        path, schema=texts, header=header, enforceSchema=True, multiLine=multi_line, lineSep=line_sep, escape='"', mode="PERMISSIVE",
        columnNameOfCorruptRecord=_RECORD, emptyValue=_QUOTED_EMPTY,
    )
    first = schema[0].name
    # The parser may leave a byte-order mark on the first field of a file without header.
    values = {f.name: F.replace(F.col(f"`{f.name}`"), F.lit(_QUOTED_EMPTY), F.lit("")) for f in schema}
    values[first] = _without_mark(values[first])
    typed = {f.name: values[f.name].try_cast(f.dataType) for f in schema}
    fields = F.lit(f"not {len(schema)} fields")
    record = F.coalesce(F.col(_RECORD), F.to_csv(F.struct(*[values[f.name].alias(f.name) for f in schema]), {"escape": '"'}))
    reason = _first_reason([F.when(F.col(_RECORD).isNotNull(), fields), *[_misfit(f.name, values[f.name], typed[f.name], f.dataType) for f in schema]])
    rows = raw.select(
        F.struct(*[typed[f.name].alias(f.name) for f in schema]).alias("_good"), F.col("_metadata.file_path").alias("_file"),
        _without_mark(record).alias("_record"), reason.alias("_reason"),
    )
    return _parted(rows, schema)


def read_json_checked(spark: SparkSession, path: str, schema: T.StructType = LABEL_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected records) of JSON lines: ``rejected`` holds ``file, record, reason``.

    A line is rejected if it is no JSON object, or if a field that is there and not null is no value of its column's type. Blank lines are
    neither. A leading byte-order mark is dropped.
    """
    lines = spark.read.text(path)
    record = _without_mark(F.col("value"))
    with_corrupt = T.StructType([*schema.fields, T.StructField(_RECORD, T.StringType())])
    parsed = lines.filter(F.trim(record) != "").select(
        record.alias("_record"), F.col("_metadata.file_path").alias("_file"),
        F.from_json(record, with_corrupt, {"columnNameOfCorruptRecord": _RECORD, "mode": "PERMISSIVE"}).alias("_good"),
        F.from_json(record, "map<string,string>").alias("_raw"),
    )
    value = lambda f: F.try_element_at("_raw", F.lit(f.name))
    misfits = [_misfit(f.name, value(f), F.col(f"_good.`{f.name}`"), f.dataType) for f in schema]
    no_object = ~F.startswith(F.ltrim("_record"), F.lit("{")) | F.col("_raw").isNull() | (F.size("_raw") == 0) & F.col(f"_good.{_RECORD}").isNotNull()
    broken = F.when(F.col(f"_good.{_RECORD}").isNotNull(), "not JSON of the schema")
    reason = _first_reason([F.when(no_object, "no JSON object"), *misfits, broken])
    return _parted(parsed.withColumn("_reason", reason), schema)
