from labelgap.sources.buckets import BucketedTable, read_bucketed, write_bucketed
from labelgap.sources.checked import read_csv_checked, read_json_checked
from labelgap.sources.files import (
    SYNTHETIC_SCHEMA,
    LABEL_SCHEMA,
    read_csv_table,
    read_first_existing,
    read_label_json,
    read_parquet,
    write_csv_table,
    write_json_lines,
    write_parquet,
)

__all__ = [
    "BucketedTable",
    "SYNTHETIC_SCHEMA",
    "LABEL_SCHEMA",
    "read_bucketed",
    "read_csv_checked",
    "read_csv_table",
    "read_first_existing",
    "read_json_checked",
    "read_label_json",
    "read_parquet",
    "write_bucketed",
    "write_csv_table",
    "write_json_lines",
    "write_parquet",
]
