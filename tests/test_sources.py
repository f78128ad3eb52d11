"""Sources that keep what they can't read."""

import pytest
from pyspark.sql import types as T

from labelgap.sources import read_csv_checked, read_json_checked, write_csv_table, write_json_lines

SCHEMA = T.StructType().add("id", "long").add("text", "string").add("n", "double")
ODD = [
    (1, 'a "q" b', 2.5), (2, "line\nbreak, and comma", None), (3, "  around  ", 0.0), (4, "", -1.0), (5, None, 1e300), (None, "\\ back \\\" slash", 1.0),
    (6, "과자 é \u2028", float("inf")),
]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _file(tmp_path, name, text):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def test_csv_round_trip_of_odd_values(spark, tmp_path):
    write_csv_table(spark.createDataFrame(ODD, SCHEMA), str(tmp_path / "csv"))
    good, bad = read_csv_checked(spark, str(tmp_path / "csv"), SCHEMA, multi_line=True, line_sep="\n")
    assert _rows(good) == sorted(ODD, key=str) and bad.count() == 0


def test_json_round_trip_of_odd_values(spark, tmp_path):
    rows = ODD[:-1] + [(7, "\t \ufeff mark", 1.0)]
    write_json_lines(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "json"))
    good, bad = read_json_checked(spark, str(tmp_path / "json"), SCHEMA)
    assert _rows(good) == sorted(rows, key=str) and bad.count() == 0


@pytest.mark.parametrize("mark", ["", "\ufeff"])
def test_broken_csv_records(spark, tmp_path, mark):
    path = _file(tmp_path, "a.csv", mark + 'id,text,n\n1,"a ""q""",2.5\nx3,t,1\n4,t\n5,t,1,2\n6,,abc\n\n')
    good, bad = read_csv_checked(spark, path, SCHEMA)
    assert _rows(good) == [(1, 'a "q"', 2.5)]
    assert {(r.record, r.reason) for r in bad.collect()} == {
        ("x3,t,1", "id: not bigint: x3"), ("4,t", "not 3 fields"), ("5,t,1,2", "not 3 fields"), ("6,,abc", "n: not double: abc"),
    }
    assert {r.file.rpartition("/")[2] for r in bad.collect()} == {"a.csv"}
    assert good.count() == 1 and bad.count() == 4  # counting needs no column, and the records are told apart all the same


def test_csv_without_header(spark, tmp_path):
    good, bad = read_csv_checked(spark, _file(tmp_path, "b.csv", "\ufeff1,x,2\n2,y,3\n,z,\n"), SCHEMA, header=False)
    assert _rows(good) == sorted([(1, "x", 2.0), (2, "y", 3.0), (None, "z", None)], key=str) and bad.count() == 0


def test_broken_json_records(spark, tmp_path):
    text = '\ufeff{"id":1,"text":"a","n":2}\n{"id":"x"}\n{"id":2,"text":"un\n[1,2]\n\n  \n{"id":null}\n{}\n{"id":3,"n":"2.5"}\nnope\n{"id":4,"text":{"a":1}}\n'
    good, bad = read_json_checked(spark, _file(tmp_path, "a.json", text), SCHEMA)
    assert _rows(good) == sorted([(1, "a", 2.0), (None, None, None), (None, None, None), (4, '{"a":1}', None)], key=str)
    assert sorted((r.record, r.reason) for r in bad.collect()) == sorted([
        ('{"id":"x"}', "id: not bigint: x"), ('{"id":2,"text":"un', "no JSON object"), ("[1,2]", "no JSON object"),
        ('{"id":3,"n":"2.5"}', "n: not double: 2.5"), ("nope", "no JSON object"),
    ])


def test_empty_files(spark, tmp_path):
    for read, name in ((read_csv_checked, "c.csv"), (read_json_checked, "c.json")):
        good, bad = read(spark, _file(tmp_path, name, ""), SCHEMA)
        assert good.count() == 0 and bad.count() == 0 and good.columns == SCHEMA.names
