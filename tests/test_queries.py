"""Every query with SQL gives the rows of that SQL on whole tables."""

import os

import pytest

import __spark_entry__ as contract
from oracle import connect, differences

FOLDER = os.environ.get("LABELGAP_TEST_TABLES", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert differences(con, contract.queries()[name](spark, FOLDER), contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).columns == ["category_top", "total", "gap_pct"]
    assert contract.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("partitions", [1, 7])
def test_results_do_not_depend_on_partitions(spark, con, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        for name in ["ks_statistic", "auroc", "roc_points", "label_encode", "split_exact", "copula_marginals"]:
            assert differences(con, contract.queries()[name](spark, FOLDER), contract.oracle_sql()[name]) == [], name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
