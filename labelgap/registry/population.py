"""Population filter, projection and profile."""

from pyspark.sql import functions as F

from labelgap.fixed_values import STRICT_MARKET_PATTERN
from labelgap.operators import population
from labelgap.registry.catalog import query
from labelgap.registry.views import PRODUCTS_SQL, products, table

_MATCH = "COALESCE(len(list_filter(countries_tags, lambda t: regexp_matches(lower(t), '{}'))) > 0, false)"
_BROAD = _MATCH.format("korea|kr")
_STRICT = _MATCH.format("en:south-korea|en:kr|en:korea|south-korea")


@query("tag_filter_broad", f"WITH {PRODUCTS_SQL} SELECT o_orderkey, brands FROM products WHERE {_BROAD}")
def tag_filter_broad(spark, folder):
    return population.filter_by_tag(products(spark, folder)).select("o_orderkey", "brands")


@query("tag_filter_strict", f"WITH {PRODUCTS_SQL} SELECT o_orderkey, brands FROM products WHERE {_STRICT}")
def tag_filter_strict(spark, folder):
    kept = population.filter_by_tag(products(spark, folder), pattern=STRICT_MARKET_PATTERN)
    return kept.select("o_orderkey", "brands")


@query(
    "filter_selectivity",
    f"""WITH {PRODUCTS_SQL}
    SELECT count_if({_BROAD})::BIGINT AS kept, count(*) AS total,
           round(count_if({_BROAD}) * 100.0::DOUBLE / count(*), 6) AS kept_pct FROM products""",
)
def filter_selectivity(spark, folder):
    found = population.filter_selectivity(products(spark, folder))
    return found.withColumn("kept_pct", F.round("kept_pct", 6))


@query("project_available", f"WITH {PRODUCTS_SQL} SELECT code, brands, nutriscore_grade FROM products")
def project_available(spark, folder):
    wanted = ["code", "brands", "quantity", "nutriscore_grade", "stores"]
    return population.project_available(products(spark, folder), wanted)[0]


NULLABLE_SQL = """
nullable AS (SELECT l_orderkey, l_quantity, l_returnflag,
    CASE WHEN l_linenumber <> 3 THEN l_discount END AS l_discount,
    CASE WHEN l_quantity <= 45 THEN l_tax END AS l_tax,
    CASE WHEN l_linenumber = 1 THEN l_shipdate END AS l_shipdate,
    CASE WHEN l_linestatus = 'O' THEN l_linestatus END AS l_linestatus FROM lineitem)
"""


def nullable(spark, folder):
    """Line items with nulls: the SQL above says where."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_quantity", "l_returnflag",
        F.when(F.col("l_linenumber") != 3, F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_quantity") <= 45, F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_linenumber") == 1, F.col("l_shipdate")).alias("l_shipdate"),
        F.when(F.col("l_linestatus") == "O", F.col("l_linestatus")).alias("l_linestatus"),
    )


@query(
    "null_profile",
    f"""WITH {NULLABLE_SQL},
    shares AS (SELECT avg((l_discount IS NULL)::INT) * 100 AS l_discount, avg((l_tax IS NULL)::INT) * 100 AS l_tax,
                      avg((l_shipdate IS NULL)::INT) * 100 AS l_shipdate, avg((l_linestatus IS NULL)::INT) * 100 AS l_linestatus,
                      avg((l_quantity IS NULL)::INT) * 100 AS l_quantity FROM nullable)
    SELECT "column", round(null_pct, 6) AS null_pct
    FROM (UNPIVOT shares ON l_discount, l_tax, l_shipdate, l_linestatus, l_quantity INTO NAME "column" VALUE null_pct)
    WHERE null_pct > 0""",
)
def null_profile(spark, folder):
    return population.null_profile(nullable(spark, folder)).withColumn("null_pct", F.round("null_pct", 6))


@query(
    "ensure_columns",
    """SELECT o_orderkey, o_orderstatus, 'missing' AS nutriscore_grade, false AS has_milk FROM orders""",
)
def ensure_columns(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return population.ensure_columns(orders, {"o_orderstatus": "?", "nutriscore_grade": "missing", "has_milk": False})
