"""Joins, target, splits, scaling and encoding."""

from pyspark.sql import functions as F

from labelgap.fixed_values import NUTRIENT_SOURCES
from labelgap.functions.language import risk_target
from labelgap.operators import cleaning, features, joins, sampling
from labelgap.operators.correlation import complete_rows
from labelgap.operators.evaluation import class_balance
from labelgap.registry.catalog import query
from labelgap.registry.features import rounded
from labelgap.registry.language import gap
from labelgap.registry.population import NULLABLE_SQL, nullable
from labelgap.registry.views import (
    CASE_SQL,
    CLASSED_SQL,
    GAP_SQL,
    NUTRIENTS_SQL,
    PRESENCE_SQL,
    PRODUCTS_SQL,
    classed,
    products,
    table,
)
from labelgap.session import scratch_folder
from labelgap.sources import write_bucketed

_NUTRIENTS = list(NUTRIENT_SOURCES)
_SHORT = ["energy_100g", "fat_100g", "sugars_100g", "proteins_100g", "sodium_100g"]
_KEY_SQL = "trim(COALESCE(code, 'None'), ' ' || chr(9))"


def nutrient_rows(spark, folder):
    return cleaning.add_nutrients(products(spark, folder))


def merged(spark, folder):
    """Gap result by document with the nutrients of the order of the same code."""
    return joins.left_join(gap(spark, folder), nutrient_rows(spark, folder), "code", _NUTRIENTS)


MERGED_SQL = f"""
{GAP_SQL}, {PRODUCTS_SQL}, {NUTRIENTS_SQL},
right_side AS (SELECT {_KEY_SQL} AS r_code, {', '.join(_NUTRIENTS)} FROM nutrients),
merged AS (SELECT gap.*, {', '.join(_NUTRIENTS)} FROM gap LEFT JOIN right_side ON gap.code = r_code)
"""


@query(
    "left_join_nutrients",
    f"WITH {MERGED_SQL} SELECT doc_id, code, {', '.join(f'round({c}, 6) AS {c}' for c in _NUTRIENTS)} FROM merged",
)
def left_join_nutrients(spark, folder):
    return rounded(merged(spark, folder).select("doc_id", "code", *_NUTRIENTS), *_NUTRIENTS)


@query(
    "left_join_bucketed",
    f"""WITH {MERGED_SQL} SELECT doc_id, code, {', '.join(f'round({c}, 6) AS {c}' for c in _NUTRIENTS)} FROM merged""",
)
def left_join_bucketed(spark, folder):
    """The join of ``left_join_nutrients`` over stages in buckets of the key."""
    place = scratch_folder(spark, "buckets")
    left = write_bucketed(gap(spark, folder), f"{place}/gap")
    right = write_bucketed(nutrient_rows(spark, folder).select("code", *_NUTRIENTS), f"{place}/nutrients")
    return rounded(joins.left_join(left, right, "code", _NUTRIENTS).select("doc_id", "code", *_NUTRIENTS), *_NUTRIENTS)


@query(
    "null_key_join",
    f"""WITH {PRODUCTS_SQL}, keyed AS (SELECT o_orderkey, {_KEY_SQL} AS code FROM products),
    per_code AS (SELECT code, max(o_orderkey) AS last_key FROM keyed GROUP BY code)
    SELECT l.o_orderkey, l.code, r.last_key FROM keyed l LEFT JOIN per_code r ON l.code = r.code""",
)
def null_key_join(spark, folder):
    # One row per code on the right, null among them: the null keys of the left all find it.
    left = products(spark, folder).select("o_orderkey", "code")
    return joins.left_join(left, left.groupBy("code").agg(F.max("o_orderkey").alias("last_key")), "code", ["last_key"], "match")


@query(
    "null_keys_both_sides",
    f"""WITH {PRODUCTS_SQL}, keyed AS (SELECT o_orderkey, {_KEY_SQL} AS code FROM products),
    right_rows AS (SELECT code, o_orderkey % 3 AS part FROM keyed),
    right_side AS (SELECT * FROM right_rows WHERE code <> 'None' UNION ALL SELECT DISTINCT * FROM right_rows WHERE code = 'None')
    SELECT l.o_orderkey, l.code, r.part FROM keyed l LEFT JOIN right_side r ON l.code = r.code""",
)
def null_keys_both_sides(spark, folder):
    """Null keys in many rows of either side: each left row meets the distinct right rows."""
    left = products(spark, folder).select("o_orderkey", "code")
    right = products(spark, folder).select("code", (F.col("o_orderkey") % 3).alias("part"))
    return joins.left_join(left, right, "code", ["part"], "match")


@query(
    "null_keys_unmatched",
    f"""WITH {PRODUCTS_SQL}, keyed AS (SELECT o_orderkey, code IS NULL AS is_null, {_KEY_SQL} AS code FROM products)
    SELECT l.o_orderkey, CASE WHEN l.is_null THEN NULL ELSE l.code END AS code, r.o_orderkey AS found
    FROM keyed l LEFT JOIN keyed r ON l.code = r.code AND NOT l.is_null AND NOT r.is_null""",
)
def null_keys_unmatched(spark, folder):
    left = products(spark, folder).select("o_orderkey", "code")
    return joins.left_join(left, left.withColumnRenamed("o_orderkey", "found"), "code", ["found"])


@query(
    "join_drop_overlap",
    f"""WITH {PRODUCTS_SQL}, {NUTRIENTS_SQL},
    right_side AS (SELECT {_KEY_SQL} AS code, energy_100g FROM nutrients)
    SELECT CAST(o.o_orderkey AS VARCHAR) AS code, o.o_totalprice, round(r.energy_100g, 6) AS energy_100g
    FROM orders o LEFT JOIN right_side r ON CAST(o.o_orderkey AS VARCHAR) = r.code""",
)
def join_drop_overlap(spark, folder):
    left = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("code"), "o_totalprice", F.lit(-1.0).alias("energy_100g")
    )
    joined = joins.left_join(left, nutrient_rows(spark, folder), "code", ["energy_100g", "no_such_column"])
    return rounded(joined.select("code", "o_totalprice", "energy_100g"), "energy_100g")


@query(
    "enrich_if_absent",
    f"""WITH {GAP_SQL}, {PRODUCTS_SQL}, keyed AS (SELECT o_orderkey, {_KEY_SQL} AS code FROM products)
    SELECT keyed.code, o_orderkey, language_case, category_top FROM keyed LEFT JOIN gap ON keyed.code = gap.code""",
)
def enrich_if_absent(spark, folder):
    labels = gap(spark, folder).select("code", "language_case", "category_top")
    rows = products(spark, folder).select("code", "o_orderkey")
    enriched = joins.enrich_if_absent(rows, labels, null_keys="match")
    return joins.enrich_if_absent(enriched, labels)  # the second call finds the columns there


@query(
    "join_audit",
    f"""WITH {MERGED_SQL} SELECT count(*) AS n_rows, count(energy_100g) AS n_matched,
    count_if(energy_100g = 0)::BIGINT AS n_zero, count_if(energy_100g > 0)::BIGINT AS n_positive FROM merged""",
)
def join_audit(spark, folder):
    return joins.join_audit(merged(spark, folder))


@query(
    "risk_target",
    f"WITH {PRESENCE_SQL}, c AS (SELECT doc_id, {CASE_SQL} AS k FROM presence) SELECT doc_id, contains(k, 'Gap')::INT AS target FROM c",
)
def risk_target_query(spark, folder):
    return gap(spark, folder).select("doc_id", risk_target(F.col("language_case")).alias("target"))


@query(
    "class_balance",
    f"""WITH {CLASSED_SQL} SELECT count_if(target = 0)::BIGINT AS n_safe, count_if(target = 1)::BIGINT AS n_risk,
    round(count_if(target = 1) * 100.0::DOUBLE / count(*), 6) AS risk_pct, count_if(target = 1) < 10 AS too_few FROM classed""",
)
def class_balance_query(spark, folder):
    return rounded(class_balance(classed(spark, folder)), "risk_pct")


@query(
    "drop_incomplete",
    f"""WITH {NULLABLE_SQL} SELECT l_orderkey, l_discount, l_tax + 0.0 AS l_tax FROM nullable
    WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL""",
)
def drop_incomplete(spark, folder):
    kept = complete_rows(nullable(spark, folder), ["l_discount", "l_tax"])
    return kept.select("l_orderkey", "l_discount", (F.col("l_tax") + 0.0).alias("l_tax"))


@query(
    "feature_roles",
    f"""WITH {PRODUCTS_SQL}, {NUTRIENTS_SQL}
    SELECT 'energy_100g' AS "column", 'continuous' AS role, count(energy_100g) AS n_present FROM nutrients
    UNION ALL SELECT 'fat_100g', 'continuous', count(fat_100g) FROM nutrients
    UNION ALL SELECT 'nutriscore_grade', 'categorical', count(nutriscore_grade) FROM nutrients
    UNION ALL SELECT 'has_grade', 'boolean', count(*) FROM nutrients
    UNION ALL SELECT 'code', 'ids', count(code) FROM nutrients""",
)
def feature_roles(spark, folder):
    rows = nutrient_rows(spark, folder).select(
        "code", "energy_100g", "fat_100g", "nutriscore_grade", F.col("nutriscore_grade").isNotNull().alias("has_grade"),
        F.lit(0).alias("is_synthetic"),
    )
    roles = features.feature_roles(rows, ["nutriscore_grade"])
    names = [*roles.features, *roles.ids]
    present = rows.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "column", "n_present")
    return roles.to_frame(spark).join(present, "column").select("column", "role", "n_present")


_SPLIT_SQL = """
ranked AS (SELECT *, row_number() OVER (ORDER BY md5(o_orderkey || '|42')) AS place, count(*) OVER () AS n FROM orders),
split AS (SELECT *, place <= ceil(0.2::DOUBLE * n) AS is_test FROM ranked)
"""


@query("split_exact", f"WITH {_SPLIT_SQL} SELECT o_orderkey, is_test FROM split")
def split_exact(spark, folder):
    return sampling.mark_split(table(spark, folder, "orders"), "o_orderkey").select("o_orderkey", "is_test")


@query(
    "split_report",
    f"""WITH {_SPLIT_SQL} SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS part, count(*) AS n,
    round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM split), 6) AS pct FROM split GROUP BY is_test""",
)
def split_report(spark, folder):
    marked = sampling.mark_split(table(spark, folder, "orders"), "o_orderkey")
    return rounded(sampling.split_report(marked), "pct")


# Train rows per class by largest remainder, the rest of each class for testing.
_STRATIFIED_SQL = f"""
{CLASSED_SQL},
sizes AS (SELECT target, count(*) AS n_class, sum(count(*)) OVER () AS n_all FROM classed GROUP BY target),
shares AS (SELECT *, n_all - ceil(0.2::DOUBLE * n_all) AS n_train FROM sizes),
parts AS (SELECT *, n_class * n_train / n_all::DOUBLE AS share FROM shares),
floors AS (SELECT *, floor(share) AS base, row_number() OVER (ORDER BY share - floor(share) DESC, target::VARCHAR) AS r,
           sum(floor(share)) OVER () AS n_base FROM parts),
drawn AS (SELECT target, n_class - base - CASE WHEN r <= n_train - n_base THEN 1 ELSE 0 END AS n_test FROM floors),
ranked AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5(doc_id || '|42')) AS place FROM classed)
"""


@query(
    "split_stratified",
    f"WITH {_STRATIFIED_SQL} SELECT doc_id, r.target, place <= n_test AS is_test FROM ranked r JOIN drawn d ON r.target = d.target",
)
def split_stratified(spark, folder):
    marked = sampling.mark_split(classed(spark, folder), "doc_id", stratify="target")
    return marked.select("doc_id", "target", "is_test")


_SCALED = ["o_totalprice", "constant"]


def _scaled(spark, folder, kind):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", F.lit(0.1).alias("constant"))
    train, test = sampling.split_train_test(orders, "o_orderkey")
    scaler = features.fit_scaler(train, _SCALED, kind)
    both = features.apply_scaler(train.unionByName(test), scaler)
    return rounded(both, *_SCALED)


@query(
    "scale_standard",
    f"""WITH {_SPLIT_SQL}, fit AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM split WHERE NOT is_test)
    SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS o_totalprice, 0.0::DOUBLE AS constant FROM split, fit""",
)
def scale_standard(spark, folder):
    return _scaled(spark, folder, "standard")


@query(
    "scale_minmax",
    f"""WITH {_SPLIT_SQL}, fit AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM split WHERE NOT is_test)
    SELECT o_orderkey, round((o_totalprice - lo) / (hi - lo), 6) AS o_totalprice, 0.0::DOUBLE AS constant FROM split, fit""",
)
def scale_minmax(spark, folder):
    return _scaled(spark, folder, "minmax")


@query(
    "scaled_statistics",
    f"""WITH {_SPLIT_SQL}, fit AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM split WHERE NOT is_test)
    SELECT 'o_totalprice' AS "column", abs(round(avg((o_totalprice - m) / s), 6)) AS mean,
           round(stddev_samp((o_totalprice - m) / s), 6) AS std
    FROM split, fit WHERE NOT is_test""",
)
def scaled_statistics(spark, folder):
    train, _ = sampling.split_train_test(table(spark, folder, "orders"), "o_orderkey")
    scaled = features.apply_scaler(train, features.fit_scaler(train, ["o_totalprice"]))
    found = rounded(features.scaled_statistics(scaled, ["o_totalprice"]), "mean", "std")
    return found.withColumn("mean", F.abs("mean"))


_CODES_SQL = """
priorities AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT o_orderpriority AS value FROM orders)),
clerks AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code
           FROM (SELECT DISTINCT 'C' || o_custkey AS value FROM orders))
"""


def _encoded(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority", F.concat(F.lit("C"), F.col("o_custkey")).alias("customer")
    )
    train, test = sampling.split_train_test(orders, "o_orderkey")
    return features.encode_categorical(train, test, ["o_orderpriority", "customer", "no_such_column"])


@query(
    "label_encode",
    f"""WITH {_CODES_SQL} SELECT o_orderkey, p.code::INT AS o_orderpriority, c.code::INT AS customer
    FROM orders JOIN priorities p ON o_orderpriority = p.value JOIN clerks c ON 'C' || o_custkey = c.value""",
)
def label_encode(spark, folder):
    train, test, _ = _encoded(spark, folder)
    return train.unionByName(test)


@query("label_decode", "SELECT o_orderkey, o_orderpriority, 'C' || o_custkey AS customer FROM orders")
def label_decode(spark, folder):
    train, test, encoder = _encoded(spark, folder)
    return features.decode(train.unionByName(test), encoder, ["o_orderpriority", "customer"])


@query(
    "artifact_tables",
    f"""WITH {_SPLIT_SQL}, {_CODES_SQL}
    SELECT 'scaler' AS artifact, 'o_totalprice' AS "column", round(avg(o_totalprice), 4)::VARCHAR AS a,
           round(stddev_pop(o_totalprice), 4)::VARCHAR AS b FROM split WHERE NOT is_test
    UNION ALL SELECT 'encoder', 'o_orderpriority', value, code::VARCHAR FROM priorities
    UNION ALL SELECT 'role', 'o_orderkey', 'ids', NULL""",
)
def artifact_tables(spark, folder):
    orders = table(spark, folder, "orders")
    train, test = sampling.split_train_test(orders, "o_orderkey")
    tables = features.artifact_tables(
        spark,
        features.fit_scaler(train, ["o_totalprice"]),
        features.fit_encoder([train, test], ["o_orderpriority"]),
        features.FeatureRoles([], [], [], ["o_orderkey"]),
    )
    text = lambda c: F.round(c, 4).cast("decimal(20,4)").cast("double").cast("string")
    scaler = tables["scaler_params"].select(F.lit("scaler").alias("artifact"), "column", text("center").alias("a"), text("scale").alias("b"))
    encoder = tables["encoder_map"].select(
        F.lit("encoder").alias("artifact"), "column", F.col("value").alias("a"), F.col("code").cast("string").alias("b")
    )
    roles = tables["feature_roles"].select(
        F.lit("role").alias("artifact"), "column", F.col("role").alias("a"), F.lit(None).cast("string").alias("b")
    )
    return scaler.union(encoder).union(roles)
