"""Nutrients, cleaning, tags, categories, flags and frequencies."""

from pyspark.sql import functions as F

from labelgap.fixed_values import ALLERGEN_PATTERNS, LABEL_PATTERNS, NUTRIENT_SOURCES
from labelgap.functions.text import normalise_key
from labelgap.operators import cleaning, frequency
from labelgap.registry.catalog import query
from labelgap.registry.population import NULLABLE_SQL, nullable
from labelgap.registry.views import NUTRIENTS_SQL, PRODUCTS_SQL, products, sql_group

_NUTRIENTS = list(NUTRIENT_SOURCES)


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _round_sql(columns, digits=6):
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


@query("nutrient_pivot", f"WITH {PRODUCTS_SQL}, {NUTRIENTS_SQL} SELECT o_orderkey, {_round_sql(_NUTRIENTS)} FROM nutrients")
def nutrient_pivot(spark, folder):
    found = cleaning.add_nutrients(products(spark, folder)).select("o_orderkey", *_NUTRIENTS)
    return rounded(found, *_NUTRIENTS)


@query("energy_fallback", f"WITH {PRODUCTS_SQL}, {NUTRIENTS_SQL} SELECT o_orderkey, round(energy_100g, 6) AS energy_100g FROM nutrients")
def energy_fallback(spark, folder):
    found = cleaning.add_nutrients(products(spark, folder), sources={"energy_100g": ["energy-kcal", "energy"]})
    return rounded(found.select("o_orderkey", "energy_100g"), "energy_100g")


@query(
    "fill_numeric",
    f"""WITH {NULLABLE_SQL} SELECT l_orderkey, COALESCE(l_discount, 0.0) AS l_discount, COALESCE(l_tax, 0.0) + 0.0 AS l_tax
    FROM nullable""",
)
def fill_numeric(spark, folder):
    filled = cleaning.fill_numeric(nullable(spark, folder), ["l_discount", "l_tax"])
    return filled.select("l_orderkey", "l_discount", (F.col("l_tax") + 0.0).alias("l_tax"))


@query(
    "fill_categorical",
    f"WITH {NULLABLE_SQL} SELECT l_orderkey, l_returnflag, COALESCE(l_linestatus, 'missing') AS l_linestatus FROM nullable",
)
def fill_categorical(spark, folder):
    filled = cleaning.fill_categorical(nullable(spark, folder), ["l_returnflag", "l_linestatus", "no_such_column"])
    return filled.select("l_orderkey", "l_returnflag", "l_linestatus")


@query(
    "key_normalise",
    f"""WITH {PRODUCTS_SQL} SELECT o_orderkey, trim(COALESCE(code, 'None'), ' ' || chr(9)) AS code FROM products""",
)
def key_normalise(spark, folder):
    return products(spark, folder).select("o_orderkey", normalise_key(F.col("code")).alias("code"))


def _sql_text(tags):
    return (
        f"CASE WHEN {tags} IS NULL OR len({tags}) = 0 THEN 'missing' "
        f"ELSE array_to_string(list_transform({tags}, lambda t: COALESCE(t, 'None')), ',') END"
    )


_TAGS = ["categories_tags", "countries_tags", "allergens_tags", "labels_tags"]
_TEXT_SQL = f"texts AS (SELECT o_orderkey, {', '.join(f'{_sql_text(t)} AS {t}' for t in _TAGS)} FROM products)"


def tag_texts(spark, folder):
    return cleaning.tags_as_text(products(spark, folder)).select("o_orderkey", *_TAGS)


@query("tags_to_text", f"WITH {PRODUCTS_SQL}, {_TEXT_SQL} SELECT * FROM texts")
def tags_to_text(spark, folder):
    return tag_texts(spark, folder)


_TOP_SQL = """
tops AS (SELECT *, CASE WHEN categories_tags = 'missing' THEN 'missing' ELSE
  COALESCE(NULLIF(trim(replace(replace(trim(list_filter(string_split(categories_tags, ','), lambda t: trim(t) <> '')[1]),
    'en:', ''), 'en-', '')), ''), 'missing') END AS category_top FROM texts)
"""


@query("top_category_text", f"WITH {PRODUCTS_SQL}, {_TEXT_SQL}, {_TOP_SQL} SELECT o_orderkey, category_top FROM tops")
def top_category_text(spark, folder):
    return cleaning.add_top_category(tag_texts(spark, folder)).select("o_orderkey", "category_top")


@query(
    "top_category_mapped",
    f"WITH {PRODUCTS_SQL} SELECT o_orderkey, {sql_group('categories_tags')} AS category_top FROM products",
)
def top_category_mapped(spark, folder):
    return cleaning.add_category_group(products(spark, folder)).select("o_orderkey", "category_top")


def _sql_flags(column, patterns):
    return ", ".join(f"regexp_matches(lower({column}), '{p}') AS {name}" for name, p in patterns.items())


_ALLERGEN_SQL = _sql_flags("allergens_tags", ALLERGEN_PATTERNS)
_LABEL_SQL = _sql_flags("labels_tags", LABEL_PATTERNS)


@query("allergen_flags", f"WITH {PRODUCTS_SQL}, {_TEXT_SQL} SELECT o_orderkey, {_ALLERGEN_SQL} FROM texts")
def allergen_flags(spark, folder):
    return cleaning.add_allergen_flags(tag_texts(spark, folder)).select("o_orderkey", *ALLERGEN_PATTERNS)


@query("label_flags", f"WITH {PRODUCTS_SQL}, {_TEXT_SQL} SELECT o_orderkey, {_LABEL_SQL} FROM texts")
def label_flags(spark, folder):
    return cleaning.add_label_flags(products(spark, folder)).select("o_orderkey", *LABEL_PATTERNS)


@query(
    "nutriscore_fill",
    f"WITH {PRODUCTS_SQL} SELECT o_orderkey, COALESCE(nutriscore_grade, 'missing') AS nutriscore_grade FROM products",
)
def nutriscore_fill(spark, folder):
    return cleaning.fill_grade(products(spark, folder)).select("o_orderkey", "nutriscore_grade")


@query("category_nunique", f"WITH {PRODUCTS_SQL}, {_TEXT_SQL}, {_TOP_SQL} SELECT count(DISTINCT category_top) AS n_distinct FROM tops")
def category_nunique(spark, folder):
    return frequency.distinct_count(cleaning.add_top_category(tag_texts(spark, folder)), "category_top")


@query(
    "freq_topk",
    f"""WITH {PRODUCTS_SQL} SELECT nutriscore_grade, count(*) AS n,
        round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM products), 6) AS pct
    FROM products WHERE nutriscore_grade IS NOT NULL GROUP BY nutriscore_grade ORDER BY n DESC, nutriscore_grade LIMIT 3""",
)
def freq_topk(spark, folder):
    return rounded(frequency.frequency_table(products(spark, folder), "nutriscore_grade", 3), "pct")


_ALL_FLAGS = [*ALLERGEN_PATTERNS, *LABEL_PATTERNS]


@query(
    "flag_rates",
    f"""WITH {PRODUCTS_SQL}, {_TEXT_SQL}, flags AS (SELECT {_ALLERGEN_SQL}, {_LABEL_SQL} FROM texts),
    totals AS (SELECT {', '.join(f'count_if({f})::BIGINT AS {f}' for f in _ALL_FLAGS)} FROM flags)
    SELECT flag, n, round(n * 100.0::DOUBLE / (SELECT count(*) FROM flags), 6) AS pct
    FROM (UNPIVOT totals ON {', '.join(_ALL_FLAGS)} INTO NAME flag VALUE n)""",
)
def flag_rates(spark, folder):
    flagged = cleaning.add_label_flags(cleaning.add_allergen_flags(tag_texts(spark, folder)))
    return rounded(frequency.flag_rates(flagged, _ALL_FLAGS), "pct")


@query(
    "drop_sparse_columns",
    f"WITH {NULLABLE_SQL} SELECT l_orderkey, l_quantity, l_returnflag, l_discount, l_tax + 0.0 AS l_tax, l_linestatus FROM nullable",
)
def drop_sparse_columns(spark, folder):
    # Six of seven ship dates are null, so that column goes.
    kept = cleaning.drop_sparse_columns(nullable(spark, folder))
    return kept.withColumn("l_tax", F.col("l_tax") + 0.0)


@query(
    "impute_group_mean",
    f"""WITH {NULLABLE_SQL},
    means AS (SELECT l_returnflag AS g, avg(l_discount) AS d, avg(l_tax) AS t FROM nullable GROUP BY l_returnflag)
    SELECT l_orderkey, l_returnflag,
      round(COALESCE(l_discount, d, (SELECT avg(l_discount) FROM nullable)), 6) AS l_discount,
      round(COALESCE(l_tax, t, (SELECT avg(l_tax) FROM nullable)) + 0.0, 6) AS l_tax
    FROM nullable LEFT JOIN means ON l_returnflag = g""",
)
def impute_group_mean(spark, folder):
    filled = cleaning.impute_group_mean(nullable(spark, folder), ["l_discount", "l_tax"], "l_returnflag")
    filled = filled.withColumn("l_tax", F.col("l_tax") + 0.0)
    return rounded(filled.select("l_orderkey", "l_returnflag", "l_discount", "l_tax"), "l_discount", "l_tax")


@query(
    "clip_range",
    f"""WITH {NULLABLE_SQL} SELECT l_orderkey, greatest(5.0, least(40.0, l_quantity)) AS l_quantity,
      CASE WHEN l_tax IS NOT NULL THEN greatest(0.02, least(0.05, l_tax)) END AS l_tax FROM nullable""",
)
def clip_range(spark, folder):
    clipped = cleaning.clip_range(nullable(spark, folder), {"l_quantity": (5.0, 40.0), "l_tax": (0.02, 0.05)})
    return clipped.select("l_orderkey", "l_quantity", "l_tax")
