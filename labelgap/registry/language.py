"""Language presence, cases and the gap per category."""

from pyspark.sql import functions as F

from labelgap.fixed_values import LANGUAGE_CASES
from labelgap.functions import language
from labelgap.operators import cleaning, frequency
from labelgap.plans.config import Config
from labelgap.plans.gap import add_language_case
from labelgap.registry.catalog import query
from labelgap.registry.features import rounded
from labelgap.registry.views import (
    CASE_SQL,
    DOMESTIC,
    EXPORT,
    GAP_SQL,
    PRESENCE_SQL,
    SCRIPT,
    ingredients,
    table,
)

_CONFIG = Config(domestic_codes=DOMESTIC, export_codes=EXPORT, domestic_script=SCRIPT)


def cases(spark, folder):
    return add_language_case(ingredients(spark, folder), config=_CONFIG)


def gap(spark, folder):
    return cleaning.add_category_group(cases(spark, folder))


@query("lang_presence_array", f"WITH {PRESENCE_SQL} SELECT doc_id, has_ingredients_ko, has_ingredients_en FROM presence")
def lang_presence_array(spark, folder):
    return cases(spark, folder).select("doc_id", "has_ingredients_ko", "has_ingredients_en")


@query(
    "lang_null_stop",
    f"""WITH {PRESENCE_SQL}, counted AS (SELECT doc_id, count(*) AS n_seen FROM
      (SELECT e.doc_id FROM entries e LEFT JOIN stops s ON e.doc_id = s.doc_id WHERE s.stop IS NULL OR e.i < s.stop)
      GROUP BY doc_id)
    SELECT i.doc_id, CASE WHEN i.doc_id % 31 = 0 THEN NULL ELSE COALESCE(n_seen, 0) END AS n_seen
    FROM ingredients i LEFT JOIN counted c ON i.doc_id = c.doc_id""",
)
def lang_null_stop(spark, folder):
    seen = language.entries_before_unnamed(F.col("ingredients_text"))
    size = F.when(seen.isNotNull(), F.size(seen).cast("bigint"))
    return ingredients(spark, folder).select("doc_id", size.alias("n_seen"))


@query(
    "lang_presence_struct",
    """SELECT doc_id, lower(lang) IN ('fr', 'fra') AS has_domestic, lower(lang) IN ('en', 'english') AS has_export FROM documents""",
)
def lang_presence_struct(spark, folder):
    entry = F.struct(F.upper("lang").alias("lang"), F.col("text"))
    domestic, export = language.presence_in_struct(entry, DOMESTIC, EXPORT)
    return table(spark, folder, "documents").select("doc_id", domestic.alias("has_domestic"), export.alias("has_export"))


@query(
    "lang_presence_text",
    """SELECT doc_id, regexp_matches(text, '[éèêç]') AS has_domestic, regexp_matches(text, '[A-Za-z]') AS has_export FROM documents""",
)
def lang_presence_text(spark, folder):
    domestic, export = language.presence_in_text(F.col("text"), SCRIPT)
    return table(spark, folder, "documents").select("doc_id", domestic.alias("has_domestic"), export.alias("has_export"))


@query("language_case", f"WITH {PRESENCE_SQL} SELECT doc_id, {CASE_SQL} AS language_case FROM presence")
def language_case(spark, folder):
    return cases(spark, folder).select("doc_id", "language_case")


@query(
    "case_distribution",
    f"""WITH {GAP_SQL} SELECT language_case, count(*) AS n,
      round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM gap), 6) AS pct FROM gap GROUP BY language_case""",
)
def case_distribution(spark, folder):
    return rounded(frequency.frequency_table(cases(spark, folder), "language_case"), "pct")


_NAMES = {c: n for c, n in zip(LANGUAGE_CASES, ["gap", "compliant", "no_data", "english_only"])}
_CROSSTAB_SQL = f"""
{GAP_SQL},
crosstab AS (SELECT category_top, {', '.join(f"count_if(language_case = '{c}')::BIGINT AS {n}" for c, n in _NAMES.items())},
  count(*) AS total FROM gap GROUP BY category_top),
top10 AS (SELECT * FROM crosstab ORDER BY total DESC, category_top LIMIT 10)
"""


def _short_names(df):
    return df.withColumnsRenamed(_NAMES)


@query("gap_crosstab", f"WITH {_CROSSTAB_SQL} SELECT * FROM crosstab")
def gap_crosstab(spark, folder):
    return _short_names(frequency.case_crosstab(gap(spark, folder)))


@query("crosstab_top10", f"WITH {_CROSSTAB_SQL} SELECT * FROM top10")
def crosstab_top10(spark, folder):
    return _short_names(frequency.top_categories(frequency.case_crosstab(gap(spark, folder))))


@query(
    "crosstab_pct",
    f"""WITH {_CROSSTAB_SQL} SELECT category_top,
    {', '.join(f'round({n} * 100.0::DOUBLE / total, 6) AS {n}' for n in _NAMES.values())}, total FROM top10""",
)
def crosstab_pct(spark, folder):
    top = frequency.top_categories(frequency.case_crosstab(gap(spark, folder)))
    return rounded(_short_names(frequency.crosstab_percent(top)), *_NAMES.values())


@query(
    "gap_ratio",
    f"WITH {_CROSSTAB_SQL} SELECT category_top, total, round(gap * 100.0::DOUBLE / total, 6) AS gap_pct FROM top10",
)
def gap_ratio(spark, folder):
    top = frequency.top_categories(frequency.case_crosstab(gap(spark, folder)))
    return rounded(frequency.gap_ratio(top), "gap_pct")


