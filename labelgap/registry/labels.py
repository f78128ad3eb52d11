"""Label content: candidates, prompts, completion, JSON and cards."""

from pyspark.sql import functions as F

from labelgap.fixed_values import NUTRIENT_SOURCES, PROMPT_TEMPLATE
from labelgap.functions.labels import allergen_text, json_rescue, list_to_text, product_name, product_name_text
from labelgap.functions.tags import tags_to_text
from labelgap.operators import cleaning, journal, label_content
from labelgap.registry.catalog import query
from labelgap.registry.features import rounded
from labelgap.registry.preparation import MERGED_SQL, merged
from labelgap.registry.views import NUTRIENTS_SQL, PRODUCTS_SQL, products, table
from labelgap.session import scratch_folder


@query(
    "label_candidates",
    f"""WITH {MERGED_SQL} SELECT code, category_top, round(energy_100g, 6) AS energy_100g FROM merged
    WHERE language_case = 'Gap (내수용)' AND category_top = 'Snacks' AND energy_100g > 0 ORDER BY code LIMIT 5""",
)
def label_candidates(spark, folder):
    found = label_content.label_candidates(merged(spark, folder))
    return rounded(found.select("code", "category_top", "energy_100g"), "energy_100g")


@query(
    "product_name_clean",
    f"WITH {PRODUCTS_SQL} SELECT o_orderkey, first_name AS name, first_name AS name_from_text, brands AS plain FROM products",
)
def product_name_clean(spark, folder):
    names = F.col("product_name")
    printed = F.concat(
        F.lit("[{'lang': '"), names[0]["lang"], F.lit("', 'text': '"), names[0]["text"], F.lit("'}\n {'lang': 'en', 'text': 'x'}]")
    )
    return products(spark, folder).select(
        "o_orderkey",
        product_name(names).alias("name"),
        product_name_text(printed).alias("name_from_text"),
        product_name_text(F.col("brands")).alias("plain"),
    )


_ALLERGENS_SQL = """
allergens AS (SELECT *, CASE WHEN allergens_tags IS NULL THEN 'Unknown (Infer from name)' ELSE
  replace(replace(replace(array_to_string(list_transform(allergens_tags, lambda t: COALESCE(t, 'None')), ','),
    'en:', ''), '-', ' '), ',', ', ') END AS allergens FROM products)
"""


@query("allergen_text", f"WITH {PRODUCTS_SQL}, {_ALLERGENS_SQL} SELECT o_orderkey, allergens FROM allergens")
def allergen_text_query(spark, folder):
    text = allergen_text(tags_to_text(F.col("allergens_tags")))
    return products(spark, folder).select("o_orderkey", text.alias("allergens"))


def prompt_rows(spark, folder):
    """Nutrients are rounded first, since engines print long fractions differently."""
    return cleaning.tags_as_text(rounded(cleaning.add_nutrients(products(spark, folder)), *NUTRIENT_SOURCES, digits=2))


def prompts(spark, folder):
    """A prompt per product."""
    return label_content.add_prompt(prompt_rows(spark, folder)).select("o_orderkey", "prompt")


def _sql_text(text):
    return "'" + text.replace("'", "''") + "'"


def _sql_whole(value):
    return f"CAST(round_even({value}, 0) AS BIGINT)"


_FACTS_SQL = " || ".join([
    """'{"Energy": "' || """ + _sql_whole("round(energy_100g, 2)") + """ || ' kcal"'""",
    *[f"""', "{name}": "' || CAST(round({column}, 2) AS VARCHAR) || 'g"'""" for name, column in [
        ("Fat", "fat_100g"), ("Saturated Fat", "saturated_fat_100g"), ("Carbs", "carbohydrates_100g"),
        ("Sugars", "sugars_100g"), ("Protein", "proteins_100g")]],
    """', "Sodium": "' || """ + _sql_whole("round(sodium_100g, 2) * 1000") + """ || 'mg"}'""",
])


@query(
    "label_prompt",
    f"""WITH {PRODUCTS_SQL}, {NUTRIENTS_SQL}, {_ALLERGENS_SQL}
    SELECT n.o_orderkey, replace(replace(replace({_sql_text(PROMPT_TEMPLATE)}, '<<name>>', n.first_name), '<<nutrition>>', {_FACTS_SQL}),
      '<<allergens>>', allergens) AS prompt
    FROM nutrients n JOIN allergens a ON n.o_orderkey = a.o_orderkey""",
)
def label_prompt(spark, folder):
    return prompts(spark, folder)


_COMPLETION_SQL = " || ".join([
    """'```json' || chr(10) || '{"product_name_en": "' || n.first_name || '", "serving_size": "100g", "calories_per_serving": "'""",
    _sql_whole("round(energy_100g, 2)"),
    """' kcal", "nutrition_facts": {"total_fat": "' || CAST(round(fat_100g, 2) AS VARCHAR) || 'g", "sodium": "'""",
    _sql_whole("round(sodium_100g, 2) * 1000"),
    """'mg", "total_carbohydrate": "' || CAST(round(carbohydrates_100g, 2) AS VARCHAR) || 'g", "protein": "'""",
    """CAST(round(proteins_100g, 2) AS VARCHAR) || 'g"}, "allergen_statement": "Contains: ' || allergens""",
    """'", "marketing_claims": []}' || chr(10) || '```'""",
])


_COMPLETE_SQL = f"""WITH {PRODUCTS_SQL}, {NUTRIENTS_SQL}, {_ALLERGENS_SQL}
    SELECT n.o_orderkey, {_COMPLETION_SQL} AS text, NULL::VARCHAR AS error
    FROM nutrients n JOIN allergens a ON n.o_orderkey = a.o_orderkey"""


@query("label_complete", _COMPLETE_SQL)
def label_complete(spark, folder):
    return label_content.template_labels(prompt_rows(spark, folder), key="o_orderkey")


@query("label_journal", _COMPLETE_SQL)
def label_journal(spark, folder):
    """Completions by way of the journal, which half of the products are in from an earlier run; that run's answers must not be asked for again."""
    path, asked = scratch_folder(spark, "journal"), prompts(spark, folder)
    first = asked.filter("o_orderkey % 2 = 0")
    journal.complete_once(first, path, label_content.template_completion, "o_orderkey", per_task=20_000)
    found = journal.complete_once(asked, path, label_content.template_completion, "o_orderkey", per_task=20_000)
    entries = journal.read_journal(spark, path).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("digest").alias("prompts")).first()
    if entries["n"] != entries["prompts"]:
        raise RuntimeError("a prompt was sent twice")
    return found


# -- JSON -------------------------------------------------------------------------

_TEXTS_SQL = r"""
texts AS (SELECT event_id, event_type, user_id, '```json' || chr(10) || '{"product_name_en": "' || event_type || ' number ' ||
    repeat('x', (event_id % 40)::INT) || '", "serving_size": "30g", "calories_per_serving": "' || (event_id % 500) ||
    ' kcal", "nutrition_facts": {"total_fat": "' || (user_id % 40) || 'g", ' ||
    CASE WHEN event_id % 3 = 0 THEN '"sodium": "5mg"' ELSE '"protein": "1g"' END ||
    '}, "allergen_statement": "Contains: ' || event_type || '", "marketing_claims": ["No ' || event_type || '", "It''s new"]' ||
    CASE WHEN event_id % 11 = 0 THEN '' ELSE '}' END || chr(10) || '``` done' AS text FROM events),
bare AS (SELECT *, regexp_replace(text, '```json\s*|```', '', 'g') AS b FROM texts),
rescued AS (SELECT *, CASE WHEN regexp_matches(b, '(?s)\{.*\}') THEN regexp_extract(b, '(?s)\{.*\}') ELSE trim(b) END AS j FROM bare),
labels AS (SELECT event_id, event_type, user_id, event_type || ' number ' || repeat('x', (event_id % 40)::INT) AS product_name_en,
  '30g' AS serving_size, (event_id % 500) || ' kcal' AS calories_per_serving, (user_id % 40) || 'g' AS total_fat,
  CASE WHEN event_id % 3 = 0 THEN '5mg' END AS sodium, CASE WHEN event_id % 3 <> 0 THEN '1g' END AS protein,
  'Contains: ' || event_type AS allergen_statement, '[''No ' || event_type || ''', "It''s new"]' AS marketing_claims,
  CAST(event_id AS VARCHAR) AS original_code FROM events WHERE event_id % 11 <> 0)
"""


def label_texts(spark, folder):
    """Completions as a text model gives them, one per event; every eleventh lacks its last brace."""
    event = F.col("event_id")
    s = F.lit
    text = F.concat(
        s('```json\n{"product_name_en": "'), F.col("event_type"), s(" number "), F.expr("repeat('x', int(event_id % 40))"),
        s('", "serving_size": "30g", "calories_per_serving": "'), (event % 500).cast("string"),
        s(' kcal", "nutrition_facts": {"total_fat": "'), (F.col("user_id") % 40).cast("string"), s('g", '),
        F.when(event % 3 == 0, '"sodium": "5mg"').otherwise('"protein": "1g"'),
        s('}, "allergen_statement": "Contains: '), F.col("event_type"), s('", "marketing_claims": ["No '), F.col("event_type"),
        s('", "It\'s new"]'), F.when(event % 11 == 0, "").otherwise("}"), s("\n``` done"),
    )
    return table(spark, folder, "events").select("event_id", "event_type", text.alias("text"))


@query("json_rescue", f"WITH {_TEXTS_SQL} SELECT event_id, j AS json FROM rescued")
def json_rescue_query(spark, folder):
    return label_texts(spark, folder).select("event_id", json_rescue(F.col("text")).alias("json"))


def parsed_labels(spark, folder):
    return label_content.parse_labels(label_texts(spark, folder), key="event_id")


@query(
    "label_parse",
    f"""WITH {_TEXTS_SQL} SELECT original_code, product_name_en, calories_per_serving, total_fat, sodium, protein,
      marketing_claims, false AS is_rejected FROM labels
    UNION ALL SELECT CAST(event_id AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, true FROM events WHERE event_id % 11 = 0""",
)
def label_parse(spark, folder):
    parsed = label_content.parsed_texts(label_texts(spark, folder), key="event_id")
    fact = lambda name: F.try_element_at("nutrition_facts", F.lit(name)).alias(name)
    claims = F.when(~F.col("is_rejected"), list_to_text(F.col("marketing_claims"))).alias("marketing_claims")
    return parsed.select(
        "original_code", "product_name_en", "calories_per_serving", fact("total_fat"), fact("sodium"), fact("protein"), claims, "is_rejected",
    )


@query(
    "json_flatten",
    f"""WITH {_TEXTS_SQL} SELECT original_code, product_name_en, serving_size, calories_per_serving, allergen_statement,
    marketing_claims, total_fat AS "nutrition_facts.total_fat", sodium AS "nutrition_facts.sodium",
    protein AS "nutrition_facts.protein" FROM labels""",
)
def json_flatten(spark, folder):
    good, _ = parsed_labels(spark, folder)
    known = {"nutrition_facts": ["protein", "sodium", "total_fat"]}
    return label_content.lists_as_text(label_content.flatten_json(good, known))


@query(
    "json_entries",
    f"""WITH {_TEXTS_SQL}, entries AS (SELECT original_code, unnest(['total_fat', 'sodium', 'protein']) AS entry,
      unnest([total_fat, sodium, protein]) AS value FROM labels)
    SELECT * FROM entries WHERE value IS NOT NULL""",
)
def json_entries(spark, folder):
    good, _ = parsed_labels(spark, folder)
    return label_content.json_entries(good, "nutrition_facts")


@query(
    "list_to_text",
    """SELECT event_id, '[' || CASE WHEN event_id % 4 = 0 THEN '' ELSE '''' || event_type || ''', "it''s"' END || ']' AS shown
    FROM events""",
)
def list_to_text_query(spark, folder):
    items = F.when(F.col("event_id") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array("event_type", F.lit("it's")))
    return table(spark, folder, "events").select("event_id", list_to_text(items).alias("shown"))


@query(
    "label_report",
    f"""WITH {_TEXTS_SQL} SELECT original_code, product_name_en, serving_size, calories_per_serving, allergen_statement
    FROM labels ORDER BY original_code LIMIT 3""",
)
def label_report(spark, folder):
    return label_content.label_report(parsed_labels(spark, folder)[0])


@query(
    "label_card",
    f"""WITH {_TEXTS_SQL} SELECT original_code, serving_size, trim(replace(calories_per_serving, 'kcal', '')) AS calories, total_fat,
    COALESCE(sodium, '0mg') AS sodium, '0g' AS total_carbohydrate, COALESCE(protein, '0g') AS protein, allergen_statement,
    CASE WHEN length(product_name_en) > 35 THEN substr(product_name_en, 1, 32) || '...' ELSE product_name_en END AS product_name
    FROM labels""",
)
def label_card(spark, folder):
    return label_content.label_card(parsed_labels(spark, folder)[0])


@query(
    "label_wrap",
    """SELECT doc_id, true AS fits, true AS is_greedy, md5(regexp_replace(text, '[ \\t\\n\\r\\f\\v]', '', 'g')) AS letters FROM documents""",
)
def label_wrap(spark, folder):
    """Per document: no line is too wide, none could have taken the next one's first word, and no letter is lost."""
    wrapped = label_content.wrap_statement(table(spark, folder, "documents").select("doc_id", "text"), "text")
    lines = F.col("statement_lines")
    word_behind = F.transform(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), lambda line: F.split(line, " ")[0])
    room = F.zip_with(
        F.slice(lines, 1, F.greatest(F.size(lines) - 1, F.lit(0))), word_behind, lambda line, word: F.char_length(line) + 1 + F.char_length(word) > 40
    )
    return wrapped.select(
        "doc_id", F.forall(lines, lambda line: F.char_length(line) <= 40).alias("fits"), F.forall(room, lambda x: x).alias("is_greedy"),
        F.md5(F.replace(F.array_join(lines, ""), F.lit(" "), F.lit(""))).alias("letters"),
    )
