"""Product-like views over the given tables, once in Spark and once as SQL.

Every view is a projection of whole tables, row by row, so it adds no shuffle
and no grouping to the query that reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COUNTRIES = [
    "en:south-korea", "en:ukraine", "en:north-korea", "EN:KR", "en:france", "en:korea", "en:united-states", "ko:South-Korea",
]
CATEGORIES = [
    "en:salty-snacks", "en:chicken-ramen", "en:plant-based-foods-and-beverages", "en:frozen-foods", "fr:soupes-froides",
    "en:meats-and-their-products", "en:chicken-soups", "children's cereals", "en:dairies", "en:condiments", "en:", "en:breakfasts",
    "en:desserts",
]
ALLERGENS = [
    "en:milk", "en:coconut", "en:shellfish", "en:crustaceans", "en:veggie-patty", "en:wheat", "en:soybeans", "EN:ALMONDS", "en:celery",
]
LABELS = [
    "en:organic", "en:vegan", "en:vegetarian", "en:fair_trade", "en:fair-trade", "en:probiotic", "en:halal", "EN:USDA-Organic",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(items: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(i) for i in items]), (F.pmod(position, F.lit(len(items))) + 1).cast("int"))


def _sql_list(items: list[str]) -> str:
    return "[" + ", ".join("'" + i.replace("'", "''") + "'" for i in items) + "]"


def _sql_pick(items: list[str], position: str) -> str:
    return f"{_sql_list(items)}[1 + ({position}) % {len(items)}]"


def products(spark: SparkSession, folder: str) -> DataFrame:
    """One product per order, with tag lists, grade, name and nutrient entries."""
    k, c, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    entry = lambda name, value: F.struct(
        name.alias("name"), value.cast("float").alias("100g"), F.lit("g").alias("unit")
    )
    named = lambda name, value: entry(F.lit(name), value)
    nothing = F.lit(None)
    calories = F.when(k % 3 == 0, nothing).when(k % 17 == 0, F.lit(float("nan"))).otherwise(price / 1000)
    sugar_name = F.when(k % 6 == 0, "").when(k % 6 == 1, nothing).otherwise("sugars")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey"),
        F.when(k % 997 == 0, nothing).otherwise(
            F.concat(F.lit(" "), k.cast("string"), F.when(k % 5 == 0, "\t").otherwise(""))
        ).alias("code"),
        F.array(
            F.struct(F.lit("main").alias("lang"), F.concat(F.lit("Item "), k.cast("string")).alias("text")),
            F.struct(F.lit("en").alias("lang"), F.lower("o_orderpriority").alias("text")),
        ).alias("product_name"),
        F.col("o_orderstatus").alias("brands"),
        F.when(c % 13 == 0, nothing)
        .when(c % 10 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(_pick(CATEGORIES, k + c), _pick(CATEGORIES, c)))
        .alias("categories_tags"),
        F.when(c % 19 == 0, nothing)
        .when(c % 23 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(_pick(COUNTRIES, c), _pick(COUNTRIES, k * 3 + c)))
        .alias("countries_tags"),
        F.when(c % 7 == 0, nothing)
        .otherwise(F.array(_pick(ALLERGENS, k), F.when(k % 11 != 0, F.lit("en:mustard")), _pick(ALLERGENS, c)))
        .alias("allergens_tags"),
        F.when(c % 9 == 0, F.array().cast("array<string>")).otherwise(F.array(_pick(LABELS, k * 5 + c))).alias("labels_tags"),
        F.when(k % 7 == 0, nothing).otherwise(_pick(["a", "b", "c", "d", "e"], c)).alias("nutriscore_grade"),
        F.array(
            named("energy-kcal", calories),
            named("energy", F.when(k % 4 == 0, nothing).otherwise(price / 250)),
            named("fat", (c % 100) / 2),
            named("fat", F.when(k % 2 == 0, nothing).otherwise(k % 70)),
            F.when(k % 29 != 0, entry(sugar_name, k % 90)),
            named("proteins", F.when(c % 5 != 0, (k + c) % 40)),
            named("carbohydrates", (k * 7) % 95),
            named("saturated-fat", F.when(k % 8 == 3, F.lit(float("nan"))).otherwise((c % 30) / 3)),
            named("sodium", (c % 50) / 100),
            named("salt", (c % 50) / 40),
        ).alias("nutriments"),
    )


_ENTRY = "{{'name': {name}, 'v': CAST({value} AS FLOAT)}}"


def _sql_entry(name: str, value: str) -> str:
    return _ENTRY.format(name=name, value=value)


PRODUCTS_SQL = f"""
products AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 997 = 0 THEN NULL
         ELSE ' ' || o_orderkey || CASE WHEN o_orderkey % 5 = 0 THEN chr(9) ELSE '' END END AS code,
    'Item ' || o_orderkey AS first_name,
    o_orderstatus AS brands,
    CASE WHEN o_custkey % 13 = 0 THEN NULL WHEN o_custkey % 10 = 0 THEN CAST([] AS VARCHAR[])
         ELSE [{_sql_pick(CATEGORIES, "o_orderkey + o_custkey")}, {_sql_pick(CATEGORIES, "o_custkey")}] END AS categories_tags,
    CASE WHEN o_custkey % 19 = 0 THEN NULL WHEN o_custkey % 23 = 0 THEN CAST([] AS VARCHAR[])
         ELSE [{_sql_pick(COUNTRIES, "o_custkey")}, {_sql_pick(COUNTRIES, "o_orderkey * 3 + o_custkey")}] END AS countries_tags,
    CASE WHEN o_custkey % 7 = 0 THEN NULL
         ELSE [{_sql_pick(ALLERGENS, "o_orderkey")}, CASE WHEN o_orderkey % 11 <> 0 THEN 'en:mustard' END,
               {_sql_pick(ALLERGENS, "o_custkey")}] END AS allergens_tags,
    CASE WHEN o_custkey % 9 = 0 THEN CAST([] AS VARCHAR[])
         ELSE [{_sql_pick(LABELS, "o_orderkey * 5 + o_custkey")}] END AS labels_tags,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE ['a','b','c','d','e'][1 + o_custkey % 5] END AS nutriscore_grade,
    [
      {_sql_entry("'energy-kcal'", "CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN 'NaN'::DOUBLE ELSE o_totalprice / 1000 END")},
      {_sql_entry("'energy'", "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice / 250 END")},
      {_sql_entry("'fat'", "(o_custkey % 100) / 2.0::DOUBLE")},
      {_sql_entry("'fat'", "CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderkey % 70 END")},
      CASE WHEN o_orderkey % 29 <> 0 THEN {_sql_entry("CASE WHEN o_orderkey % 6 = 0 THEN '' WHEN o_orderkey % 6 = 1 THEN NULL ELSE 'sugars' END", "o_orderkey % 90")} END,
      {_sql_entry("'proteins'", "CASE WHEN o_custkey % 5 <> 0 THEN (o_orderkey + o_custkey) % 40 END")},
      {_sql_entry("'carbohydrates'", "(o_orderkey * 7) % 95")},
      {_sql_entry("'saturated-fat'", "CASE WHEN o_orderkey % 8 = 3 THEN 'NaN'::DOUBLE ELSE (o_custkey % 30) / 3.0::DOUBLE END")},
      {_sql_entry("'sodium'", "(o_custkey % 50) / 100.0::DOUBLE")},
      {_sql_entry("'salt'", "(o_custkey % 50) / 40.0::DOUBLE")}
    ] AS nutriments
  FROM orders)
"""


def _sql_nutrient(name: str) -> str:
    return f"CAST(list_filter(nutriments, lambda e: e.name = '{name}' AND e.v IS NOT NULL)[-1].v AS DOUBLE)"


def _sql_zero(value: str) -> str:
    return f"CASE WHEN isnan({value}) THEN 0.0 ELSE COALESCE({value}, 0.0) END"


# The eight nutrients of every product, written as the reader of the data would do it.
NUTRIENTS_SQL = f"""
found AS (
  SELECT *, COALESCE({_sql_nutrient("energy-kcal")}, {_sql_nutrient("energy")} / 4.184::DOUBLE) AS f_energy,
    {_sql_nutrient("fat")} AS f_fat, {_sql_nutrient("saturated-fat")} AS f_satfat,
    {_sql_nutrient("carbohydrates")} AS f_carbs, {_sql_nutrient("sugars")} AS f_sugars,
    {_sql_nutrient("proteins")} AS f_proteins, {_sql_nutrient("sodium")} AS f_sodium, {_sql_nutrient("salt")} AS f_salt
  FROM products),
nutrients AS (
  SELECT *, {_sql_zero("f_energy")} AS energy_100g, {_sql_zero("f_fat")} AS fat_100g,
    {_sql_zero("f_satfat")} AS saturated_fat_100g, {_sql_zero("f_carbs")} AS carbohydrates_100g,
    {_sql_zero("f_sugars")} AS sugars_100g, {_sql_zero("f_proteins")} AS proteins_100g,
    {_sql_zero("f_sodium")} AS sodium_100g, {_sql_zero("f_salt")} AS salt_100g
  FROM found)
"""

# The languages of the documents stand for the label languages: fr for the domestic one, en for export.
DOMESTIC = ["fr", "fra"]
EXPORT = ["en", "english"]
SCRIPT = "[éèêç]"


def ingredients(spark: SparkSession, folder: str) -> DataFrame:
    """One product per document; every line of its whole text is an entry with a language."""
    doc = F.col("doc_id")

    def entry(line: Column, i: Column) -> Column:
        lang = (
            F.when((doc % 5 == 0) & (i == 2), F.lit(None))
            .when((doc % 4 == 1) & (i % 3 == 1), "EN")
            .when(i % 2 == 0, F.upper("lang"))
            .otherwise(F.col("lang"))
        )
        text = F.when((doc % 9 == 4) & (i == 1), F.lit(None)).otherwise(line)
        return F.when(~((doc % 6 == 2) & (i == 0)), F.struct(lang.alias("lang"), text.alias("text")))

    lines = F.transform(F.split("text", "\n"), entry)
    empty = F.slice(lines, 1, 0)
    source = F.substring("source", 4, 10).cast("bigint")
    return table(spark, folder, "documents").select(
        "doc_id",
        doc.cast("string").alias("code"),
        "source",
        "text",
        F.array(_pick(CATEGORIES, source), F.col("source")).alias("categories_tags"),
        F.array(_pick(COUNTRIES, doc * 5 + source)).alias("countries_tags"),
        F.when(doc % 31 == 0, F.lit(None)).when(doc % 37 == 0, empty).otherwise(lines).alias("ingredients_text"),
    )


INGREDIENTS_SQL = f"""
ingredients AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS code, source, text,
    [{_sql_pick(CATEGORIES, "CAST(substr(source, 4) AS BIGINT)")}, source] AS categories_tags,
    [{_sql_pick(COUNTRIES, "doc_id * 5 + CAST(substr(source, 4) AS BIGINT)")}] AS countries_tags,
    doc_id % 31 = 0 OR doc_id % 37 = 0 AS no_entries, lang
  FROM documents),
entries AS (
  SELECT doc_id, i,
    doc_id % 6 = 2 AND i = 0 AS is_null_entry,
    CASE WHEN doc_id % 5 = 0 AND i = 2 THEN NULL WHEN doc_id % 4 = 1 AND i % 3 = 1 THEN 'EN'
         WHEN i % 2 = 0 THEN upper(lang) ELSE lang END AS lang,
    CASE WHEN doc_id % 9 = 4 AND i = 1 THEN NULL ELSE lines[i + 1] END AS text
  FROM (SELECT doc_id, lang, lines, unnest(range(len(lines))) AS i
        FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS lines FROM ingredients WHERE NOT no_entries)))
"""

PRESENCE_SQL = f"""
{INGREDIENTS_SQL},
stops AS (SELECT doc_id, min(i) AS stop FROM entries WHERE NOT is_null_entry AND lang IS NULL GROUP BY doc_id),
seen AS (
  SELECT e.* FROM entries e LEFT JOIN stops s ON e.doc_id = s.doc_id
  WHERE NOT e.is_null_entry AND (s.stop IS NULL OR e.i < s.stop)),
flags AS (
  SELECT doc_id,
    bool_or(lower(lang) IN ('fr', 'fra') OR COALESCE(regexp_matches(text, '{SCRIPT}'), false)) AS domestic,
    bool_or(lower(lang) IN ('en', 'english')) AS export
  FROM seen GROUP BY doc_id),
presence AS (
  SELECT i.*, COALESCE(f.domestic, false) AS has_ingredients_ko, COALESCE(f.export, false) AS has_ingredients_en
  FROM ingredients i LEFT JOIN flags f ON i.doc_id = f.doc_id)
"""

CASE_SQL = """
CASE WHEN has_ingredients_ko AND has_ingredients_en THEN 'Compliant (수출/글로벌용)'
     WHEN has_ingredients_ko THEN 'Gap (내수용)' WHEN has_ingredients_en THEN 'English Only'
     ELSE 'No Data (데이터 부족)' END
"""


def sql_title(text: str) -> str:
    runs = f"regexp_extract_all({text}, '([A-Za-z]+|[^A-Za-z]+)')"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || lower(r[2:])), '')"


def sql_group(tags: str) -> str:
    """Display group of the first tag of a list column."""
    name = f"trim(replace(replace({tags}[1], 'en:', ''), 'en-', ''))"
    groups = [
        ("snacks", "Snacks"), ("instant-noodles", "Instant Noodles"), ("ramen", "Instant Noodles"),
        ("beverages", "Beverages"), ("sauces", "Sauces"), ("condiments", "Sauces"), ("dairies", "Dairies"),
        ("meats-and-their-products", "Meat Products"), ("plant-based-foods-and-beverages", "Plant-based Foods"),
        ("breakfasts", "Breakfast Foods"), ("desserts", "Desserts"),
    ]
    whens = " ".join(f"WHEN contains(lower({name}), '{part}') THEN '{group}'" for part, group in groups)
    return f"CASE WHEN {tags} IS NULL OR len({tags}) = 0 OR {name} = '' THEN 'Unknown' {whens} ELSE {sql_title(name)} END"


GAP_SQL = f"""
{PRESENCE_SQL},
gap AS (SELECT *, {CASE_SQL} AS language_case, {sql_group("categories_tags")} AS category_top FROM presence)
"""

SIDE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def sides(spark: SparkSession, folder: str) -> DataFrame:
    """All line items, those with return flag R as the synthetic side and all others as the original."""
    return table(spark, folder, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("is_synthetic"), *SIDE_COLUMNS)


SIDES_SQL = """
sides AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_synthetic,
                 l_quantity, l_extendedprice, l_discount, l_tax
          FROM lineitem),
side_values AS (
  SELECT is_synthetic, 'l_quantity' AS variable, l_quantity + 0.0 AS value FROM sides
  UNION ALL SELECT is_synthetic, 'l_extendedprice', l_extendedprice + 0.0 FROM sides
  UNION ALL SELECT is_synthetic, 'l_discount', l_discount + 0.0 FROM sides
  UNION ALL SELECT is_synthetic, 'l_tax', l_tax + 0.0 FROM sides)
"""

CLASS_FEATURES = ["n_chars", "n_words", "n_lines", "category_top"]


def measured(spark: SparkSession, folder: str) -> DataFrame:
    """All documents: measures of the whole text, source as category."""
    return table(spark, folder, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", " ")).cast("double").alias("n_words"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
        F.col("source").alias("category_top"),
    )


def classed(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents, with toxic as the rare target."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("target"), "quality")
    return measured(spark, folder).join(labels, "doc_id")


MEASURED_SQL = """
measured AS (
  SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars, CAST(len(string_split(text, ' ')) AS DOUBLE) AS n_words,
         CAST(len(string_split(text, chr(10))) AS DOUBLE) AS n_lines, source AS category_top FROM documents)
"""

CLASSED_SQL = """
classed AS (
  SELECT d.doc_id, CAST(n_chars AS DOUBLE) AS n_chars, CAST(len(string_split(text, ' ')) AS DOUBLE) AS n_words,
         CAST(len(string_split(text, chr(10))) AS DOUBLE) AS n_lines, source AS category_top,
         toxic AS target, quality
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
"""
