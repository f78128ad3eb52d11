"""Label content: candidates, prompts, completion, parsing, flattening, report."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgap.fixed_values import (
    CASE_GAP,
    LABEL_COUNT,
    LABEL_GROUP,
    PROMPT_TEMPLATE,
    REPORT_COLUMNS,
)
from labelgap.functions.labels import (
    allergen_text,
    card_calories,
    card_name,
    json_rescue,
    label_prompt,
    label_text,
    list_to_text,
    nutrition_json,
    product_name,
    product_name_text,
)
from labelgap.operators.population import ensure_columns
from labelgap.sources import LABEL_SCHEMA

_CORRUPT = "_corrupt_record"
_STATEMENT_WIDTH = 40


def label_candidates(
    df: DataFrame, case: str = CASE_GAP, group: str = LABEL_GROUP, energy: str = "energy_100g", k: int | None = LABEL_COUNT,
    key: str = "code",
) -> DataFrame:
    """Products of one case and group with a positive energy, the first ``k`` by key."""
    found = df.filter((F.col("language_case") == case) & (F.col("category_top") == group) & (F.col(energy) > 0))
    return found.orderBy(key).limit(k) if k is not None else found


_PROMPT_NUTRIENTS = ["energy_100g", "fat_100g", "saturated_fat_100g", "carbohydrates_100g", "sugars_100g", "proteins_100g"]


def _filled(df: DataFrame) -> DataFrame:
    filled = ensure_columns(df, {c: 0.0 for c in _PROMPT_NUTRIENTS})
    return ensure_columns(filled, {"sodium_100g": None, "allergens_tags": None})


def _name(df: DataFrame, compat: bool) -> Column:
    if "product_name" not in df.columns:
        return F.lit("Unknown Snack")
    if isinstance(df.schema["product_name"].dataType, T.ArrayType):
        return product_name(F.col("product_name"), compat)
    return product_name_text(F.col("product_name"), compat)


def add_prompt(df: DataFrame, compat: bool = True, output: str = "prompt") -> DataFrame:
    """Drafting prompt per product. An absent nutrient column is 0, an absent name column is unknown."""
    facts = nutrition_json(*[F.col(c) for c in _PROMPT_NUTRIENTS], F.col("sodium_100g").cast("double"))
    prompt = label_prompt(_name(df, compat), facts, allergen_text(F.col("allergens_tags").cast("string")))
    return _filled(df).withColumn(output, prompt).select(*df.columns, output)


# -- completion ---------------------------------------------------------------


def template_completion(prompts: Sequence[str]) -> list[str]:
    """Stand-in for a text model: fills the label structure from the prompt itself. Needs no network."""
    texts = []
    lines = [line.split("<<")[0] for line in PROMPT_TEMPLATE.split("\n") if "<<" in line]
    for prompt in prompts:
        found = [re.search(re.escape(line) + r"(.*)", prompt) for line in lines]
        name, facts, allergens = (m.group(1) if m else "" for m in found)
        values = json.loads(facts) if facts else {}
        label = {
            "product_name_en": name,
            "serving_size": "100g",
            "calories_per_serving": values.get("Energy", ""),
            "nutrition_facts": {
                "total_fat": values.get("Fat", ""),
                "sodium": values.get("Sodium", ""),
                "total_carbohydrate": values.get("Carbs", ""),
                "protein": values.get("Protein", ""),
            },
            "allergen_statement": f"Contains: {allergens}",
            "marketing_claims": [],
        }
        texts.append(f"```json\n{json.dumps(label, ensure_ascii=False)}\n```")
    return texts


def template_labels(df: DataFrame, key: str = "code", compat: bool = True) -> DataFrame:
    """``(key, text, error)`` per product: what ``template_completion`` makes of its prompt, straight from the columns.

    No prompt is formed and nothing leaves the JVM.
    """
    facts = F.col("energy_100g"), F.col("fat_100g"), F.col("sodium_100g").cast("double"), F.col("carbohydrates_100g"), F.col("proteins_100g")
    text = label_text(_name(df, compat), allergen_text(F.col("allergens_tags").cast("string")), *facts)
    return _filled(df).select(key, text.alias("text"), F.lit(None).cast("string").alias("error"))


def complete_labels(
    df: DataFrame,
    complete: Callable[[Sequence[str]], Sequence[str]] = template_completion,
    key: str = "code",
    prompt: str = "prompt",
) -> DataFrame:
    """``(key, text, error)`` per prompt.

    A batch that fails is sent again in halves, so a bad prompt costs its neighbours a few more
    sendings and not one each; a prompt that fails alone has an error. Prompts are sent again whenever the result is
    computed again: write it, or see ``journal.complete_once``.
    """
    return answered(df, complete, key, prompt)


def answered(df: DataFrame, complete: Callable[[Sequence[str]], Sequence[str]], key: str, prompt: str) -> DataFrame:
    def answers(prompts: list[str]) -> list[tuple[str | None, str | None]]:
        try:
            texts = list(complete(prompts))
            if len(texts) != len(prompts):
                raise ValueError("one text per prompt is needed")
            return [(text, None) for text in texts]
        except Exception as failure:  # whatever the caller's function raises is kept with its prompt
            if len(prompts) == 1:
                return [(None, f"{type(failure).__name__}: {failure}")]
            half = len(prompts) // 2
            return answers(prompts[:half]) + answers(prompts[half:])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                texts, errors = zip(*answers(batch[prompt].tolist()))
                yield pd.DataFrame({key: batch[key], "text": list(texts), "error": list(errors)})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, prompt).mapInPandas(run, f"`{key}` {kind}, text string, error string")


def parse_labels(
    df: DataFrame, text: str = "text", key: str = "code", schema: T.StructType = LABEL_SCHEMA, code_field: str = "original_code"
) -> tuple[DataFrame, DataFrame]:
    """(labels with their source code, rejected rows). The JSON is cut out of its surroundings first.

    Either frame parses the texts for itself; ``parsed_texts`` gives both in one.
    """
    parsed = parsed_texts(df, text, key, schema, code_field)
    good = parsed.filter("NOT is_rejected").drop("rejected_text", "is_rejected")
    bad = parsed.filter("is_rejected").select(F.col(code_field).cast(df.schema[key].dataType).alias(key), F.col("rejected_text").alias(text))
    return good, bad


def parsed_texts(
    df: DataFrame, text: str = "text", key: str = "code", schema: T.StructType = LABEL_SCHEMA, code_field: str = "original_code"
) -> DataFrame:
    """A row per text: the label's fields and its source code, ``is_rejected``, and ``rejected_text`` where no label could be read."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    # Generated columns are computed once per row; a filter on a plain column would parse a second time.
    rescued = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"), json_rescue(F.col(text)).alias("_json"))
    parsed = rescued.select("_key", "_text", F.inline(F.array(F.from_json("_json", with_corrupt))))
    is_bad = F.col("_text").isNull() | F.col(_CORRUPT).isNotNull()
    fields = [F.when(~is_bad, F.col(f"`{f.name}`")).alias(f.name) for f in schema if f.name != code_field]
    return parsed.select(
        *fields, F.col("_key").cast("string").alias(code_field), is_bad.alias("is_rejected"), F.when(is_bad, F.col("_text")).alias("rejected_text")
    )


# -- flattening and report ---------------------------------------------------------


def flatten_json(df: DataFrame, keys: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Structs and string-keyed maps to dotted columns; a key a record lacks is null.

    ``keys`` names the keys of each map by its dotted path. Without it they are found with one
    distinct aggregate, one job for each map, and ordered by name: a record of very many kinds of keys is
    better served by ``json_entries``, which gives rows.
    """
    found = {}
    for path in _map_columns(df.schema):
        named = None if keys is None else keys.get(path.replace("`", ""))
        if named is None:
            named = sorted(r["k"] for r in df.select(F.explode(F.map_keys(path)).alias("k")).distinct().collect())
        found[path] = list(named)
    return df.select(*_flat_columns(df.schema, "", "", found))


def json_entries(df: DataFrame, column: str, key: str = "original_code") -> DataFrame:
    """``(key, entry, value)``: a row per entry of a map, for maps whose keys are not known."""
    return df.select(key, F.explode(column).alias("entry", "value"))


def _map_columns(schema: T.StructType, prefix: str = "") -> list[str]:
    paths = []
    for field in schema:
        path = f"{prefix}`{field.name}`"
        if isinstance(field.dataType, T.MapType):
            paths.append(path)
        elif isinstance(field.dataType, T.StructType):
            paths += _map_columns(field.dataType, f"{path}.")
    return paths


def _flat_columns(schema, prefix, shown, keys):
    plain, nested = [], []
    for field in schema:
        path, name = f"{prefix}`{field.name}`", f"{shown}{field.name}"
        if isinstance(field.dataType, T.StructType):
            nested += _flat_columns(field.dataType, f"{path}.", f"{name}.", keys)
        elif isinstance(field.dataType, T.MapType):
            nested += [F.try_element_at(path, F.lit(k)).alias(f"{name}.{k}") for k in keys[path]]
        else:
            plain.append(F.col(path).alias(name))
    return plain + nested


def lists_as_text(df: DataFrame) -> DataFrame:
    """Every text-array column in its printed list form, so it fits a flat file."""
    lists = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    return df.select(*[list_to_text(F.col(f"`{c}`")).alias(c) if c in lists else F.col(f"`{c}`") for c in df.columns])


def label_report(df: DataFrame, columns: Sequence[str] = REPORT_COLUMNS, k: int = 3, key: str = "original_code") -> DataFrame:
    """The display columns that exist, of the first ``k`` labels by code."""
    shown = [c for c in columns if c in df.columns]
    return df.orderBy(key, *[c for c in shown if c != key]).select(*shown).limit(k)


def label_card(df: DataFrame, facts: str = "nutrition_facts") -> DataFrame:
    """The fields printed on a label card, with their defaults."""
    fact = lambda name, default: F.coalesce(F.try_element_at(F.col(facts), F.lit(name)), F.lit(default))
    return df.select(
        "original_code",
        F.coalesce("serving_size", F.lit("N/A")).alias("serving_size"),
        card_calories(F.col("calories_per_serving")).alias("calories"),
        fact("total_fat", "0g").alias("total_fat"),
        fact("sodium", "0mg").alias("sodium"),
        fact("total_carbohydrate", "0g").alias("total_carbohydrate"),
        fact("protein", "0g").alias("protein"),
        F.coalesce("allergen_statement", F.lit("")).alias("allergen_statement"),
        card_name(F.col("product_name_en")).alias("product_name"),
    )


#: Where a hyphenated word may be divided.
_BEHIND_HYPHEN = r"(?<=[\p{L}\p{N}_][\p{L}_]-)(?=[\p{L}\p{N}_]*[\p{L}_][\p{L}_])"


def wrapped_lines(text: Column, width: int = _STATEMENT_WIDTH) -> Column:
    """Text wrapped to the width of a label card, as many words to a line as fit.

    A hyphenated word may end a line behind a hyphen; a word longer than a line is cut. Null gives no lines.
    """
    spaced = F.trim(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " "))
    # A part wider than a line begins in what room the line has; behind a full line it keeps the blank before it.
    wide = rf"[^ ](?:(?!{_BEHIND_HYPHEN})[^ ]){{{width}}}"
    line = rf"(?>[^ ].{{0,{width - 1}}}(?:(?= |\z)|{_BEHIND_HYPHEN}))(?! ?{wide})"
    lines = F.regexp_extract_all(spaced, F.lit(rf"(?s)(?:(?! {wide}) )?( .{{{width - 1}}}|{line}|[^ ].{{0,{width - 1}}})"), F.lit(1))
    return F.coalesce(F.transform(lines, lambda line: F.rtrim(line)), F.array().cast("array<string>"))


def wrap_statement(df: DataFrame, statement: str = "allergen_statement", output: str = "statement_lines") -> DataFrame:
    return df.withColumn(output, wrapped_lines(F.col(statement)))
