"""Label drafting: names, allergens, prompts, JSON rescue, card fields."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelgap.fixed_values import (
    PROMPT_TEMPLATE,
    UNKNOWN_ALLERGENS,
    UNKNOWN_CARD_NAME,
    UNKNOWN_PRODUCT_NAME,
)
from labelgap.functions.text import float_text, strip_text, whole_number_text


def product_name(names: Column, compat: bool = True) -> Column:
    """Text of the first entry of a ``{lang, text}`` array."""
    first = F.get(names, F.lit(0))["text"]
    return F.coalesce(first, F.lit("None" if compat else UNKNOWN_PRODUCT_NAME))


def product_name_text(value: Column, compat: bool = True) -> Column:
    """Name out of a printed list of entries; any other text is the name itself."""
    single = r"'text':\s*'([^']*)'"
    double = r'"text":\s*"([^"]*)"'
    printed = value.startswith("[") & value.contains("text")
    name = (
        F.when(printed & value.rlike(single), F.regexp_extract(value, single, 1))
        .when(printed & value.rlike(double), F.regexp_extract(value, double, 1))
        .otherwise(value)
    )
    return F.coalesce(name, F.lit("None" if compat else UNKNOWN_PRODUCT_NAME))


def allergen_text(tags_text: Column) -> Column:
    """Comma text of tags as readable text; nothing known asks for inference from the name."""
    raw = F.when(tags_text.isNull() | tags_text.isin("None", "nan", "missing"), "").otherwise(tags_text)
    text = F.replace(raw, F.lit("en:"), F.lit(""))
    text = F.replace(text, F.lit("-"), F.lit(" "))
    text = F.replace(text, F.lit(","), F.lit(", "))
    return F.when(text == "", UNKNOWN_ALLERGENS).otherwise(text)


def _grams(value: Column) -> Column:
    return F.concat(float_text(value), F.lit("g"))


def _milligrams(grams: Column) -> Column:
    return F.when(grams.isNull() | F.isnan(grams), "0mg").otherwise(F.concat(whole_number_text(grams * 1000), F.lit("mg")))


def _kcal(energy: Column) -> Column:
    return F.concat(whole_number_text(energy), F.lit(" kcal"))


def nutrition_json(
    energy: Column, fat: Column, saturated_fat: Column, carbohydrates: Column, sugars: Column, protein: Column,
    sodium: Column,
) -> Column:
    """Nutrition facts as one JSON object, with a blank after each colon and comma."""
    # One expression forms the texts of all five, so the plan holds its branches once.
    grams = F.transform(F.array(*[c.cast("double") for c in (fat, saturated_fat, carbohydrates, sugars, protein)]), _grams)
    facts = {
        "Energy": _kcal(energy),
        **{name: grams[i] for i, name in enumerate(["Fat", "Saturated Fat", "Carbs", "Sugars", "Protein"])},
        "Sodium": _milligrams(sodium),
    }
    pairs = [F.concat(F.lit(f'"{name}": "'), value, F.lit('"')) for name, value in facts.items()]
    return F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}"))


def label_prompt(name: Column, nutrition: Column, allergens: Column) -> Column:
    """The drafting prompt of one product."""
    places = {"name": name, "nutrition": nutrition, "allergens": allergens}
    # Pieces of text and names of places take turns.
    return F.concat(*[places[piece] if i % 2 else F.lit(piece) for i, piece in enumerate(re.split("<<(.*?)>>", PROMPT_TEMPLATE))])


def _json_text(value: Column) -> Column:
    """A text as a JSON string with its quotes."""
    listed = F.to_json(F.array(value))
    return F.substring(listed, F.lit(2), F.char_length(listed) - 2)


def label_text(
    name: Column, allergens: Column, energy: Column, fat: Column, sodium: Column, carbohydrates: Column, protein: Column
) -> Column:
    """A label in the form that a text model is asked for, as JSON within a code fence."""
    quoted = lambda value: F.concat(F.lit('"'), value, F.lit('"'))
    fields = {
        '{"product_name_en": ': _json_text(name),
        ', "serving_size": "100g", "calories_per_serving": ': quoted(_kcal(energy)),
        ', "nutrition_facts": {"total_fat": ': quoted(_grams(fat)),
        ', "sodium": ': quoted(_milligrams(sodium)),
        ', "total_carbohydrate": ': quoted(_grams(carbohydrates)),
        ', "protein": ': quoted(_grams(protein)),
        '}, "allergen_statement": ': _json_text(F.concat(F.lit("Contains: "), allergens)),
        ', "marketing_claims": []}': F.lit(""),
    }
    return F.concat(F.lit("```json\n"), *[part for lead, value in fields.items() for part in (F.lit(lead), value)], F.lit("\n```"))


def json_rescue(text: Column) -> Column:
    """Drop code fences, then keep what lies between the first ``{`` and the last ``}``."""
    bare = F.regexp_replace(text, r"```json\s*|```", "")
    inner = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    return F.when(inner != "", inner).otherwise(strip_text(bare))


def list_to_text(items: Column) -> Column:
    """A text array in the form ``['a', 'b']``; null stays null."""

    def quoted(item: Column) -> Column:
        escaped = F.replace(item, F.lit("\\"), F.lit("\\\\"))
        escaped = F.replace(escaped, F.lit("\n"), F.lit("\\n"))
        single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
        double = F.concat(F.lit('"'), escaped, F.lit('"'))
        shown = F.when(item.contains("'") & ~item.contains('"'), double).otherwise(single)
        return F.coalesce(shown, F.lit("None"))

    return F.concat(F.lit("["), F.array_join(F.transform(items, quoted), ", "), F.lit("]"))


def card_calories(calories: Column) -> Column:
    text = F.replace(calories.cast("string"), F.lit("kcal"), F.lit(""))
    return strip_text(F.replace(F.coalesce(text, F.lit("N/A")), F.lit("Calories"), F.lit("")))


def card_name(name: Column, width: int = 35) -> Column:
    """Name cut to the card width, the last three places being dots."""
    shown = F.coalesce(name, F.lit(UNKNOWN_CARD_NAME))
    cut = F.concat(F.substring(shown, 1, width - 3), F.lit("..."))
    return F.when(F.char_length(shown) > width, cut).otherwise(shown)
