"""Tag lists: text form, top category, display group, flags."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelgap.fixed_values import (
    ALLERGEN_PATTERNS,
    CATEGORY_GROUPS,
    LABEL_PATTERNS,
    MISSING,
    NULL_KEY_TEXT,
    UNKNOWN_CATEGORY,
)
from labelgap.functions.text import strip_text, title_case

# Texts that Python reads as a literal other than a list.
_LITERAL = (
    r"^[ \t]*(None|True|False|\.\.\.|\{.*\}|\(.*\)|b?'[^']*'|b?\"[^\"]*\""
    r"|[+-]?(0[xX][0-9a-fA-F]+|0+|[1-9][0-9_]*|[0-9]+\.[0-9]*|\.[0-9]+|[0-9.]+[eE][+-]?[0-9]+)[jJ]?)\s*$"
)
_ONE_ITEM_LIST = r"^[ \t]*\[\s*(?:'([^']*)'|\"([^\"]*)\"|([^'\"\]]*))\s*\]\s*$"


def tag_matches(tags: Column, pattern: str) -> Column:
    """True when some tag of the array matches, ignoring case; a null array is false."""
    return F.coalesce(F.exists(tags, lambda t: F.lower(t).rlike(pattern)), F.lit(False))


def tags_to_text(tags: Column) -> Column:
    """Array as comma text; null or empty is ``missing``, a null tag is ``None``."""
    return F.when(tags.isNull() | (F.size(tags) == 0), MISSING).otherwise(F.array_join(tags, ",", NULL_KEY_TEXT))


def _without_language(tag: Column, compat: bool) -> Column:
    if compat:
        cleaned = F.replace(F.replace(tag, F.lit("en:"), F.lit("")), F.lit("en-"), F.lit(""))
    else:
        cleaned = F.regexp_replace(tag, "^en:", "")
    return strip_text(cleaned)


def _or_default(text: Column, default: str) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def top_category(tags: Column, compat: bool = True) -> Column:
    """First tag of an array without its language mark."""
    first = F.coalesce(F.get(tags, F.lit(0)), F.when(F.size(tags) > 0, NULL_KEY_TEXT))
    return _or_default(_without_language(first, compat), MISSING)


def top_category_text(tags: Column, compat: bool = True) -> Column:
    """First tag of a comma text without its language mark.

    With ``compat`` every ``en:`` and ``en-`` inside the tag is deleted and a
    text that is a Python literal is read as one; without it only a leading
    ``en:`` is.
    """
    parts = F.filter(F.transform(F.split(tags, ","), strip_text), lambda t: t != "")
    first = F.get(parts, F.lit(0))
    single = tags
    if compat:
        in_list = F.coalesce(*(F.nullif(F.regexp_extract(tags, _ONE_ITEM_LIST, i), F.lit("")) for i in (1, 2, 3)))
        single = (
            F.when(tags.rlike(_ONE_ITEM_LIST), in_list).when(tags.rlike(_LITERAL), F.lit(None)).otherwise(tags)
        )
    picked = F.when(tags.isin("", MISSING, "nan"), F.lit(None)).when(tags.contains(","), first).otherwise(single)
    return _or_default(_without_language(picked, compat), MISSING)


def group_of(name: Column, groups: Mapping[str, str] = CATEGORY_GROUPS) -> Column:
    """Display group of a tag without its language mark; the first part found in it decides."""
    lowered = F.lower(name)
    result = F.when(F.coalesce(name, F.lit("")) == "", UNKNOWN_CATEGORY)
    for part, group in groups.items():
        result = result.when(lowered.contains(part), group)
    # The outer default makes the column non-null for the optimizer, which then drops null filters on it.
    return F.coalesce(result.otherwise(title_case(name)), F.lit(UNKNOWN_CATEGORY))


def first_name(tags: Column, compat: bool = True) -> Column:
    """First tag of an array without its language mark; null when there is none."""
    first = F.when(F.size(tags) > 0, F.coalesce(F.get(tags, F.lit(0)), F.lit(NULL_KEY_TEXT)))
    return _without_language(first, compat)


def first_name_text(tags: Column, compat: bool = True) -> Column:
    """First tag of a comma text without its language mark."""
    first = strip_text(F.substring_index(tags, ",", 1))
    return _without_language(F.when(~tags.isin(MISSING, "nan"), first), compat)


def category_group(tags: Column, groups: Mapping[str, str] = CATEGORY_GROUPS, compat: bool = True) -> Column:
    """Display group of the first tag of an array."""
    return group_of(first_name(tags, compat), groups)


def category_group_text(tags: Column, groups: Mapping[str, str] = CATEGORY_GROUPS, compat: bool = True) -> Column:
    """Display group of the first tag of a comma text."""
    return group_of(first_name_text(tags, compat), groups)


def _flags(text: Column, patterns: Mapping[str, str]) -> dict[str, Column]:
    # Substrings parted by bars: a plain search for each is cheaper than a regular expression.
    lowered = F.lower(text)
    hits = {name: reduce(or_, (lowered.contains(part) for part in parts.split("|"))) for name, parts in patterns.items()}
    return {name: F.coalesce(hit, F.lit(False)) for name, hit in hits.items()}


def allergen_flags(tags_text: Column, patterns: Mapping[str, str] = ALLERGEN_PATTERNS) -> dict[str, Column]:
    """One boolean per allergen: does the tag text hold one of its substrings?"""
    return _flags(tags_text, patterns)


def label_flags(tags_text: Column, patterns: Mapping[str, str] = LABEL_PATTERNS) -> dict[str, Column]:
    """One boolean per label claim, by the same rule."""
    return _flags(tags_text, patterns)


def joined_tags(tags: Column) -> Column:
    """Array of tags as one text, for the flag functions."""
    return F.array_join(tags, " ")
