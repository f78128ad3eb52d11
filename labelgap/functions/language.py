"""Which languages a label text is written in, and the case that follows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelgap.fixed_values import (
    CASE_COMPLIANT,
    CASE_EXPORT_ONLY,
    CASE_GAP,
    CASE_NO_DATA,
    DOMESTIC_CODES,
    DOMESTIC_SCRIPT,
    EXPORT_CODES,
    EXPORT_SCRIPT,
    RISK_MARK,
)


def entries_before_unnamed(entries: Column) -> Column:
    """The entries in front of the first one that has no language.

    A null entry is not an unnamed one: it is passed over, not a stop.
    """
    unnamed = F.transform(entries, lambda e: e.isNotNull() & e["lang"].isNull())
    stop = F.array_position(unnamed, True)
    return F.when(stop > 0, F.slice(entries, F.lit(1), (stop - 1).cast("int"))).otherwise(entries)


def presence_in_array(
    entries: Column,
    domestic_codes: Sequence[str] = DOMESTIC_CODES,
    export_codes: Sequence[str] = EXPORT_CODES,
    domestic_script: str = DOMESTIC_SCRIPT,
    stop_at_unnamed: bool = True,
) -> tuple[Column, Column]:
    """(domestic, export) for an array of ``{lang, text}``.

    Domestic: a language code, or a character of the domestic script in the
    text. Export: a language code only.
    """
    seen = entries_before_unnamed(entries) if stop_at_unnamed else entries
    domestic = F.exists(
        seen,
        lambda e: F.coalesce(F.lower(e["lang"]).isin(*domestic_codes), F.lit(False))
        | F.coalesce(e["text"].rlike(domestic_script), F.lit(False)),
    )
    export = F.exists(seen, lambda e: F.coalesce(F.lower(e["lang"]).isin(*export_codes), F.lit(False)))
    return F.coalesce(domestic, F.lit(False)), F.coalesce(export, F.lit(False))


def presence_in_struct(
    entry: Column, domestic_codes: Sequence[str] = DOMESTIC_CODES, export_codes: Sequence[str] = EXPORT_CODES
) -> tuple[Column, Column]:
    """(domestic, export) for one ``{lang, text}``: by language code only."""
    lang = F.lower(entry["lang"])
    return F.coalesce(lang.isin(*domestic_codes), F.lit(False)), F.coalesce(lang.isin(*export_codes), F.lit(False))


def presence_in_text(
    text: Column, domestic_script: str = DOMESTIC_SCRIPT, export_script: str = EXPORT_SCRIPT
) -> tuple[Column, Column]:
    """(domestic, export) for plain text: by script only."""
    return F.coalesce(text.rlike(domestic_script), F.lit(False)), F.coalesce(text.rlike(export_script), F.lit(False))


def language_case(domestic: Column, export: Column) -> Column:
    return (
        F.when(domestic & export, CASE_COMPLIANT)
        .when(domestic, CASE_GAP)
        .when(export, CASE_EXPORT_ONLY)
        .otherwise(CASE_NO_DATA)
    )


def risk_target(case: Column) -> Column:
    """1 for a product labelled for the domestic market only, else 0; null is 0."""
    return F.coalesce(case.contains(RISK_MARK), F.lit(False)).cast("int")


def language_columns(columns: Sequence[str], subject: str = "ingredients") -> dict[str, list[str]]:
    """Columns whose name holds the subject and a language code. Informational.

    The English list holds every match of the subject, since the word
    itself contains ``en``.
    """
    found = {}
    for lang, marks in {"ko": ("ko", "korean"), "en": ("en", "english")}.items():
        found[lang] = [c for c in columns if subject in c.lower() and any(m in c.lower() for m in marks)]
    return found
