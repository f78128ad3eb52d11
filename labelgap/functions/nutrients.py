"""Nutrient values out of an array of ``{name, 100g}`` entries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelgap.fixed_values import KILOJOULE_NAME, KJ_PER_KCAL, NUTRIENT_SOURCES


def usable_entries(nutriments: Column, name_field: str = "name", value_field: str = "100g") -> Column:
    """``{name, value}`` entries that have both, the last one first.

    Zipping the two field arrays keeps every other field of the entries out of the scan.
    """
    pairs = F.arrays_zip(
        nutriments.getField(name_field).alias("name"), nutriments.getField(value_field).alias("value")
    )
    return F.reverse(F.filter(pairs, lambda e: e["name"].isNotNull() & e["value"].isNotNull()))


def nutrient_columns(
    entries: Column, sources: Mapping[str, Sequence[str]] = NUTRIENT_SOURCES
) -> dict[str, Column]:
    """One double expression per nutrient, out of ``usable_entries``.

    The last entry of a name wins. Names are tried in order and a kilojoule
    energy is converted. A NaN counts as found, so it stops the search and
    ends as 0, like an absent nutrient.
    """

    def value_of(name: str) -> Column:
        position = F.array_position(entries["name"], name).cast("int") - 1
        return F.get(entries["value"], position).cast("double")

    columns = {}
    for target, names in sources.items():
        found = []
        for name in names:
            kilojoules = name == KILOJOULE_NAME and len(names) > 1
            found.append(value_of(name) / F.lit(KJ_PER_KCAL) if kilojoules else value_of(name))
        columns[target] = F.nanvl(F.coalesce(*found, F.lit(0.0)), F.lit(0.0))
    return columns
