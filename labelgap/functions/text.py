"""Text expressions: keys, title case and number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelgap.fixed_values import NULL_KEY_TEXT


def strip_text(value: Column) -> Column:
    """Remove leading and trailing white space of any kind (``trim`` removes blanks only)."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def normalise_key(value: Column, null_text: str | None = NULL_KEY_TEXT) -> Column:
    """Key as stripped text. A null key becomes ``null_text``; ``None`` keeps it null."""
    text = value.cast("string")
    if null_text is not None:
        text = F.coalesce(text, F.lit(null_text))
    return strip_text(text)


def title_case(value: Column) -> Column:
    """Upper-case the first and lower-case the other letters of every run of cased letters.

    ``initcap`` alone starts words at blanks only, so it is applied to each run.
    """
    cased = r"[\p{Lu}\p{Ll}\p{Lt}]+"
    other = r"[^\p{Lu}\p{Ll}\p{Lt}]+"
    runs = F.regexp_extract_all(value, F.lit(f"({cased}|{other})"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def float_text(value: Column) -> Column:
    """A double as its shortest plain text: ``12.0``, ``12345678.0``, ``1e-05``; null and NaN are ``nan``."""
    number = value.cast("double")
    text = number.cast("string")
    plain = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    scientific = F.format_string(
        "%se%s%s", mantissa, F.when(exponent < 0, "-").otherwise("+"), F.lpad(F.abs(exponent).cast("string"), 2, "0")
    )
    size = F.abs(number)
    # Nearly all numbers take the first branch, which forms their text once.
    return (
        F.when(((size >= 1e-3) & (size < 1e7)) | (number == 0), text)
        .when(number.isNull() | F.isnan(number), "nan")
        .when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


def whole_number_text(value: Column) -> Column:
    """A double without decimals, ties to the even number; null and NaN are ``nan``."""
    number = value.cast("double")
    whole = F.bround(number, 0).cast("decimal(38,0)").cast("string")
    return F.when(number.isNull() | F.isnan(number), "nan").otherwise(whole)
