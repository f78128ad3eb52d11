"""Score lines and risk bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelgap.fixed_values import MODEL_NUTRIENTS, RISK_CAUTION, RISK_HIGH

_DIGITS = r"\d(_?\d)*"
_NUMBER = rf"(?i)^[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})(e[+-]?{_DIGITS})?|inf|infinity|nan)$"


def line_words(line: Column) -> Column:
    """The words of a line of numbers: commas are deleted, then it is split at white space."""
    return F.filter(F.split(F.replace(line, F.lit(","), F.lit("")), r"(?U)\s+"), lambda w: w != "")


def line_status(line: Column, words: Column, n_fields: int) -> Column:
    """``quit``, ``number_error`` (checked first), ``count_error`` or ``ok``."""
    return (
        F.when(F.lower(line) == "q", "quit")
        .when(line.isNull(), "count_error")
        .when(~F.forall(words, lambda w: w.rlike(_NUMBER)), "number_error")
        .when(F.size(words) != n_fields, "count_error")
        .otherwise("ok")
    )


def word_number(words: Column, position: int) -> Column:
    return F.lower(F.replace(F.get(words, F.lit(position)), F.lit("_"), F.lit(""))).try_cast("double")


def risk_band(score: Column, high: float = RISK_HIGH, caution: float = RISK_CAUTION) -> Column:
    """Band of the unrounded score in percent."""
    return F.when(score >= high, "high").when(score >= caution, "caution").otherwise("safe")


def risk_verdict(band: Column) -> Column:
    # fixed values: verdict texts
    return (
        F.when(band == "high", "[수출 부적합 / 내수용 스펙]")
        .when(band == "caution", "[수출 가능성 있음 / 라벨 보완 필요]")
        .otherwise("[수출 적합 / 글로벌 스펙]")
    )


def risk_advice(band: Column) -> Column:
    # fixed values: advice texts; there is none for the middle band
    return F.when(
        band == "high",
        "당류와 지방 함량이 수출 기준에 비해 높을 가능성이 큽니다. "
        "영문 라벨 작성 시 'High Sugar' 경고 문구가 필요할 수 있습니다.",
    ).when(band == "safe", "현재 영양 성분은 글로벌 표준 제품들과 유사합니다.")
