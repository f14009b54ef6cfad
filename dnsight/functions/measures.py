"""Counting and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(condition: Column, weight: str | None = None) -> Column:
    """Rows (or their ``weight``) for which the condition is true; 0 on empty input."""
    if weight is None:
        return F.count_if(condition)
    return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0)).cast("bigint")


def count_rows(weight: str | None = None) -> Column:
    if weight is None:
        return F.count(F.lit(1))
    return F.coalesce(F.sum(weight), F.lit(0)).cast("bigint")


def percent(part: Column | str, whole: Column | str, empty: float | None = None) -> Column:
    """100 * part / whole as double; ``empty`` where the denominator is zero or missing."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    ratio = F.lit(100.0) * part / F.nullif(whole, F.lit(0))
    return ratio if empty is None else F.coalesce(ratio, F.lit(float(empty)))


def first_max(value: Column | str, key: Column | str) -> Column:
    """Key of the largest value; the smallest key wins a tie."""
    value = F.col(value) if isinstance(value, str) else value
    key = F.col(key) if isinstance(key, str) else key
    return F.min(F.struct((-value).alias("v"), key.alias("k")))["k"]


def grouped_number(value: Column | str) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(value, 0)


def millions_text(value: Column | str) -> Column:
    """``11.7 M`` from one million upwards, ``1,234`` below."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(
        value >= 1_000_000, F.format_string("%.1f M", value / F.lit(1e6))
    ).otherwise(grouped_number(value))


def percent_text(value: Column | str, digits: int = 2) -> Column:
    """Percentage text; a missing value gives null, not the text ``null%``."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}f%%", value))
