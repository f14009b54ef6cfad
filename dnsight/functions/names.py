"""Domain name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(name: Column | str) -> Column:
    return F.col(name) if isinstance(name, str) else name


def normalised(name: Column | str) -> Column:
    """Lower case without trailing dots."""
    return F.lower(F.rtrim(_column(name), F.lit(".")))


def entropy(name: Column | str, digits: int = 6) -> Column:
    """Shannon entropy of the characters in bits, rounded so that summation order has no effect.

    log2(size) - sum(k * log2(k)) / size over the frequency k of each distinct character. The
    outer ``transform`` evaluates the name once, not once per character, and characters that occur
    once, which are most, need no logarithm.
    """
    name = _column(name)

    def weighted(text: Column) -> Column:
        def add(acc: Column, char: Column) -> Column:
            k = F.length(text) - F.length(F.replace(text, char, F.lit("")))
            return F.when(k > 1, acc + k * F.log2(k.cast("double"))).otherwise(acc)

        total = F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), add)
        size = F.length(text).cast("double")
        return F.log2(size) - total / size

    bits = F.round(F.transform(F.array(name), weighted)[0], digits)
    return F.when(F.length(name) > 0, F.abs(bits)).when(name.isNotNull(), F.lit(0.0))


def label_count(name: Column | str) -> Column:
    name = _column(name)
    return F.length(name) - F.length(F.replace(name, F.lit("."), F.lit(""))) + F.lit(1)


def longest_label(name: Column | str) -> Column:
    return F.array_max(F.transform(F.split(_column(name), r"\."), F.length))


def digit_count(name: Column | str) -> Column:
    name = _column(name)
    return F.length(name) - F.length(F.translate(name, "0123456789", ""))


def digit_ratio(name: Column | str, digits: int = 6) -> Column:
    name = _column(name)
    return F.round(digit_count(name).cast("double") / F.nullif(F.length(name), F.lit(0)), digits)


def top_level(name: Column | str) -> Column:
    name = _column(name)
    return F.when(name.contains("."), F.substring_index(name, ".", -1)).otherwise("none")


def last_two_labels(name: Column | str) -> Column:
    return F.substring_index(_column(name), ".", -2)


def foreign_characters(name: Column | str) -> Column:
    """Characters outside lower-case letters, digits, dot, hyphen and underscore."""
    return F.length(F.regexp_replace(_column(name), "[a-z0-9._-]", ""))


def in_selected_charset(name: Column | str) -> Column:
    return ~_column(name).rlike("[^a-z0-9._-]")


def has_escape(name: Column | str, strict: bool = False) -> Column:
    """Three-digit escape after a backslash; ``strict`` accepts octal digits only."""
    return _column(name).rlike(r"\\[0-7]{3}" if strict else r"\\[0-9]{3}")
