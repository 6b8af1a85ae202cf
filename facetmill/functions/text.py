"""Blank handling, defaults, sentinels and pattern predicates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def has_text(c: Column | str) -> Column:
    """Not null and not blank."""
    return col(c).isNotNull() & (F.trim(col(c)) != "")


def strip_char(c: Column | str, char: str) -> Column:
    """Trim one given character from both ends."""
    return F.btrim(col(c), F.lit(char))


def default(c: Column | str, value) -> Column:
    """NULL becomes ``value`` (P10)."""
    return F.coalesce(col(c), F.lit(value))


def sentinel_to_default(c: Column | str, sentinel: str = "-", value: str = "Unknown") -> Column:
    """NULL or the sentinel becomes ``value``."""
    return F.coalesce(F.nullif(col(c), F.lit(sentinel)), F.lit(value))


def value_if(condition: Column, new, old) -> Column:
    """``new`` where the condition holds, else ``old``; an unknown condition keeps ``old``."""
    return F.when(condition, new).otherwise(old)


def missing_id(c: Column | str) -> Column:
    """Whether an id says "none": NULL, '0' or '-1' (P12)."""
    return col(c).isNull() | col(c).isin("0", "-1")


def like_any(c: Column | str, patterns: Iterable[str]) -> Column:
    """True when any LIKE pattern matches (P5)."""
    hits = [col(c).like(p) for p in patterns]
    out = hits[0]
    for hit in hits[1:]:
        out = out | hit
    return out


def not_like_all(c: Column | str, patterns: Iterable[str]) -> Column:
    """True when no LIKE pattern matches."""
    return ~like_any(c, patterns)


def country_code_repair(code: Column | str, name: Column | str) -> Column:
    """A NULL code beside 'Namibia' is the text 'NA' lost by a CSV reader."""
    return F.when(col(name) == "Namibia", F.coalesce(col(code), F.lit("NA"))).otherwise(col(code))
