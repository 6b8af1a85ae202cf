"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import col

UNKNOWN_KEY = -1
SEPARATOR = "\u001f"


def joined(*parts: Column | str) -> Column:
    """Parts as one text with a separator, NULL when any part is NULL (F8)."""
    out: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            out.append(F.lit(SEPARATOR))
        out.append(col(part).cast("string"))
    return F.concat(*out)


def surrogate_key(*parts: Column | str) -> Column:
    """A stable non-negative 60-bit number for the parts; NULL in, NULL out.

    Taken from md5, so any engine can compute the same key. It never collides
    with the unknown member -1.
    """
    return F.conv(F.substring(F.md5(joined(*parts)), 1, 15), 16, 10).cast("bigint")


def key_or_unknown(key: Column | str) -> Column:
    """A missing foreign key points to the unknown member (M9)."""
    return F.coalesce(col(key), F.lit(UNKNOWN_KEY).cast("bigint"))


def unknown_if_all(key: Column, *parts: Column | str, value: str = "Unknown") -> Column:
    """-1 when every part is unknown, else the key."""
    all_unknown = F.lit(True)
    for part in parts:
        all_unknown = all_unknown & (col(part) == value)
    return F.when(all_unknown, F.lit(UNKNOWN_KEY).cast("bigint")).otherwise(key)
