"""Numbers written by people in many countries, and order ids written as floats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import col

PRICE_TYPE = "decimal(18,6)"

# The shapes a price may have, tested in this order.
EUROPEAN = r"\..*,"          # 1.234,56
AMERICAN = r",.*\."          # 1,234.56
SWISS = r"'.*\."             # 1'234.56
ZERO_CENTS = r"[^0-9]00$"    # 1234,00 and the like, any separator
DECIMAL_COMMA = r"^[0-9]+,[0-9]{1,2}$"


def price_text(c: Column | str, strict_decimal_comma: bool = False) -> Column:
    """The price as plain decimal text, NULL for blank."""
    p = F.trim(col(c))
    plain = F.when(
        p.rlike(EUROPEAN), F.translate(p, ",.", ".")
    ).when(
        p.rlike(AMERICAN), F.replace(p, F.lit(","))
    ).when(
        p.rlike(SWISS), F.replace(p, F.lit("'"))
    ).when(
        p.rlike(ZERO_CENTS), F.regexp_replace(p, ZERO_CENTS, "")
    )
    if strict_decimal_comma:
        plain = plain.when(p.rlike(DECIMAL_COMMA), F.translate(p, ",", "."))
    return plain.when(p == "", None).otherwise(F.replace(p, F.lit(",")))


def parse_price(c: Column | str, strict_decimal_comma: bool = False) -> Column:
    """Locale-tolerant price (F1).

    A lone decimal comma (``1234,5``) counts as a thousands mark unless
    ``strict_decimal_comma`` is set. Text that is no number gives NULL; see
    :func:`is_price_reject`.
    """
    return price_text(c, strict_decimal_comma).try_cast(PRICE_TYPE)


def is_price_reject(c: Column | str, strict_decimal_comma: bool = False) -> Column:
    """True for text that is present but cannot be read as a price."""
    return price_text(c, strict_decimal_comma).isNotNull() & parse_price(
        c, strict_decimal_comma
    ).isNull()


def leading_digits(c: Column | str) -> Column:
    """Digits at the start (``123.0`` -> ``123``), NULL when there are none (F2)."""
    return F.nullif(F.regexp_extract(F.trim(col(c)), "^([0-9]+)", 1), F.lit(""))
