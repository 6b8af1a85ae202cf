"""Store identity hidden in page addresses."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from .text import col, like_any, not_like_all


@dataclass(frozen=True)
class StoreUrlRules:
    """Which addresses belong to a shop front, and which are noise.

    ``shop_hosts`` are LIKE patterns of public shop addresses, ``local_host``
    the in-house host whose first path segment names the country, and
    ``local_prefix`` the start of that segment.
    """

    shop_hosts: tuple[str, ...] = ("%www.shop.%", "%www.ring%")
    local_host: str = "shop.local"
    local_prefix: str = "st"
    # Words that mark search engines, test systems and ad traffic.
    excluded: tuple[str, ...] = field(
        default=("%google%", "%dev%", "%web%", "%chase%", "%trans%", "%test%", "%click%")
    )

    @property
    def local_pattern(self) -> str:
        return f"%{self.local_host}/{self.local_prefix}%"


def url_host(c: Column | str) -> Column:
    """Host of a URL without leading or trailing dots; NULL for a bad URL."""
    return F.btrim(F.try_parse_url(col(c), F.lit("HOST")), F.lit("."))


def host_and_first_segment(c: Column | str) -> Column:
    """``host/segment`` of an http address, NULL when there is no segment."""
    return F.nullif(F.regexp_extract(col(c), "^https?://([^/]+/[^/]+)", 1), F.lit(""))


def top_level_domain(host: Column | str) -> Column:
    """Letters after the last dot, NULL when absent."""
    return F.nullif(F.regexp_extract(col(host), r"\.([a-zA-Z]+)$", 1), F.lit(""))


def last_segment_tail(path: Column | str, n: int = 2) -> Column:
    """Last ``n`` characters of the last path segment."""
    return F.right(F.nullif(F.regexp_extract(col(path), "([^/]+)$", 1), F.lit("")), F.lit(n))


def is_store_url(c: Column | str, rules: StoreUrlRules) -> Column:
    return like_any(c, [*rules.shop_hosts, rules.local_pattern]) & not_like_all(c, rules.excluded)


def store_address(c: Column | str, rules: StoreUrlRules) -> Column:
    """Host of a public shop page, ``host/segment`` of an in-house page, else NULL."""
    return F.when(like_any(c, rules.shop_hosts), url_host(c)).when(
        col(c).like(rules.local_pattern), host_and_first_segment(c)
    )


def page_address(prefix: str, ident: Column | str) -> Column:
    """Address of an entity page from a fixed prefix and an id."""
    return F.concat(F.lit(prefix), col(ident))
