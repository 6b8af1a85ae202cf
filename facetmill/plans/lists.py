"""Input lists of the ingestion side: product ids, address locations, exchange rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import value_if
from ..functions.urls import page_address
from ..operators.distincts import distinct_non_blank, earliest_value
from ..operators.joins import locate_addresses, locate_any_addresses
from ..operators.normalize import distinct_codes, flatten_rates, sorted_rates, with_event_types

# Event types that name a product, and the one whose page is the referrer.
PRODUCT_EVENTS = (
    "view_product_detail",
    "select_product_option",
    "select_product_option_quality",
    "add_to_cart_action",
    "product_detail_recommendation_visible",
    "product_detail_recommendation_noticed",
    "product_view_all_recommend_clicked",
)
REFERRER_EVENT = "product_view_all_recommend_clicked"


def product_id_list(
    events: DataFrame,
    url_prefix: str,
    event_types: tuple[str, ...] = PRODUCT_EVENTS,
    referrer_event: str = REFERRER_EVENT,
) -> DataFrame:
    """Products seen in events, with the first page they were seen on.

    "First" is the earliest event (then the least id), so that a re-run gives
    the same list.
    """
    seen = (
        with_event_types(events, event_types)
        .withColumn("product_id", F.coalesce("product_id", "viewing_product_id"))
        .where(F.col("product_id").isNotNull())
        .withColumn(
            "url",
            value_if(
                F.col("collection") == referrer_event, F.col("referrer_url"), F.col("current_url")
            ),
        )
    )
    return earliest_value(seen, "product_id", "url", ["time_stamp", "_id"], "first_url").withColumn(
        "url_request", page_address(url_prefix, "product_id")
    )


def ip_location_table(events: DataFrame, ranges: DataFrame) -> DataFrame:
    """Location of every distinct address in the events.

    Ranges of numbers (``ip_from``) hold IPv4, ranges of text (``range_from``) both families.
    """
    addresses = distinct_non_blank(events, "ip").withColumnRenamed("ip", "ip_address")
    return (locate_any_addresses if "range_from" in ranges.columns else locate_addresses)(addresses, ranges)


def exchange_rate_table(
    payloads: DataFrame, codes: DataFrame, currency: str = "currency_code", payload: str = "payload"
) -> DataFrame:
    """Rates of the listed currencies, one payload per currency and period."""
    wanted = distinct_codes(codes, currency)
    return sorted_rates(flatten_rates(payloads.join(wanted, currency, "left_semi"), currency, payload))
