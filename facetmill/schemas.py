"""Declared schemas of the inputs. Loads never infer types."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(38, 9)


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# Field names of the three option variants and of the event log.
OPTION_OBJECT_FIELDS = [
    "alloy", "diamond", "shapediamond", "stone", "pearlcolor", "finish", "price",
    "category id", "Kollektion", "kollektion_id",
]
OPTION_LIST_FIELDS = [
    "option_label", "option_id", "value_label", "value_id", "quality_label", "quality",
]
CART_OPTION_FIELDS = ["option_label", "option_id", "value_label", "value_id"]

OPTION_OBJECT = T.StructType(_strings(*OPTION_OBJECT_FIELDS))
OPTION_ITEM = T.StructType(_strings(*OPTION_LIST_FIELDS))
OPTION_ANY = T.StructType(_strings(*OPTION_OBJECT_FIELDS, *OPTION_LIST_FIELDS))
CART_OPTION = T.StructType(_strings(*CART_OPTION_FIELDS))

CART_ITEM = T.StructType(
    _strings("product_id")
    + [T.StructField("amount", T.LongType())]
    + _strings("price", "currency")
    + [T.StructField("option", T.ArrayType(CART_OPTION))]
)

_EVENT_HEAD = [
    T.StructField("_id", T.StringType()),
    T.StructField("time_stamp", T.LongType()),
    *_strings(
        "ip", "user_agent", "resolution", "user_id_db", "device_id", "api_version", "store_id",
        "local_time", "show_recommendation", "current_url", "referrer_url", "email_address",
    ),
    T.StructField("recommendation", T.BooleanType()),
    *_strings(
        "utm_source", "utm_medium", "collection", "key_search", "product_id",
        "viewing_product_id", "recommendation_product_id", "recommendation_clicked_position",
        "recommendation_product_position", "price", "currency",
    ),
    T.StructField("is_paypal", T.BooleanType()),
]

# The event table after normalisation: 34 top-level columns.
EVENTS = T.StructType(
    _EVENT_HEAD
    + [
        T.StructField("option", T.ArrayType(OPTION_ANY)),
        T.StructField("option_object", OPTION_OBJECT),
        T.StructField("option_list", T.ArrayType(OPTION_ITEM)),
        *_strings("cat_id", "collect_id", "order_id"),
        T.StructField("cart_products", T.ArrayType(CART_ITEM)),
    ]
)

# The event log as exported: the polymorphic fields are still JSON text.
RAW_EVENTS = T.StructType(
    _EVENT_HEAD + _strings("option", "cat_id", "collect_id", "order_id", "cart_products")
)

# The product attributes that are kept (27 of an open-ended object).
PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType(), False),
        *_strings("name", "sku", "attribute_set_id", "attribute_set", "type_id"),
        T.StructField("price", MONEY),
        T.StructField("min_price", MONEY),
        T.StructField("max_price", MONEY),
        *_strings("min_price_format", "max_price_format"),
        T.StructField("gold_weight", T.DoubleType()),
        T.StructField("none_metal_weight", T.DoubleType()),
        T.StructField("fixed_silver_weight", T.DoubleType()),
        *_strings("material_design"),
        T.StructField("qty", T.LongType()),
        *_strings(
            "collection", "collection_id", "product_type", "product_type_value", "category",
            "category_name", "store_code", "platinum_palladium_info_in_alloy",
            "bracelet_without_chain", "show_popup_quantity_eternity", "gender",
        ),
    ]
)

IP_LOCATIONS = T.StructType(
    [T.StructField("ip_address", T.StringType(), False)]
    + _strings("country_code", "country_name", "region", "city")
)

IP_RANGES = T.StructType(
    [T.StructField("ip_from", T.LongType()), T.StructField("ip_to", T.LongType())]
    + _strings("country_code", "country_name", "region", "city")
)

COUNTRIES = T.StructType(
    _strings(
        "country_code_iso2", "country_name", "currency_code", "currency_name", "phone_code",
        "country_group",
    )
)
CURRENCIES = T.StructType(_strings("currency_code", "currency_name", "raw_symbol"))
RATES = T.StructType(
    [T.StructField("date_key", T.LongType())]
    + _strings("from_currency_code", "to_currency_code")
    + [T.StructField("exchange_rate", MONEY)]
)
RATE_PAYLOAD = "struct<rates:array<struct<date:string,rate:decimal(38,9)>>>"
