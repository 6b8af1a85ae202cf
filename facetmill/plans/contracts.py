"""The declared columns of every output, and their enforcement (Q4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from ..operators.quality import type_mismatches

_AUDIT = ", created_at timestamp, created_by string, updated_at timestamp, updated_by string"

# What each output promises its readers, in order.
CONTRACTS = {
    "dim_date": "date_key bigint, full_date date, year_num bigint, quarter_num bigint, quarter_name string, month_num bigint, "
    "full_month_name string, year_month string, day_of_month bigint, day_of_week bigint, full_day_name string, is_weekend boolean",
    "dim_currency": "currency_key bigint, currency_code string, currency_name string" + _AUDIT,
    "dim_location": "location_key bigint, country_code string, country_name string, region string, city string" + _AUDIT,
    "dim_store": "store_key bigint, store_id string, country_code string, country_name string" + _AUDIT,
    "dim_product": "product_key bigint, product_id string, product_name string, product_sku string, attribute_set_id string, "
    "attribute_set_name string, packaging_type string, vnd_unit_price decimal(38,9), vnd_min_price decimal(38,9), vnd_max_price decimal(38,9), "
    "collection_id string, collection_name string, product_type_id string, product_type_name string, category_id string, "
    "category_name string, gender string" + _AUDIT,
    "dim_customer_scd": "scd_customer_key bigint, user_id_db string, email_address string, start_local_date date, end_local_date date, "
    "start_local_datetime timestamp_ntz, end_local_datetime timestamp_ntz, is_current boolean, has_email_info boolean" + _AUDIT,
    "dim_customer_current": "customer_key bigint, user_id_db string, email_address string, active_date date, has_email_info boolean" + _AUDIT,
    "fact_snapshot_exchange_rate": "exchange_rate_key bigint, date_key bigint, full_date date, from_currency_key bigint, "
    "to_currency_key bigint, exchange_rate decimal(38,9)" + _AUDIT,
    "fact_sales_order_detail": "sales_key bigint, order_id string, order_date_key bigint, local_order_date date, local_datetime timestamp_ntz, "
    "scd_customer_key bigint, customer_key bigint, location_key bigint, store_key bigint, product_key bigint, currency_key bigint, "
    "product_qty bigint, local_unit_price decimal(18,6), usd_unit_price decimal(38,9), local_amount decimal(38,9), usd_amount decimal(38,9)" + _AUDIT,
    "mart_sales_report": "order_id string, order_datetime timestamp_ntz, order_date date, year bigint, quarter_name string, month_num bigint, "
    "month_name string, day_name string, is_weekend boolean, product_id string, product_name string, product_sku string, "
    "product_category string, product_collection string, product_gender string, customer_country string, customer_region string, "
    "customer_city string, store_id string, store_country string, customer_id string, customer_email string, currency_code string, "
    "currency_name string, quantity_sold bigint, unit_price decimal(38,9), sales_amount decimal(38,9)",
}


class ContractError(ValueError):
    """A table has not the columns it declares."""


def columns(name: str) -> dict[str, str]:
    """The declared type of each column of an output."""
    return dict(part.split(" ", 1) for part in CONTRACTS[name].split(", "))


def declared(name: str) -> T.StructType:
    return T.StructType.fromDDL(CONTRACTS[name])


def promised(name: str, df: DataFrame) -> DataFrame:
    """``df`` with the declared columns of output ``name`` in their order; :class:`ContractError` if it has others or other types.

    Tables that declare nothing pass as they are. Runs no job: NULLs are counted when the table is written.
    """
    if name not in CONTRACTS:
        return df
    want = columns(name)
    wrong = want | {c: "no column" for c in df.columns if c not in want}
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wrong = {c: (t, actual.get(c)) for c, t in wrong.items() if actual.get(c) != t}
    if wrong:
        raise ContractError(f"{name}: " + ", ".join(f"{c} is {a or 'missing'}, declared {t}" for c, (t, a) in wrong.items()))
    return df.select(*want)


def mismatches(name: str, df: DataFrame) -> DataFrame:
    """Declared columns that are missing or have another type, as rows."""
    return type_mismatches(df, {f.name: f.dataType for f in declared(name)})
