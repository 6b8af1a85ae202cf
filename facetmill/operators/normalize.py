"""Ingestion-time normalisers: one stable shape per field, without a UDF."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..functions.text import col, has_text


def _first_char(c: Column) -> Column:
    return F.substring(F.ltrim(c), 1, 1)


def json_array_of(c: Column | str, item: T.StructType) -> Column:
    """Polymorphic JSON text to an array.

    An object becomes a one-element array, an array is kept, anything else
    (NULL, blank, number, quoted text) becomes the empty array.
    """
    text = col(c)
    empty = F.array().cast(T.ArrayType(item))
    parsed = F.from_json(text, T.ArrayType(item))
    return F.when(
        _first_char(text).isin("{", "["), F.coalesce(parsed, empty)
    ).otherwise(empty)


def json_object_of(c: Column | str, item: T.StructType) -> Column:
    """The value when the JSON text is an object, else NULL."""
    return F.when(_first_char(col(c)) == "{", F.from_json(col(c), item))


def json_list_of(c: Column | str, item: T.StructType) -> Column:
    """The value when the JSON text is an array, empty for an object, else NULL."""
    text = col(c)
    return F.when(
        _first_char(text) == "{", F.array().cast(T.ArrayType(item))
    ).when(_first_char(text) == "[", F.from_json(text, T.ArrayType(item)))


def normalize_option(df: DataFrame, column: str = "option") -> DataFrame:
    """Replace the raw ``option`` text by its array form and add the two split forms.

    The text is parsed once, with the fields of both forms; each form picks its own.
    """
    first = _first_char(F.col(column))
    parsed = df.withColumns({"_first": first, "_parsed": json_array_of(F.col(column), schemas.OPTION_ANY)})

    def of(value: Column, fields: T.StructType) -> Column:
        return F.struct(*[value.getField(f.name).alias(f.name) for f in fields])

    none = F.array().cast(T.ArrayType(schemas.OPTION_ITEM))
    listed = F.transform("_parsed", lambda x: of(x, schemas.OPTION_ITEM))
    return parsed.withColumns(
        {
            "option_object": F.when(F.col("_first") == "{", of(F.get("_parsed", F.lit(0)), schemas.OPTION_OBJECT)),
            "option_list": F.when(F.col("_first") == "{", none).when(F.col("_first") == "[", listed),
            column: F.col("_parsed"),
        }
    ).drop("_first", "_parsed")


_RAW_CART_ITEM = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in ("product_id", "amount", "price", "currency", "option")
    ]
)


def cart_of(c: Column | str) -> Column:
    """Raw cart text to a typed array.

    A cart that is no array is empty. ``amount`` is read as text and cast, so
    that both ``2`` and ``"2"`` count.
    """
    text = col(c)
    items = F.when(
        _first_char(text) == "[", F.from_json(text, T.ArrayType(_RAW_CART_ITEM))
    )
    typed = F.transform(
        items,
        lambda item: F.struct(
            item["product_id"].alias("product_id"),
            item["amount"].try_cast("bigint").alias("amount"),
            item["price"].alias("price"),
            item["currency"].alias("currency"),
            json_array_of(item["option"], schemas.CART_OPTION).alias("option"),
        ),
    )
    return F.coalesce(typed, F.array().cast(T.ArrayType(schemas.CART_ITEM)))


def normalize_cart(df: DataFrame, column: str = "cart_products") -> DataFrame:
    return df.withColumn(column, cart_of(column))


def normalize_events(raw: DataFrame) -> DataFrame:
    """Raw event log to the declared 34-column event table."""
    shaped = normalize_cart(normalize_option(raw))
    return shaped.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schemas.EVENTS])


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text: JSON for nested values, plain text otherwise, NULL stays NULL."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType))
        out.append((F.to_json(c) if nested else c.cast("string")).alias(f.name))
    return df.select(*out)


def discover_schema(df: DataFrame, json_column: str, fraction: float = 1.0, seed: int = 0) -> DataFrame:
    """The merged shape of JSON documents as one DDL text.

    ``fraction`` reads a random sample; unreadable documents are left out. The
    merge is an aggregate with partial results per task.
    """
    sampled = df if fraction >= 1.0 else df.sample(fraction=fraction, seed=seed)
    return sampled.agg(
        F.schema_of_variant_agg(F.try_parse_json(F.col(json_column))).alias("document_schema")
    )


def unwrap_envelope(lines: DataFrame, line: str, data: T.StructType, field: str = "data") -> DataFrame:
    """Keep the payload of JSON envelopes; drop unreadable lines and empty envelopes.

    The payload is first taken as text, so that only a malformed line counts
    as unreadable, not a payload with an odd value in one attribute.
    """
    envelope = T.StructType(
        [T.StructField(field, T.StringType()), T.StructField("_bad", T.StringType())]
    )
    parsed = F.from_json(
        F.col(line), envelope, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    )
    return (
        lines.select(parsed.alias("envelope"))
        .where(F.col("envelope._bad").isNull() & F.col(f"envelope.{field}").isNotNull())
        .select(F.from_json(f"envelope.{field}", data).alias("payload"))
        .select("payload.*")
    )


def read_enveloped_products(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """Crawl output files to product rows (N6 over files)."""
    lines = spark.read.option("pathGlobFilter", glob).text(path)
    return unwrap_envelope(lines, "value", schemas.PRODUCTS)


def keep_keys(c: Column | str, whitelist: T.StructType = schemas.PRODUCTS) -> Column:
    """A JSON object cut down to the declared keys."""
    return F.from_json(col(c), whitelist)


def embedded_payload(
    df: DataFrame,
    html: str,
    whitelist: T.StructType = schemas.PRODUCTS,
    marker: str = "react_data",
) -> DataFrame:
    """Pull the JSON object assigned to ``marker`` out of a page's script.

    Adds ``status`` and ``payload``. The status names the first step that
    failed. The whole page is searched. Marker and assignment are fixed by the pages.
    """
    assignment = rf"{marker}\s*[:=]"
    bodies = F.regexp_extract_all(
        F.col(html), F.lit(r"(?is)<script\b[^>]*>(.*?)</script"), F.lit(1)
    )
    script = F.get(F.filter(bodies, lambda body: body.rlike(assignment)), F.lit(0))
    literal = F.nullif(
        F.regexp_extract(F.col("_script"), rf"(?s){assignment}\s*(\{{.+?\}});", 1), F.lit("")
    )
    readable = F.try_parse_json(F.col("_literal")).isNotNull()
    status = (
        F.when(F.col("_script").isNull(), "MISSING_SCRIPT_TAG")
        .when(F.col("_literal").isNull(), "MISSING_JSON_MATCH")
        .when(~readable, "JSON_DECODE_ERROR")
        .otherwise("SUCCESS")
    )
    return (
        df.withColumn("_script", script)
        .withColumn("_literal", literal)
        .withColumn("status", status)
        .withColumn("payload", F.when(F.col("status") == "SUCCESS", keep_keys("_literal", whitelist)))
        .drop("_script", "_literal")
    )


def flatten_rates(payloads: DataFrame, currency: str, payload: str, to_currency: str = "USD") -> DataFrame:
    """Rate payloads to rows.

    One row per ``rates[]`` entry that has a real ``yyyy-mm-dd`` date and a
    rate. Sorting is left to the writer, see :func:`sorted_rates`.
    """
    item = F.explode(F.from_json(F.col(payload), schemas.RATE_PAYLOAD)["rates"])
    day = F.when(
        F.col("item.date").rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"),
        F.try_to_date(F.col("item.date"), "yyyy-M-d"),
    )
    return (
        payloads.select(F.col(currency).alias("_code"), item.alias("item"))
        .select(
            F.date_format(day, "yyyyMMdd").cast("bigint").alias("date_key"),
            F.upper(F.trim("_code")).alias("from_currency_code"),
            F.lit(to_currency).alias("to_currency_code"),
            F.col("item.rate").alias("exchange_rate"),
        )
        .where(F.col("date_key").isNotNull() & F.col("exchange_rate").isNotNull())
    )


def sorted_rates(rates: DataFrame) -> DataFrame:
    """Rates in currency, then date order (O2); a range-partitioned sort."""
    return rates.orderBy("from_currency_code", "date_key")


def distinct_codes(df: DataFrame, column: str) -> DataFrame:
    """Trimmed distinct codes, NULL left out."""
    return df.where(F.col(column).isNotNull()).select(F.trim(column).alias(column)).distinct()


def with_event_types(df: DataFrame, types: Iterable[str], column: str = "collection") -> DataFrame:
    """Rows of the named event types."""
    return df.where(F.col(column).isin(*types))


def non_blank(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where every named column has text."""
    for c in columns:
        df = df.where(has_text(c))
    return df
