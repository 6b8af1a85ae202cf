"""Staging, dimension, fact and mart tables, and the ingestion lists."""

from __future__ import annotations

import dataclasses
import functools

from pyspark.sql import DataFrame, functions as F

from ..functions.audit import AUDIT, without_audit
from ..operators import joins
from ..plans import checks, contracts, dims, facts, lists, pipeline, staging
from ..plans import testdata as td
from ..session import materialize, new_folder, run_folder
from . import fragments as q
from .registry import SQL, query


@query(f"""WITH {q.SALES} SELECT order_id, {q.ts('local_datetime')} AS local_datetime,
  CAST(local_order_date AS VARCHAR) AS local_order_date, order_date_key, store_id, ip_address, user_id_db,
  email_address, product_id, currency, product_qty, CAST(unit_price AS DOUBLE) AS unit_price FROM sales""")
def stg_sales_order_detail(spark, folder):
    """P1 A5 U1 U2 P7 P11 F1 F2 F12 F14."""
    return staging.stg_sales_order_detail(td.checkouts(spark, folder))


@query(f"""WITH {q.FOLDED} SELECT order_id, product_id, currency, CAST(unit_price AS DOUBLE) AS unit_price, product_qty,
  user_id_db, email_address FROM folded""")
def summed_lines(spark, folder):
    """A1."""
    sales = staging.stg_sales_order_detail(td.checkouts(spark, folder))
    return facts.summed_lines(sales).select(
        "order_id", "product_id", "currency", "unit_price", "product_qty", "user_id_db", "email_address"
    )


@query("""SELECT CASE WHEN o_orderstatus = 'P' THEN 'order_id' WHEN o_orderstatus = 'O' THEN 'local_time' ELSE 'price' END AS reason,
  count(*) AS n_rows FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def rejected_lines(spark, folder):
    """Unusable checkouts by reason: no digits in the id, no real time, no number in the price."""
    orders = td.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    lines = td.table(spark, folder, "lineitem")
    status = F.col("o_orderstatus")
    row = F.struct("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    events = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.lit(staging.CHECKOUT).alias("collection"),
        F.when(status == "P", "no id").otherwise(F.col("l_orderkey").cast("string")).alias("order_id"),
        F.when(status == "O", "31 of March").otherwise("2020-03-31 10:00:00").alias("local_time"),
        F.lit("1").alias("store_id"),
        F.to_json(row).alias("ip"),
        F.lit("u").alias("user_id_db"),
        F.lit("").alias("email_address"),
        F.array(
            F.struct(
                F.lit("p").alias("product_id"), F.lit(1).cast("bigint").alias("amount"),
                F.when(status == "F", "twelve").otherwise("12.00").alias("price"), F.lit("x").alias("currency"),
            )
        ).alias("cart_products"),
    )
    return staging.rejected_lines(events).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"""WITH {q.BUYERS}, {q.STORES} SELECT store_id, address AS hostname_or_extracted_local_url FROM store_pages""")
def stg_store_url_info(spark, folder):
    """P4 P5 P6 A6 F3 F4."""
    return staging.stg_store_url_info(td.visits(spark, folder), td.URL_RULES)


@query(f"""WITH {q.BUYERS}, {q.STORES} SELECT {q.key('store_id')} AS store_key, CAST(store_id AS VARCHAR) AS store_id,
  country_code, country_name FROM stores UNION ALL SELECT -1, '-1', 'Unknown', 'Unknown'""")
def dim_store(spark, folder):
    """A6 F5 J14 P8 J15 F9 O5."""
    pages = staging.stg_store_url_info(td.visits(spark, folder), td.URL_RULES)
    return without_audit(dims.dim_store(pages, td.countries(spark, folder), td.URL_RULES.local_host))


_DATE_SQL = """WITH {calendar} SELECT CAST(strftime(day, '%Y%m%d') AS BIGINT) AS date_key, CAST(day AS VARCHAR) AS full_date,
  year(day) AS year_num, quarter(day) AS quarter_num, 'Quarter ' || quarter(day) AS quarter_name, month(day) AS month_num,
  monthname(day) AS full_month_name, strftime(day, '%Y-%m') AS year_month, day(day) AS day_of_month,
  dayofweek(day) + 1 AS day_of_week, dayname(day) AS full_day_name, dayofweek(day) IN (0, 6) AS is_weekend FROM calendar"""


@query(_DATE_SQL.format(calendar=q.CALENDAR))
def dim_date(spark, folder):
    """Every day of the order history."""
    first, last = td.calendar_bounds(spark, folder)
    return dims.dim_date(staging.stg_generate_date(spark, last, first))


@query(f"""WITH {q.COUNTRIES} SELECT {q.key('currency_code')} AS currency_key, currency_code, currency_name FROM countries
  UNION ALL SELECT -1, 'Unknown', 'Unknown'""")
def dim_currency(spark, folder):
    """F9 O5."""
    return without_audit(dims.dim_currency(td.currencies(spark, folder)))


@query(f"""WITH {q.LOCATED} SELECT ip_address, location_key, country_code, country_name, region, city FROM ip_map""")
def stg_ip_location_mapping(spark, folder):
    """Dashes and quotes in the input are cleaned away."""
    raw = td.ip_locations(spark, folder)
    dirty = raw.select(
        F.concat(F.lit(" "), "ip_address").alias("ip_address"),
        *[
            F.when(F.col(c) == "Unknown", "-").otherwise(F.concat(F.lit(mark), F.col(c), F.lit(mark))).alias(c)
            for c, mark in (("country_code", ""), ("country_name", "'"), ("region", "'"), ("city", "'"))
        ],
    )
    return staging.stg_ip_location_mapping(dirty)


@query(f"""WITH {q.LOCATED} SELECT DISTINCT location_key, country_code, country_name, region, city FROM ip_map
  WHERE location_key <> -1 UNION ALL SELECT -1, 'Unknown', 'Unknown', 'Unknown', 'Unknown'""")
def dim_location(spark, folder):
    """A6 O5."""
    return without_audit(dims.dim_location(staging.stg_ip_location_mapping(td.ip_locations(spark, folder))))


_PRODUCT_COLUMNS = """product_id, product_name, product_sku, attribute_set_id, attribute_set_name, packaging_type,
  vnd_unit_price, vnd_min_price, vnd_max_price, collection_id, collection_name, product_type_id, product_type_name,
  category_id, category_name, gender"""


@query(f"WITH {q.PRODUCTS} SELECT {_PRODUCT_COLUMNS} FROM crawled")
def stg_product(spark, folder):
    """P7 P11 P4."""
    return staging.stg_product(td.products(spark, folder))


@query(f"""WITH {q.PRODUCTS} SELECT {q.key('product_id')} AS product_key, {_PRODUCT_COLUMNS} FROM products
  UNION ALL SELECT -1, '-1', 'Unknown', 'Unknown', '-1', 'Unknown', 'Unknown', 0, 0, 0, '-1', 'Unknown', '-1', 'Unknown',
    '-1', 'Unknown', 'Unknown'""")
def dim_product(spark, folder):
    """J10 P9 P10 P12 F9 O5."""
    sold = td.lines_as_written(spark, folder).select("product_id")
    return without_audit(dims.dim_product(staging.stg_product(td.products(spark, folder)), sold))


@query(f"""WITH {q.PRODUCTS.replace('p_retailprice AS vnd_unit_price', 'p_retailprice + 1 AS vnd_unit_price')}
  SELECT {q.key('product_id')} AS product_key, {_PRODUCT_COLUMNS} FROM products
  UNION ALL SELECT -1, '-1', 'Unknown', 'Unknown', '-1', 'Unknown', 'Unknown', 0, 0, 0, '-1', 'Unknown', '-1', 'Unknown',
    '-1', 'Unknown', 'Unknown'""")
def dim_product_recrawled(spark, folder):
    """Every product crawled twice; through the whole build the later crawl counts, one row per product."""
    src = td.sources(spark, folder)
    early = src.products.withColumn("crawled", F.lit(1))
    # The earlier crawl is greater in all other columns.
    late = early.withColumns({"price": (F.col("price") + 1).cast("decimal(38,9)"), "crawled": F.lit(2)})
    early = early.withColumns({"name": F.concat(F.lit("~"), "name"), "sku": F.concat(F.lit("~"), "sku")})
    src = dataclasses.replace(src, products=early.unionByName(late), product_loaded="crawled")
    return without_audit(pipeline.build_core(src)["dim_product"])


@query("""WITH sold AS (SELECT DISTINCT 'P' || l_suppkey AS id FROM lineitem), listed AS (SELECT 'P' || (p_partkey // 2) AS id,
    max(p_name) AS name FROM part GROUP BY 1)
  SELECT coalesce(l.id, s.id) AS product_id, coalesce(name, 'Unknown') AS product_name FROM listed l FULL JOIN sold s ON l.id = s.id""")
def product_full_outer(spark, folder):
    """J10 where both sides have rows of their own."""
    ident = F.concat(F.lit("P"), F.floor(F.col("p_partkey") / 2).cast("string"))
    listed = td.products(spark, folder).join(
        td.table(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("k"), ident.alias("id")),
        F.trim("product_id") == F.col("k"),
    ).groupBy(F.col("id").alias("product_id")).agg(
        *[F.max(c).alias(c) for c in td.products(spark, folder).columns if c != "product_id"]
    )
    sold = td.table(spark, folder, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_suppkey").cast("string")).alias("product_id")
    )
    return dims.product_rows(staging.stg_product(listed), sold).select("product_id", "product_name")


@query(f"""WITH {q.CONVERTED} SELECT order_id, product_id, currency_code, CAST(local_unit_price AS DOUBLE) AS local_unit_price,
  CAST(rate AS DOUBLE) AS exchange_rate, CAST(usd_unit_nano AS DOUBLE) / 1e9 AS usd_unit_price,
  CAST(local_amount AS DOUBLE) AS local_amount, CAST(usd_nano AS DOUBLE) / 1e9 AS usd_amount, product_qty FROM converted""")
def fx_convert_lines(spark, folder):
    """M11 with F16, F17, J1, J2, J3."""
    return _converted(spark, folder).select(
        "order_id", "product_id", "currency_code", "local_unit_price", "exchange_rate", "usd_unit_price",
        "local_amount", "usd_amount", "product_qty",
    )


def _converted(spark, folder):
    from ..operators.rates import convert_lines, dense_rates

    first, last = td.calendar_bounds(spark, folder)
    money = td.countries(spark, folder).select(
        F.col("country_code_iso2").alias("country_code"), F.col("currency_code").alias("country_currency")
    )
    pages = staging.stg_store_url_info(td.visits(spark, folder), td.URL_RULES)
    stores = (
        dims.store_rows(pages, td.countries(spark, folder), td.URL_RULES.local_host)
        .join(money, "country_code", "left")
        .select("store_id", "country_currency")
    )
    lines = facts.summed_lines(staging.stg_sales_order_detail(td.checkouts(spark, folder)))
    daily = dense_rates(
        td.rates(spark, folder), staging.stg_generate_date(spark, last, first), td.currencies(spark, folder)
    )
    spread = ["order_id", "product_id"]
    priced = joins.lookup_join(lines, materialize(stores, "stores"), ["store_id"], spread)
    return convert_lines(priced, materialize(daily, "daily"), spread)


@query(f"""WITH {q.CONVERTED} SELECT currency_code, strftime(local_order_date, '%Y-%m') AS year_month,
  count(*) AS n_lines, CAST(sum(product_qty) AS BIGINT) AS quantity, CAST(sum(usd_nano) AS DOUBLE) / 1e9 AS usd_amount
  FROM converted GROUP BY ALL""")
def sales_monthly_usd(spark, folder):
    """Monthly revenue in dollars by currency: A5 U1 F1 A1 M10 M11."""
    return (
        _converted(spark, folder)
        .groupBy("currency_code", F.date_format("local_order_date", "yyyy-MM").alias("year_month"))
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum("product_qty").alias("quantity"),
            F.sum("usd_amount").alias("usd_amount"),
        )
    )


@query(f"""WITH {q.FACT} SELECT sales_key, order_id, order_date_key, CAST(local_order_date AS VARCHAR) AS local_order_date,
  {q.ts('local_datetime')} AS local_datetime, scd_customer_key, customer_key, location_key, store_key, product_key, currency_key,
  product_qty, CAST(local_unit_price AS DOUBLE) AS local_unit_price, CAST(usd_unit_nano AS DOUBLE) / 1e9 AS usd_unit_price,
  CAST(local_amount AS DOUBLE) AS local_amount, CAST(usd_nano AS DOUBLE) / 1e9 AS usd_amount FROM fact""")
def fact_sales(spark, folder):
    """J1 to J8."""
    return without_audit(pipeline.build_core(td.sources(spark, folder))["fact_sales_order_detail"])


@query(f"""WITH {q.FACT} SELECT order_id, {q.ts('local_datetime')} AS order_datetime, CAST(local_order_date AS VARCHAR) AS order_date,
  year(local_order_date) AS year, 'Quarter ' || quarter(local_order_date) AS quarter_name, month(local_order_date) AS month_num,
  monthname(local_order_date) AS month_name, dayname(local_order_date) AS day_name, dayofweek(local_order_date) IN (0, 6) AS is_weekend,
  p.product_id, p.product_name, p.product_sku, p.category_name AS product_category, p.collection_name AS product_collection,
  p.gender AS product_gender, coalesce(place_country, 'Unknown') AS customer_country, coalesce(place_region, 'Unknown') AS customer_region,
  coalesce(place_city, 'Unknown') AS customer_city, coalesce(CAST(known_store AS VARCHAR), '-1') AS store_id,
  CASE WHEN known_store IS NULL THEN 'Unknown' ELSE coalesce(sc.country_name, 'INTERNATIONAL') END AS store_country,
  coalesce(version_user, '-1') AS customer_id, coalesce(version_email, 'Unknown') AS customer_email,
  coalesce(cc.currency_code, 'Unknown') AS currency_code, coalesce(cc.currency_name, 'Unknown') AS currency_name,
  product_qty AS quantity_sold, CAST(usd_unit_nano AS DOUBLE) / 1e9 AS unit_price, CAST(usd_nano AS DOUBLE) / 1e9 AS sales_amount
  FROM fact f JOIN products p ON f.product_id = p.product_id
  LEFT JOIN countries sc ON f.store_code = sc.country_code
  LEFT JOIN countries cc ON f.currency_code = cc.currency_code""")
def mart_sales(spark, folder):
    """M13, J9."""
    return pipeline.build_mart(td.sources(spark, folder))["mart_sales_report"]


def _output_sql() -> dict[str, str]:
    """The SQL of the ten outputs, without audit columns."""
    return {name: SQL[name] for name in contracts.CONTRACTS if name in SQL} | {
        "fact_snapshot_exchange_rate": SQL["fact_exchange_rate"], "fact_sales_order_detail": SQL["fact_sales"], "mart_sales_report": SQL["mart_sales"],
    }


def _checks_sql() -> str:
    """Every declared check, over the SQL of the table it concerns."""
    source = _output_sql() | {
        "countries_currencies_full": f"WITH {q.COUNTRIES} SELECT *, country_code AS country_code_iso2 FROM countries",
        "currencies_with_raw_symbol": f"WITH {q.COUNTRIES} SELECT currency_code, currency_name FROM countries",
        "exchange_rates": f"WITH {q.KNOWN_RATES} SELECT strftime(day, '%Y%m%d') AS date_key, code AS from_currency_code, 'USD' AS to_currency_code, rate AS exchange_rate FROM known_rates",
        "stg_generate_date": SQL["dim_date"], "stg_store_url_info": SQL["stg_store_url_info"],
    }
    parts = []
    for name, c in checks.CHECKS.items():
        keys = [[u] for u in c.unique] + c.combinations
        names = [f"'not_null:{x}'" for x in c.not_null] + [f"'unique:{','.join(k)}'" for k in keys]
        counts = [f"(SELECT count(*) FROM t WHERE {x} IS NULL)" for x in c.not_null]
        counts += [f"(SELECT count(*) FROM (SELECT 1 FROM t WHERE {k[0]} IS NOT NULL GROUP BY {', '.join(k)} HAVING count(*) > 1))" for k in keys]
        parts.append(f"SELECT * FROM (WITH t AS MATERIALIZED ({source[name]}) SELECT '{name}' AS table_name, unnest([{', '.join(names)}]) AS check_name, unnest([{', '.join(counts)}]) AS violations)")
    return " UNION ALL ".join(parts)


@query(_checks_sql())
def dq_models(spark, folder):
    """Q1 to Q3: the declared checks of seeds, staging and all ten outputs, counted as the tables are written."""
    report = checks.Report()
    pipeline.build_mart(td.sources(spark, folder), report=report)
    return report.to_df(spark)


def _types_sql() -> str:
    """Every declared column of the outputs with the rows that hold a value."""
    parts = []
    for name, sql in _output_sql().items():
        columns = {c: kind for c, kind in contracts.columns(name).items() if c not in AUDIT}
        rows = ", ".join(f"('{c}', '{kind}', (SELECT count({c}) FROM t))" for c, kind in columns.items())
        parts.append(f"SELECT * FROM (WITH t AS MATERIALIZED ({sql}) SELECT '{name}' AS table_name, c.* FROM (VALUES {rows}) c(column_name, actual_type, filled_rows))")
    return " UNION ALL ".join(parts)


@query(_types_sql())
def dq_types(spark, folder):
    """Q4: the columns of the ten built outputs, their types, and how many rows hold a value."""
    built = pipeline.build_mart(td.sources(spark, folder))
    parts = []
    for name in contracts.CONTRACTS:
        df = without_audit(built[name])
        counts = df.agg(*[F.count(f.name).alias(f.name) for f in df.schema])
        column = lambda f: F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("actual_type"), F.col(f.name).alias("filled_rows"))
        parts.append(counts.select(F.lit(name).alias("table_name"), F.inline(F.array(*[column(f) for f in df.schema]))))
    return functools.reduce(DataFrame.unionByName, parts)


CUTOFF = "1998-06-01"


@query(SQL["mart_sales"])
def mart_incremental(spark, folder):
    """A first load up to a day, kept in its layouts, then everything; equal to a full build."""
    src = td.sources(spark, folder)
    # both loads read checkouts and page views as a raw event log keeps them
    src = dataclasses.replace(src, events=materialize(src.events, "events"), visits=materialize(src.visits, "visits"))
    early = F.col("local_time") < CUTOFF
    first = dataclasses.replace(
        src, events=src.events.where(early), visits=src.visits.where(early),
        rates=src.rates.where(F.col("date_key") < int(CUTOFF.replace("-", ""))),
        calendar=src.calendar.where(F.col("full_date") < F.lit(CUTOFF).cast("date")),
    )
    kept = new_folder(spark, "core")
    # only what is kept outlives the first load
    with run_folder(spark):
        pipeline.write_core(pipeline.build_core(first), kept)
    return pipeline.build_mart(src, pipeline.read_core(spark, kept))["mart_sales_report"]


# -- ingestion lists -----------------------------------------------------------------


@query("""SELECT product_id, arg_min(url, (ts, event_id)) AS first_url, 'https://shop.example/id/' || product_id AS url_request FROM (
  SELECT *, CASE WHEN event_type = 'purchase' THEN 'ref/' || event_id ELSE 'cur/' || event_id END AS url,
    CASE WHEN event_type = 'view' THEN 'k' || json_extract_string(props, '$.k') ELSE 'u' || user_id END AS product_id
  FROM events WHERE event_type IN ('view', 'click', 'purchase')) GROUP BY product_id""")
def product_id_list(spark, folder):
    """P2 P3 P13 A8 F20."""
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k")
    ident = F.col("event_id").cast("string")
    events = td.table(spark, folder, "events").select(
        kind.alias("collection"),
        F.when(kind == "view", F.concat(F.lit("k"), k)).alias("product_id"),
        F.when(kind != "error", F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("viewing_product_id"),
        F.concat(F.lit("cur/"), ident).alias("current_url"),
        F.concat(F.lit("ref/"), ident).alias("referrer_url"),
        F.col("ts").alias("time_stamp"),
        F.col("event_id").alias("_id"),
    )
    return lists.product_id_list(
        events, "https://shop.example/id/", ("view", "click", "purchase"), "purchase"
    )


@query(f"""WITH {q.BUYERS}, {q.LOCATED} SELECT DISTINCT b.ip_address, country_code, country_name, region, city
  FROM buyers b JOIN located l ON b.ip_address = l.ip_address""")
def ip_location_table(spark, folder):
    """Every distinct address of the page views."""
    return lists.ip_location_table(td.visits(spark, folder), td.address_ranges(spark, folder))


_LOOKUP = f"""{q.RANGES}, found AS (
  SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN '2001:db8::' || c_custkey ELSE {q.ipv4('c_custkey * 67')} END AS ip_address,
    coalesce(country_code, 'Unknown') AS country_code, coalesce(country_name, 'Unknown') AS country_name,
    coalesce(region, 'Unknown') AS region, coalesce(city, 'Unknown') AS city
  FROM customer LEFT JOIN ranges ON c_mktsegment <> 'MACHINERY' AND c_custkey * 67 BETWEEN ip_from AND ip_to)"""


@query(f"WITH {_LOOKUP} SELECT * FROM found")
def ip_range_lookup(spark, folder):
    """J20 with addresses that are no IPv4."""
    return joins.locate_addresses(td.addresses(spark, folder), td.address_ranges(spark, folder))


@query(f"""WITH {q.RANGES} SELECT c_custkey, coalesce(country_code, 'Unknown') AS country_code, coalesce(country_name, 'Unknown') AS country_name,
    coalesce(region, 'Unknown') AS region, coalesce(city, 'Unknown') AS city FROM customer LEFT JOIN ranges
  ON c_mktsegment <> 'BUILDING' AND c_custkey * 67 BETWEEN ip_from AND ip_to AND (ip_from // 1000 % 2 = 0) = (c_mktsegment = 'MACHINERY')""")
def ip6_range_lookup(spark, folder):
    """J20 with addresses and ranges of both families, IPv6 in several spellings."""
    return joins.locate_any_addresses(td.any_addresses(spark, folder), td.any_address_ranges(spark, folder)).drop("ip_address")


@query(f"""WITH {_LOOKUP} SELECT count(*) AS total, count(*) FILTER (country_code <> 'Unknown') AS found,
  count(*) FILTER (country_code = 'Unknown') AS missed, count(*) FILTER (country_code <> 'Unknown') * 100.0::DOUBLE / count(*) AS found_pct,
  count(*) FILTER (country_code = 'Unknown') * 100.0::DOUBLE / count(*) AS missed_pct FROM found""")
def ip_hit_rate(spark, folder):
    """A9."""
    return joins.location_hit_rate(
        joins.locate_addresses(td.addresses(spark, folder), td.address_ranges(spark, folder))
    )
