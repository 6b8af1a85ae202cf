"""SQL pieces shared by the reference queries (DuckDB dialect)."""

from __future__ import annotations

TIME = "'%Y-%m-%d %H:%M:%S.%f'"


def ts(expr: str) -> str:
    return f"strftime({expr}, {TIME})"


def key(*parts: str) -> str:
    joined = " || chr(31) || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5({joined}), 1, 15)) AS BIGINT)"


def country(nation: str) -> str:
    return f"(chr(CAST(65 + {nation} // 5 AS INT)) || chr(CAST(65 + {nation} % 5 AS INT)))"


def currency(nation: str) -> str:
    return (
        f"(CASE {nation} WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 3 THEN 'LTL' "
        f"ELSE 'C' || lpad(CAST({nation} AS VARCHAR), 2, '0') END)"
    )


def ipv4(n: str) -> str:
    return f"(({n}) >> 24) || '.' || ((({n}) >> 16) & 255) || '.' || ((({n}) >> 8) & 255) || '.' || (({n}) & 255)"


def price_written(value: str, k: str) -> str:
    us = f"format('{{:,.2f}}', {value})"
    return (
        f"(CASE {k} % 4 WHEN 0 THEN translate({us}, ',.', '.,') WHEN 1 THEN {us} "
        f"WHEN 2 THEN replace({us}, ',', '''') ELSE replace({us}, ',', '') END)"
    )


def price_parsed(p: str) -> str:
    return f"""TRY_CAST(CASE
      WHEN regexp_matches({p}, '\\..*,') THEN replace(replace({p}, '.', ''), ',', '.')
      WHEN regexp_matches({p}, ',.*\\.') THEN replace({p}, ',', '')
      WHEN regexp_matches({p}, '''.*\\.') THEN replace({p}, '''', '')
      WHEN regexp_matches({p}, '[^0-9]00$') THEN regexp_replace({p}, '[^0-9]00$', '')
      WHEN {p} = '' THEN NULL
      ELSE replace({p}, ',', '') END AS DECIMAL(18,6))"""


def usd_nano(amount: str, rate: str) -> str:
    """Amount / rate in units of 1e-9, half up, at first with fifteen decimals.

    ``amount`` has six decimals at most, ``rate`` is DECIMAL(18,2). Integers only,
    as DuckDB divides decimals in floating point.
    """
    a = f"CAST(({amount}) * 1000000 AS HUGEINT) * 1000000000000000000"
    r = f"(CAST(({rate}) * 100 AS HUGEINT) * 10000000)"
    return f"((({a} * 2 + {r}) // (2 * {r})) + 500000) // 1000000"


BUYERS = f"""
buyers AS (
  SELECT o_orderkey, o_orderpriority, c_nationkey AS nation,
    CAST(o_custkey AS VARCHAR) AS user_id_db,
    CASE WHEN o_orderstatus = 'P' THEN NULL
      ELSE 'c' || o_custkey || '.' || substr(o_orderpriority, 1, 1) || '@mail.example' END AS email_address,
    CAST(o_orderdate AS TIMESTAMP) + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS local_datetime,
    CAST(o_orderdate AS TIMESTAMP) + to_seconds(CAST(o_orderkey % 86400 - 3600 AS BIGINT)) AS utc,
    CAST(c_nationkey + 60 AS VARCHAR) AS store_id,
    {ipv4('o_custkey * 67')} AS ip_address
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

LINES = f"""{BUYERS},
lines AS (
  SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS order_id, local_datetime,
    CAST(local_datetime AS DATE) AS local_order_date,
    CAST(strftime(local_datetime, '%Y%m%d') AS BIGINT) AS order_date_key,
    store_id, ip_address, user_id_db, email_address,
    CAST(l_partkey AS VARCHAR) AS product_id, {currency('nation')} AS currency,
    CAST(l_quantity AS BIGINT) AS quantity,
    {price_parsed(price_written('l_extendedprice', 'l_orderkey'))} AS unit_price
  FROM lineitem JOIN buyers ON l_orderkey = o_orderkey)"""

SALES = f"""{LINES},
sales AS (
  SELECT * EXCLUDE (quantity), unnest([(quantity + 1) // 2, quantity - (quantity + 1) // 2]) AS product_qty
  FROM lines)"""

FOLDED = f"""{SALES},
folded AS (
  SELECT order_id, local_datetime, local_order_date, order_date_key, store_id, ip_address, user_id_db,
    email_address, product_id, currency, unit_price, CAST(sum(product_qty) AS BIGINT) AS product_qty
  FROM sales GROUP BY ALL)"""

COUNTRIES = f"""
countries AS (
  SELECT {country('n_nationkey')} AS country_code, n_name AS country_name,
    {currency('n_nationkey')} AS currency_code, n_name || ' money' AS currency_name,
    CAST(n_nationkey AS VARCHAR) AS phone_code, r_name AS country_group, n_nationkey
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

KNOWN_RATES = f"""
known_rates AS (
  SELECT {currency('c_nationkey')} AS code, CAST(o_orderdate AS DATE) AS day,
    CAST(max(o_totalprice) AS DECIMAL(18,2)) AS rate
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""

CALENDAR = """
calendar AS (
  SELECT CAST(unnest(generate_series((SELECT min(CAST(o_orderdate AS DATE)) FROM orders),
    (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY)) AS DATE) AS day)"""

# The empty grid of days and currencies, filled forward: the long way round.
DENSE_RATES = f"""{KNOWN_RATES}, {CALENDAR},
grid AS (
  SELECT day, code, rate FROM calendar CROSS JOIN (SELECT DISTINCT code FROM known_rates)
  LEFT JOIN known_rates USING (day, code)),
dense AS (
  SELECT * FROM (
    SELECT day, code, CAST(strftime(day, '%Y%m%d') AS BIGINT) AS date_key,
      last_value(rate IGNORE NULLS) OVER (PARTITION BY code ORDER BY day
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rate
    FROM grid) WHERE rate IS NOT NULL)"""

STORES = f"""{COUNTRIES},
store_pages AS (
  SELECT DISTINCT CAST(store_id AS BIGINT) AS store_id,
    CASE WHEN nation % 5 = 0 THEN 'shop.local/st' || lower({country('nation')})
      WHEN nation = 7 THEN 'www.shop.co.uk' ELSE 'www.shop.' || lower({country('nation')}) END AS address
  FROM buyers WHERE o_orderpriority <> '1-URGENT'),
stores AS (
  SELECT store_id, code AS country_code, coalesce(country_name, 'INTERNATIONAL') AS country_name, currency_code
  FROM (SELECT store_id, upper(right(address, 2)) AS code FROM store_pages)
  LEFT JOIN countries ON country_code = code)"""

RANGES = f"""
ranges AS (
  SELECT s_suppkey * 1000 AS ip_from, s_suppkey * 1000 + 899 AS ip_to,
    {country('n_nationkey')} AS country_code, n_name AS country_name, r_name AS region, s_name AS city
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

LOCATED = f"""{RANGES},
located AS (
  SELECT {ipv4('c_custkey * 67')} AS ip_address,
    coalesce(country_code, 'Unknown') AS country_code, coalesce(country_name, 'Unknown') AS country_name,
    coalesce(region, 'Unknown') AS region, coalesce(city, 'Unknown') AS city
  FROM customer LEFT JOIN ranges ON c_custkey * 67 BETWEEN ip_from AND ip_to),
ip_map AS (
  SELECT ip_address, CASE WHEN country_code = 'Unknown' AND region = 'Unknown' AND city = 'Unknown' THEN -1
      ELSE {key('country_code', 'region', 'city')} END AS location_key,
    country_code, country_name, region, city
  FROM located)"""


def intervals(source: str) -> str:
    """Runs of equal state by plain windows. ``source`` has columns k, s, t, utc."""
    order = "PARTITION BY k ORDER BY t, utc, s NULLS FIRST"
    return f"""
seen AS ({source}),
filled AS (SELECT *, coalesce(last_value(s IGNORE NULLS) OVER ({order}
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'Unspecified') AS state FROM seen),
flagged AS (SELECT *, CASE WHEN state <> lag(state) OVER ({order}) THEN 1 ELSE 0 END AS flag FROM filled),
grouped AS (SELECT *, sum(flag) OVER (PARTITION BY k ORDER BY t) AS grp FROM flagged),
runs AS (
  SELECT k, nullif(state, 'Unspecified') AS s, CAST(grp AS BIGINT) AS grp, min(t) AS start_at, min(utc) AS start_utc
  FROM grouped GROUP BY k, state, grp),
versions AS (
  SELECT k, s, grp, start_at, start_utc, next_at IS NULL AS is_current,
    coalesce(next_at, TIMESTAMP '9999-12-31 00:00:00') AS end_at,
    {key('k', 'start_at', "coalesce(s, '')")} AS version_key
  FROM (SELECT *, lead(start_at) OVER (PARTITION BY k ORDER BY start_at, start_utc, grp, coalesce(s, '')) AS next_at
        FROM runs))"""


BROWSING = """SELECT CAST(user_id AS VARCHAR) AS k,
  CASE WHEN event_type NOT IN ('signup', 'error') THEN event_type END AS s, ts AS t, ts AS utc FROM events"""
BUYING = "SELECT user_id_db AS k, email_address AS s, local_datetime AS t, utc FROM buyers"

PRODUCTS = """
crawled AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, 'SKU-' || p_partkey AS product_sku,
    CAST(p_size AS VARCHAR) AS attribute_set_id, p_type AS attribute_set_name, 'simple' AS packaging_type,
    p_retailprice AS vnd_unit_price, p_retailprice AS vnd_min_price,
    CASE WHEN p_size > 40 THEN NULL ELSE p_retailprice END AS vnd_max_price,
    CASE WHEN p_size < 10 THEN '0' ELSE CAST(p_size AS VARCHAR) END AS collection_id, p_brand AS collection_name,
    CAST(NULL AS VARCHAR) AS product_type_id, p_type AS product_type_name, p_type AS category_id,
    p_type AS category_name,
    CASE p_size % 3 WHEN 0 THEN 'false' WHEN 1 THEN 'women' END AS gender
  FROM part),
products AS (
  SELECT coalesce(c.product_id, s.product_id) AS product_id, coalesce(product_name, 'Unknown') AS product_name,
    coalesce(product_sku, 'Unknown') AS product_sku, coalesce(attribute_set_id, '-1') AS attribute_set_id,
    coalesce(attribute_set_name, 'Unknown') AS attribute_set_name, coalesce(packaging_type, 'Unknown') AS packaging_type,
    coalesce(vnd_unit_price, 0) AS vnd_unit_price, coalesce(vnd_min_price, 0) AS vnd_min_price,
    coalesce(vnd_max_price, 0) AS vnd_max_price,
    CASE WHEN coalesce(collection_id, '0') IN ('0', '-1') THEN '-1' ELSE collection_id END AS collection_id,
    CASE WHEN coalesce(collection_id, '0') IN ('0', '-1') THEN 'Unknown' ELSE coalesce(collection_name, 'Unknown') END AS collection_name,
    '-1' AS product_type_id, 'Unknown' AS product_type_name,
    coalesce(category_id, '-1') AS category_id, coalesce(category_name, 'Unknown') AS category_name,
    CASE WHEN gender = 'false' THEN 'Uncategorized' ELSE coalesce(gender, 'Unknown') END AS gender
  FROM crawled c FULL JOIN (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS product_id FROM lineitem) s
    ON c.product_id = s.product_id)"""

CONVERTED = f"""{FOLDED}, {STORES}, {DENSE_RATES},
priced AS (
  SELECT f.*, coalesce(f.unit_price, 0) AS local_unit_price, s.store_id AS known_store, s.country_code AS store_code,
    CASE WHEN f.store_id = '68' THEN 'USD' WHEN s.currency_code = 'LTL' THEN 'EUR' ELSE s.currency_code END AS currency_code
  FROM folded f LEFT JOIN stores s ON f.store_id = CAST(s.store_id AS VARCHAR)),
converted AS (
  SELECT p.*, d.rate, {usd_nano('local_unit_price', 'd.rate')} AS usd_unit_nano,
    product_qty * local_unit_price AS local_amount,
    {usd_nano('product_qty * local_unit_price', 'd.rate')} AS usd_nano
  FROM priced p LEFT JOIN dense d ON p.order_date_key = d.date_key AND p.currency_code = d.code)"""

LINE_KEY = key(
    *[
        f"coalesce(CAST(c.{c} AS VARCHAR), '')"
        for c in (
            "order_id", "local_datetime", "local_order_date", "order_date_key", "store_id", "ip_address",
            "user_id_db", "email_address", "product_id", "currency", "unit_price",
        )
    ]
)

FACT = f"""{CONVERTED}, {intervals(BUYING)}, {LOCATED}, {PRODUCTS},
fact AS (
  SELECT {LINE_KEY} AS sales_key, c.*, coalesce(v.version_key, -1) AS scd_customer_key, v.s AS version_email, v.k AS version_user,
    {key('c.user_id_db')} AS customer_key, coalesce(m.location_key, -1) AS location_key,
    CASE WHEN known_store IS NULL THEN -1 ELSE {key('c.store_id')} END AS store_key,
    {key('c.product_id')} AS product_key,
    CASE WHEN c.currency_code IS NULL THEN -1 ELSE {key('c.currency_code')} END AS currency_key,
    m.country_code AS place_code, m.country_name AS place_country, m.region AS place_region, m.city AS place_city
  FROM converted c
  LEFT JOIN versions v ON c.user_id_db = v.k AND c.local_datetime >= v.start_at AND c.local_datetime < v.end_at
  LEFT JOIN ip_map m ON c.ip_address = m.ip_address)"""
