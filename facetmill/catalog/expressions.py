"""Column expressions, filters and checks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, keys, money, prices, text, urls
from ..operators import distincts, joins, normalize, quality
from ..plans import testdata as td
from . import fragments as q
from .registry import query


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, price_text,
  CAST({q.price_parsed('price_text')} AS DOUBLE) AS price FROM (
  SELECT *, {q.price_written('l_extendedprice', 'l_orderkey')} AS price_text FROM lineitem)""")
def price_parse(spark, folder):
    """F1 over every order line."""
    lines = td.table(spark, folder, "lineitem").withColumn(
        "price_text", td.price_as_written(F.col("l_extendedprice"), F.col("l_orderkey"))
    )
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "price_text",
        prices.parse_price("price_text").alias("price"),
    )


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, price_text,
  CAST(CAST(l_extendedprice AS DECIMAL(18,6)) AS DOUBLE) AS price FROM (
  SELECT *, CASE WHEN l_orderkey % 2 = 0 THEN replace(format('{{:.2f}}', l_extendedprice), '.', ',')
    ELSE format('{{:,.2f}}', l_extendedprice) END AS price_text FROM lineitem)""")
def price_parse_decimal_comma(spark, folder):
    """F1 with a lone decimal comma read as decimal."""
    american = F.format_number("l_extendedprice", 2)
    written = F.when(F.col("l_orderkey") % 2 == 0, F.translate(american, ".,", ",")).otherwise(american)
    return td.table(spark, folder, "lineitem").withColumn("price_text", written).select(
        "l_orderkey", "l_linenumber", "l_partkey", "price_text",
        prices.parse_price("price_text", strict_decimal_comma=True).alias("price"),
    )


@query("""SELECT o_orderkey, raw_id, nullif(regexp_extract(raw_id, '^([0-9]+)', 1), '') AS order_id FROM (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN o_orderkey || '.0' WHEN 'F' THEN CAST(o_orderkey AS VARCHAR)
    ELSE 'N' || o_orderkey END AS raw_id FROM orders)""")
def order_id_digits(spark, folder):
    """Ids written as floats, as they are, and unusable."""
    k = F.col("o_orderkey").cast("string")
    raw = (
        F.when(F.col("o_orderstatus") == "O", F.concat(k, F.lit(".0")))
        .when(F.col("o_orderstatus") == "F", k)
        .otherwise(F.concat(F.lit("N"), k))
    )
    return td.table(spark, folder, "orders").select("o_orderkey", raw.alias("raw_id")).withColumn(
        "order_id", prices.leading_digits("raw_id")
    )


@query("""SELECT page_id, host, segment, nullif(regexp_extract(host, '\\.([a-zA-Z]+)$', 1), '') AS top_level,
  upper(right(segment, 2)) AS tail, 'https://pages.example/id/' || page_id AS address FROM (
  SELECT page_id, trim(regexp_extract(url, '^https?://([^/?#:]+)', 1), '.') AS host,
    nullif(regexp_extract(url, '^https?://([^/]+/[^/]+)', 1), '') AS segment FROM pages)""")
def url_parts(spark, folder):
    """F3, F4, F5, F20 on page addresses."""
    return (
        td.table(spark, folder, "pages")
        .select(
            "page_id",
            urls.url_host("url").alias("host"),
            urls.host_and_first_segment("url").alias("segment"),
        )
        .select(
            "*",
            urls.top_level_domain("host").alias("top_level"),
            F.upper(F.right("segment", F.lit(2))).alias("tail"),
            urls.page_address("https://pages.example/id/", F.col("page_id").cast("string")).alias("address"),
        )
    )


@query("""SELECT page_id, url FROM pages WHERE url IS NOT NULL AND trim(url) <> ''
  AND (url LIKE '%www.%' OR url LIKE '%blog.%')
  AND url NOT LIKE '%google%' AND url NOT LIKE '%dev%' AND url NOT LIKE '%web%' AND url NOT LIKE '%chase%'
  AND url NOT LIKE '%trans%' AND url NOT LIKE '%test%' AND url NOT LIKE '%click%'""")
def url_pattern_filter(spark, folder):
    """P4, P5, P6."""
    rules = urls.StoreUrlRules()
    return (
        normalize.non_blank(td.table(spark, folder, "pages"), "url")
        .where(text.like_any("url", ["%www.%", "%blog.%"]) & text.not_like_all("url", rules.excluded))
        .select("page_id", "url")
    )


@query("""SELECT p_partkey, CASE WHEN p_size < 10 THEN NULL ELSE p_type END AS kind,
  coalesce(CASE WHEN p_size >= 10 THEN p_type END, 'Unknown') AS kind_or_unknown,
  CASE WHEN p_brand = 'Brand#1' THEN 'Unknown' ELSE p_brand END AS brand,
  CASE WHEN p_size < 10 THEN '-1' ELSE CAST(p_size AS VARCHAR) END AS size_id,
  CASE WHEN p_size < 10 THEN 'Unknown' ELSE p_name END AS size_name, p_name AS bare_name FROM part""")
def default_values(spark, folder):
    """Blanks, sentinels, parameterised CASE, quotes around text."""
    blank = F.when(F.col("p_size") < 10, "  ").otherwise(F.col("p_type"))
    dashed = F.when(F.col("p_brand") == "Brand#1", "-").otherwise(F.col("p_brand"))
    ident = F.when(F.col("p_size") < 10, "0").otherwise(F.col("p_size").cast("string"))
    quoted = F.concat(F.lit("'"), F.col("p_name"), F.lit("'"))
    return td.table(spark, folder, "part").select(
        "p_partkey",
        text.blank_to_null(blank).alias("kind"),
        text.default(text.blank_to_null(blank), "Unknown").alias("kind_or_unknown"),
        text.sentinel_to_default(dashed).alias("brand"),
        text.value_if(text.missing_id(ident), F.lit("-1"), ident).alias("size_id"),
        text.value_if(text.missing_id(ident), F.lit("Unknown"), F.col("p_name")).alias("size_name"),
        text.strip_char(quoted, "'").alias("bare_name"),
    )


@query("""SELECT event_id, user_id FROM events WHERE event_type IN ('view', 'click', 'purchase')""")
def event_type_filter(spark, folder):
    """P1, P2."""
    return normalize.with_event_types(
        td.table(spark, folder, "events"), ["view", "click", "purchase"], "event_type"
    ).select("event_id", "user_id")


@query(f"""SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS day_key,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, {q.ts('o_orderdate')} AS local_datetime,
  CAST(epoch(o_orderdate) AS BIGINT) AS epoch_seconds, CAST(CAST(o_orderdate AS DATE) - 7 AS VARCHAR) AS floor_day,
  year(o_orderdate) AS year_num, CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN TRUE ELSE FALSE END AS is_weekend,
  dayofweek(o_orderdate) + 1 AS day_of_week, dayname(o_orderdate) AS full_day_name,
  'Quarter ' || quarter(o_orderdate) AS quarter_name FROM orders""")
def date_parts(spark, folder):
    """F11 to F15, F19."""
    written = td.table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").cast("string").alias("written")
    )
    local = dates.local_datetime("written")
    day = dates.date_from_key("day_key")
    attributes = {c: F.col(f"attr.{c}") for c in ("year_num", "is_weekend", "day_of_week", "full_day_name", "quarter_name")}
    seconds = F.datediff(F.to_date(local), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
    return (
        written.select("o_orderkey", local.alias("local_datetime"), dates.date_key(local).alias("day_key"), seconds.alias("seconds"))
        .withColumn("day", day)
        .withColumn("epoch_seconds", F.unix_seconds(dates.utc_from_epoch("seconds")))
        .withColumn("floor_day", dates.lookback("day"))
        .withColumn("attr", F.struct(*dates.calendar_attributes("day")))
        .withColumns(attributes)
        .drop("attr", "seconds")
    )


@query(f"""SELECT c_custkey, {q.key('c_name')} AS name_key, {q.key('c_nationkey', 'c_mktsegment')} AS pair_key,
  CAST(NULL AS BIGINT) AS null_key,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN -1 ELSE {q.key('c_mktsegment')} END AS member_key FROM customer""")
def surrogate_keys(spark, folder):
    """F8, F9, F10."""
    segment = F.when(F.col("c_mktsegment") == "MACHINERY", "Unknown").otherwise(F.col("c_mktsegment"))
    return td.table(spark, folder, "customer").select(
        "c_custkey",
        keys.surrogate_key("c_name").alias("name_key"),
        keys.surrogate_key("c_nationkey", "c_mktsegment").alias("pair_key"),
        keys.surrogate_key("c_name", F.lit(None)).alias("null_key"),
        keys.unknown_if_all(keys.surrogate_key(segment), segment).alias("member_key"),
    )


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, CAST(qty * price AS DOUBLE) AS amount,
  CAST({q.usd_nano('qty * price', 'rate')} AS DOUBLE) / 1e9 AS dollars FROM (
  SELECT *, CAST(l_quantity AS BIGINT) AS qty, CAST(l_extendedprice AS DECIMAL(18,6)) AS price,
    CAST(o_totalprice AS DECIMAL(18,2)) AS rate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""")
def exact_amounts(spark, folder):
    """F16 on every line, the order total standing for the rate."""
    lines, orders = td.table(spark, folder, "lineitem"), td.table(spark, folder, "orders")
    amount = money.times("l_quantity", "l_extendedprice")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", amount.alias("amount"),
        money.in_dollars(amount, F.col("o_totalprice").cast("decimal(18,2)")).alias("dollars"),
    )


@query("""SELECT c_custkey, c_nationkey + 60 AS store, CASE WHEN c_nationkey = 8 THEN 'USD'
  WHEN c_mktsegment = 'MACHINERY' THEN 'EUR' ELSE substr(c_mktsegment, 1, 3) END AS code FROM customer""")
def currency_override(spark, folder):
    """F17."""
    listed = F.when(F.col("c_mktsegment") == "MACHINERY", "LTL").otherwise(F.substring("c_mktsegment", 1, 3))
    return td.table(spark, folder, "customer").select(
        "c_custkey",
        (F.col("c_nationkey") + 60).alias("store"),
        money.sale_currency((F.col("c_nationkey") + 60).cast("string"), listed).alias("code"),
    )


@query("""SELECT c_custkey, CASE WHEN c_nationkey = 5 THEN 'NA' WHEN c_nationkey % 2 = 0 THEN NULL
  ELSE 'N' || c_nationkey END AS code FROM customer""")
def country_code_repair(spark, folder):
    """a NULL code is repaired beside one country name only."""
    name = F.when(F.col("c_nationkey") == 5, "Namibia").otherwise("Elsewhere")
    code = F.when(
        (F.col("c_nationkey") % 2 == 1) & (F.col("c_nationkey") != 5),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")),
    )
    return td.table(spark, folder, "customer").select(
        "c_custkey", text.country_code_repair(code, name).alias("code")
    )


@query("""SELECT DISTINCT o_orderstatus, o_orderpriority, year(o_orderdate) AS order_year FROM orders""")
def distinct_rows(spark, folder):
    """A6."""
    orders = td.table(spark, folder, "orders").withColumn("order_year", F.year("o_orderdate"))
    return distincts.distinct_rows(orders, "o_orderstatus", "o_orderpriority", "order_year")


@query("""SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('7|' || o_orderkey), o_orderkey LIMIT 1000""")
def random_sample(spark, folder):
    """A sample of 1,000 rows, the same on every run."""
    orders = td.table(spark, folder, "orders")
    return distincts.sample_rows(orders, 1000, ["o_orderkey"], seed=7).select("o_orderkey", "o_custkey")


@query("""SELECT DISTINCT user_id FROM events WHERE event_type <> 'purchase' AND user_id NOT IN
  (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 20) ORDER BY user_id""")
def resume_targets(spark, folder):
    """Viewers and failures without those finished, sorted."""
    events = td.table(spark, folder, "events")

    def users(condition):
        return events.where(condition).select("user_id")

    kind = F.col("event_type")
    return joins.resume_targets(
        users(kind.isin("view", "click")),
        users((kind == "signup") & (F.col("value") > 20)),
        users(kind.isin("error", "signup")),
        "user_id",
    ).orderBy("user_id")


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, p_name, p_brand FROM
  (SELECT *, CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_linestatus = 'F' THEN NULL ELSE l_partkey END AS k FROM lineitem)
  LEFT JOIN part ON k = p_partkey""")
def spread_lookup(spark, folder):
    """J4, J6, J7 at their worst: a third of the lines on one key, others on none."""
    hot = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_linestatus") == "F", None).otherwise(F.col("l_partkey"))
    lines = td.table(spark, folder, "lineitem").withColumn("p_partkey", hot)
    parts = td.table(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    return joins.lookup_join(
        lines, parts, ["p_partkey"], ["l_orderkey", "l_linenumber"], max_bytes=0, hot_rows=1000, counted=lines
    ).select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "p_name", "p_brand")


@query("""SELECT 'l_discount' AS column_name, count(*) FILTER (l_discount IS NULL) AS null_rows FROM lineitem
  UNION ALL SELECT 'returned_on', count(*) FILTER (l_returnflag <> 'R') FROM lineitem""")
def dq_not_null(spark, folder):
    """Q1: all columns in one pass."""
    lines = td.table(spark, folder, "lineitem").withColumn(
        "returned_on", F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))
    )
    return quality.null_counts(lines, ["l_discount", "returned_on"])


@query("""SELECT o_orderkey, CAST(o_orderpriority AS VARCHAR) AS priority FROM orders WHERE o_orderstatus = 'P'""")
def dq_null_rows(spark, folder):
    """Q1: the offending rows."""
    orders = td.table(spark, folder, "orders").withColumn(
        "closed", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    )
    return quality.not_null(orders, "closed", "o_orderkey").select(
        "o_orderkey", F.col("o_orderpriority").alias("priority")
    )


@query("""SELECT o_custkey, count(*) AS n_rows FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def dq_unique(spark, folder):
    """Q2."""
    return quality.duplicates(td.table(spark, folder, "orders"), "o_custkey")


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def dq_unique_combination(spark, folder):
    """Q3."""
    return quality.duplicates(td.table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@query("""SELECT check_name, violations FROM (
  SELECT 'not_null:l_orderkey' AS check_name, count(*) FILTER (l_orderkey IS NULL) AS violations FROM lineitem
  UNION ALL SELECT 'not_null:l_quantity', count(*) FILTER (l_quantity IS NULL) FROM lineitem
  UNION ALL SELECT 'unique:l_orderkey', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'unique:l_orderkey,l_partkey,l_suppkey', count(*) FROM
    (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey HAVING count(*) > 1))""")
def dq_report(spark, folder):
    """Q1 to Q3 as one report with violation counts."""
    return quality.run_checks(
        td.table(spark, folder, "lineitem"),
        ["l_orderkey", "l_quantity"],
        ["l_orderkey"],
        [["l_orderkey", "l_partkey", "l_suppkey"]],
    )
