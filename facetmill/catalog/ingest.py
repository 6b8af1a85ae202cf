"""Sources, sinks and normalisers. Files go to the session's shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from .. import schemas
from ..operators import normalize
from ..plans import lists
from ..plans import testdata as td
from ..session import new_folder
from ..sources import readers, writers
from . import fragments as q
from .registry import query


@query(f"""WITH {q.BUYERS} SELECT CAST(l_orderkey AS VARCHAR) || CASE WHEN l_orderkey % 2 = 0 THEN '.0' ELSE '' END AS order_id,
  user_id_db, time_stamp, CAST(len(copies) AS BIGINT) AS items, CAST(l_quantity AS BIGINT) AS quantity,
  {q.price_written('l_extendedprice', 'l_orderkey')} AS price
  FROM (SELECT *, CAST(epoch(utc) AS BIGINT) AS time_stamp, [1, 2] AS copies,
    unnest(CASE WHEN l_orderkey % 10 = 0 THEN [1, 2] ELSE [1] END) AS copy FROM lineitem JOIN buyers ON l_orderkey = o_orderkey)""")
def event_log_json(spark, folder):
    """Checkouts written as newline JSON and read with the declared schema."""
    path = new_folder(spark, "events-json")
    writers.write_json_lines(td.checkouts(spark, folder), path, compression="gzip")
    events = readers.read_events(spark, path, glob="*.json.gz")
    cart = F.col("cart_products")
    return events.select(
        "order_id", "user_id_db", "time_stamp",
        F.size(cart).alias("items"),
        F.aggregate(cart, F.lit(0).cast("bigint"), lambda acc, i: acc + i["amount"]).alias("quantity"),
        cart[0]["price"].alias("price"),
    )


@query("""SELECT ' ' || p_partkey AS product_id, p_name AS name, p_retailprice AS price,
  CASE WHEN p_size > 40 THEN NULL ELSE p_retailprice END AS max_price, CAST(NULL AS BIGINT) AS qty FROM part""")
def product_json(spark, folder):
    """S2."""
    path = new_folder(spark, "products-json")
    writers.write_json_lines(td.products(spark, folder), path)
    return readers.read_products(spark, path, glob="*.json").select(
        "product_id", "name", "price", "max_price", "qty"
    )


@query(f"""WITH {q.LOCATED} SELECT ip_address, CASE WHEN country_code = 'AA' THEN 'NA' ELSE country_code END AS country_code,
  country_name || ', "here"' AS country_name, region, city FROM located""")
def ip_location_csv(spark, folder):
    """The text NA survives, a helper column is dropped, quotes and commas are kept."""
    path = new_folder(spark, "ip-csv")
    rows = (
        td.ip_locations(spark, folder)
        .withColumn("country_code", F.when(F.col("country_code") == "AA", "NA").otherwise(F.col("country_code")))
        .withColumn("country_name", F.concat("country_name", F.lit(', "here"')))
        .withColumn("Mapped", F.lit(True))
    )
    writers.write_csv(rows, path)
    return readers.read_ip_locations(spark, path)


@query("""SELECT CAST(c_custkey AS VARCHAR) AS currency_code, c_name AS currency_name,
  CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS raw_symbol FROM customer""")
def seed_csv(spark, folder):
    """S4."""
    path = new_folder(spark, "seed-csv")
    rows = td.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("currency_code"),
        F.col("c_name").alias("currency_name"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("raw_symbol"),
    )
    writers.write_csv(rows, path)
    return readers.read_seed(spark, path, schemas.CURRENCIES)


@query("""SELECT o_orderstatus, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_orders FROM
  (SELECT * FROM orders UNION ALL SELECT * FROM orders) GROUP BY 1""")
def append_and_replace(spark, folder):
    """Replace the table, then append the same load once."""
    path = new_folder(spark, "appended")
    orders = td.table(spark, folder, "orders")
    writers.append_table(td.table(spark, folder, "orders"), path)
    writers.replace_table(orders, path)
    writers.append_table(orders, path)
    return spark.read.schema(orders.schema).parquet(path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_orderkey").alias("n_orders")
    )


@query("""SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, '2024-02-01' AS load_date FROM events""")
def dated_snapshot(spark, folder):
    """All columns as text, snappy Parquet below a dated folder."""
    path = new_folder(spark, "snapshot")
    events = normalize.stringify(td.table(spark, folder, "events"))
    writers.write_snapshot(events, path, "2024-02-01")
    return spark.read.parquet(path).select(F.col("event_id").cast("bigint"), "user_id", "load_date")


@query("""SELECT o_orderkey, o_custkey, CAST(CAST(date_trunc('year', o_orderdate) AS DATE) AS VARCHAR) AS order_year FROM orders
  WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1999-01-01'""")
def partitioned_table(spark, folder):
    """A date-partitioned table, read through partition pruning."""
    path = new_folder(spark, "partitioned")
    orders = td.table(spark, folder, "orders").withColumn(
        "order_year", F.trunc(F.to_date("o_orderdate"), "year")
    )
    writers.write_partitioned(orders, path, "order_year", ["o_orderkey"])
    return (
        spark.read.schema(orders.schema)
        .parquet(path)
        .where("order_year >= date'1997-01-01' and order_year < date'1999-01-01'")
        .select("o_orderkey", "o_custkey", "order_year")
    )


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n_rows, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem
  WHERE l_shipdate >= DATE '1998-01-01' GROUP BY ALL""")
def clustered_table(spark, folder):
    """Rows laid out by date, so that a date filter skips row groups."""
    path = new_folder(spark, "clustered")
    lines = td.table(spark, folder, "lineitem")
    writers.write_clustered(lines, path, ["l_shipdate", "l_orderkey"])
    return (
        spark.read.schema(lines.schema)
        .parquet(path)
        .where("l_shipdate >= timestamp_ntz'1998-01-01 00:00:00'")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").cast("bigint").alias("quantity"))
    )


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 0 END AS n_options,
  CASE WHEN event_type = 'click' THEN json_extract_string(props, '$.k') END AS alloy,
  CASE WHEN event_type = 'view' THEN json_extract_string(props, '$.k') END AS second_label,
  CASE WHEN event_type = 'click' THEN json_extract_string(props, '$.k') END AS object_alloy,
  CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 2 END AS list_size FROM events""")
def normalize_option(spark, folder):
    """Object, array, quoted text, NULL and number."""
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    raw = (
        F.when(kind == "click", F.concat(F.lit('{"alloy": "'), k, F.lit('", "other": 1}')))
        .when(kind == "view", F.concat(F.lit('[{"option_label": "a"}, {"option_label": "'), k, F.lit('"}]')))
        .when(kind == "purchase", F.lit('""'))
        .when(kind == "signup", k)
    )
    shaped = normalize.normalize_option(
        td.table(spark, folder, "events").select("event_id", raw.alias("option"))
    )
    return shaped.select(
        "event_id",
        F.size("option").alias("n_options"),
        F.get("option", F.lit(0))["alloy"].alias("alloy"),
        F.get("option", F.lit(1))["option_label"].alias("second_label"),
        F.col("option_object.alloy").alias("object_alloy"),
        F.when(F.col("option_list").isNotNull(), F.size("option_list")).alias("list_size"),
    )


@query("""SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN 0 ELSE 1 END AS items,
  CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS amount,
  CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN NULL WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS options,
  CASE WHEN l_returnflag = 'A' THEN CAST(l_suppkey AS VARCHAR) END AS label FROM lineitem""")
def normalize_cart(spark, folder):
    """Carts that are arrays or text; item options as object, text or missing."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    option = (
        F.when(flag == "A", F.concat(F.lit(', "option": {"option_label": "'), F.col("l_suppkey").cast("string"), F.lit('"}')))
        .when(flag == "N", F.lit(', "option": ""'))
        .otherwise(F.lit(""))
    )
    amount = F.col("l_quantity").cast("bigint").cast("string")
    cart = F.when((status == "F") & (flag == "R"), F.lit('"none"')).otherwise(
        F.concat(
            F.lit('[{"product_id": "p", "amount": '),
            F.when(status == "F", F.concat(F.lit('"'), amount, F.lit('"'))).otherwise(amount),
            F.lit(', "price": "1,00"'), option, F.lit("}]"),
        )
    )
    shaped = normalize.normalize_cart(
        td.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", cart.alias("cart_products"))
    )
    item = F.get("cart_products", F.lit(0))
    return shaped.select(
        "l_orderkey", "l_partkey", "l_suppkey",
        F.size("cart_products").alias("items"),
        item["amount"].alias("amount"),
        F.when(item.isNotNull(), F.size(item["option"])).alias("options"),
        F.get(item["option"], F.lit(0))["option_label"].alias("label"),
    )


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  '{"s":"' || o_orderstatus || '","n":' || o_custkey || '}' AS nested,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority FROM orders""")
def stringify_rows(spark, folder):
    """N3, N4."""
    return normalize.stringify(
        td.table(spark, folder, "orders").select(
            "o_orderkey", "o_custkey",
            F.struct(F.col("o_orderstatus").alias("s"), F.col("o_custkey").alias("n")).alias("nested"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"),
        )
    )


@query("""SELECT 'OBJECT<' || string_agg(name || ': BIGINT', ', ' ORDER BY name) || '>' AS document_schema FROM
  (SELECT DISTINCT unnest(json_keys(props)) AS name FROM events)""")
def discover_schema(spark, folder):
    """N5 over every event's properties."""
    return normalize.discover_schema(td.table(spark, folder, "events"), "props")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_retailprice AS price FROM part
  WHERE p_type NOT IN ('ECONOMY', 'SMALL')""")
def unwrap_envelope(spark, folder):
    """Lines of one product type are cut short, those of another have no payload."""
    part = td.table(spark, folder, "part")
    payload = F.to_json(
        F.struct(
            F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("name"),
            F.col("p_retailprice").alias("price"), F.col("p_brand").alias("not_listed"),
        )
    )
    kind = F.col("p_type")
    line = (
        F.when(kind == "ECONOMY", F.concat(F.lit('{"data": '), payload, F.lit(', "crawled_at": ')))
        .when(kind == "SMALL", F.lit('{"product_id": 1, "crawled_at": "now"}'))
        .otherwise(F.concat(F.lit('{"data": '), payload, F.lit(', "crawled_at": "now"}')))
    )
    return normalize.unwrap_envelope(part.select(line.alias("line")), "line", schemas.PRODUCTS).select(
        "product_id", "name", "price"
    )


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_whitelist(spark, folder):
    """Only the declared key is kept of an open object."""
    wide = F.concat(F.expr("rtrim('}', props)"), F.lit(', "extra": {"a": [1, 2]}, "k2": 5}'))
    listed = T.StructType([T.StructField("k", T.LongType())])
    return td.table(spark, folder, "events").select(
        "event_id", normalize.keep_keys(wide, listed).alias("kept")
    ).select("event_id", "kept.*")


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'SUCCESS' WHEN 1 THEN 'MISSING_SCRIPT_TAG'
  WHEN 2 THEN 'MISSING_JSON_MATCH' ELSE 'JSON_DECODE_ERROR' END AS status,
  CASE WHEN page_id % 4 = 0 THEN CAST(page_id AS VARCHAR) END AS product_id,
  CASE WHEN page_id % 4 = 0 THEN url END AS name FROM pages""")
def html_payload_status(spark, folder):
    """N8 on whole pages, to which a payload script of one of four kinds is added."""
    ident = F.col("page_id").cast("string")
    payload = F.to_json(F.struct(ident.alias("product_id"), F.col("url").alias("name"), F.lit(1).alias("other")))
    kind = F.pmod("page_id", F.lit(4))
    script = (
        F.when(kind == 0, F.concat(F.lit("<script>\nwindow.react_data = "), payload, F.lit(";\n</script>")))
        .when(kind == 1, F.concat(F.lit("<p>react_data = "), payload, F.lit(";</p>")))
        .when(kind == 2, F.lit("<SCRIPT type='x'>var react_data = {};</SCRIPT>"))
        .otherwise(F.lit('<script>react_data : {"product_id": };</script>'))
    )
    pages = td.table(spark, folder, "pages").select(
        "page_id", "url", F.concat("html", script).alias("html")
    )
    return normalize.embedded_payload(pages, "html").select(
        "page_id", "status", "payload.product_id", "payload.name"
    )


@query("""SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key, 'P' || substr(o_orderpriority, 1, 1) AS from_currency_code,
  'USD' AS to_currency_code, o_totalprice AS exchange_rate FROM orders WHERE o_orderstatus <> 'F'
  ORDER BY 2, 1""")
def fx_payload_rows(spark, folder):
    """Per order a payload with one good and three unusable entries."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    rate = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    payload = F.concat(
        F.lit('{"rates": [{"date": "'), day, F.lit('", "rate": '),
        F.when(F.col("o_orderstatus") == "F", "null").otherwise(rate),
        F.lit('}, {"rate": 1}, {"date": "2019-13-01", "rate": 2}, {"date": "'), day, F.lit('"}]}'),
    )
    code = F.concat(F.lit("p"), F.substring("o_orderpriority", 1, 1))
    payloads = td.table(spark, folder, "orders").select(code.alias("currency_code"), payload.alias("payload"))
    return lists.exchange_rate_table(payloads, payloads.select("currency_code"))


@query("""SELECT DISTINCT c_mktsegment AS code FROM customer WHERE c_mktsegment <> 'MACHINERY'""")
def distinct_codes(spark, folder):
    """N10."""
    padded = F.concat(F.lit(" "), F.col("c_mktsegment"), F.when(F.col("c_acctbal") > 0, "  ").otherwise(""))
    code = F.when(F.col("c_mktsegment") != "MACHINERY", padded)
    return normalize.distinct_codes(td.table(spark, folder, "customer").select(code.alias("code")), "code")
