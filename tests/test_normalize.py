import json

from pyspark.sql import types as T

from facetmill import schemas
from facetmill.operators import normalize


def test_option_shapes(spark):
    data = [
        (1, '{"alloy":"x","category id":"9"}'), (2, '[{"option_label":"a"}]'), (3, '""'), (4, None),
        (5, "[]"), (6, "12"), (7, " "),
    ]
    df = normalize.normalize_option(spark.createDataFrame(data, "id int, option string"))
    got = {r.id: r for r in df.collect()}
    assert {i: len(r.option) for i, r in got.items()} == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0}
    assert got[1].option[0]["category id"] == "9" and got[1].option_object.alloy == "x"
    assert got[1].option_list == [] and got[2].option_object is None
    assert got[2].option_list[0].option_label == "a"
    assert got[3].option_list is None and got[3].option_object is None


def test_cart_shapes(spark):
    item = {"product_id": "1", "amount": 2, "price": "1,00", "currency": "$"}
    carts = [
        None, '"text"', "{}", json.dumps([dict(item, option="")]),
        json.dumps([dict(item, amount="3", option={"option_label": "a"})]),
        json.dumps([dict(item, option=[{"option_label": "a"}, {"option_label": "b"}]), item]),
        json.dumps([dict(item, amount="x", option=None)]),
    ]
    df = normalize.normalize_cart(spark.createDataFrame(list(enumerate(carts)), "id int, cart_products string"))
    got = [r.cart_products for r in df.orderBy("id").collect()]
    assert [len(c) for c in got] == [0, 0, 0, 1, 1, 2, 1]
    assert got[3][0].option == [] and got[4][0].option[0].option_label == "a"
    assert [got[4][0].amount, got[6][0].amount] == [3, None]
    assert [len(i.option) for i in got[5]] == [2, 0]


def test_normalized_events_have_the_declared_schema(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(
        json.dumps({"_id": "1", "time_stamp": 5, "option": {"alloy": "x"}, "cart_products": [{"product_id": "7", "amount": 1}]})
        + "\n"
    )
    (tmp_path / "b.csv").write_text("not,json\n")
    from facetmill.sources import read_raw_events

    events = normalize.normalize_events(read_raw_events(spark, str(tmp_path)))
    assert [f.name for f in events.schema] == [f.name for f in schemas.EVENTS] and len(events.columns) == 34
    [row] = events.collect()
    assert row.option[0].alloy == "x" and row.cart_products[0].product_id == "7"


def test_stringify_keeps_null(spark):
    df = spark.createDataFrame([(1, None, [1, 2]), (None, "a", None)], "a int, b string, c array<int>")
    assert [tuple(r) for r in normalize.stringify(df).collect()] == [("1", None, "[1,2]"), (None, "a", None)]


def test_discovered_schema_merges_shapes(spark):
    docs = ['{"a": 1}', '{"a": "x", "b": [1]}', '{"c": {"d": 1.5}}', "broken {"]
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    [(ddl,)] = normalize.discover_schema(df, "doc").collect()
    assert ddl == "OBJECT<a: VARIANT, b: ARRAY<BIGINT>, c: OBJECT<d: DECIMAL(2,1)>>"


def test_envelopes(spark):
    lines = [
        '{"product_id": 1, "data": {"product_id": "1", "name": "a", "price": 2.5}, "crawled_at": "t"}',
        '{"product_id": 2, "data": null}', '{"product_id": 3}', "{broken",
        '{"data": {"product_id": "5"}, "crawled_at": ',
        '{"data": {"product_id": "4", "price": "no number"}}',
    ]
    df = normalize.unwrap_envelope(
        spark.createDataFrame([(x,) for x in lines], "line string"), "line", schemas.PRODUCTS
    )
    got = {r.product_id: r for r in df.collect()}
    assert sorted(got) == ["1", "4"] and float(got["1"].price) == 2.5 and got["4"].price is None


def test_embedded_payload_status(spark):
    filler = "<script>track(1);</script>" + "<p>text</p>" * 20_000
    pages = {
        "ok": filler + '<script type="a">\n var react_data = {"product_id": "7", "other": {"x": 1}};\n</script>',
        "none": filler,
        "outside": "<p>react_data = {};</p>" + filler,
        "open": '<script>react_data = {"a": 1}</script>',
        "broken": "<script>react_data: {a b};</script>",
        "first_wins": '<script>react_data = {"product_id": "1"};</script><script>react_data = {"product_id": "2"};</script>',
    }
    df = spark.createDataFrame(list(pages.items()), "id string, html string")
    got = {r.id: r for r in normalize.embedded_payload(df, "html").collect()}
    assert {k: r.status for k, r in got.items()} == {
        "ok": "SUCCESS", "none": "MISSING_SCRIPT_TAG", "outside": "MISSING_SCRIPT_TAG",
        "open": "MISSING_JSON_MATCH", "broken": "JSON_DECODE_ERROR", "first_wins": "SUCCESS",
    }
    assert got["ok"].payload.product_id == "7" and got["first_wins"].payload.product_id == "1"
    assert got["broken"].payload is None


def test_rate_payloads(spark, rows):
    payload = json.dumps(
        {"rates": [{"rate": 1}, {"date": "2019-01-02"}, {"date": "2019-13-01", "rate": 2},
                   {"date": "2019-01-03", "rate": 1.25}, {"date": "", "rate": 1}]}
    )
    df = spark.createDataFrame([(" eur ", payload), ("x", '{"rates": []}')], "code string, body string")
    got = rows(normalize.flatten_rates(df, "code", "body"))
    assert [(g[0], g[1], g[2], float(g[3])) for g in got] == [(20190103, "EUR", "USD", 1.25)]


def test_distinct_codes_drop_null_before_text(spark, rows):
    df = spark.createDataFrame([("A ",), ("A",), (None,), (" B",)], "c string")
    assert rows(normalize.distinct_codes(df, "c")) == [("A",), ("B",)]


def test_whitelist(spark):
    df = spark.createDataFrame([('{"a": 1, "b": {"c": 2}}',)], "j string")
    listed = T.StructType([T.StructField("a", T.LongType())])
    assert df.select(normalize.keep_keys("j", listed).alias("k")).select("k.*").first().asDict() == {"a": 1}
