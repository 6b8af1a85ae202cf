from decimal import Decimal

from pyspark.sql import functions as F

from facetmill import schemas
from facetmill.functions.urls import StoreUrlRules
from facetmill.operators import quality
from facetmill.plans import dims, staging

RULES = StoreUrlRules()


def countries(spark):
    data = [("DE", "Germany", "EUR"), ("US", "United States", "USD"), ("GB", "United Kingdom", "GBP"), ("AT", "Austria", "EUR")]
    return spark.createDataFrame(
        [(c, n, m, m, "0", "x") for c, n, m in data], schemas.COUNTRIES
    )


def stores(spark, visits, target=None):
    events = spark.createDataFrame(visits, "store_id string, current_url string")
    info = staging.stg_store_url_info(events, RULES)
    return dims.dim_store(info, countries(spark), RULES.local_host, target)


def codes(df):
    return {r.store_id: (r.country_code, r.country_name) for r in df.collect()}


VISITS = [
    ("1", "https://www.shop.de/x"), ("2", "https://www.shop.co.uk/"), ("3", "http://shop.local/stus/a"),
    ("4", "https://www.google.de/?q=www.shop.de"), ("", "https://www.shop.de/"), (None, "https://www.shop.de/"),
    ("5", "https://www.shop.com/"), ("5", "https://www.shop.de/"), ("5", "https://www.shop.at/"),
    ("6", "http://shop.local/stgb/a"), ("6", "https://www.shop.de/"),
    ("7", "http://shop.local/stfr/a"), ("7", "https://www.shop.de/"),
    ("8", "http://shop.local/stat/a"),
]


def test_one_row_per_store_d5(spark):
    dim = stores(spark, VISITS)
    assert codes(dim) == {
        "1": ("DE", "Germany"), "2": ("UK", "INTERNATIONAL"), "3": ("US", "United States"),
        "5": ("AT", "Austria"), "6": ("GB", "United Kingdom"), "7": ("DE", "Germany"),
        "8": ("AT", "Austria"), "-1": ("Unknown", "Unknown"),
    }
    assert quality.duplicates(dim, "store_id").count() == 0


def test_store_upsert_keeps_created_and_moves_updated_on_change(spark):
    old = (
        stores(spark, VISITS[:3])
        .withColumn("created_by", F.lit("first")).withColumn("updated_by", F.lit("first"))
    )
    changed = [("1", "https://www.shop.at/"), VISITS[1], ("9", "https://www.shop.de/")]
    got = {r.store_id: r for r in stores(spark, changed, target=old).collect()}
    assert sorted(got) == ["-1", "1", "2", "3", "9"]
    assert got["1"].country_code == "AT" and got["1"].created_by == "first" and got["1"].updated_by != "first"
    assert got["2"].updated_by == "first" and got["3"].updated_by == "first"
    assert got["9"].created_by != "first"


def product(pid, **extra):
    row = dict.fromkeys([f.name for f in schemas.PRODUCTS])
    row.update(product_id=pid, name="n", sku="s", collection_id="5", collection="c", gender="women", price=Decimal(3))
    row.update(extra)
    return row


def products(spark, *rows):
    schema = schemas.PRODUCTS
    relaxed = type(schema)([type(f)(f.name, f.dataType, True) for f in schema])
    return staging.stg_product(spark.createDataFrame(list(rows), relaxed))


def sold(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "product_id string")


def test_product_defaults_and_outer_join(spark):
    staged = products(
        spark, product(" 1 "), product("2", collection_id="0", gender="false"), product("3", collection_id=None, gender=" "),
        product(" "), product(None),
    )
    dim = dims.dim_product(staged, sold(spark, "1", "9", None, None))
    got = {r.product_id: r for r in dim.collect()}
    assert sorted(got) == ["-1", "1", "2", "3", "9"], "blank ids (D8) and null sales (D9) add nothing"
    assert (got["1"].collection_id, got["1"].collection_name, got["1"].gender) == ("5", "c", "women")
    assert (got["2"].collection_id, got["2"].collection_name, got["2"].gender) == ("-1", "Unknown", "Uncategorized")
    assert (got["3"].collection_id, got["3"].gender) == ("-1", "Unknown")
    assert (got["9"].product_name, got["9"].vnd_unit_price, got["9"].attribute_set_id) == ("Unknown", 0, "-1")
    assert quality.duplicates(dim, "product_id").count() == 0
    assert quality.not_null(dim, *dims.PRODUCT_ATTRIBUTES).count() == 0


def test_product_upsert_writes_real_changes_only(spark):
    old = dims.dim_product(products(spark, product("1"), product("2"), product("3")), sold(spark))
    old = old.withColumn("created_by", F.lit("first")).withColumn("updated_by", F.lit("first"))
    staged = products(spark, product("1"), product("2", name="other"), product("4"))
    got = {r.product_id: r for r in dims.dim_product(staged, sold(spark), target=old).collect()}
    assert sorted(got) == ["-1", "1", "2", "3", "4"], "a product that is gone stays"
    assert got["1"].updated_by == "first"
    assert got["2"].product_name == "other" and got["2"].created_by == "first" and got["2"].updated_by != "first"
    assert got["4"].created_by != "first"


def test_locations_are_cleaned_and_unknown_is_minus_one_d11_d12(spark):
    raw = spark.createDataFrame(
        [
            (" 1.1.1.1 ", None, "Namibia", "'Khomas'", "'Windhoek'"), ("2.2.2.2", "VN", "'Viet Nam'", "-", "'Hanoi'"),
            ("3.3.3.3", "-", "-", "-", "-"), ("Unknown", "Unknown", "Unknown", "Unknown", "Unknown"),
            ("4.4.4.4", "Unknown", "Nowhere", "Unknown", "Unknown"), ("5.5.5.5", "VN", "Vietnam", "-", "'Hanoi'"),
        ],
        schemas.IP_LOCATIONS,
    )
    mapped = staging.stg_ip_location_mapping(raw)
    got = {r.ip_address: r for r in mapped.collect()}
    assert sorted(got) == ["1.1.1.1", "2.2.2.2", "3.3.3.3", "4.4.4.4", "5.5.5.5"]
    assert got["1.1.1.1"].country_code == "NA" and got["1.1.1.1"].city == "Windhoek"
    assert got["2.2.2.2"].region == "Unknown" and got["2.2.2.2"].city == "Hanoi"
    assert got["3.3.3.3"].location_key == got["4.4.4.4"].location_key == -1
    assert got["2.2.2.2"].location_key == got["5.5.5.5"].location_key
    dim = dims.dim_location(mapped)
    assert quality.duplicates(dim, "location_key").count() == 0
    assert dim.where("location_key = -1").count() == 1


def test_dim_date_appends_missing_days_only(spark):
    first = dims.dim_date(staging.stg_generate_date(spark, "2020-01-03", "2020-01-01"))
    later = staging.stg_generate_date(spark, "2020-01-05", "2020-01-01")
    assert [r.date_key for r in dims.dim_date(later, first).orderBy("date_key").collect()] == [20200104, 20200105]
    assert dims.dim_date(later, later).count() == 0
    assert dims.dim_date(later, first.limit(0)).count() == 5
    assert staging.stg_generate_date(spark, "2018-01-02").count() == 2


def test_currency_member(spark):
    dim = dims.dim_currency(spark.createDataFrame([("USD", "Dollar", "$")], schemas.CURRENCIES))
    assert {r.currency_code for r in dim.collect()} == {"USD", "Unknown"}
