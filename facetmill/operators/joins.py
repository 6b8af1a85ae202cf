"""Lookups, resume sets and address ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..session import materialize
from .scans import latest_at

HOT_ROWS = 1_000_000
MOST_HOT_KEYS = 10_000
BROADCAST_ROWS = 200_000
#: A broadcast side may fill this share of the smaller heap, of an executor or the driver. It is built on the driver, sent, and held unfolded.
BROADCAST_SHARE = 1 / 16
#: What a row of a broadcast side costs besides its values.
ROW_BYTES = 48


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, and into how many parts of that size each is cut (``_parts``). A written table.

    One job, with partial sums per task, counts the keys and all rows. The bar rises with the table, so that there are
    at most ``MOST_HOT_KEYS`` of them: the list can be broadcast whatever the data.
    """
    seen = Observation()
    counts = df.groupBy(*on).count().observe(seen, F.sum("count").alias("rows"))
    many = materialize(counts.where(F.col("count") > hot_rows), "hot_keys")
    bar = max(hot_rows, (seen.get.get("rows") or 0) // MOST_HOT_KEYS)
    return many.where(F.col("count") > bar).select(*on, F.ceil(F.col("count") / bar).cast("int").alias("_parts"))


def spread_left_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join to a large table with unique keys, hot keys spread over as many tasks as their rows need.

    Right rows of hot keys are copied once per part; left rows of hot keys take a
    part from a hash of ``spread_by``, so that a re-run task gives the same
    rows. Rows with a NULL key match nothing and do not move. No row is dropped
    and, as keys are unique on the right, none is doubled.

    Keys are counted in ``counted``: the written table that ``left`` was derived from, if
    it has the key columns. Without it ``left`` is written once, as it is read twice. Where no
    key is hot the join is a plain one.
    """
    if counted is None:
        left = counted = materialize(left, "spread")
    known = F.lit(True)
    for k in on:
        known = known & F.col(k).isNotNull()
    hot = hot_keys(counted.select(*on).dropna(), on, hot_rows)
    if hot.isEmpty():
        return left.where(known).join(right, list(on), "left").unionByName(left.where(~known), allowMissingColumns=True)
    hot = F.broadcast(hot)
    part = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_parts")).cast("int"), F.lit(0))
    parts = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    cut_left = left.where(known).join(hot, list(on), "left").withColumn("_part", part).drop("_parts")
    cut_right = right.join(hot, list(on), "left").withColumn("_part", F.explode(parts)).drop("_parts")
    joined = cut_left.join(cut_right, [*on, "_part"], "left").drop("_part")
    return joined.unionByName(left.where(~known), allowMissingColumns=True)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows.

    A plain count: on a written table it reads file footers, in any case it is
    summed per task.
    """
    return df.count() <= max_rows


def _megabytes(memory: str) -> float:
    """A memory setting such as ``4g``; a bare number is in MB."""
    unit = memory.strip().lower().rstrip("b")[-1:]
    factor = {"k": 2**-10, "m": 1, "g": 2**10, "t": 2**20}.get(unit)
    return float(memory.strip().lower().rstrip("bkmgt")) * (factor or 1)


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes that a broadcast side may hold, from the heaps of this session."""
    conf = spark.sparkContext.getConf()
    heaps = [conf.get("spark.driver.memory", "1g")]
    if not spark.sparkContext.master.startswith("local["):
        heaps.append(conf.get("spark.executor.memory", "1g"))
    return int(min(map(_megabytes, heaps)) * 2**20 * BROADCAST_SHARE)


def fits_memory(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether ``df``, unfolded, holds at most ``max_bytes`` (default: :func:`broadcast_limit`).

    Rows and the bytes of texts are summed per task, in one pass over a written table; nested values count as long as their JSON.
    """
    limit = broadcast_limit(df.sparkSession) if max_bytes is None else max_bytes
    fixed, measured = ROW_BYTES, []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            measured.append(F.octet_length(c))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            measured.append(F.octet_length(F.to_json(F.struct(c))))
        else:
            fixed += 16 if isinstance(f.dataType, T.DecimalType) else 8
    texts = sum((F.coalesce(F.sum(m), F.lit(0)) for m in measured), F.lit(0))
    rows, more = df.agg(F.count(F.lit(1)), texts).first()
    return rows * (fixed + 8 * len(measured)) + more <= limit


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    max_bytes: int | None = None,
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join to a table with unique keys.

    ``right`` is measured: up to ``max_bytes`` (default: a share of the heap, see
    :func:`broadcast_limit`) it is broadcast, so the left side does not move; beyond that the join is
    a shuffle with hot keys spread. Pass a materialised ``right`` with only the columns you need.
    """
    if fits_memory(right, max_bytes):
        return left.join(F.broadcast(right), list(on), "left")
    return spread_left_join(left, right, on, spread_by, hot_rows, counted)


def resume_targets(targets: DataFrame, finished: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    """Ids still to do: targets and failures, without those finished."""
    wanted = targets.select(key).unionByName(failed.select(key)).distinct()
    return wanted.join(finished.select(key).distinct(), key, "left_anti")


_OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def ipv4_number(ip: Column | str) -> Column:
    """An IPv4 address as a number, NULL for anything else."""
    ip = F.col(ip) if isinstance(ip, str) else ip
    parts = F.split(ip, r"\.")
    number = F.lit(0).cast("bigint")
    for i in range(4):
        number = number * 256 + F.get(parts, F.lit(i)).try_cast("bigint")
    return F.when(ip.rlike(IPV4), number)


def ipv4_text(number: Column | str) -> Column:
    n = F.col(number) if isinstance(number, str) else number
    octets = [F.shiftright(n, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *octets)


def address_block(number: Column | str) -> Column:
    """The /16 block of an address number. There are 65,536 of them."""
    return F.shiftright(F.col(number) if isinstance(number, str) else number, 16)


LOCATION_FIELDS = ("country_code", "country_name", "region", "city")


def locate_addresses(
    addresses: DataFrame, ranges: DataFrame, ip: str = "ip_address", unknown: str = "Unknown"
) -> DataFrame:
    """Country, region and city of each address from a table of address ranges.

    Ranges do not overlap, so the only candidate is the range that starts last
    at or before the address; it holds if its end is not passed. Both sides
    are scanned in address order in /16 blocks, thus neither a wide range nor
    a crowded block multiplies rows. Addresses without a range, malformed
    ones and IPv6 get ``unknown`` in every field.
    """
    numbered = addresses.withColumn("_number", ipv4_number(ip)).withColumn("_all", F.lit(0))
    spans = ranges.withColumn("_all", F.lit(0)).withColumn("_to", F.col("ip_to"))
    found = latest_at(
        numbered, spans, ["_all"], "_number", "ip_from", ["_to", *LOCATION_FIELDS],
        ties=["ip_to"], slice_of=address_block,
    )
    inside = F.col("_number") <= F.col("_to")
    fields = {
        f: F.coalesce(F.when(inside, F.nullif(F.col(f), F.lit(""))), F.lit(unknown))
        for f in LOCATION_FIELDS
    }
    return found.withColumns(fields).drop("_number", "_all", "_to")


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value taken once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _expanded(text: Column) -> Column:
    """Lower-case hexadecimal digits of an IPv6 address without a dotted tail, NULL if it is none."""
    groups = lambda part: F.when(part == "", F.array().cast("array<string>")).otherwise(F.split(part, ":", -1))
    padded = lambda part: F.array_join(F.transform(part, lambda g: F.lpad(g, 4, "0")), "")

    def joined(sides: Column) -> Column:
        left, right, n = sides["left"], sides["right"], F.size(sides["left"]) + F.size(sides["right"])
        sound = F.when(sides["short"], n <= 7).otherwise(n == 8) & F.forall(F.concat(left, right), lambda g: g.rlike("^[0-9a-f]{1,4}$"))
        return F.when(sound, F.concat(padded(left), F.repeat(F.lit("0000"), F.lit(8) - n), padded(right)))

    def halves(parts: Column) -> Column:
        right = F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
        sides = F.struct(groups(F.get(parts, F.lit(0))).alias("left"), groups(right).alias("right"), (F.size(parts) == 2).alias("short"))
        return F.when(F.size(parts) <= 2, _with(sides, joined))

    return _with(F.split(text, "::", -1), halves)


def address_key(ip: Column | str) -> Column:
    """Sixteen bytes in address order for an address of either family, NULL for anything else.

    IPv4 is taken as ``::ffff:a.b.c.d``, so both ways to write one address give one key. Zones (``%eth0``) are no part of an address.
    """
    ip = F.col(ip) if isinstance(ip, str) else ip

    def six(text: Column) -> Column:
        # A dotted tail is two groups.
        tail = ipv4_number(F.regexp_extract(text, r":([0-9.]+)$", 1))
        head = F.regexp_extract(text, r"^(.*:)[0-9.]+$", 1)
        dotted = _with(tail, lambda n: F.concat(head, F.lower(F.hex(F.shiftright(n, 16))), F.lit(":"), F.lower(F.hex(n.bitwiseAND(F.lit(0xFFFF))))))
        return _with(F.when(text.rlike(r":[0-9]+\."), dotted).otherwise(text), _expanded)

    four = _with(ipv4_number(ip), lambda n: F.concat(F.lit("0" * 20 + "ffff"), F.lpad(F.hex(n), 8, "0")))
    return F.unhex(F.when(ip.contains(":"), _with(F.lower(ip), six)).otherwise(four))


def key_block(key: Column | str) -> Column:
    """The block of an address key, in address order: a /32 of IPv6, or a /16 of IPv4."""
    key = F.col(key) if isinstance(key, str) else key
    number = lambda at, n: F.conv(F.hex(F.substring(key, at, n)), 16, 10).cast("bigint")
    mapped = F.unhex(F.lit("0" * 20 + "ffff"))
    head = F.substring(key, 1, 12)
    inside = F.when(head == mapped, number(13, 2) + 1).when(head > mapped, 0x10001).otherwise(0)
    return number(1, 4) * 0x20000 + F.when(number(1, 4) == 0, inside).otherwise(0)


def locate_any_addresses(addresses: DataFrame, ranges: DataFrame, ip: str = "ip_address", unknown: str = "Unknown") -> DataFrame:
    """Like :func:`locate_addresses` for addresses and ranges of both families in one scan.

    ``ranges``: ``range_from`` and ``range_to`` as text, and the location fields. Ranges that cannot be read match nothing.
    """
    keyed = addresses.withColumn("_key", address_key(ip)).withColumn("_all", F.lit(0))
    spans = ranges.select(
        *LOCATION_FIELDS, address_key("range_from").alias("_from"), address_key("range_to").alias("_to"), F.lit(0).alias("_all")
    ).where("_from is not null and _to is not null")
    found = latest_at(keyed, spans, ["_all"], "_key", "_from", ["_to", *LOCATION_FIELDS], ties=["_to"], slice_of=key_block)
    inside = F.col("_key") <= F.col("_to")
    fields = {f: F.coalesce(F.when(inside, F.nullif(F.col(f), F.lit(""))), F.lit(unknown)) for f in LOCATION_FIELDS}
    return found.withColumns(fields).drop("_key", "_all", "_to")


def location_hit_rate(located: DataFrame, unknown: str = "Unknown") -> DataFrame:
    """How many addresses were found, and the shares (A9). Empty input gives NULL shares."""
    missed = F.col("country_code") == unknown
    total, hits = F.count(F.lit(1)), F.count_if(~missed)
    return located.agg(
        total.alias("total"),
        hits.alias("found"),
        F.count_if(missed).alias("missed"),
        F.try_divide(hits * F.lit(100.0), total).alias("found_pct"),
        F.try_divide(F.count_if(missed) * F.lit(100.0), total).alias("missed_pct"),
    )
