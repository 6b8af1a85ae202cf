import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from facetmill.operators import intervals, scans
from facetmill.plans import dims


def at(minutes):
    return dt.datetime(2020, 1, 1) + dt.timedelta(minutes=minutes)


def runs_of(spark, seen):
    df = spark.createDataFrame(seen, "user_id_db string, email_address string, t timestamp_ntz, utc timestamp_ntz")
    return intervals.change_intervals(df, "user_id_db", "email_address", "t", "utc")


def named(runs):
    return runs.select(
        "user_id_db", "email_address", F.col("group_number").alias("group_user_email"),
        F.col("start_at").alias("start_local_datetime"), F.col("start_utc").alias("start_utc_timestamp"),
    )


STATES = [None, None, "a", None, "a", "b", None, "a"]


def history(user="u", step=40):
    return [(user, s, at(i * step), at(i * step)) for i, s in enumerate(STATES)]


def plain_runs(seen):
    """The same by definition: sort, carry the last state, cut where it changes."""
    out = set()
    for user in {s[0] for s in seen}:
        mine = sorted(
            ((t, utc, e is not None, e or "") for u, e, t, utc in set(seen) if u == user)
        )
        state, previous, flags = "Unspecified", None, []
        for t, utc, known, email in mine:
            state = email if known else state
            flags.append((t, utc, state, int(previous is not None and previous != state)))
            previous = state
        groups = {}
        for t, utc, state, _ in flags:
            number = sum(f for tt, _, _, f in flags if tt <= t)
            groups.setdefault((state, number), []).append((t, utc))
        for (state, number), members in groups.items():
            out.add((user, None if state == "Unspecified" else state, number,
                     min(m[0] for m in members), min(m[1] for m in members)))
    return out


def test_intervals_of_the_fixture(spark):
    got = sorted(tuple(r) for r in runs_of(spark, history()).select("group_number", "email_address", "start_at").collect())
    assert got == [(0, None, at(0)), (1, "a", at(80)), (2, "b", at(200)), (3, "a", at(280))]


def test_only_unknown_states_give_one_interval(spark):
    got = runs_of(spark, [("u", None, at(i * 100), at(0)) for i in range(4)]).collect()
    assert [(r.email_address, r.group_number, r.start_at) for r in got] == [(None, 0, at(0))]


def test_tie_of_unknown_and_known_puts_unknown_first_x8(spark):
    got = runs_of(spark, [("u", "a", at(5), at(5)), ("u", None, at(5), at(5))]).collect()
    assert sorted((r.email_address or "", r.group_number) for r in got) == [("", 1), ("a", 1)]


@pytest.mark.parametrize("seed", range(4))
def test_intervals_match_definition_on_a_hot_user(spark, seed):
    rnd = random.Random(seed)
    seen = []
    for _ in range(600):
        user = "hot" if rnd.random() < 0.5 else f"u{rnd.randrange(30)}"
        t = at(rnd.randrange(0, 6000))
        seen.append((user, rnd.choice([None, None, "a", "b"]), t, t + dt.timedelta(minutes=rnd.randrange(5))))
    seen += rnd.sample(seen, 100)  # copies
    got = {
        (r.user_id_db, r.email_address, r.group_number, r.start_at, r.start_utc)
        for r in runs_of(spark, seen).collect()
    }
    assert got == plain_runs(seen)


def test_scd_versions_tile_the_timeline(spark):
    scd = dims.dim_customer_scd(named(runs_of(spark, history())))
    rows = {r.email_address + r.start_local_datetime.isoformat(): r for r in scd.collect()}
    mine = sorted((r for r in rows.values() if r.user_id_db == "u"), key=lambda r: r.start_local_datetime)
    assert [r.email_address for r in mine] == ["Unknown", "a", "b", "a"]
    assert [r.end_local_datetime for r in mine[:-1]] == [r.start_local_datetime for r in mine[1:]]
    assert [r.is_current for r in mine] == [False, False, False, True]
    assert mine[-1].end_local_date == dt.date(9999, 12, 31)
    assert [r.has_email_info for r in mine] == [False, True, True, True]
    [member] = [r for r in rows.values() if r.scd_customer_key == -1]
    assert member.user_id_db == "-1" and member.start_local_date == dt.date(1900, 1, 1)


def test_current_customer(spark):
    current = dims.dim_customer_current(named(runs_of(spark, history() + [("v", None, at(3), at(3))])))
    got = {r.user_id_db: (r.email_address, r.active_date, r.has_email_info) for r in current.collect()}
    day = dt.date(2020, 1, 1)
    assert got == {"u": ("a", day, True), "v": ("Unknown", day, False), "-1": ("Unknown", dt.date(1900, 1, 1), False)}


def test_version_at_half_open_bounds(spark):
    versions = spark.createDataFrame(
        [("u", 1, at(10), at(20)), ("u", 2, at(20), at(500)), ("u", 3, at(600), at(700)), (None, 9, at(0), at(900))],
        "user string, k bigint, s timestamp_ntz, e timestamp_ntz",
    )
    facts = [(0, "u", at(10)), (1, "u", at(20)), (2, "u", at(5)), (3, None, at(15)), (4, "u", at(499)),
             (5, "u", at(550)), (6, "w", at(15)), (7, "u", None), (8, "u", at(699)), (9, "u", at(700))]
    df = spark.createDataFrame(facts, "id int, user string, t timestamp_ntz")
    got = {r.id: r.k for r in intervals.version_at(df, versions, "user", "t", ["k"], "s", "e").collect()}
    assert got == {0: 1, 1: 2, 2: None, 3: None, 4: 2, 5: None, 6: None, 7: None, 8: 3, 9: None}


def test_version_at_matches_brute_force_on_a_hot_user(spark):
    rnd = random.Random(3)
    versions, facts = [], []
    for user in ["hot"] + [f"u{i}" for i in range(20)]:
        starts = sorted(rnd.sample(range(0, 9000), 200 if user == "hot" else 5))
        for i, s in enumerate(starts):
            end = starts[i + 1] if i + 1 < len(starts) else 20000
            versions.append((user, len(versions), at(s), at(end - rnd.choice([0, 0, 3]))))
    for i in range(1500):
        user = "hot" if rnd.random() < 0.4 else f"u{rnd.randrange(25)}"
        facts.append((i, user, at(rnd.randrange(0, 12000))))
    want = {
        i: next((k for u, k, s, e in versions if u == user and s <= t < e), None) for i, user, t in facts
    }
    got = intervals.version_at(
        spark.createDataFrame(facts, "id int, user string, t timestamp_ntz"),
        spark.createDataFrame(versions, "user string, k bigint, s timestamp_ntz, e timestamp_ntz"),
        "user", "t", ["k"], "s", "e",
    ).collect()
    assert len(got) == len(facts) and {r.id: r.k for r in got} == want


@pytest.fixture(scope="module")
def series(spark):
    rnd = random.Random(5)
    data = [
        ("hot" if rnd.random() < 0.4 else f"k{rnd.randrange(9)}", i, at(rnd.randrange(4000)), rnd.choice([None, None, i]))
        for i in range(800)
    ]
    return spark.createDataFrame(data, "k string, id int, t timestamp_ntz, v int")


def test_sliced_scans_equal_plain_windows(spark, series, rows):
    w = Window.partitionBy("k").orderBy("t", "id")
    plain = series.select(
        "id",
        F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("f"),
        F.lead("id").over(w).alias("n"),
    )
    filled = scans.fill_forward(series, ["k"], ["t", "id"], "v", "f")
    both = scans.next_value(filled, ["k"], ["t", "id"], "id", "n").select("id", "f", "n")
    assert rows(both) == rows(plain)


def test_row_numbers_equal_plain_windows(spark, series, rows):
    got = scans.global_row_number(series, ["t", "id"]).select("id", "row_num")
    assert rows(got) == rows(series.select("id", F.row_number().over(Window.orderBy("t", "id")).alias("row_num")))
    days = series.withColumn("d", F.to_date("t"))
    plain = days.select("id", F.row_number().over(Window.partitionBy("d").orderBy("t", "id")).alias("row_num"))
    assert rows(scans.day_row_number(days, "d", ["t", "id"]).select("id", "row_num")) == rows(plain)


def test_no_window_is_partitioned_by_the_user_over_events(spark):
    """Windows run over (key, slice), or over one summary row per slice."""
    plan = runs_of(spark, history())._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "_slice" not in line:
            raise AssertionError(line)


def test_rows_without_a_time_come_first_and_are_kept(spark, rows):
    df = spark.createDataFrame(
        [("k", 1, None, 5), ("k", 2, at(3), None), ("k", 3, at(500), None)], "k string, id int, t timestamp_ntz, v int"
    )
    got = scans.fill_forward(df, ["k"], ["t", "id"], "v", "f").select("id", "f")
    assert rows(got) == [(1, 5), (2, 5), (3, 5)]


def test_interval_builder_shuffles_the_events_once(spark):
    """Both branches of the builder share the exchange over the events."""
    seen = spark.createDataFrame(history(), "user_id_db string, email_address string, t timestamp_ntz, utc timestamp_ntz")
    runs = intervals.change_intervals(seen, "user_id_db", "email_address", "t", "utc")
    runs.collect()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = intervals.change_intervals(seen, "user_id_db", "email_address", "t", "utc")
        assert "ReusedExchange" in plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("hot", [[], ["whale"]])
def test_scans_of_known_hot_keys_equal_sliced_ones(spark, hot):
    rng = random.Random(5)
    start = dt.datetime(2020, 1, 1)

    def data(n):
        return [
            (rng.choice(["whale", "whale", "a", "b", None]), rng.choice([None, "x", "y", "z"]), start + dt.timedelta(minutes=rng.randrange(600)), i)
            for i in range(n)
        ]

    events = spark.createDataFrame(data(300), "u string, s string, at timestamp_ntz, utc long").withColumn("utc", F.timestamp_seconds("utc"))
    facts = spark.createDataFrame([(*r[:1], r[2], r[3]) for r in data(200)] + [("a", None, 900)], "u string, at timestamp_ntz, n long")
    build = lambda h: intervals.change_intervals(events, "u", "s", "at", "utc", h)
    same = lambda a, b: sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert same(build(hot), build(None))
    spans = build(None).where("u is not null")
    order = ["start_at", "start_utc", "group_number"]
    nexts = lambda h: scans.next_value(spans, ["u"], order, "start_at", "n", hot=h)
    assert same(nexts(hot), nexts(None))
    starts = events.groupBy("u", F.col("at").alias("from")).agg(F.max("utc").alias("last"))
    found = lambda h: scans.latest_at(facts, starts, ["u"], "at", "from", ["last"], hot=h)
    assert same(found(hot), found(None))


def test_without_hot_keys_a_history_is_not_cut(spark):
    events = spark.createDataFrame([("a", "x", dt.datetime(2020, 1, 1, h), h) for h in range(5)] * 2, "u string, s string, at timestamp_ntz, utc long")
    assert scans.hot_values(events, "u", 9) == ["a"] and scans.hot_values(events, "u") == []
    plan = intervals.change_intervals(events, "u", "s", "at", "utc", [])._jdf.queryExecution().executedPlan().toString()
    # copies are folded, then everything is computed where a user's rows are
    assert plan.count("Exchange hashpartitioning") == 2
