"""Velocity, joins by time and near duplicates against plain brute force, with hot groups, ties, nulls, repeats, empty tables."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from paylens.operators import temporal_joins
from paylens.operators.buckets import ordered_buckets
from paylens.operators.duplicates import near_in_time_duplicates, without_duplicates
from paylens.operators.sequence import sender_sequence
from paylens.operators.temporal_joins import asof_join, interval_bins, interval_join
from paylens.operators.velocity import sender_velocity

START = dt.datetime(2024, 3, 1)
SCHEMA = "sender_bic string, receiver_bic string, timestamp timestamp, amount double, currency string"


def payments(n=600, seed=1, hot=0.5, seconds=20_000):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        sender = "HOT" if rnd.random() < hot else rnd.choice(["A", "B", "C", None])
        at = None if rnd.random() < 0.04 else START + dt.timedelta(seconds=rnd.randrange(seconds), microseconds=rnd.choice([0, 0, 1, 500_000]))
        rows.append((sender, rnd.choice("XY"), at, rnd.choice([None, 1.0, 2.5, 10.01, round(rnd.uniform(1, 9e6), 2)]), rnd.choice(["USD", "EUR"])))
    return rows + rows[:20] + [("HOT", "X", START, 5.0, "USD")] * 30


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def span(seconds):
    return dt.timedelta(seconds=seconds)


@pytest.mark.parametrize("max_rows", [25, 100_000])
def test_buckets_rise_and_stay_small(spark, max_rows):
    rows = payments()
    df = ordered_buckets(spark.createDataFrame(rows, SCHEMA), ["sender_bic"], ["timestamp", "receiver_bic", "amount"], max_rows)
    got = df.collect()
    assert len(got) == len(rows)
    groups = {}
    for r in got:
        groups.setdefault((r.sender_bic, r.bucket), []).append((r.timestamp or dt.datetime.min, r.receiver_bic, -math.inf if r.amount is None else r.amount))
    ends = {}
    for (sender, bucket), members in sorted(groups.items(), key=lambda g: (g[0][0] or "", g[0][1])):
        assert min(members) >= ends.get(sender, min(members))
        ends[sender] = max(members)
        assert len(members) <= max_rows or len(set(members)) == 1
    assert (len(groups) > 20) == (max_rows == 25)


def test_buckets_of_other_columns(spark):
    df = spark.createDataFrame([(1, i % 50, f"é{i:04d}") for i in range(300)], "k int, d int, s string")
    for order in (["s"], ["d", "s"]):
        out = ordered_buckets(df, ["k"], order, max_rows=10).collect()
        ordered = sorted(out, key=lambda r: [r[c] for c in order])
        assert [r.bucket for r in ordered] == sorted(r.bucket for r in out) and len({r.bucket for r in out}) >= 30
    stamped = df.withColumn("t", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("d") * 3600).cast("timestamp_ntz"))
    out = sorted(ordered_buckets(stamped, ["k"], ["t"], max_rows=10).collect(), key=lambda r: r.t)
    assert [r.bucket for r in out] == sorted(r.bucket for r in out) and out[-1].bucket > 20
    with pytest.raises(ValueError):
        ordered_buckets(df.withColumn("m", F.array("d")), ["k"], ["m"])


@pytest.mark.parametrize("max_rows", [25, 100_000])
def test_sequence_of_hot_senders_and_null_times(spark, max_rows):
    rows = payments() + [("HOT", f"R{i:03d}", None, 1.0, "USD") for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = Window.partitionBy("sender_bic").orderBy(*[F.asc_nulls_first(c) for c in ("timestamp", "receiver_bic", "amount", "currency")])
    assert collected(sender_sequence(df, max_rows=max_rows)) == collected(df.withColumn("row_num", F.row_number().over(plain)))


def plain_velocity(rows, window):
    out = []
    for r in rows:
        if r[0] is None or r[2] is None:
            out.append((*r, None, None, None))
            continue
        mine = [x for x in rows if x[0] == r[0] and x[2] is not None]
        inside = [x for x in mine if r[2] - span(window) <= x[2] <= r[2]]
        before = [x[2] for x in mine if x[2] < r[2]]
        total = sum(round((x[3] or 0) * 100) for x in inside) / 100
        out.append((*r, len(inside), total, (r[2] - max(before)).total_seconds() if before else None))
    return sorted(out, key=key)


@pytest.mark.parametrize("max_rows", [30, 100_000])
@pytest.mark.parametrize("window", [1, 600, 90_000])
def test_velocity_equals_plain_ranges(spark, max_rows, window):
    rows = payments()
    got = [(*r[:6], round(r[6], 2) if r[6] is not None else None, r[7]) for r in collected(sender_velocity(spark.createDataFrame(rows, SCHEMA), window, max_rows=max_rows))]
    assert sorted(got, key=key) == plain_velocity(rows, window)


def test_velocity_of_odd_amounts_and_nothing(spark):
    rows = [("A", "X", START + span(10 * i), v, "USD") for i, v in enumerate([1.0, float("nan"), 2.0, 3.0, float("inf"), 1e300, 4.0, 5.0])]
    got = [r.velocity_sum for r in sender_velocity(spark.createDataFrame(rows, SCHEMA), 10).orderBy("timestamp").collect()]
    assert got[0] == 1 and all(map(math.isnan, got[1:3])) and got[3] == 5 and all(map(math.isnan, got[4:7])) and got[7] == 9
    assert sender_velocity(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        sender_velocity(spark.createDataFrame([], SCHEMA), 0)


@pytest.mark.parametrize("max_rows", [30, 100_000])
@pytest.mark.parametrize("age", [None, 300.0])
def test_asof_join_equals_search(spark, max_rows, age):
    left, rnd = payments(300, 2), random.Random(3)
    right = [(rnd.choice(["HOT", "HOT", "A", "B", None]), None if rnd.random() < 0.05 else START + span(rnd.randrange(0, 20_000, 50)), rnd.choice([None, i]), "x") for i in range(200)]
    right += right[:5] + [("HOT", START, 7, None), ("HOT", START, None, "y")]
    want = []
    for r in left:
        found = [x for x in right if r[0] is not None and x[0] == r[0] and x[1] is not None and r[2] is not None and x[1] <= r[2]]
        best = max(found, key=lambda x: (x[1], x[2] is not None, x[2] or 0, x[3] is not None, x[3] or ""), default=None)
        if best is None or (age is not None and (r[2] - best[1]).total_seconds() > age):
            best = (None,) * 4
        want.append((*r, *best[1:]))
    a = spark.createDataFrame(left, SCHEMA)
    b = spark.createDataFrame(right, "sender_bic string, since timestamp, level int, note string")
    got = asof_join(a, b, ["sender_bic"], "timestamp", "since", age, max_rows)
    assert got.columns == [*a.columns, "since", "level", "note"] and collected(got) == sorted(want, key=key)


def test_asof_join_of_empty_sides_and_clashes(spark):
    a = spark.createDataFrame(payments(40), SCHEMA)
    b = spark.createDataFrame([], "sender_bic string, since timestamp, level int")
    assert asof_join(a.limit(0), b, ["sender_bic"], "timestamp", "since").count() == 0
    assert asof_join(a, b, ["sender_bic"], "timestamp", "since").filter("since is null and level is null").count() == a.count()
    every = spark.createDataFrame([(START - span(5), 3)], "since timestamp, level int")
    assert asof_join(a, every, [], "timestamp", "since").filter("level = 3").count() == a.filter("timestamp is not null").count()
    with pytest.raises(ValueError):
        asof_join(a, b.withColumn("amount", F.lit(1)), ["sender_bic"], "timestamp", "since")


def test_interval_bins_make_up_the_interval(spark):
    rnd = random.Random(4)
    rows = [(a, a + rnd.choice([0, 3, 100, 10**5, 10**8])) for a in (rnd.randrange(-10**6, 10**6) for _ in range(60))] + [(5, 4), (-10**11, 10**11)]
    for r in spark.createDataFrame(rows, "a long, b long").withColumn("bins", interval_bins(F.col("a"), F.col("b"), 10)).collect():
        if r.a > r.b:
            assert r.bins is None
            continue
        pieces = sorted((x.bin * 10 * 16**x.level, (x.bin + 1) * 10 * 16**x.level) for x in r.bins)
        assert pieces[0][0] == r.a // 10 * 10 and pieces[-1][1] == r.b // 10 * 10 + 10
        assert all(p[1] == q[0] for p, q in zip(pieces, pieces[1:]))
        assert len(pieces) <= 30 * (1 + math.ceil(math.log((r.b - r.a) / 10 + 2, 16)))


@pytest.mark.parametrize("keys", [["sender_bic"], []])
def test_interval_join_equals_between(spark, keys):
    points, rnd = payments(250, 5), random.Random(6)
    intervals = []
    for i in range(120):
        a = START + span(rnd.randrange(-30_000, 20_000))
        intervals.append((rnd.choice(["HOT", "A", "B", None]), a, rnd.choice([a, a + span(rnd.randrange(50_000)), a - span(9), a + span(10**8), None]), i))
    intervals += intervals[:4] + [("HOT", None, START, 999)]
    want = sorted(((*p, *x[1:]) for p in points for x in intervals
                   if p[2] and x[1] and x[2] and x[1] <= p[2] <= x[2] and (not keys or (p[0] is not None and p[0] == x[0]))), key=key)
    a = spark.createDataFrame(points, SCHEMA)
    b = spark.createDataFrame(intervals, "sender_bic string, valid_from timestamp, valid_to timestamp, note int")
    if not keys:
        b = b.drop("sender_bic")
    got = interval_join(a, b, keys, "timestamp", "valid_from", "valid_to", unit_seconds=100)
    assert collected(got) == want and len(want) > 100
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert interval_join(a, b.limit(0), keys, "timestamp", "valid_from", "valid_to").count() == 0
    with pytest.raises(ValueError):
        interval_join(a, b.withColumn("amount", F.lit(1)), keys, "timestamp", "valid_from", "valid_to")


@pytest.mark.parametrize("steps", [2, 14])
@pytest.mark.parametrize("keys", [["sender_bic"], []])
def test_interval_join_in_chunks_equals_between(spark, monkeypatch, keys, steps):
    monkeypatch.setattr(temporal_joins, "STEPS", steps)
    points, rnd = payments(250, 8), random.Random(9)
    points += [("TIES", "X", START, float(i), "EUR") for i in range(40)] + [("OLD", "X", dt.datetime(1901, 1, 1), 1.0, "EUR")] * 12
    intervals = []
    for i in range(150):
        a = rnd.choice([START, dt.datetime(1900, 12, 31), START + span(rnd.randrange(-30_000, 20_000))])
        intervals.append((rnd.choice(["HOT", "A", "TIES", "OLD", None]), a, rnd.choice([a, a + span(rnd.randrange(9_000)), a - span(9), a + span(4 * 10**9), None]), i))
    want = sorted(((*p, *x[1:]) for p in points for x in intervals
                   if p[2] and x[1] and x[2] and x[1] <= p[2] <= x[2] and (not keys or (p[0] is not None and p[0] == x[0]))), key=key)
    a = spark.createDataFrame(points, SCHEMA)
    b = spark.createDataFrame(intervals, "sender_bic string, valid_from timestamp, valid_to timestamp, note int")
    got = interval_join(a, b if keys else b.drop("sender_bic"), keys, "timestamp", "valid_from", "valid_to", unit_seconds=60, chunk_rows=5)
    assert collected(got) == want and len(want) > 100
    cuts = temporal_joins._time_cuts(a.filter("timestamp is not null"), keys, "timestamp", 60_000_000, 5).collect()
    assert max(len(r.j_cuts) for r in cuts) in ((3,) if steps == 2 else range(20, 200))
    assert all(list(r.j_cuts) == sorted(set(r.j_cuts)) for r in cuts)


def test_interval_join_deals_each_point_once_and_in_order_of_time(spark):
    n, days = 3_000, 300
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7919 % n * (days * 86_400 // n))
    points = spark.range(0, n, 1, 4).select(F.lit("A").alias("sender"), at.alias("at"), F.col("id").alias("point"))
    since = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 86_400)
    periods = spark.range(days).select(F.lit("A").alias("sender"), since.alias("since"), F.timestamp_add("DAY", F.col("id") % 100 + 20, since).alias("until"), F.col("id").alias("period"))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = interval_join(points, periods, ["sender"], "at", "since", "until", chunk_rows=500)
        times = [r[0] for r in found.select(F.unix_micros("at")).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    # copies are made of periods only, and the result's times fall back from chunk to chunk at most, so it packs well
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1
    assert len(times) > 50_000 and sum(b < a for a, b in zip(times, times[1:])) < 6


def test_interval_join_deals_by_columns_of_its_own(spark):
    day = lambda n: START + span(n * 86_400)
    points = spark.createDataFrame([("A", day(3), 1), ("A", day(40), 2), ("B", day(700), 3)], "sender string, at timestamp, bin int")
    periods = spark.createDataFrame([("A", day(0), day(39), 10), ("A", day(-9_000), day(9_000), 11), ("B", day(0), day(699), 12)], "sender string, since timestamp, until timestamp, level int")
    found = interval_join(points, periods, ["sender"], "at", "since", "until")
    assert sorted((r.bin, r.level) for r in found.collect()) == [(1, 10), (1, 11), (2, 11)]
    # bins are made in compiled code, as rows: no expression interpreted row by row
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "inline" not in plan


def test_periods_query_casts_no_time_per_pair(spark, tmp_path):
    from paylens.plans.queries import q_payments_in_periods

    day = lambda x: dt.datetime.fromisoformat(x)
    tables = {
        "customer": ([(1, 2)], "c_custkey long, c_nationkey int"),
        "supplier": ([(1, 3)], "s_suppkey long, s_nationkey int"),
        "orders": ([(1, 1, day("2000-01-01")), (50, 1, day("2000-01-02"))], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "lineitem": ([(1, 1, 1, 10.0, day("2000-01-02")), (50, 1, 1, 20.0, day("2000-03-01"))],
                     "l_orderkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_shipdate timestamp_ntz"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    found = q_payments_in_periods(spark, str(tmp_path))
    first, second = day("2000-01-02 12:00:01"), day("2000-03-01 12:00:50")
    assert sorted((r.timestamp, r.period_id, r.valid_from, r.valid_to) for r in found.collect()) == [
        (first, 1, day("2000-01-01"), day("2000-01-03")),
        (first, 50, day("2000-01-02"), day("2000-01-02") + span(7300 * 86_400)),
        (second, 50, day("2000-01-02"), day("2000-01-02") + span(7300 * 86_400)),
    ]
    assert found.columns == ["sender_bic", "timestamp", "receiver_bic", "amount", "currency", "period_id", "valid_from", "valid_to"]
    assert {found.schema[c].dataType.typeName() for c in ("timestamp", "valid_from", "valid_to")} == {"timestamp_ntz"}
    above = found._jdf.queryExecution().optimizedPlan().toString().split("Join ")[0]
    assert "cast(" not in above


@pytest.mark.parametrize("max_rows", [30, 100_000])
@pytest.mark.parametrize("gap", [1, 120])
def test_duplicates_equal_gaps_and_islands(spark, max_rows, gap):
    rows = [(*r[:3], r[3] if r[3] is None or r[3] < 3 else float("nan"), r[4]) for r in payments(700, 7, seconds=9_000)]
    groups, want = {}, []
    for r in sorted(rows, key=lambda r: (r[2] or START, r[1:2], r[4])):
        if None in r:
            want.append((*r, r[2], 1, False))
        else:
            groups.setdefault((r[0], r[1], str(r[3]), r[4]), []).append(r)
    for members in groups.values():
        begin, position, last = None, 0, None
        for r in members:
            if last is None or r[2] - last > span(gap):
                begin, position = r[2], 0
            position, last = position + 1, r[2]
            want.append((*r, begin, position, position > 1))
    df = spark.createDataFrame(rows, SCHEMA)
    got = collected(near_in_time_duplicates(df, gap, max_rows=max_rows))
    assert got == sorted(want, key=key) and sum(w[-1] for w in want) > 50
    assert without_duplicates(df, gap).count() == sum(not w[-1] for w in want)


def test_duplicates_of_nothing(spark):
    assert near_in_time_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hot_sender_windows_are_split(spark):
    """The windows are dealt by (party, bucket), and no such group is much larger than asked for."""
    df = spark.createDataFrame(payments(2_000, 8, hot=0.8), SCHEMA)
    for out in (sender_velocity(df, 600, max_rows=100), near_in_time_duplicates(df, 60, max_rows=100)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "bucket" in plan and "hashpartitioning(sender_bic" not in plan.split("Window")[1].split("\n")[0]
    events = df.filter("sender_bic = 'HOT' and timestamp is not null").select("sender_bic", "timestamp").distinct()
    sizes = ordered_buckets(events, ["sender_bic"], ["timestamp"], max_rows=100).groupBy("bucket").count().agg(F.max("count")).first()[0]
    assert sizes <= 100


def test_cuts_follow_the_size_and_shuffle_no_rows(spark):
    df = spark.range(0, 900, 1, 4).selectExpr("CASE WHEN id < 120 THEN 'HOT' ELSE concat('C', id % 50) END AS k", "id * 17 % 1000 AS v")
    out = ordered_buckets(df, ["k"], ["v"], max_rows=100)
    sizes = {(r.k, r.bucket): r["count"] for r in out.groupBy("k", "bucket").count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == "HOT"]
    assert sum(hot) == 120 and 2 <= len(hot) <= 4 and max(hot) <= 100
    assert {b for k, b in sizes if k != "HOT"} == {0} and all(b > 0 for k, b in sizes if k == "HOT")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("gap", [1, 120])
def test_whole_and_cut_groups_have_the_same_runs(spark, gap):
    df = spark.createDataFrame([(*r[:3], r[3] if r[3] is None or r[3] < 3 else float("nan"), r[4]) for r in payments(700, 7, seconds=9_000)], SCHEMA)
    whole, cut = (list(map(key, collected(near_in_time_duplicates(df, gap, max_rows=n)))) for n in (100_000, 30))
    assert whole == cut and len(whole) == df.count()
    # the payments by plain windows
    same = Window.partitionBy(*[F.col(c) for c in ("sender_bic", "receiver_bic", "amount", "currency")])
    known = df.filter(" and ".join(f"{c} is not null" for c in df.columns))
    at = same.orderBy("timestamp")
    starts = F.coalesce(F.unix_micros("timestamp") - F.unix_micros(F.lag("timestamp").over(at)) > gap * 1_000_000, F.lit(True))
    runs = known.withColumn("starts", starts).withColumn("number", F.row_number().over(at))
    runs = runs.withColumn("first", F.max(F.when(F.col("starts"), F.struct(F.col("timestamp").alias("at"), "number"))).over(at.rowsBetween(Window.unboundedPreceding, 0)))
    want = runs.select(*df.columns, F.col("first.at"), (F.col("number") - F.col("first.number") + 1).cast("long"), ~F.col("starts"))
    lone = [(*r, r[2], 1, False) for r in collected(df) if None in r]
    assert whole == sorted(map(key, [*map(tuple, want.collect()), *lone]))
