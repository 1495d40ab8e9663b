"""Stream sessions, snapshot differences and mergeable states."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from paylens.operators.snapshots import apply_changes, multiset_difference
from paylens.operators.states import daily_states, merge_states, state_figures
from paylens.sinks import scratch_path
from paylens.streaming.sessions import open_sessions, start_session_stream

START = dt.datetime(2024, 3, 1)
SCHEMA = "sender_bic string, timestamp timestamp, amount double, currency string, is_valid boolean"


def payments(n, seed, seconds=40_000):
    rnd = random.Random(seed)
    return [(rnd.choice(["A", "A", "B", "C", None]), None if rnd.random() < 0.05 else START + dt.timedelta(seconds=rnd.randrange(seconds)),
             rnd.choice([None, 1.5, 20.0, 300.25]), rnd.choice(["USD", "EUR", None]), rnd.random() < 0.9) for _ in range(n)]


def sessions_of(batches, gap, delay):
    """Plain sessions of the payments that aren't late, late ones and unplaced ones, as the stream has them."""
    clock, kept, out = {}, {}, []
    for batch in batches:
        seen = dict(clock)
        for sender, at, amount, *_ in batch:
            if sender is None or at is None:
                out.append(("unplaced", sender, at, at, 1, amount or 0.0))
            elif sender in seen and at < seen[sender] - dt.timedelta(seconds=delay):
                out.append(("late", sender, at, at, 1, amount or 0.0))
            else:
                kept.setdefault(sender, []).append((at, amount or 0.0))
                clock[sender] = max(clock.get(sender, at), at)
    for sender, rows in kept.items():
        rows.sort()
        begin = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i][0] - rows[i - 1][0] > dt.timedelta(seconds=gap):
                out.append(("session", sender, rows[begin][0], rows[i - 1][0], i - begin, sum(a for _, a in rows[begin:i])))
                begin = i
    return sorted(out, key=str)


@pytest.mark.parametrize("gap, delay", [(300, 2_000), (60, 0)])
def test_streamed_sessions_over_restarts_equal_plain_ones(spark, gap, delay):
    rnd = random.Random(gap)
    everything = sorted(payments(500, 3), key=lambda r: (r[1] or START) + dt.timedelta(seconds=rnd.randrange(4_000)))
    batches = [everything[:200], everything[200:350], everything[350:]]
    landing, out, checkpoint = (scratch_path(spark, f"t-{x}") for x in ("landing", "sessions", "ckpt"))
    columns = dict(gap_seconds=gap, delay_seconds=delay)
    for batch in batches:  # the query ends after each batch and is started again
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
        start_session_stream(spark, landing, out, checkpoint, **columns).awaitTermination()
    written = spark.read.parquet(out)
    got = [tuple(r) for r in written.union(open_sessions(spark, checkpoint)).collect()]
    assert sorted(got, key=str) == sessions_of(batches, gap, delay)
    kinds = {r.kind for r in written.collect()}
    assert kinds == {"session", "late", "unplaced"}
    assert sum(r[4] for r in got) == len(everything)


def multiset(df):
    counts = {}
    for r in df.collect():
        counts[str(tuple(r))] = counts.get(str(tuple(r)), 0) + 1
    return counts


def test_multiset_difference(spark):
    a, b = payments(120, 1, 500), payments(120, 1, 500)[:90] + payments(60, 2, 500)
    a, b = a + a[:7] + [("N", None, float("nan"), None, True)] * 3, b + [("N", None, float("nan"), None, True)]
    before, after = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    got = {str(tuple(r)[:-1]): r.n_change for r in multiset_difference(before, after.select(*reversed(after.columns))).select(*before.columns, "n_change").collect()}
    x, y = multiset(before), multiset(after)
    assert got == {k: y.get(k, 0) - x.get(k, 0) for k in x.keys() | y.keys() if y.get(k, 0) != x.get(k, 0)}
    assert sum(v for v in got.values() if v > 0) == after.exceptAll(before).count()
    assert multiset_difference(before, before).count() == 0 and multiset_difference(before.limit(0), before.limit(0)).count() == 0
    with pytest.raises(ValueError):
        multiset_difference(before, after.drop("amount"))


def files_of(path):
    path = path.removeprefix("file:")
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_changes_touch_only_their_partitions(spark):
    day = lambda rows: spark.createDataFrame(rows, SCHEMA).withColumn("day", F.dayofmonth("timestamp"))
    old = payments(300, 4, 86_400 * 6)
    new = [r for r in old if not (r[1] and r[1].day == 3)] + old[:2] + [("Z", dt.datetime(2024, 3, 20), 1.0, "USD", True)] * 2
    new = [(*r[:2], -9.0, *r[3:]) if r[1] and r[1].day == 5 else r for r in new]
    path = scratch_path(spark, "t-table")
    day(old).repartition("day").write.partitionBy("day").parquet(path)
    files = files_of(path)
    changes = multiset_difference(day(old), day(new))
    touched = {r["day"] for r in apply_changes(spark, path, changes, ["day"])}
    assert {3, 5, 20} <= touched and len(touched) < 8
    after = files_of(path)
    folders = {f"day={'__HIVE_DEFAULT_PARTITION__' if d is None else d}" for d in touched}
    kept = {f for f in files if f.split("/")[0] not in folders}
    assert kept and {f: after.get(f) for f in kept} == {f: files[f] for f in kept}
    assert not any(f.startswith("day=3/") for f in after) and any(f.startswith("day=20/") for f in after)
    table = spark.read.schema(day(new).schema).parquet(path).select(*day(new).columns)
    assert multiset(table) == multiset(day(new))
    assert apply_changes(spark, path, multiset_difference(day(new), day(new)), ["day"]) == []


def test_merged_states_equal_direct_figures(spark):
    rnd = random.Random(9)
    rows = [(f"S{rnd.randrange(700)}", START + dt.timedelta(days=rnd.randrange(70), seconds=rnd.randrange(86_400)),
             rnd.choice([None, float("nan"), round(rnd.uniform(0, 1e6), 2), 1e9 + round(rnd.random(), 2)]), rnd.choice(["USD", "EUR", None]), rnd.random() < 0.95)
            for _ in range(6_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    path = scratch_path(spark, "t-states")
    daily_states(df).write.parquet(path)
    states = spark.read.parquet(path)
    for by, key in (((F.trunc("date", "month").alias("month"), "currency"), lambda r: (r[1].date().replace(day=1), r[3])), ((), lambda r: ())):
        got = {tuple(r[c] for c in ("month", "currency") if by): r for r in state_figures(merge_states(states, *by)).collect()}
        groups = {}
        for r in rows:
            if r[4]:
                groups.setdefault(key(r), []).append(r)
        assert got.keys() == groups.keys()
        for k, members in groups.items():
            amounts = sorted(r[2] for r in members if r[2] is not None and r[2] == r[2])
            mean = sum(amounts) / len(amounts)
            deviation = (sum((a - mean) ** 2 for a in amounts) / (len(amounts) - 1)) ** 0.5
            r = got[k]
            assert (r.transaction_count, r.min_amount, r.max_amount) == (len(members), amounts[0], amounts[-1])
            assert r.total_volume == pytest.approx(sum(amounts), rel=1e-12) and r.avg_amount == pytest.approx(mean, rel=1e-9)
            assert r.stddev_amount == pytest.approx(deviation, rel=1e-9)
            senders = len({m[0] for m in members})
            assert abs(r.senders_estimate - senders) <= 4 * 1.04 / 64 * senders + 1
            for q, value in ((0.5, r.amount_p50), (0.95, r.amount_p95)):
                ranks = [i / len(amounts) for i, a in enumerate(amounts) if a == value]
                assert ranks and min(abs(x - q) for x in ranks) < 0.04
    assert merge_states(daily_states(df.limit(0)), "currency").count() == 0
