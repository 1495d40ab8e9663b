"""Sender velocity: what a sender paid in the time up to each payment.

A payment enters its sender's window when it happens and leaves it a moment
after the window's length has passed, so the figures at any time are running
sums over entries and departures in time order. Running sums split anywhere:
a hot sender's events are cut into buckets, and each bucket starts from the
sums of those before it. No frame is ever scanned, so the cost doesn't depend
on how many payments a window holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylens.operators.buckets import MAX_ROWS, ordered_buckets

#: Sums are exact in this type: millionths of a currency unit.
EXACT = "decimal(38,6)"


def sender_velocity(
    df: DataFrame,
    window_seconds: int = 3600,
    party: str = "sender_bic",
    time: str = "timestamp",
    amount: str = "amount",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """``df`` plus ``velocity_count``, ``velocity_sum`` and ``seconds_since_previous``.

    Count and sum are over the party's payments from ``window_seconds`` before
    the payment to its own time, both included, itself and others of the same
    time too. The last is the time since the party's latest payment at an
    earlier time; null for its first. ``time`` is a ``timestamp``.

    A null party or time has null figures. A null amount counts and adds
    nothing; a NaN, an infinity, or an amount beyond ``decimal(38,6)`` makes
    the sums of the windows it lies in NaN. Repeated rows count each. An empty
    table gives an empty result. No (party, bucket) of the running sums holds
    many more than ``max_rows`` times of payments, however hot the party.
    """
    if window_seconds <= 0:
        raise ValueError("window_seconds must be positive")
    exact = F.col(amount).try_cast(EXACT)
    known = F.col(party).isNotNull() & F.col(time).isNotNull()
    # one row per party and time, so that many payments of one time are one event
    moments = (
        df.filter(known).groupBy(F.col(party).alias("v_party"), F.col(time).alias("v_time"))
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(exact), F.lit(0)).cast(EXACT).alias("total"),
             F.count_if(F.col(amount).isNotNull() & exact.isNull()).alias("odd"))
    )
    at = F.unix_micros("v_time")
    enter = moments.select("v_party", at.alias("at"), F.lit(0).alias("leaves"), "n", "total", "odd")
    leave = moments.select("v_party", (at + window_seconds * 1_000_000).alias("at"), F.lit(1).alias("leaves"),
                           (-F.col("n")).alias("n"), (-F.col("total")).cast(EXACT).alias("total"), (-F.col("odd")).alias("odd"))
    events = ordered_buckets(enter.union(leave), ["v_party"], ["at"], max_rows, name="bucket")
    entered = F.when(F.col("leaves") == 0, F.col("at"))
    per_bucket = events.groupBy(F.col("v_party").alias("b_party"), F.col("bucket").alias("b_bucket")).agg(
        F.sum("n").alias("n"), F.sum("total").cast(EXACT).alias("total"), F.sum("odd").alias("odd"), F.max(entered).alias("latest"))
    before = Window.partitionBy("b_party").orderBy("b_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_bucket.select(
        "b_party", "b_bucket", F.sum("n").over(before).alias("b_n"), F.sum("total").over(before).alias("b_total"),
        F.sum("odd").over(before).alias("b_odd"), F.max("latest").over(before).alias("b_latest"))
    upto = Window.partitionBy("v_party", "bucket").orderBy("at", "leaves").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("v_party", "bucket").orderBy("at", "leaves").rowsBetween(Window.unboundedPreceding, -1)
    running = events.select(
        "v_party", "bucket", "at", "leaves", F.sum("n").over(upto).alias("n"), F.sum("total").over(upto).alias("total"),
        F.sum("odd").over(upto).alias("odd"), F.max(entered).over(earlier).alias("latest")).filter("leaves = 0")
    zero = F.lit(0)
    figures = running.join(carried, (F.col("v_party") == F.col("b_party")) & (F.col("bucket") == F.col("b_bucket"))).select(
        "v_party", F.timestamp_micros("at").alias("v_time"),
        (F.col("n") + F.coalesce("b_n", zero)).cast("long").alias("velocity_count"),
        F.when(F.col("odd") + F.coalesce("b_odd", zero) > 0, F.lit(float("nan")))
        .otherwise((F.col("total") + F.coalesce("b_total", zero.cast(EXACT))).cast("double")).alias("velocity_sum"),
        ((F.col("at") - F.coalesce("latest", "b_latest")) / 1e6).alias("seconds_since_previous"),
    )
    columns = [F.col(c) for c in df.columns]
    added = ["velocity_count", "velocity_sum", "seconds_since_previous"]
    found = df.filter(known).join(figures, (F.col(party) == F.col("v_party")) & (F.col(time) == F.col("v_time"))).select(*columns, *added)
    kinds = {f.name: f.dataType for f in found.schema.fields}
    return found.union(df.filter(~known).select(*columns, *[F.lit(None).cast(kinds[a]).alias(a) for a in added]))
