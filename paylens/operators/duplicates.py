"""Payments sent again: equal payments close in time, and the one of each run to keep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylens.operators.buckets import MAX_ROWS, ordered_buckets

#: What makes two payments equal.
SAME = ("sender_bic", "receiver_bic", "amount", "currency")


def near_in_time_duplicates(
    df: DataFrame, gap_seconds: int = 3600, same: Sequence[str] = SAME, time: str = "timestamp", max_rows: int = MAX_ROWS
) -> DataFrame:
    """``df`` plus ``run_start``, ``run_position`` and ``is_duplicate``.

    Payments equal in ``same`` form a run as long as each follows the one
    before within ``gap_seconds``; a longer gap starts the next run. The first
    of a run (ties in time: by the remaining columns in order) is the original,
    position 1; the others are duplicates. ``run_start`` is its time.

    A row with a null in ``same`` or ``time`` is no duplicate: it is a run of its
    own. NaN equals NaN, 0.0 equals -0.0. Identical rows are interchangeable.
    An empty table gives an empty result. More than ``max_rows`` equal payments
    (a hot group) are cut into buckets; what a bucket needs from those before
    is the last time, the start of the run and the position in it.
    """
    columns = list(df.columns)
    order = [time, *[c for c in columns if c != time and c not in same]]
    known = F.col(time).isNotNull()
    for c in same:
        known = known & F.col(c).isNotNull()
    bucketed = ordered_buckets(df.filter(known), same, order, max_rows, name="d_bucket")
    lone = df.filter(~known).select(*columns, F.col(time).alias("run_start"), F.lit(1).cast("long").alias("run_position"), F.lit(False).alias("is_duplicate"))
    return _whole_groups(bucketed.filter("d_bucket = 0"), columns, order, gap_seconds, same, time).union(
        _cut_groups(bucketed.filter("d_bucket > 0"), columns, order, gap_seconds, same, time)).union(lone)


def _whole_groups(rows: DataFrame, columns: list[str], order: list[str], gap_seconds: int, same: Sequence[str], time: str) -> DataFrame:
    """Groups in one bucket: one window over each."""
    inside = Window.partitionBy(*same).orderBy(*[F.asc_nulls_first(c) for c in order])
    previous = F.lag(time).over(inside)
    starts = previous.isNull() | (F.unix_micros(time) - F.unix_micros(previous) > gap_seconds * 1_000_000)
    marked = rows.withColumn("d_starts", starts).withColumn("d_number", F.row_number().over(inside))
    first = F.when(F.col("d_starts"), F.struct(F.col(time).alias("at"), F.col("d_number").alias("number")))
    marked = marked.withColumn("d_run", F.last(first, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.select(
        *columns, F.col("d_run.at").alias("run_start"),
        (F.col("d_number") - F.col("d_run.number") + 1).cast("long").alias("run_position"), (~F.col("d_starts")).alias("is_duplicate"))


def _cut_groups(rows: DataFrame, columns: list[str], order: list[str], gap_seconds: int, same: Sequence[str], time: str) -> DataFrame:
    """Hot groups: a window over each bucket, and what it needs from those before."""
    group = [*same, "d_bucket"]
    inside = Window.partitionBy(*group).orderBy(*[F.asc_nulls_first(c) for c in order])
    edges = rows.groupBy(*group).agg(F.max(time).alias("e_last"))
    before = Window.partitionBy(*same).orderBy("d_bucket").rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(*[F.col(c).alias(f"e_{i}") for i, c in enumerate(group)], F.max("e_last").over(before).alias("e_before"))
    alike = F.lit(True)
    for i, c in enumerate(group):
        alike = alike & (F.col(c) == F.col(f"e_{i}"))
    linked = rows.join(edges, alike)
    previous = F.coalesce(F.lag(time).over(inside), F.col("e_before"))
    starts = previous.isNull() | (F.unix_micros(time) - F.unix_micros(previous) > gap_seconds * 1_000_000)
    marked = linked.withColumn("d_starts", starts)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    # numbers within the bucket: of the row, and of the row that started its run there
    marked = marked.withColumn("d_number", F.row_number().over(inside))
    marked = marked.withColumn("d_first", F.last(F.when(F.col("d_starts"), F.struct(F.col(time).alias("at"), F.col("d_number").alias("number"))), ignorenulls=True).over(upto))
    ends = marked.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.max("d_first").alias("open"))
    # the run open at a bucket's end: started in it, or carried through it
    carry = Window.partitionBy(*same).orderBy("d_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counted = ends.withColumn("c_rows", F.coalesce(F.sum("n").over(carry), F.lit(0)))
    opened = F.when(F.col("open").isNotNull(), F.struct(F.col("open.at").alias("at"), (F.col("c_rows") + F.col("open.number")).alias("number")))
    carried = counted.select(*[F.col(c).alias(f"c_{i}") for i, c in enumerate(group)], "c_rows", F.last(opened, ignorenulls=True).over(carry).alias("c_open"))
    alike = F.lit(True)
    for i, c in enumerate(group):
        alike = alike & (F.col(c) == F.col(f"c_{i}"))
    own = F.when(F.col("d_first").isNotNull(), F.struct(F.col("d_first.at").alias("at"), (F.col("c_rows") + F.col("d_first.number")).alias("number")))
    whole = marked.join(carried, alike).withColumn("d_run", F.coalesce(own, F.col("c_open")))
    return whole.select(
        *columns, F.col("d_run.at").alias("run_start"),
        (F.col("c_rows") + F.col("d_number") - F.col("d_run.number") + 1).cast("long").alias("run_position"), (~F.col("d_starts")).alias("is_duplicate"))


def without_duplicates(df: DataFrame, gap_seconds: int = 3600, same: Sequence[str] = SAME, time: str = "timestamp") -> DataFrame:
    """The originals only: the first payment of every run."""
    return near_in_time_duplicates(df, gap_seconds, same, time).filter(~F.col("is_duplicate")).select(*df.columns)
