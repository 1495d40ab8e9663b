"""Per-sender sequence numbers (``row_number`` by time) that survive skew.

``row_number() OVER (PARTITION BY sender ORDER BY timestamp)`` as a plain
window puts every row of a sender into one task. Here rows are numbered inside
(sender, bucket), and the buckets' row counts, summed in order, give each
bucket's offset within its sender: one row per sender and bucket, so the
window over them is small. Everything is lazy and stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.operators.buckets import MAX_ROWS, ordered_buckets


def sender_sequence(
    df: DataFrame,
    partition_col: str = "sender_bic",
    order_by: Sequence[str] = ("timestamp",),
    out_col: str = "row_num",
    bucket: str | Column | None = None,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """``df`` plus ``out_col`` = 1-based position of the row within its ``partition_col``.

    A sender with more than ``max_rows`` rows is cut at the quantiles of its
    own times (many rows of one time, or without one: of the next column), see
    :func:`~paylens.operators.buckets.ordered_buckets`. ``bucket`` replaces
    this, and the passes that count and measure, where the caller knows
    better: a ``date_trunc`` unit of the first order column, or a column that
    never falls as that one rises. NULL times come first.

    Ties beyond ``order_by`` are broken by the remaining columns in DataFrame
    order (ascending, NULLs first). Identical rows are interchangeable.
    """
    cols = list(df.columns)
    order = [*order_by, *[c for c in cols if c != partition_col and c not in order_by]]
    if bucket is None:
        rows = ordered_buckets(df, [partition_col], order, max_rows, name="_bucket")
        bucket = F.col("_bucket")
    else:
        rows = df
        if isinstance(bucket, str):
            kind = df.schema[order_by[0]].dataType
            if not isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
                raise ValueError(f"{order_by[0]} is no time: give bucket as a column")
            bucket = F.date_trunc(bucket, F.col(order_by[0]))
    rows = rows.select(F.struct(*cols).alias("row"), F.col(partition_col).alias("party"), bucket.alias("bucket"))
    inside = Window.partitionBy("party", "bucket").orderBy(*[F.asc_nulls_first(f"row.{c}") for c in order])
    earlier = Window.partitionBy("o_party").orderBy(F.asc_nulls_first("o_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(F.col("party").alias("o_party"), F.col("bucket").alias("o_bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("o_party", "o_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    numbered = rows.withColumn("number", F.row_number().over(inside))
    same = F.col("party").eqNullSafe(F.col("o_party")) & F.col("bucket").eqNullSafe(F.col("o_bucket"))
    return numbered.join(offsets, same).select("row.*", (F.col("before") + F.col("number")).alias(out_col))
