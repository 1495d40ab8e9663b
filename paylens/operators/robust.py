"""Exact medians and median absolute deviations per group, and the anomalies that they show.

A quantile is looked up in two passes: a summary per group gives a narrow
bracket around the wanted rank, counts below, in and above it say which of the
three the rank lies in, and only the distinct values there are sorted. No
group is shuffled or sorted as a whole, however large, and the result is exact
even where a bracket misses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylens.operators.buckets import ACCURACY, MAX_ROWS
from paylens.operators.rollups import valid_only

#: Scores beyond this are anomalies; SCALE makes the deviation of normal amounts comparable to a standard deviation.
CUTOFF, SCALE = 3.5, 0.6745


def group_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float = 0.5, max_rows: int = MAX_ROWS, name: str = "quantile") -> DataFrame:
    """Per ``keys``: ``n`` (values) and ``name``, the exact quantile with linear interpolation between ranks.

    Null and NaN values don't count; groups without a value have no row. Null
    keys are a group. Lazy.
    """
    if not 0 <= q <= 1:
        raise ValueError("q must be from 0 to 1")
    given = df.filter(F.col(value).isNotNull() & ~F.isnan(value)).select(*keys, F.col(value).cast("double").alias("q_value"))
    named = [f"q_{i}" for i in range(len(keys))]
    same = F.lit(True)
    for k, k_named in zip(keys, named):
        same = same & F.col(k).eqNullSafe(F.col(k_named))
    # twice the summary's error to both sides; groups of up to max_rows values stay whole
    ends = [max(q - 2 / ACCURACY, 0.0), min(q + 2 / ACCURACY, 1.0)]
    brackets = given.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, named)]).agg(
        F.count(F.lit(1)).alias("q_total"), F.percentile_approx("q_value", ends, ACCURACY).alias("q_ends"))
    cut = F.col("q_total") > max_rows
    brackets = brackets.select(
        *named, "q_total", (F.lit(q) * (F.col("q_total") - 1)).alias("q_at"),
        F.when(cut, F.col("q_ends")[0]).alias("q_from"), F.when(cut, F.col("q_ends")[1]).alias("q_to"))
    side = F.coalesce((F.col("q_value") > F.col("q_from")).cast("int") + (F.col("q_value") > F.col("q_to")).cast("int"), F.lit(0))
    placed = given.join(brackets, same).withColumn("q_bucket", side)
    sizes = placed.groupBy(*keys, "q_bucket", "q_total", "q_at").agg(F.count(F.lit(1)).alias("q_size"))
    upto = Window.partitionBy(*keys).orderBy("q_bucket").rowsBetween(Window.unboundedPreceding, 0)
    sizes = sizes.select(
        *[F.col(k).alias(n) for k, n in zip(keys, named)], F.col("q_bucket").alias("s_bucket"), "q_total", "q_at",
        (F.sum("q_size").over(upto) - F.col("q_size")).alias("q_start"), F.sum("q_size").over(upto).alias("q_end"))
    low, high = F.floor("q_at"), F.ceil("q_at")
    wanted = sizes.filter((F.col("q_end") > low) & (F.col("q_start") <= high))
    placed = placed.drop(*named, "q_total", "q_at")
    counted = placed.join(wanted, same & (F.col("q_bucket") == F.col("s_bucket"))).groupBy(*keys, "q_bucket", "q_start", "q_total", "q_at", "q_value").agg(F.count(F.lit(1)).alias("q_n"))
    inside = Window.partitionBy(*keys, "q_bucket").orderBy("q_value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("q_upto", F.col("q_start") + F.sum("q_n").over(inside))

    def value_at(rank):
        return F.max(F.when((F.col("q_upto") - F.col("q_n") <= rank) & (rank < F.col("q_upto")), F.col("q_value")))

    found = ranked.groupBy(*keys).agg(
        F.first("q_total").alias("n"), value_at(low).alias("q_low"), value_at(high).alias("q_high"), F.first("q_at").alias("q_at"))
    between = F.col("q_low") + (F.col("q_high") - F.col("q_low")) * (F.col("q_at") - low)
    return found.select(*keys, "n", F.when(F.col("q_low") == F.col("q_high"), F.col("q_low")).otherwise(between).alias(name))


def robust_statistics(df: DataFrame, keys: Sequence[str] = ("currency",), max_rows: int = MAX_ROWS) -> DataFrame:
    """Per ``keys`` of the valid payments: ``n``, ``median_amount`` and ``mad_amount`` (median absolute deviation from it)."""
    valid = valid_only(df).select(*keys, "amount")
    medians = group_quantile(valid, keys, "amount", 0.5, max_rows, "median_amount")
    named = medians.select(*[F.col(k).alias(f"m_{i}") for i, k in enumerate(keys)], "median_amount")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"m_{i}"))
    off = valid.join(named, same).select(*keys, "median_amount", F.abs(F.col("amount") - F.col("median_amount")).alias("off"))
    return group_quantile(off, [*keys, "median_amount"], "off", 0.5, max_rows, "mad_amount").select(*keys, "n", "median_amount", "mad_amount")


def robust_anomalies(df: DataFrame, keys: Sequence[str] = ("currency",), cutoff: float = CUTOFF, max_rows: int = MAX_ROWS) -> DataFrame:
    """The valid payments whose amount is far from the median of their ``keys``, with ``robust_score``.

    The score is 0.6745 times the distance from the median in median absolute
    deviations. Where that deviation is 0 there is no score and no anomaly;
    null and NaN amounts have no score. An empty table gives an empty result.
    """
    statistics = robust_statistics(df, keys, max_rows)
    statistics = statistics.select(*[F.col(k).alias(f"r_{i}") for i, k in enumerate(keys)], "median_amount", "mad_amount")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"r_{i}"))
    score = F.try_divide(F.lit(SCALE) * (F.col("amount") - F.col("median_amount")), F.col("mad_amount"))
    scored = valid_only(df).join(statistics, same).withColumn("robust_score", score)
    return scored.filter((F.abs("robust_score") > cutoff) & ~F.isnan("amount")).select(*df.columns, "median_amount", "mad_amount", "robust_score")
