"""Mergeable aggregate states: figures of any period from stored days, without the payments.

A state holds the count, mean and second moment of the amounts, their least and
greatest, their exact total, a HyperLogLog sketch of the senders and a KLL
sketch of the amounts. States of days are written once; those of a month, a
quarter or any other period come from merging them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.operators.rollups import valid_only
from paylens.operators.velocity import EXACT

#: Sizes of the sketches: 2 ** LG_K registers (relative standard error 1.04 / sqrt of that), and KLL's k (rank error about 1.3 %).
LG_K, KLL_K = 12, 200


def daily_states(df: DataFrame, keys: tuple[str, ...] = ("currency",), party: str = "sender_bic") -> DataFrame:
    """One state per day and ``keys`` of the valid payments: ``date``, the keys, and the columns of a state.

    Null and NaN amounts count in ``payments`` but in no figure of the amounts
    (``n`` is how many have one); null parties are no sender. Days of payments
    without a time are null. An amount beyond ``decimal(38,6)`` makes the total null.
    """
    amount = F.when(~F.isnan("amount"), F.col("amount"))
    n = F.count(amount)
    return (
        valid_only(df)
        .groupBy(F.to_date("timestamp").alias("date"), *keys)
        .agg(
            F.count(F.lit(1)).alias("payments"),
            n.alias("n"),
            F.avg(amount).alias("mean"),
            (F.var_pop(amount) * n).alias("m2"),
            F.min(amount).alias("low"),
            F.max(amount).alias("high"),
            F.sum(amount.try_cast(EXACT)).cast(EXACT).alias("total"),
            F.count_if(amount.isNotNull() & amount.try_cast(EXACT).isNull()).alias("beyond"),
            F.hll_sketch_agg(party, LG_K).alias("senders"),
            F.kll_sketch_agg_double(amount, KLL_K).alias("amounts"),
        )
    )


def merge_states(states: DataFrame, *by: Column | str) -> DataFrame:
    """States of the groups ``by`` (expressions over the states' columns; none: of all), merged from smaller ones.

    Second moments are merged around the common mean, which is made first, so
    no digits are lost to a difference of large squares.
    """
    named = states.select("*", *[(F.col(b) if isinstance(b, str) else b).alias(f"_by{i}") for i, b in enumerate(by)])
    groups = [f"_by{i}" for i in range(len(by))]
    names = states.select(*by).columns if by else []
    means = named.groupBy(*groups).agg((F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("_mean"))
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"m{g}"))
    means = means.select(*[F.col(g).alias(f"m{g}") for g in groups], "_mean")
    merged = named.join(means, same).groupBy(*groups).agg(
        F.sum("payments").alias("payments"),
        F.sum("n").alias("n"),
        F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) * (F.col("mean") - F.col("_mean"))).alias("m2"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("total").cast(EXACT).alias("total"),
        F.sum("beyond").alias("beyond"),
        F.hll_union_agg("senders").alias("senders"),
        F.kll_merge_agg_double("amounts").alias("amounts"),
    )
    return merged.select(*[F.col(g).alias(name) for g, name in zip(groups, names)], *merged.columns[len(groups):])


def state_figures(states: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """What states say: count, total, mean, sample deviation, extremes; estimates of distinct senders and of quantiles."""
    own = {"payments", "n", "mean", "m2", "low", "high", "total", "beyond", "senders", "amounts"}
    return states.select(
        *[c for c in states.columns if c not in own],
        F.col("payments").alias("transaction_count"),
        F.when(F.col("beyond") == 0, F.col("total").cast("double")).alias("total_volume"),
        F.col("mean").alias("avg_amount"),
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("stddev_amount"),
        F.col("low").alias("min_amount"),
        F.col("high").alias("max_amount"),
        F.hll_sketch_estimate("senders").alias("senders_estimate"),
        *[F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("amounts", F.lit(q))).alias(f"amount_p{round(q * 100)}") for q in quantiles],
    )
