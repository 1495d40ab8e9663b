"""Statistical amount anomalies (z-score against all valid payments)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.config import ANOMALY_SIGMAS
from paylens.functions.stats import money_avg, money_stddev
from paylens.operators.rollups import valid_only

#: The result table's columns.
ANOMALY_COLUMNS = (
    "timestamp", "sender_bic", "receiver_bic", "amount", "currency",
    "z_score", "is_high_value_anomaly", "is_statistical_anomaly", "is_high_value",
)


def amount_stats(df: DataFrame) -> DataFrame:
    """One row: ``mean_amount`` and sample ``std_amount`` of valid payments.

    NaN amounts are left out: one of them would make every score NaN, and NaN
    counts as larger than anything, so every payment would be flagged.
    """
    known = valid_only(df).filter(~F.isnan("amount"))
    return known.agg(money_avg("amount").alias("mean_amount"), money_stddev("amount").alias("std_amount"))


def score_amounts(df: DataFrame, sigmas: float = ANOMALY_SIGMAS, stats: tuple[float, float] | None = None) -> DataFrame:
    """Valid rows with ``z_score`` and the two statistical flags.

    Without ``stats`` (mean, std) they enter as one scalar subquery (a one-row
    aggregate the engine evaluates once and inlines), not as a driver round
    trip or a join; with them the input is read only once. A zero or undefined
    std gives a NULL ``z_score`` instead of an error. A NaN amount has a NaN
    score and is flagged itself.
    """
    valid = valid_only(df)
    if stats is None:
        one = amount_stats(df).select(F.struct("mean_amount", "std_amount").alias("s")).scalar()
        mean, std = one.getField("mean_amount"), one.getField("std_amount")
    else:
        mean, std = (F.lit(x).cast("double") for x in stats)
    z = F.try_divide(F.col("amount") - mean, std)
    return valid.withColumns({
        "z_score": z,
        "is_high_value_anomaly": F.col("amount") > mean + sigmas * std,
        "is_statistical_anomaly": F.abs(z) > sigmas,
    })


def detect_anomalies(
    df: DataFrame, sigmas: float = ANOMALY_SIGMAS, stats: tuple[float, float] | None = None, ordered: bool = True
) -> DataFrame:
    """Valid payments that are high value or more than ``sigmas`` std from the mean.

    Sorted by ``z_score`` descending (NULL last), ties by the payment fields so
    the order is total; not sorted without ``ordered``, for writing a table:
    a global sort reads its input a second time to sample its ranges.
    """
    scored = score_amounts(df, sigmas, stats)
    flagged = scored.where(
        F.coalesce(F.col("is_high_value_anomaly"), F.lit(False))
        | F.coalesce(F.col("is_statistical_anomaly"), F.lit(False))
        | F.coalesce(F.col("is_high_value"), F.lit(False))
    ).select(*ANOMALY_COLUMNS)
    if not ordered:
        return flagged
    return flagged.orderBy(F.desc_nulls_last("z_score"), "timestamp", "sender_bic", "receiver_bic", "amount", "currency")
