"""Grouped statistics over valid payments.

Every operator filters ``is_valid`` itself (so the filter reaches the Parquet
scan as a pushed predicate) and returns a lazy DataFrame. All groupings are
hash aggregates with a map-side partial phase, so a hot key (one currency or
sender with a third of all rows) is pre-combined inside each task and only
one partial row per task and key crosses the shuffle.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylens.config import TOP_PARTIES
from paylens.functions.rules import country_of
from paylens.functions.stats import money_avg, money_stddev, money_sum


#: Groups of a breakdown that reach the driver in the summary dicts.
MAX_GROUPS = 1000


def valid_only(df: DataFrame) -> DataFrame:
    """Rows whose ``is_valid`` is true (NULL and false dropped)."""
    return df.where(F.col("is_valid"))


def overall_stats(df: DataFrame) -> DataFrame:
    """One row: count, sum, avg, sample stddev, min and max of valid amounts."""
    return valid_only(df).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        money_sum("amount").alias("total_volume"),
        money_avg("amount").alias("avg_amount"),
        money_stddev("amount").alias("stddev_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )


def by_currency(df: DataFrame) -> DataFrame:
    """Valid payments per currency, most frequent first (ties by code)."""
    return (
        valid_only(df)
        .groupBy("currency")
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            money_sum("amount").alias("total_volume"),
        )
        .orderBy(F.desc("transaction_count"), F.asc("currency"))
    )


def by_msg_type(df: DataFrame) -> DataFrame:
    """Valid payments per message type, most frequent first (ties by type)."""
    return (
        valid_only(df)
        .groupBy("msg_type")
        .agg(F.count(F.lit(1)).alias("transaction_count"))
        .orderBy(F.desc("transaction_count"), F.asc("msg_type"))
    )


def aggregations(df: DataFrame) -> dict[str, DataFrame]:
    """The three aggregate views of the ingest step, still lazy."""
    return {
        "overall": overall_stats(df),
        "by_currency": by_currency(df),
        "by_message_type": by_msg_type(df),
    }


def aggregations_dict(df: DataFrame, max_groups: int = MAX_GROUPS) -> dict[str, Any]:
    """Driver-side summary: the overall row and the ``max_groups`` most frequent currencies and message types.

    NULL or zero overall metrics are reported as 0.0. Currencies of valid rows
    may be arbitrary text (a row that fails one check is still valid), so the
    lists are top-k reports; the full breakdowns are :func:`by_currency` and
    :func:`by_msg_type`.
    """
    return aggregations_from_sets(bounded_sets(aggregation_sets(df), max_groups).collect())


def bounded_sets(sets: DataFrame, max_groups: int = MAX_GROUPS) -> DataFrame:
    """Of :func:`aggregation_sets`, the overall row and the most frequent ``max_groups`` of each breakdown, in one pass over them."""
    best = Window.partitionBy("grouping_set").orderBy(F.desc("transaction_count"), F.asc_nulls_first("currency"), F.asc_nulls_first("msg_type"))
    return sets.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= max_groups).drop("_place")


def daily_volumes(df: DataFrame) -> DataFrame:
    """Per calendar day (session time zone) and currency: count, sum, avg, min, max.

    ``date`` is the payment time truncated to midnight (a timestamp).
    """
    return (
        valid_only(df)
        .groupBy(F.date_trunc("day", F.col("timestamp")).alias("date"), F.col("currency"))
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            money_sum("amount").alias("total_volume"),
            money_avg("amount").alias("avg_amount"),
            F.min("amount").alias("min_amount"),
            F.max("amount").alias("max_amount"),
        )
        .orderBy("date", "currency")
    )


def top_parties(df: DataFrame, party: str = "sender", k: int = TOP_PARTIES) -> DataFrame:
    """The ``k`` BICs with most valid payments as ``party`` ("sender"/"receiver").

    Ties on the count are broken by BIC so the cut is deterministic. Planned
    as a partial/final aggregate followed by TakeOrderedAndProject: each task
    keeps only its local top ``k``, nothing is globally sorted.
    """
    if party not in ("sender", "receiver"):
        raise ValueError(f"party must be 'sender' or 'receiver', not {party!r}")
    bic = f"{party}_bic"
    suffix = "sent" if party == "sender" else "received"
    return (
        valid_only(df)
        .groupBy(bic)
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            money_sum("amount").alias(f"total_{suffix}"),
            money_avg("amount").alias(f"avg_{suffix}"),
        )
        .orderBy(F.desc("transaction_count"), F.asc(bic))
        .limit(k)
    )


def top_senders(df: DataFrame, k: int = TOP_PARTIES) -> DataFrame:
    return top_parties(df, "sender", k)


def top_receivers(df: DataFrame, k: int = TOP_PARTIES) -> DataFrame:
    return top_parties(df, "receiver", k)


def with_countries(df: DataFrame) -> DataFrame:
    """Add ``sender_country`` / ``receiver_country`` (BIC characters 5-6)."""
    return df.withColumns({
        "sender_country": country_of("sender_bic"),
        "receiver_country": country_of("receiver_bic"),
    })


def country_statistics(df: DataFrame) -> DataFrame:
    """Per sender country, receiver country and currency: count, avg, stddev, min, max, sum.

    Most frequent first; ties ordered by the three keys.
    """
    keys = ("sender_country", "receiver_country", "currency")
    return (
        with_countries(valid_only(df))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            money_avg("amount").alias("avg_amount"),
            money_stddev("amount").alias("stddev_amount"),
            F.min("amount").alias("min_amount"),
            F.max("amount").alias("max_amount"),
            money_sum("amount").alias("total_volume"),
        )
        .orderBy(F.desc("transaction_count"), *[F.asc(k) for k in keys])
    )


def aggregation_sets(df: DataFrame) -> DataFrame:
    """Overall, per-currency and per-message-type figures in ONE scan.

    A grouping-sets aggregate over ``()``, ``(currency)`` and ``(msg_type)``;
    ``grouping_set`` tells the rows apart ("overall", "currency",
    "msg_type"), since a NULL key would otherwise be ambiguous.
    """
    gid = F.grouping_id("currency", "msg_type")
    return (
        valid_only(df)
        .groupingSets([[], ["currency"], ["msg_type"]], "currency", "msg_type")
        .agg(
            gid.alias("_gid"),
            F.count(F.lit(1)).alias("transaction_count"),
            money_sum("amount").alias("total_volume"),
            money_avg("amount").alias("avg_amount"),
            money_stddev("amount").alias("stddev_amount"),
            F.min("amount").alias("min_amount"),
            F.max("amount").alias("max_amount"),
        )
        .withColumn(
            "grouping_set",
            F.when(F.col("_gid") == 3, "overall").when(F.col("_gid") == 1, "currency").otherwise("msg_type"),
        )
        .drop("_gid")
    )


def aggregations_from_sets(rows: list) -> dict[str, Any]:
    """Shape collected :func:`aggregation_sets` rows like :func:`aggregations_dict`."""
    def money(v):
        return float(v) if v else 0.0

    overall = next((r for r in rows if r["grouping_set"] == "overall"), None)
    cur = sorted((r for r in rows if r["grouping_set"] == "currency"),
                 key=lambda r: (-r["transaction_count"], r["currency"] is not None, r["currency"] or ""))
    msg = sorted((r for r in rows if r["grouping_set"] == "msg_type"),
                 key=lambda r: (-r["transaction_count"], r["msg_type"] is not None, r["msg_type"] or ""))
    return {
        "overall": {
            "total_transactions": overall["transaction_count"] if overall else 0,
            "total_volume": money(overall and overall["total_volume"]),
            "avg_amount": money(overall and overall["avg_amount"]),
            "stddev_amount": money(overall and overall["stddev_amount"]),
            "min_amount": money(overall and overall["min_amount"]),
            "max_amount": money(overall and overall["max_amount"]),
        },
        "by_currency": [
            {"currency": r["currency"], "transaction_count": r["transaction_count"],
             "total_volume": float(r["total_volume"]) if r["total_volume"] is not None else None}
            for r in cur
        ],
        "by_message_type": [{"msg_type": r["msg_type"], "transaction_count": r["transaction_count"]} for r in msg],
    }
