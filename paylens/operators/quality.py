"""Data-quality report: thirteen metrics from one aggregate over all rows."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.config import QUALITY_REPORT_KEYS

N_CHECKS = 7
DERIVED_KEYS = ("invalid_records", "validity_rate", "avg_quality_score")
COUNT_KEYS = tuple(k for k in QUALITY_REPORT_KEYS if k not in DERIVED_KEYS)


def quality_metric_columns() -> list[Column]:
    """Partial-aggregatable metrics; also usable with ``DataFrame.observe``."""
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("is_valid")).alias("valid_records"),
        F.count_if(F.col("has_nulls")).alias("null_count"),
        F.count_if(~F.col("is_amount_valid")).alias("invalid_amount_count"),
        F.count_if(~F.col("is_sender_bic_valid")).alias("invalid_sender_bic_count"),
        F.count_if(~F.col("is_receiver_bic_valid")).alias("invalid_receiver_bic_count"),
        F.count_if(~F.col("is_currency_valid")).alias("invalid_currency_count"),
        F.count_if(~F.col("is_msg_type_valid")).alias("invalid_msg_type_count"),
        F.count_if(~F.col("is_timestamp_valid")).alias("future_timestamp_count"),
        F.count_if(F.col("is_high_value")).alias("high_value_count"),
        F.sum(F.round(F.col("quality_score") * N_CHECKS).cast("bigint")).alias("_score_points"),
        F.count("quality_score").alias("_scored_rows"),
    ]


def _finish(m: DataFrame) -> DataFrame:
    total, valid = F.col("total_records"), F.col("valid_records")
    avg_score = F.try_divide(F.col("_score_points").cast("double"), F.col("_scored_rows").cast("double") * float(N_CHECKS))
    derived = {
        "invalid_records": total - valid,
        "validity_rate": F.when(total > 0, valid.cast("double") / total.cast("double")).otherwise(F.lit(0.0)),
        # NULL (no scored row) or 0 is reported as 0.0.
        "avg_quality_score": F.coalesce(avg_score.cast("double"), F.lit(0.0)),
    }
    return m.withColumns(derived).select(*QUALITY_REPORT_KEYS)


def quality_report(df: DataFrame) -> DataFrame:
    """One-row DataFrame with the 13 report metrics, in report order.

    Counters use the negated flag, so a NULL flag is not counted by its own
    counter (a NULL message type is counted nowhere). The average score comes
    from the integer number of passed checks, so it has no rounding drift.
    """
    return _finish(df.agg(*quality_metric_columns()))


def report_from_metrics(metrics: dict[str, Any]) -> dict[str, Any]:
    """Turn observed raw metrics (``quality_metric_columns``) into the report dict."""
    total = int(metrics.get("total_records") or 0)
    valid = int(metrics.get("valid_records") or 0)
    scored = metrics.get("_scored_rows") or 0
    avg = (metrics.get("_score_points") or 0) / (scored * N_CHECKS) if scored else None
    out = {k: int(metrics.get(k) or 0) for k in COUNT_KEYS}
    out.update(
        invalid_records=total - valid,
        validity_rate=valid / total if total > 0 else 0,
        avg_quality_score=float(avg) if avg else 0.0,
    )
    return {k: out[k] for k in QUALITY_REPORT_KEYS}


def quality_report_dict(df: DataFrame) -> dict[str, Any]:
    """The report as a Python dict (one action, one row to the driver)."""
    row = quality_report(df).first()
    report = row.asDict()
    if not report["total_records"]:
        report["validity_rate"] = 0  # the original reports an int 0 for empty input
    return report
