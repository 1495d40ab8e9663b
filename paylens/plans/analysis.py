"""Analysis job: processed Parquet -> five result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylens.config import ANALYSIS_TABLES, TOP_PARTIES
from paylens.operators.anomaly import detect_anomalies
from paylens.operators.rollups import country_statistics, daily_volumes, top_parties
from paylens.sinks.writers import write_results
from paylens.sources.payments import read_processed


def analysis_results(
    df: DataFrame, top_k: int = TOP_PARTIES, stats: tuple[float, float] | None = None, ordered: bool = True
) -> dict[str, DataFrame]:
    """The five analyses as lazy DataFrames, keyed by result table name."""
    results = {
        "daily_volumes": daily_volumes(df),
        "top_senders": top_parties(df, "sender", top_k),
        "top_receivers": top_parties(df, "receiver", top_k),
        "country_statistics": country_statistics(df),
        "fraud_anomalies": detect_anomalies(df, stats=stats, ordered=ordered),
    }
    return {name: results[name] for name in ANALYSIS_TABLES}


def run_analysis(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    parallel: int = len(ANALYSIS_TABLES),
    stats: tuple[float, float] | None = None,
) -> dict[str, str]:
    """Read processed payments, write the five tables under ``output_path``.

    One write per table, nothing else: each write scans only the columns it
    needs with ``is_valid`` pushed into the Parquet reader. The five writes
    are independent jobs and are submitted together (``parallel``). With
    ``stats`` (mean and standard deviation of the valid amounts, from the
    ingest's overall aggregates) the anomaly table needs one pass, else two.
    """
    df = read_processed(spark, input_path)
    paths = write_results(analysis_results(df, stats=stats, ordered=False), output_path, parallel=parallel)
    return dict(zip(ANALYSIS_TABLES, paths))
