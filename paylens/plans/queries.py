"""Named queries over the test tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query builds payments from the whole ``lineitem`` table (see
:mod:`paylens.sources.fixture`), runs the library operators and returns the
result of the mode the jobs run. Sums, means and deviations are double, so
their last bits depend on the order in which partial results meet: the final
output gives sums to the cent and means, deviations and scores as ``float``. Timestamps are returned as
``timestamp_ntz`` (wall-clock values), so results do not depend on the
session time zone of whoever collects them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.operators.anomaly import detect_anomalies
from paylens.operators.clean import clean
from paylens.operators.duplicates import near_in_time_duplicates
from paylens.operators.quality import quality_report
from paylens.operators.robust import robust_anomalies, robust_statistics
from paylens.operators.rollups import (
    aggregation_sets,
    by_currency,
    by_msg_type,
    country_statistics,
    daily_volumes,
    overall_stats,
    top_receivers,
    top_senders,
)
from paylens.operators.sequence import sender_sequence
from paylens.operators.snapshots import apply_changes, multiset_difference
from paylens.operators.states import daily_states, merge_states, state_figures
from paylens.operators.temporal_joins import asof_join, interval_join
from paylens.operators.validate import validate
from paylens.operators.velocity import sender_velocity
from paylens.plans.analysis import analysis_results, run_analysis
from paylens.plans.ingest import run_ingest, write_validated
from paylens.sinks.writers import scratch_path, write_csv, write_parquet, write_results
from paylens.sources.fixture import FIXTURE_AS_OF, payment_messages, raw_payments, resent_payments, validated_payments, validity_periods
from paylens.sources.generator import generate_payments
from paylens.sources.messages import accepted, read_messages, rejected
from paylens.sources.payments import read_payments_csv, read_processed
from paylens.streaming.sessions import open_sessions, start_session_stream

Query = Callable[[SparkSession, str], DataFrame]


def wall_clock(df: DataFrame) -> DataFrame:
    """Cast every ``timestamp`` column to ``timestamp_ntz`` (same wall-clock value)."""
    casts = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns(casts) if casts else df


def without_processing_time(df: DataFrame) -> DataFrame:
    return df.drop("processing_timestamp")


def q_parse_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = raw_payments(spark, sf_dir).transform(clean, as_of=FIXTURE_AS_OF)
    return wall_clock(without_processing_time(cleaned))


def q_validate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wall_clock(without_processing_time(validated_payments(spark, sf_dir)))


SUMS = ("total_volume", "total_sent", "total_received")
APPROXIMATE = ("avg_amount", "stddev_amount", "avg_sent", "avg_received", "z_score")


def settled(df: DataFrame) -> DataFrame:
    """Sums to the cent, other aggregates as float: the digits that any order of addition agrees on."""
    casts = {c: F.round(c, 2) for c in SUMS if c in df.columns} | {c: F.col(c).cast("float") for c in APPROXIMATE if c in df.columns}
    return df.withColumns(casts) if casts else df


def q_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(validated_payments(spark, sf_dir))


def q_overall_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(overall_stats(validated_payments(spark, sf_dir)))


def q_by_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(by_currency(validated_payments(spark, sf_dir)))


def q_by_msg_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_msg_type(validated_payments(spark, sf_dir))


def q_aggregation_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(aggregation_sets(validated_payments(spark, sf_dir)))


def q_daily_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(wall_clock(daily_volumes(validated_payments(spark, sf_dir))))


def q_top_senders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(top_senders(validated_payments(spark, sf_dir)))


def q_top_receivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(top_receivers(validated_payments(spark, sf_dir)))


def q_country_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(country_statistics(validated_payments(spark, sf_dir)))


def q_amount_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(wall_clock(detect_anomalies(validated_payments(spark, sf_dir))))


SEQUENCE_COLUMNS = ("sender_bic", "timestamp", "receiver_bic", "amount", "currency", "msg_type")


def valid_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid payments, written and read back: what operators with several passes read in real use."""
    path = scratch_path(spark, "valid")
    validated_payments(spark, sf_dir).where(F.col("is_valid")).select(*SEQUENCE_COLUMNS).write.parquet(path)
    return spark.read.parquet(path)


def q_sender_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wall_clock(sender_sequence(valid_written(spark, sf_dir)))


def q_sender_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per valid payment: its sender's count and sum of the 30 days up to it, and the time since the payment before."""
    figures = sender_velocity(valid_written(spark, sf_dir), window_seconds=30 * 86_400)
    return wall_clock(figures.withColumn("velocity_sum", F.round("velocity_sum", 2)))


def q_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments sent again within an hour of the one before, among valid payments and copies made of some."""
    path = scratch_path(spark, "resent")
    resent_payments(spark, sf_dir).write.parquet(path)
    return wall_clock(near_in_time_duplicates(spark.read.parquet(path), gap_seconds=3600))


def q_events_asof_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event, moved into the years of the orders, with its user's latest order by then."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "user_id", F.timestamp_add("DAY", F.lit(-9500), F.col("ts").cast("timestamp")).alias("at"), "event_type")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderdate").cast("timestamp").alias("o_orderdate"), "o_orderkey", "o_totalprice")
    return wall_clock(asof_join(events, orders, ["user_id"], "at", "o_orderdate"))


def q_payments_in_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every valid payment with every period of its sender that it falls in."""
    payments = valid_written(spark, sf_dir).select("sender_bic", "timestamp", "receiver_bic", "amount", "currency")
    # wall-clock values are made once per payment and period, not once per pair
    wall = {c: F.col(c).cast("timestamp_ntz").alias(f"wall_{c}") for c in ("timestamp", "valid_from", "valid_to")}
    payments, periods = payments.select("*", wall["timestamp"]), validity_periods(spark, sf_dir).select("*", wall["valid_from"], wall["valid_to"])
    found = interval_join(payments, periods, ["sender_bic"], "timestamp", "valid_from", "valid_to")
    columns = ("sender_bic", "timestamp", "receiver_bic", "amount", "currency", "period_id", "valid_from", "valid_to")
    return found.select(*[F.col(f"wall_{c}").alias(c) if c in wall else c for c in columns])


SNAPSHOT_COLUMNS = (*SEQUENCE_COLUMNS, "year")


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A written table of payments, and a later state: some rows gone, some twice, some with another amount."""
    path = scratch_path(spark, "snapshot")
    validated_payments(spark, sf_dir).select(*SNAPSHOT_COLUMNS).write.partitionBy("year").parquet(path)
    before = spark.read.schema("timestamp timestamp, sender_bic string, receiver_bic string, amount double, currency string, msg_type string, year int").parquet(path)
    before.path = path
    cents = F.abs(F.round(F.col("amount") * 100)).cast("long")
    copies = F.when(cents % 11 == 0, 0).when(cents % 13 == 0, 2).otherwise(1)
    after = before.withColumn("copy", F.explode(F.slice(F.array(F.lit(1), F.lit(2)), F.lit(1), copies)))
    after = after.withColumn("amount", F.when(cents % 17 == 0, F.col("amount") + 1).otherwise(F.col("amount")))
    # changes from 1998 on only, so that the folders before stay untouched
    old = before.filter("year < 1998 or year is null")
    return before, after.filter("year >= 1998").select(*before.columns).union(old)


def q_snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows whose number of copies differs between two states of the payments, and by how much."""
    return wall_clock(multiset_difference(*snapshots(spark, sf_dir)))


def q_snapshot_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored payments after the changes between two states were applied to their partitions."""
    before, after = snapshots(spark, sf_dir)
    apply_changes(spark, before.path, multiset_difference(before, after), ["year"])
    return wall_clock(spark.read.schema(before.schema).parquet(before.path))


def q_monthly_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures per month and currency, merged from stored states of days."""
    path = scratch_path(spark, "states")
    daily_states(validated_payments(spark, sf_dir)).write.parquet(path)
    months = merge_states(spark.read.parquet(path), F.date_trunc("month", F.col("date")).cast("timestamp_ntz").alias("month"), "currency")
    return settled(state_figures(months, ()).drop("senders_estimate"))


def q_streamed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sender sessions of the valid payments, streamed in four deliveries with restarts; some payments come one delivery late."""
    rows = valid_written(spark, sf_dir)
    cents = F.abs(F.round(F.col("amount") * 100)).cast("long")
    late = F.coalesce((cents % 40 == 0).cast("int"), F.lit(0))
    delivery = F.coalesce(F.least(F.lit(3), F.greatest(F.lit(0), F.call_function("div", F.year("timestamp") - 1995, F.lit(2)).cast("int") + late)), F.lit(0))
    landing, out, checkpoint = (scratch_path(spark, f"sessions-{x}") for x in ("landing", "out", "state"))
    for k in range(4):
        rows.filter(delivery == k).write.mode("append").parquet(landing)
        start_session_stream(spark, landing, out, checkpoint, gap_seconds=15 * 86_400, delay_seconds=10 * 86_400).awaitTermination()
    found = spark.read.parquet(out).union(open_sessions(spark, checkpoint))
    return wall_clock(found.withColumn("total_amount", F.round("total_amount", 2)))


def q_robust_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_statistics(valid_amounts(spark, sf_dir))


def q_robust_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid payments far from the median of their currency, in median absolute deviations."""
    found = robust_anomalies(valid_amounts(spark, sf_dir)).drop("is_valid")
    return wall_clock(found.withColumn("robust_score", F.col("robust_score").cast("float")))


def q_messages_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments read from nested JSON messages: those that can be used."""
    return accepted(read_messages(payment_messages(spark, sf_dir))).drop("received", "message", "parsed")


def q_messages_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other messages (by their length) with the reasons."""
    found = rejected(read_messages(payment_messages(spark, sf_dir)))
    return found.select("received", "reasons", (F.length("message") > 40).alias("is_long"))


def valid_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_written(spark, sf_dir).select("sender_bic", "timestamp", "currency", "amount", F.lit(True).alias("is_valid"))


def positions(ordered: DataFrame, label: str) -> DataFrame:
    """``ordered`` plus ``position``: the place of each row in the order that it comes in, from 1.

    Written with the running ids of its sorted partitions; the places come from
    their counts, one row per partition.
    """
    spark = ordered.sparkSession
    path = scratch_path(spark, label)
    ordered.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    part, inside = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(parts, part == F.col("_part")).withColumn("position", F.col("_before") + inside + 1).drop("_id", "_part", "_before")


def ordered_query(name: str, operator: Callable[[DataFrame], DataFrame], columns: tuple[str, ...] = ()) -> Query:
    """A query: the operator's rows with their places in its order."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = positions(operator(validated_payments(spark, sf_dir)), name)
        return settled(wall_clock(out.select(*columns, "position") if columns else out))

    return query


def q_ingest_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All groups of the ingest job's aggregations, as the table that it writes."""
    source, path = scratch_path(spark, "ingest-csv"), scratch_path(spark, "ingest-aggregates")
    write_csv(raw_payments(spark, sf_dir), source)
    run_ingest(spark, source, scratch_path(spark, "ingest-rows"), as_of=FIXTURE_AS_OF, aggregates_path=path)
    return settled(spark.read.parquet(path))


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw payments written as CSV (shared scratch folder) and read back lazily."""
    path = scratch_path(spark, "csv-roundtrip")
    write_csv(raw_payments(spark, sf_dir), path)
    return read_payments_csv(spark, path)


def q_parquet_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated payments written year/month/day-partitioned, read back with the fixed schema."""
    path = scratch_path(spark, "parquet-roundtrip")
    write_parquet(validated_payments(spark, sf_dir), path, ["year", "month", "day"])
    return wall_clock(without_processing_time(read_processed(spark, path)))


def q_analysis_results_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest write + the five-table analysis job; returns country statistics read back."""
    processed = scratch_path(spark, "processed")
    write_validated(validated_payments(spark, sf_dir), processed, ["year", "month", "day"])
    paths = run_analysis(spark, processed, scratch_path(spark, "analysis"))
    return settled(spark.read.parquet(paths["country_statistics"]))


def written_result(name: str) -> Query:
    """A query: one table of the analysis job, written and read back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        results = analysis_results(validated_payments(spark, sf_dir), ordered=False)
        (path,) = write_results(results, scratch_path(spark, "result"), [name])
        return settled(wall_clock(spark.read.parquet(path)))

    return query


def q_ingest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the ingest job writes from CSV."""
    source = scratch_path(spark, "ingest-csv")
    write_csv(raw_payments(spark, sf_dir), source)
    processed, _, _ = run_ingest(spark, source, scratch_path(spark, "ingest-rows"), as_of=FIXTURE_AS_OF)
    return wall_clock(without_processing_time(processed))


def q_ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report that the ingest job observes while it writes."""
    report = write_validated(validated_payments(spark, sf_dir), scratch_path(spark, "ingest-report"))
    schema = ", ".join(f"{k} {'double' if k in ('validity_rate', 'avg_quality_score') else 'bigint'}" for k in report)
    return spark.createDataFrame([tuple(float(v) if isinstance(v, float) else v for v in report.values())], schema)


def q_generated_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic payment per line item (ids from the table), cleaned and validated."""
    ids = spark.read.schema("l_orderkey BIGINT, l_linenumber INT").parquet(f"{sf_dir}/lineitem.parquet").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id")
    )
    raw = generate_payments(spark, ids=ids, as_of=FIXTURE_AS_OF)
    cleaned = raw.transform(clean, as_of=FIXTURE_AS_OF)
    return wall_clock(without_processing_time(cleaned.transform(validate, as_of=FIXTURE_AS_OF)))


QUERIES: dict[str, Query] = {
    "parse_clean": q_parse_clean,
    "validate_flags": q_validate_flags,
    "quality_report": q_quality_report,
    "overall_stats": q_overall_stats,
    "by_currency": q_by_currency,
    "by_msg_type": q_by_msg_type,
    "aggregation_sets": q_aggregation_sets,
    "daily_volumes": q_daily_volumes,
    "top_senders": q_top_senders,
    "top_receivers": q_top_receivers,
    "country_statistics": q_country_statistics,
    "amount_anomalies": q_amount_anomalies,
    "sender_sequence": q_sender_sequence,
    "csv_roundtrip": q_csv_roundtrip,
    "parquet_partitioned_roundtrip": q_parquet_partitioned_roundtrip,
    "analysis_results_roundtrip": q_analysis_results_roundtrip,
    "written_daily_volumes": written_result("daily_volumes"),
    "written_top_senders": written_result("top_senders"),
    "written_top_receivers": written_result("top_receivers"),
    "written_fraud_anomalies": written_result("fraud_anomalies"),
    "ingest_rows": q_ingest_rows,
    "ingest_report": q_ingest_report,
    "generated_payments": q_generated_payments,
    "sender_velocity": q_sender_velocity,
    "near_duplicates": q_near_duplicates,
    "events_asof_orders": q_events_asof_orders,
    "payments_in_periods": q_payments_in_periods,
    "snapshot_changes": q_snapshot_changes,
    "snapshot_applied": q_snapshot_applied,
    "monthly_states": q_monthly_states,
    "streamed_sessions": q_streamed_sessions,
    "messages_accepted": q_messages_accepted,
    "messages_rejected": q_messages_rejected,
    "robust_statistics": q_robust_statistics,
    "robust_anomalies": q_robust_anomalies,
    "ordered_daily_volumes": ordered_query("ordered-daily", daily_volumes),
    "ordered_by_currency": ordered_query("ordered-currency", by_currency),
    "ordered_country_statistics": ordered_query("ordered-countries", country_statistics),
    "ordered_anomalies": ordered_query("ordered-anomalies", detect_anomalies, ("amount",)),
    "ingest_aggregates": q_ingest_aggregates,
}
