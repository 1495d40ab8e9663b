import statistics
from datetime import datetime

import pytest

from paylens.operators import (
    aggregations_dict,
    by_currency,
    clean,
    country_statistics,
    daily_volumes,
    detect_anomalies,
    overall_stats,
    top_receivers,
    top_senders,
    validate,
)
from paylens.operators.anomaly import ANOMALY_COLUMNS, amount_stats
from paylens.operators.rollups import aggregation_sets, aggregations_from_sets
from tests.conftest import ANALYSIS_SCHEMA, AS_OF, VALID5


def test_daily_volumes(analysis6):
    df = daily_volumes(analysis6)
    assert df.columns == ["date", "currency", "transaction_count", "total_volume", "avg_amount", "min_amount",
                          "max_amount"]
    assert [(str(r.date)[:10], r.currency, r.transaction_count, r.total_volume) for r in df.collect()] == [
        ("2024-02-05", "EUR", 1, 250.0), ("2024-02-05", "SEK", 1, 750.0), ("2024-02-06", "EUR", 1, 400.0),
        ("2024-02-06", "SEK", 1, 90000.0), ("2024-02-08", "EUR", 1, 500.0)]


def test_top_senders_receivers(analysis6):
    s = top_senders(analysis6).collect()
    assert s[0].asDict() == {"sender_bic": "ORIODE4BXXX", "transaction_count": 3, "total_sent": 1500.0, "avg_sent": 500.0}
    assert [r.sender_bic for r in s[1:]] == ["LYRAFR2PXXX", "NORDNO33XXX"]
    r = top_receivers(analysis6)
    assert r.columns == ["receiver_bic", "transaction_count", "total_received", "avg_received"]
    assert (r.first().receiver_bic, r.first().transaction_count) == ("LYRAFR2PXXX", 2)


def test_top_k_ties_are_deterministic(spark):
    rows = [(datetime(2024, 1, 1), f"BANK{i:02d}XXXXX", "BBBBGBCCXXX", 1.0, "USD", True, False) for i in range(30)]
    df = spark.createDataFrame(rows, ANALYSIS_SCHEMA)
    got = [r.sender_bic for r in top_senders(df, k=20).collect()]
    assert got == sorted(f"BANK{i:02d}XXXXX" for i in range(30))[:20]


def test_country_statistics(analysis6):
    rows = country_statistics(analysis6).collect()
    assert {(r.sender_country, r.receiver_country, r.currency) for r in rows} == {
        ("DE", "FR", "EUR"), ("DE", "NO", "SEK"), ("FR", "DE", "EUR"), ("NO", "FR", "SEK"), ("DE", "CH", "EUR")}
    assert all(r.stddev_amount is None for r in rows)


def test_aggregations_valid5(raw):
    df = raw(VALID5).transform(clean, as_of=AS_OF).transform(validate, as_of=AS_OF)
    aggs = aggregations_dict(df)
    o = aggs["overall"]
    assert (o["total_transactions"], o["total_volume"], o["min_amount"], o["max_amount"]) == (5, 68600.5, 19.5, 64000.0)
    assert o["avg_amount"] == pytest.approx(13720.1)
    assert [(c["currency"], c["transaction_count"], c["total_volume"]) for c in aggs["by_currency"]] == [
        ("CHF", 2, 3700.25), ("SEK", 2, 64880.75), ("INR", 1, 19.5)]
    assert [(m["msg_type"], m["transaction_count"]) for m in aggs["by_message_type"]] == [
        ("MT103", 2), ("MT940", 2), ("MT202", 1)]
    # single-scan grouping sets give the same dict
    assert aggregations_from_sets(aggregation_sets(df).collect()) == aggs


def test_summary_dicts_are_bounded(spark):
    rows = spark.range(10_000).selectExpr(
        "timestamp'2024-02-05 00:00:00' AS timestamp", "'ORIODE4B' AS sender_bic", "'LYRAFR2P' AS receiver_bic", "1.0D AS amount",
        "concat('junk', id) AS currency", "'MT103' AS msg_type", "true AS is_valid", "false AS is_high_value")
    aggs = aggregations_dict(rows, max_groups=50)
    assert aggs["overall"]["total_transactions"] == 10_000 and len(aggs["by_currency"]) == 50
    assert by_currency(rows).count() == 10_000


def test_ingest_writes_every_group(spark, raw):
    from paylens.plans.ingest import run_ingest
    from paylens.sinks import scratch_path, write_csv

    source, table = scratch_path(spark, "t-csv"), scratch_path(spark, "t-aggregates")
    write_csv(raw(VALID5), source)
    processed, _, aggs = run_ingest(spark, source, scratch_path(spark, "t-rows"), as_of=AS_OF, aggregates_path=table)
    assert aggs == aggregations_dict(processed)
    kinds = {r.grouping_set: r["count"] for r in spark.read.parquet(table).groupBy("grouping_set").count().collect()}
    assert kinds == {"overall": 1, "currency": 3, "msg_type": 3}


@pytest.mark.parametrize("amounts", [[0.001] * 50, [1e29, 1e29, 1e29, 5.0], [1.5, float("inf")], [2.0, float("nan")]])
def test_no_amount_vanishes_from_money_aggregates(spark, amounts):
    rows = [(datetime(2024, 1, 1), "ORIODE4B", "LYRAFR2P", a, "USD", True, False) for a in amounts]
    r = overall_stats(spark.createDataFrame(rows, ANALYSIS_SCHEMA)).first()
    assert r.total_transactions == len(amounts)
    assert r.total_volume == pytest.approx(sum(amounts), nan_ok=True)
    assert r.avg_amount == pytest.approx(sum(amounts) / len(amounts), nan_ok=True)


def test_anomalies_analysis6(analysis6):
    amounts = [250.0, 750.0, 400.0, 90000.0, 500.0]
    st = amount_stats(analysis6).first()
    assert st.mean_amount == pytest.approx(statistics.mean(amounts)) and st.std_amount == pytest.approx(statistics.stdev(amounts))
    (r,) = detect_anomalies(analysis6).collect()
    assert detect_anomalies(analysis6).columns == list(ANOMALY_COLUMNS)
    assert r.amount == 90000.0 and r.is_high_value and not r.is_statistical_anomaly and not r.is_high_value_anomaly
    assert r.z_score == pytest.approx((90000 - statistics.mean(amounts)) / statistics.stdev(amounts))
    given = detect_anomalies(analysis6, stats=(st.mean_amount, st.std_amount), ordered=False)
    assert given.collect() == [r]


def test_one_nan_amount_flags_itself_only(spark):
    rows = [(datetime(2024, 1, 1, i % 24), "ORIODE4B", "LYRAFR2P", 100.0 + i, "USD", True, False) for i in range(50)]
    rows.append((datetime(2024, 1, 2), "ORIODE4B", "LYRAFR2P", float("nan"), "USD", True, False))
    out = detect_anomalies(spark.createDataFrame(rows, ANALYSIS_SCHEMA)).collect()
    assert len(out) == 1 and out[0].amount != out[0].amount


def test_real_three_sigma_outlier(spark):
    rows = [(datetime(2024, 1, 1, i), "AAAAUSBBXXX", "BBBBGBCCXXX", 100.0, "USD", True, False) for i in range(20)]
    rows.append((datetime(2024, 1, 2), "AAAAUSBBXXX", "BBBBGBCCXXX", 1_000_000.0, "USD", True, False))
    out = detect_anomalies(spark.createDataFrame(rows, ANALYSIS_SCHEMA)).collect()
    assert len(out) == 1 and out[0].is_statistical_anomaly and out[0].is_high_value_anomaly
    assert out[0].z_score > 3


def test_zero_std_gives_null_z(spark):
    rows = [(datetime(2024, 1, 1, i), "AAAAUSBBXXX", "BBBBGBCCXXX", 100.0, "USD", True, i == 0) for i in range(3)]
    out = detect_anomalies(spark.createDataFrame(rows, ANALYSIS_SCHEMA)).collect()
    assert len(out) == 1 and out[0].z_score is None and out[0].is_high_value


def test_anomaly_stats_do_not_run_on_driver(analysis6):
    plan = detect_anomalies(analysis6)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan.lower() or "ScalarSubquery" in plan
