import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ["lineitem", "orders", "customer", "supplier", "events"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "currency", "transaction_count", "total_volume", "avg_amount", "min_amount",
                          "max_amount"]
    assert df.count() > 0


def payment_queries():
    from paylens.plans.queries import QUERIES

    return list(QUERIES)


def test_every_payment_query_has_an_oracle():
    assert set(payment_queries()) <= set(E.oracle_sql()) <= set(E.queries())


#: Writes some 2,500 day folders; their contents are covered by the other queries.
SLOW = {"parquet_partitioned_roundtrip", "analysis_results_roundtrip"}


@pytest.mark.parametrize("name", [q for q in payment_queries() if q not in SLOW])
def test_oracle_agrees_on_small_data(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    result = con.execute(E.oracle_sql()[name])
    df = E.queries()[name](spark, SF_SMALL)
    names = [d[0] for d in result.description]
    cols = sorted(df.columns)
    assert sorted(names) == cols
    number = lambda v: float(v) if isinstance(v, float) else str(v)
    want = [tuple(number(r[names.index(c)]) for c in cols) for r in result.fetchall()]
    got = [tuple(number(r[c]) for c in cols) for r in df.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_operators_are_lazy(spark):
    from paylens.operators import country_statistics, daily_volumes, detect_anomalies, quality_report
    from paylens.operators.sequence import sender_sequence
    from paylens.sources import validated_payments

    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    v = validated_payments(spark, SF_SMALL)  # declared read schemas: no inference job
    for op in (daily_volumes, country_statistics, detect_anomalies, quality_report):
        op(v)
    assert set(tracker.getJobIdsForGroup(None)) == before
    seq = sender_sequence(v.where("is_valid").select("sender_bic", "timestamp", "amount"))
    seq.select("row_num")
    from paylens.operators import asof_join, interval_join, near_in_time_duplicates, sender_velocity

    paid, since = v.select("sender_bic", "timestamp"), v.selectExpr("sender_bic", "timestamp AS since", "timestamp AS until")
    sender_velocity(v), near_in_time_duplicates(v), asof_join(paid, since, ["sender_bic"], "timestamp", "since")
    interval_join(paid, since, ["sender_bic"], "timestamp", "since", "until")
    assert set(tracker.getJobIdsForGroup(None)) == before
