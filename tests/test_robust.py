"""Exact quantiles and robust anomalies against numpy, with hot groups, ties, nulls and NaN."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paylens.operators.robust import SCALE, group_quantile, robust_anomalies, robust_statistics

SCHEMA = "currency string, amount double, is_valid boolean"


def rows(n=900, seed=3):
    rnd = random.Random(seed)
    made = [(rnd.choice(["HOT", "HOT", "HOT", "A", None]), rnd.choice([None, 5.0, 5.0, round(rnd.lognormvariate(3, 1), 2), float("nan"), 1e7]), rnd.random() < 0.9) for _ in range(n)]
    return made + [("EVEN", x, True) for x in (4.0, 1.0, 2.5, 3.0)] + [("FLAT", 7.0, True)] * 9 + [("NONE", None, True)]


def values(made, valid=True):
    groups = {}
    for currency, amount, ok in made:
        if (ok or not valid) and amount is not None and amount == amount:
            groups.setdefault(currency, []).append(amount)
    return groups


@pytest.mark.parametrize("max_rows", [20, 100_000])
@pytest.mark.parametrize("q", [0.0, 0.3, 0.5, 1.0])
def test_quantiles_are_exact(spark, max_rows, q):
    got = {r.currency: (r.n, r.quantile) for r in group_quantile(spark.createDataFrame(rows(), SCHEMA), ["currency"], "amount", q, max_rows).collect()}
    want = {k: (len(v), pytest.approx(float(np.quantile(v, q)), rel=1e-12)) for k, v in values(rows(), valid=False).items()}
    assert got == want


@pytest.mark.parametrize("max_rows", [20, 100_000])
def test_robust_anomalies(spark, max_rows):
    made = rows()
    df = spark.createDataFrame(made, SCHEMA).withColumn("n", F.lit("clash"))
    stats = {k: (float(np.median(v)), float(np.median(np.abs(np.array(v) - np.median(v))))) for k, v in values(made).items()}
    got = {r.currency: (r.median_amount, r.mad_amount) for r in robust_statistics(df, max_rows=max_rows).collect()}
    assert got == {k: (pytest.approx(m), pytest.approx(d)) for k, (m, d) in stats.items()}
    flagged = sorted((str(r.currency), r.amount) for r in robust_anomalies(df, max_rows=max_rows).collect())
    want = sorted((str(c), a) for c, a, ok in made if ok and a is not None and a == a and stats[c][1] > 0 and abs(SCALE * (a - stats[c][0]) / stats[c][1]) > 3.5)
    assert flagged == want and len(want) > 20
    plan = robust_anomalies(df)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Python" not in plan


def test_quantiles_of_a_hot_group_by_a_narrow_bracket(spark):
    """One group of many distinct values and a heavy one: exact, with a fixed number of looks at the table."""
    df = spark.range(60_000).selectExpr("'HOT' AS currency", "CASE WHEN id % 3 = 0 THEN 7.0D ELSE (id * 7919) % 60013 / 4.0D END AS amount")
    got = group_quantile(df, ["currency"], "amount", 0.8, max_rows=1_000)
    v = [7.0 if i % 3 == 0 else i * 7919 % 60013 / 4 for i in range(60_000)]
    assert [(r.n, r.quantile) for r in got.collect()] == [(60_000, pytest.approx(float(np.quantile(v, 0.8)), rel=1e-12))]
    for out, looks in ((got, 4), (robust_statistics(df.withColumn("is_valid", F.lit(True))), 20)):
        assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (") <= looks


def test_robust_anomalies_of_nothing(spark):
    assert robust_anomalies(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        group_quantile(spark.createDataFrame([], SCHEMA), ["currency"], "amount", 1.5)
