import hashlib
import os

import pytest
from pyspark.sql import functions as F

from paylens.config import RAW_COLUMNS
from paylens.operators import clean, validate
from paylens.sinks import scratch_path, write_csv
from paylens.sources import read_processed
from paylens.sources.generator import GEN_ANOMALY_KINDS, generate_payments
from paylens.streaming import start_stream_ingest
from tests.conftest import AS_OF, INVALID8, VALID5


def test_generator_is_deterministic_and_sized(spark):
    a = generate_payments(spark, 5000, seed=3, as_of=AS_OF)
    b = generate_payments(spark, 5000, seed=3, as_of=AS_OF)
    assert a.columns == list(RAW_COLUMNS)
    assert a.count() == 5000
    assert a.exceptAll(b).count() == 0


def test_every_number_has_a_digest_of_its_own(spark):
    def u(i, salt):
        return int(hashlib.md5(f"{i}:42:{salt}".encode()).hexdigest()[:13], 16) / 16**13

    ids = spark.range(400)
    got = generate_payments(spark, ids=ids.coalesce(1), as_of=AS_OF, with_kind=True).filter("anomaly_kind = 'normal'").select("amount", "currency", "msg_type").collect()
    want = [(round(100 + u(i, 4) * 999_900, 2), ("USD", "EUR", "GBP", "JPY")[int(u(i, 5) * 4)], ("MT103", "MT202", "MT950")[int(u(i, 6) * 3)]) for i in range(400) if u(i, 7) >= 0.05]
    assert sorted(want) == sorted(map(tuple, got))


def test_generator_anomaly_mix_and_validity(spark):
    df = generate_payments(spark, 20000, seed=11, as_of=AS_OF, with_kind=True)
    kinds = {r.anomaly_kind: r["count"] for r in df.groupBy("anomaly_kind").count().collect()}
    share = 1 - kinds["normal"] / 20000
    assert 0.04 < share < 0.06 and set(kinds) - {"normal"} <= set(GEN_ANOMALY_KINDS)
    v = df.drop("anomaly_kind").transform(clean, as_of=AS_OF).transform(validate, as_of=AS_OF)
    # every generated anomaly breaks at most one check, so every row stays valid
    assert v.where(~F.col("is_valid")).count() == 0
    assert v.where(F.col("sender_bic").startswith("INVALID")).where(F.length("sender_bic") == 15).count() > 0


def test_stream_ingest_matches_batch(spark, raw):
    src = scratch_path(spark, "t-stream-src")
    write_csv(raw(VALID5).coalesce(1), src + "/a")
    write_csv(raw(INVALID8).coalesce(1), src + "/b")
    landing = scratch_path(spark, "t-landing")
    os.makedirs(landing.removeprefix("file:"), exist_ok=True)
    for sub in ("a", "b"):
        d = (src + "/" + sub).removeprefix("file:")
        for f in os.listdir(d):
            if f.endswith(".csv"):
                os.link(os.path.join(d, f), os.path.join(landing.removeprefix("file:"), f"{sub}-{f}"))
    out = scratch_path(spark, "t-stream-out")
    q = start_stream_ingest(spark, landing, out, as_of=AS_OF)
    q.awaitTermination(120)
    observed = [p.observedMetrics["quality"] for p in q.recentProgress if "quality" in (p.observedMetrics or {})]
    got = read_processed(spark, out).drop("processing_timestamp")
    want = raw(VALID5 + INVALID8).transform(clean, as_of=AS_OF).transform(validate, as_of=AS_OF) \
        .drop("processing_timestamp")
    assert got.count() == 13
    assert got.select(sorted(got.columns)).exceptAll(want.select(sorted(want.columns))).count() == 0
    assert sum(int(m["total_records"]) for m in observed) == 13
    assert sum(int(m["valid_records"]) for m in observed) == 12


@pytest.mark.parametrize("named", [True, False])
def test_stream_ingest_restart_processes_only_new_files(spark, raw, named):
    src = scratch_path(spark, "t-restart-src")
    write_csv(raw(VALID5).coalesce(1), src + "/a")
    write_csv(raw(INVALID8).coalesce(1), src + "/b")
    landing = scratch_path(spark, "t-restart-landing").removeprefix("file:")
    os.makedirs(landing, exist_ok=True)

    def land(sub):
        d = (src + "/" + sub).removeprefix("file:")
        for f in os.listdir(d):
            if f.endswith(".csv"):
                os.link(os.path.join(d, f), os.path.join(landing, f"{sub}-{f}"))

    out = scratch_path(spark, "t-restart-out")
    ckpt = scratch_path(spark, "t-restart-ckpt") if named else None
    land("a")
    start_stream_ingest(spark, landing, out, checkpoint_location=ckpt, as_of=AS_OF).awaitTermination(120)
    assert read_processed(spark, out).count() == 5
    land("b")  # a new file arrives; the restarted stream must take only that one
    start_stream_ingest(spark, landing, out, checkpoint_location=ckpt, as_of=AS_OF).awaitTermination(120)
    assert read_processed(spark, out).count() == 13
