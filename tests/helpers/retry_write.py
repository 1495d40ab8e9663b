"""Subprocess for tests: a partitioned ingest write whose result tasks fail once.

Prints the observed quality report as JSON. Run with a ``local[N,maxFailures]``
master so failed tasks are retried.
"""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from paylens.plans.ingest import observed_for_write, validated_from_raw  # noqa: E402
from paylens.operators.quality import report_from_metrics  # noqa: E402
from paylens.sinks.writers import scratch_path, write_parquet  # noqa: E402
from paylens.sources.fixture import FIXTURE_AS_OF, raw_payments  # noqa: E402


@F.udf(T.BooleanType())
def fail_first_attempt(_):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected task failure")
    return True


def main() -> None:
    sf_dir, out = sys.argv[1], sys.argv[2] if len(sys.argv) > 2 else None
    spark = (SparkSession.builder.master(os.environ.get("RETRY_MASTER", "local[4,4]")).config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    validated = validated_from_raw(raw_payments(spark, sf_dir), FIXTURE_AS_OF)
    df, obs = observed_for_write(validated, ["year"])
    # the failing filter sits above the metrics, in the same (result) stage
    df = df.where(fail_first_attempt(F.col("amount")))
    path = out or scratch_path(spark, "retry-write")
    write_parquet(df, path, ["year"], rebalance=False)
    report = report_from_metrics(obs.get)
    written = spark.read.parquet(path).count()
    print(json.dumps({"report_total": report["total_records"], "report_valid": report["valid_records"],
                      "written": written, "expected": validated.count()}))
    spark.stop()


if __name__ == "__main__":
    main()
