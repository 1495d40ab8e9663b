"""Subprocess for tests: sender_sequence while map tasks fail once and are retried.

Prints JSON with the row count and whether the numbers equal a plain window.
"""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from paylens.operators.sequence import sender_sequence  # noqa: E402
from paylens.sources.fixture import validated_payments  # noqa: E402


@F.udf(T.BooleanType())
def fail_first_attempt(_):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected task failure")
    return True


def main() -> None:
    sf_dir = sys.argv[1]
    spark = (SparkSession.builder.master(os.environ.get("RETRY_MASTER", "local[4,4]"))
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "6").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    cols = ["sender_bic", "timestamp", "receiver_bic", "amount", "currency", "msg_type"]
    valid = validated_payments(spark, sf_dir).where("is_valid").select(*cols)
    flaky = valid.where(fail_first_attempt(F.col("amount")))
    got = sender_sequence(flaky)
    w = Window.partitionBy("sender_bic").orderBy(*[F.asc_nulls_first(c) for c in cols[1:]])
    want = valid.withColumn("row_num", F.row_number().over(w))
    diff = got.exceptAll(want).count() + want.exceptAll(got).count()
    print(json.dumps({"rows": got.count(), "expected": valid.count(), "diff": diff}))
    spark.stop()


if __name__ == "__main__":
    main()
