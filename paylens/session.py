"""Session settings used by the command-line jobs, the bench and the tests.

Library functions never create or configure a session: ``spark`` is always
passed in. Only entry points call :func:`build_session`.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

#: Settings the jobs rely on. AQE re-plans joins from measured sizes
#: (size-checked broadcast, else sort-merge), coalesces small shuffle
#: partitions, splits skewed join partitions and honours the REBALANCE hint
#: used before partitioned writes. The shuffle partition count is a ceiling
#: that AQE coalesces down, so it can be set for the largest input.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Only bites on tiny inputs: keeps partitioned writes of small data parallel.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    # Shuffles start with this many partitions and AQE merges small ones; raise it
    # so that (shuffled bytes / partitions) stays near 128 MB on the largest job.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "paylens",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
