"""Writers for processed payments and analysis results, plus shared scratch space."""

from __future__ import annotations

import re
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.config import ANALYSIS_TABLES


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Makes sure the SparkContext checkpoints there too. A private temp folder is
    created only for a ``local`` master that names none (tests); any other
    master without the setting raises, since executors could not see it.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(f"spark.checkpoint.dir is not set for master {sc.master}; name a folder all executors share")
        root = tempfile.mkdtemp(prefix="paylens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root}/paylens/{name}-{uuid.uuid4().hex}"


def rebalance_for_write(
    df: DataFrame, cols: Iterable[str], spread: int | None = None, adaptive: bool | None = None
) -> DataFrame:
    """Cluster rows by the directory-partition columns before a partitioned write.

    With AQE (the normal case) this is the ``REBALANCE`` hint: AQE merges small
    directory values into one task and splits a hot one into right-sized
    tasks. Without AQE the rows are hash-partitioned on the columns plus a
    row hash modulo ``spread`` (default: the session's shuffle partitions), so
    a hot value can use every task; a smaller ``spread`` makes fewer files.
    ``adaptive`` overrides the session setting (streaming micro-batches are
    planned without AQE).
    """
    cols = list(cols)
    if adaptive is None:
        adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
    if adaptive:
        return df.hint("rebalance", *cols)
    spread = spread or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread))
    return df.repartition(*[F.col(c) for c in cols], bucket)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Iterable[str] | None = None,
    rebalance: bool = True,
    max_records_per_file: int | None = None,
) -> None:
    """Overwrite ``path`` with ``df`` as Parquet, optionally directory-partitioned.

    With partition columns the rows are first clustered on them
    (:func:`rebalance_for_write`), so each task writes few, large files rather
    than one file per (task, day) pair. NULL keys land in Hive's default
    partition directory.
    """
    cols = list(partition_by or [])
    if cols and rebalance:
        df = rebalance_for_write(df, cols)
    writer = df.write.mode("overwrite")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, **options: str) -> None:
    """Overwrite ``path`` with ``df`` as headed CSV, keeping surrounding spaces."""
    (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .options(**options)
        .csv(path)
    )


def write_results(
    results: Mapping[str, DataFrame],
    base: str,
    names: Iterable[str] = ANALYSIS_TABLES,
    parallel: int = 1,
) -> list[str]:
    """Write each named result to ``base/name`` (overwrite); returns the paths in order.

    ``parallel > 1`` submits that many writes at once from driver threads;
    the jobs are independent, so their stages interleave on the executors and
    one job's tail does not leave the cluster idle. Any failure is re-raised
    after all writes finished.
    """
    paths = [f"{base.rstrip('/')}/{name}" for name in names]
    jobs = [(results[name], path) for name, path in zip(names, paths)]

    def write(job):
        df, path = job
        df.write.mode("overwrite").parquet(path)

    if parallel <= 1:
        for job in jobs:
            write(job)
        return paths
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for future in [pool.submit(write, job) for job in jobs]:
            future.result()
    return paths
