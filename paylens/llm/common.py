"""Helpers shared by the operators: table access, staged tables, ranks, connected components."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import paylens
from paylens.sinks.writers import scratch_path

#: Bytes of a batch handed to a Python worker; Spark's own bound lets whole texts take hundreds of MB per task.
BATCH_BYTES = 4 << 20
BATCH_SETTING, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once per application, and bound the batches they get.

    For callers that didn't deploy it with ``--py-files``: the operators'
    Python functions import it there. Batches are bounded to ``BATCH_BYTES``
    in this session unless it sets a bound of its own.
    """
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        home = os.path.dirname(os.path.abspath(paylens.__file__))
        made = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "paylens"), "zip", os.path.dirname(home), "paylens")
        sc.addPyFile(made)
        _shipped.add(sc.applicationId)


def ships_package(operator: Callable) -> Callable:
    """The operator, whose first argument is a DataFrame, with the package handed to that session's workers first."""

    @functools.wraps(operator)
    def shipped(df: DataFrame, *args, **kwargs):
        ship_package(df.sparkSession)
        return operator(df, *args, **kwargs)

    return shipped


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage at a table every executor can read, so a lost executor
    costs a re-read, and later steps prune its columns.
    """
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete :func:`staged` tables that nothing reads any more: all that was made from them is written."""
    for table in tables:
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.staged_path)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def all_of(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Null-safe equality of every pair, as a join condition Spark can hash."""
    cond = pairs[0][0].eqNullSafe(pairs[0][1])
    for a, b in pairs[1:]:
        cond = cond & a.eqNullSafe(b)
    return cond


#: Buckets of the prefilter of :func:`only`, and so the bound of what it broadcasts (8 bytes each).
ONLY_BUCKETS = 1 << 20


def only(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The ``rows`` whose ``key`` is among ``ids`` (one column of distinct longs, of any number).

    Where few rows are wanted, a bounded broadcast of their ids' hash buckets
    drops most others before the join, so that it doesn't shuffle whole texts
    only to drop them.
    """
    (name,) = ids.columns
    bucket = F.pmod(F.xxhash64(F.col(name)), F.lit(ONLY_BUCKETS)).cast("int")
    buckets = F.broadcast(ids.select(bucket.alias("only_bucket")).distinct())
    mine = F.pmod(F.xxhash64(F.col(key)), F.lit(ONLY_BUCKETS)).cast("int")
    return rows.join(buckets, mine == F.col("only_bucket"), "left_semi").join(ids, F.col(key) == F.col(name), "left_semi")


def ranked(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: the 0-based rank of a row in its ``group``, ordered by (``bucket``, *``order``).

    A window over ``group`` alone would put a hot group into one task. Rows
    are numbered inside (group, bucket); the offsets of the buckets come from
    their counts, one row per bucket. ``bucket`` must spread a group evenly.
    """
    keys = [*group, bucket]
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_in_bucket"))
        .select(*[F.col(k).alias(f"o_{k}") for k in keys], F.coalesce(F.sum("n_in_bucket").over(before), F.lit(0)).alias("rank_offset"))
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("rank_inside", F.row_number().over(inside) - 1)
        .join(offsets, all_of([(F.col(k), F.col(f"o_{k}")) for k in keys]))
        .withColumn(name, F.col("rank_inside") + F.col("rank_offset"))
        .drop("rank_inside", "rank_offset", *[f"o_{k}" for k in keys])
    )


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node of ``edges`` (a, b long).

    Alternates two star contractions until nothing changes: every larger
    neighbour of a node moves to the node's smallest neighbour, then every
    smaller one does. Each step is a partially aggregated minimum and an equi
    join against it, whose skewed side AQE can split, so a hub is never one
    task. The edge table is written to the shared folder after each round;
    only its row count and checksum reach the driver.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    pairs = staged(pairs, "edges")
    seen = None
    for _ in range(max_rounds):
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(low, both.a == low.u).filter("b > u").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        small = large.join(low, large.a == low.u).filter("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        before, pairs = pairs, staged(small.union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
        discard(before)
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
