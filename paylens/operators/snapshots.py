"""Differences between two states of a payment table, and their application to partitioned storage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Column with the signed number of copies: above 0 to add, below 0 to remove.
CHANGE = "n_change"


def multiset_difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """The distinct rows whose number of copies differs, with ``n_change`` = copies in ``after`` less those in ``before``.

    Both tables have the same columns, in any order. Equality is null-safe
    (null equals null, NaN equals NaN, 0.0 equals -0.0). Copies are counted
    map-side by the whole row, so neither a hot row nor an unchanged bulk is
    compared pairwise: each side is one partial aggregate and one shuffle of
    its distinct rows. Empty tables are empty multisets.
    """
    columns = before.columns
    if sorted(columns) != sorted(after.columns) or CHANGE in columns:
        raise ValueError(f"the tables need the same columns, none named {CHANGE}")
    sides = before.withColumn(CHANGE, F.lit(-1)).unionByName(after.withColumn(CHANGE, F.lit(1)))
    return sides.groupBy(*columns).agg(F.sum(CHANGE).alias(CHANGE)).filter(F.col(CHANGE) != 0)


def repeated(rows: DataFrame, copies: str) -> DataFrame:
    """Each row as many times as ``copies`` says, without that column."""
    others = [c for c in rows.columns if c != copies]
    return rows.filter(F.col(copies) > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies).cast("long")))).select(*others)


def apply_changes(spark: SparkSession, path: str, changes: DataFrame, partition_by: Iterable[str]) -> list[dict]:
    """Bring the partitioned Parquet table at ``path`` to the state that ``changes`` (:func:`multiset_difference`) leads to.

    Only the partitions that occur in ``changes`` are read and rewritten
    (dynamic overwrite); files of all others stay as they are. Partition
    columns are numbers, dates or plain words (their folders' names). Removing more
    copies than there are leaves none. The new partitions are written beside
    the table first and only then moved into it, so a failure before that
    leaves the table untouched; running the whole difference again is safe.
    Returns the touched partitions. A partition that becomes empty is removed.
    """
    from paylens.sinks.writers import scratch_path

    cols = list(partition_by)
    staged = scratch_path(spark, "changes")
    changes.write.parquet(staged)
    changes = spark.read.parquet(staged)
    touched = changes.select(*cols).distinct()
    # one row per touched partition: as many as folders to rewrite
    folders = [r.asDict() for r in touched.collect()]
    if not folders:
        return []
    schema = changes.drop(CHANGE).schema
    # only the touched folders are listed and read
    existing = [p for p in (_folder(path, f) for f in folders) if _exists(spark, p)]
    table = spark.read.schema(schema).option("basePath", path).parquet(*existing) if existing else spark.createDataFrame([], schema)
    rows = table.withColumn(CHANGE, F.lit(1).cast("long")).unionByName(changes.select(*schema.names, CHANGE))
    new = repeated(rows.groupBy(*schema.names).agg(F.sum(CHANGE).alias(CHANGE)), CHANGE)
    beside = scratch_path(spark, "partitions")
    new.write.partitionBy(*cols).parquet(beside)
    written = spark.read.schema(schema).parquet(beside)
    left = {tuple(r) for r in written.select(*cols).distinct().collect()}
    # the option holds for this write only; the session's setting stays
    written.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)
    for folder in folders:
        if tuple(folder[c] for c in cols) not in left:
            _remove_folder(spark, path, folder)
    return folders


def _folder(path: str, values: dict) -> str:
    names = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in values.items())
    return f"{path.rstrip('/')}/{names}"


def _on_disk(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    target, files = _on_disk(spark, path)
    return files.exists(target)


def _remove_folder(spark: SparkSession, path: str, values: dict) -> None:
    target, files = _on_disk(spark, _folder(path, values))
    files.delete(target, True)
