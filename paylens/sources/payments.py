"""Readers for raw (CSV) and processed (Parquet) payments. All lazy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paylens.config import RAW_SCHEMA, VALIDATED_SCHEMA


def read_payments_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType = RAW_SCHEMA,
    **options: str,
) -> DataFrame:
    """Raw payments from CSV files with a header row.

    Columns bind by position to ``schema`` (no inference, no header
    matching); PERMISSIVE mode turns malformed fields into NULLs. ``path`` may
    be any Hadoop-supported URI, a directory or a glob, so the scan splits
    across the cluster by file blocks.
    """
    reader = (
        spark.read.schema(schema)
        .option("header", "true")
        .option("mode", "PERMISSIVE")
        .options(**options)
    )
    return reader.csv(path)


def read_processed(spark: SparkSession, path: str, schema: StructType = VALIDATED_SCHEMA) -> DataFrame:
    """Validated payments from (optionally year/month/day partitioned) Parquet.

    The explicit schema avoids a footer-inference pass over every file and
    still works on an empty directory. Filters on ``is_valid`` or on the
    partition columns are pushed into the scan by Catalyst.
    """
    return spark.read.schema(schema).parquet(path)


def with_row_count(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row-count metric that is filled by whatever action runs next.

    Replaces an eager ``count()``: no extra pass over the data.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("row_count")), obs
