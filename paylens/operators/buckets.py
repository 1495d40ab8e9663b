"""Ordered buckets that split hot groups by the data's own quantiles.

An ordered computation per group (numbering, running sums, the last value
before) puts a whole group into one task when written as a plain window. Here
rows get a bucket that rises with their order inside the group, and groups
with more than ``max_rows`` rows are cut at approximate quantiles, so that a
window over (group, bucket) stays small whatever the group's size; what
crosses a bucket's edge is carried over by a window over one row per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a group that stay together.
MAX_ROWS = 100_000
#: Quantiles that cut a group at each level.
CUTS = 255
#: Error of a quantile's rank, as one part in this many.
ACCURACY = 10_000
_LOWEST, _HIGHEST = -1.7e308, 1.7e308


def order_code(df: DataFrame, name: str) -> Column | None:
    """A double that never falls as the column rises (nulls first); None for types without one."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampType):
        code = F.unix_micros(c).cast("double")
    elif isinstance(kind, T.TimestampNTZType):
        # by fields: a cast would go through the session's time zone, which may go back an hour
        day, seconds = F.unix_date(c.cast("date")), F.hour(c) * 3600 + F.minute(c) * 60 + F.extract(F.lit("SECOND"), c)
        code = day * F.lit(86400e6) + F.round(seconds * 1_000_000).cast("double")
    elif isinstance(kind, T.DateType):
        code = F.unix_date(c).cast("double")
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        code = F.when(F.isnan(c), F.lit(_HIGHEST)).otherwise(F.least(F.greatest(c.cast("double"), F.lit(-_HIGHEST)), F.lit(_HIGHEST)))
    elif isinstance(kind, T.NumericType):
        code = c.cast("double")
    elif isinstance(kind, T.StringType):
        code = F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    else:
        return None
    return F.coalesce(code, F.lit(_LOWEST))


def ordered_buckets(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int = MAX_ROWS, levels: int = 2, name: str = "bucket"
) -> DataFrame:
    """``df`` plus ``name``, a long that never falls as the row's (``order``) rises within its ``keys``.

    Groups of up to ``max_rows`` rows have one bucket, 0. Larger ones are cut at
    their quantiles into buckets from 1 on, as many as their size needs, and
    buckets still too large are cut again, ``levels`` times in all. A cut goes
    by the first ``order`` column that is not constant in the bucket, so many
    rows of one time are told apart by the next column; rows alike in all
    columns with a code (numbers, times, texts by their first six bytes) stay
    together. Null keys are a group like any other.

    Lazy. Only rows of hot groups are read for quantiles and counted again.
    Their cuts are broadcast, so rows aren't shuffled for them: of N rows, at
    most N / ``max_rows`` groups are hot, with twice as many cuts in all.
    """
    codes = []
    for c in order:
        code = order_code(df, c)
        if code is None:
            break
        codes.append(code)
    if name in df.columns or not codes:
        raise ValueError(f"{name} is a column already, or no order column has a code")
    out = df.withColumn(name, F.lit(0).cast("long"))
    for level in range(levels):
        out = _cut(out, [*keys, name], codes, max_rows, name, level)
    return out


def _cut(df: DataFrame, group: list[str], codes: list[Column], max_rows: int, name: str, level: int) -> DataFrame:
    picked = F.lit(None).cast("int")
    for i in reversed(range(len(codes))):
        picked = F.when(F.col(f"g_low{i}") < F.col(f"g_high{i}"), i).otherwise(picked)
    # a group that the level before left whole needs no look
    sizes = (df if level == 0 else df.filter(F.col(name) > 0)).groupBy(*group).agg(
        F.count(F.lit(1)).alias("g_rows"),
        *[f(codes[i]).alias(f"g_{end}{i}") for i in range(len(codes)) for end, f in (("low", F.min), ("high", F.max))],
    )
    hot = sizes.filter(F.col("g_rows") > max_rows).select(*[F.col(k).alias(f"g_{i}") for i, k in enumerate(group)], "g_rows", picked.alias("g_code")).filter("g_code is not null")
    same = F.lit(True)
    for i, k in enumerate(group):
        same = same & F.col(k).eqNullSafe(F.col(f"g_{i}"))
    code = F.lit(None).cast("double")
    for i, c in enumerate(codes):
        code = F.when(F.col("g_code") == i, c).otherwise(code)
    quantiles = [(i + 1) / (CUTS + 1) for i in range(CUTS)]
    cuts = df.join(F.broadcast(hot), same).groupBy(*[f"g_{i}" for i in range(len(group))], "g_rows", "g_code").agg(F.percentile_approx(code, quantiles, ACCURACY).alias("g_all"))
    # of the quantiles, those that make buckets of half of max_rows
    parts = F.least(F.lit(CUTS + 1), F.ceil(F.col("g_rows") * 2 / max_rows)).cast("int")
    some = F.transform(F.sequence(F.lit(1), parts - 1), lambda j: F.get("g_all", (F.floor(j * (CUTS + 1) / parts) - 1).cast("int")))
    cuts = cuts.select(*[f"g_{i}" for i in range(len(group))], "g_code", F.array_distinct(some).alias("g_cuts"))
    # how many cuts lie below the row: they ascend, so steps that halve find it
    steps = F.array(*[F.lit((CUTS + 1) >> (i + 1)) for i in range((CUTS + 1).bit_length() - 1)])
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get("g_cuts", at + step - 1) < code, at + step).otherwise(at))
    place = below + 1 if level == 0 else F.col(name) * (CUTS + 1) + below
    placed = F.when(F.col("g_code").isNotNull(), place).otherwise(F.col(name) if level == 0 else F.col(name) * (CUTS + 1))
    return df.join(F.broadcast(cuts), same, "left").withColumn(name, placed.cast("long")).select(*df.columns)
