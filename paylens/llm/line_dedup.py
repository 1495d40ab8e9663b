"""Line dedup: lines that spread over many sites are boilerplate and go.

Every line's distinct sites are counted by a HyperLogLog sketch per line hash,
merged map-side and again after the shuffle, so a line that stands in a third
of all documents costs one sketch per task. Lines whose estimate is near the
threshold get an exact distinct count; only those are counted again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import staged

#: Distinct sites from which a line counts as boilerplate.
MIN_SITES = 8
#: Share of a document's characters above which boilerplate lines make it a copy, not a host.
MAX_SHARE = 0.5
#: log2 of the sketch's registers: 6.5 % standard error.
LG_K = 8
#: Estimates within this share of the threshold (nearly four standard errors) are counted exactly.
NEAR = 0.25


def stripped(line: Column) -> Column:
    """A line without surrounding spaces, tabs and carriage returns."""
    return F.btrim(line, F.lit(" \t\r"))


def line_key(line: Column) -> Column:
    """128 bits of hash of the stripped line."""
    s = stripped(line)
    return F.struct(F.xxhash64(s).alias("h1"), F.xxhash64(F.lit(1), s).alias("h2"))


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, near: float = NEAR) -> DataFrame:
    """The ``key`` of every line of ``lines`` (key, site) that stands on at least ``min_sites`` sites."""
    sketched = lines.groupBy("key").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"))
    likely = staged(sketched.filter(F.col("sites") >= min_sites * (1 - near)), "lines-likely")
    sure = likely.filter(F.col("sites") > min_sites * (1 + near)).select("key")
    unsure = likely.filter(F.col("sites") <= min_sites * (1 + near)).select("key")
    exact = lines.join(unsure, "key", "left_semi").groupBy("key").agg(F.count_distinct("site").alias("sites"))
    return sure.union(exact.filter(F.col("sites") >= min_sites).select("key"))


def drop_boilerplate(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    max_share: float = MAX_SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
) -> DataFrame:
    """``docs`` with cross-site boilerplate lines removed from ``text_col``, one row per input row.

    A line is boilerplate when its stripped text stands on ``min_sites`` or
    more distinct sites. A document of which such lines make up more than
    ``max_share`` of the characters (of all non-blank lines) is a copy of
    another document rather than a host of boilerplate and stays whole, for
    the document-level dedup to judge. The other lines stay as they are.

    Adds ``n_lines``, ``n_dropped`` and ``kept_whole`` (replacing input columns
    so named). Blank lines are never boilerplate. A null site counts as no
    site. A null text stays null, with 0 lines; an empty text has one blank
    line. Rows that repeat an id are judged one by one, each on its own text;
    null ids likewise. Empty input gives an empty result.
    """
    docs = docs.drop("n_lines", "n_dropped", "kept_whole")
    split = F.split(F.col(text_col), "\n")
    # stands for the row wherever its lines go; rows with the same id and text share it
    row_key = F.struct(F.xxhash64(id_col, text_col).alias("r1"), F.xxhash64(F.lit(1), id_col, text_col).alias("r2"))
    lines = docs.select(row_key.alias("row_key"), F.col(site_col).cast("string").alias("site"), F.explode(split).alias("line"))
    lines = lines.filter(stripped(F.col("line")) != "").select(
        "row_key", "site", line_key(F.col("line")).alias("key"), F.length(stripped(F.col("line"))).alias("chars")
    )
    lines = staged(lines, "lines")
    found = staged(spread_lines(lines.select("key", "site"), min_sites), "lines-found")
    hits = lines.join(found, "key", "left_semi").groupBy("row_key").agg(F.collect_set("key").alias("drop_keys"))

    rows = docs.select(F.struct("*").alias("row"), row_key.alias("row_key"), split.alias("lines"))
    rows = rows.join(hits, "row_key", "left")
    flagged = F.transform("lines", lambda x: F.coalesce(F.array_contains("drop_keys", line_key(x)), F.lit(False)))
    rows = rows.withColumn("flagged", F.when(F.col("drop_keys").isNotNull(), flagged))

    def chars(keep) -> Column:
        picked = F.when(F.col("flagged").isNotNull(), F.filter("lines", keep))
        return F.aggregate(picked, F.lit(0).cast("long"), lambda n, x: n + F.length(stripped(x)))

    hit_chars = chars(lambda x, i: F.get("flagged", i))
    all_chars = chars(lambda x, i: F.lit(True))
    rows = rows.withColumn("kept_whole", F.coalesce(hit_chars > all_chars * max_share, F.lit(False)))
    rows = rows.withColumn("drops", F.col("flagged").isNotNull() & ~F.col("kept_whole"))
    kept = F.array_join(F.filter("lines", lambda x, i: ~F.get("flagged", i)), "\n")
    names = [F.col(f"row.{c}").alias(c) for c in docs.columns if c != text_col]
    out = rows.select(
        *names,
        F.when(F.col("drops"), kept).otherwise(F.col(f"row.{text_col}")).alias(text_col),
        F.coalesce(F.array_size("lines"), F.lit(0)).alias("n_lines"),
        F.when(F.col("drops"), F.size(F.filter("flagged", lambda x: x))).otherwise(0).alias("n_dropped"),
        "kept_whole",
    )
    return out.select(*docs.columns, "n_lines", "n_dropped", "kept_whole")
