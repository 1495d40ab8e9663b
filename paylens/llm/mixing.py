"""Mixing sources to target weights by Pfair scheduling of source blocks.

A source of weight w out of W shares has block i released at slot
floor(i*W/w) and due before slot ceil((i+1)*W/w). Earliest deadline first over
the released blocks, one block per slot, meets every deadline because the
weights fill the stream exactly; so after any t slots each source has been
given less than one block more or less than t*w/W blocks.

The schedule repeats after W slots. Only one cycle is laid out, from the
weights alone; a block of any number finds its slot by division, so the work
on the corpus is a distributed rank, one small join and arithmetic.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import ranked

#: Repeats of a row that one task makes at a time.
REPEATS = 1024
#: Bound of the cycle (sum of all shares), and so of the table that holds it.
MAX_SHARES = 100_000
#: Hex digits of the shuffling digest that split a source into buckets: 16**3 per source.
BUCKET_DIGITS = 3


def pfair_cycle(weights: Mapping[str, int]) -> list[str]:
    """The sources of one cycle's slots, in order: earliest deadline first, ties by name."""
    total = sum(weights.values())
    waiting = [(0, name, 0) for name in sorted(weights)]
    ready: list[tuple[int, str, int]] = []
    slots = []
    for t in range(total):
        while waiting and waiting[0][0] <= t:
            _, name, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // weights[name]), name, i))
        _, name, i = heapq.heappop(ready)
        slots.append(name)
        if i + 1 < weights[name]:
            heapq.heappush(waiting, ((i + 1) * total // weights[name], name, i + 1))
    return slots


def _repeated(rows: DataFrame, last_epoch: Column, often: list[str]) -> DataFrame:
    """``rows`` once for each ``mix_epoch`` from 0 to ``last_epoch``; those of sources that repeat ``often`` are dealt over tasks first."""
    zero = F.lit(0).cast("long")
    if not often:
        return rows.withColumn("mix_epoch", F.explode(F.sequence(zero, last_epoch)))
    few = rows.filter(~F.col("mix_source").isin(often)).withColumn("mix_epoch", F.explode(F.sequence(zero, last_epoch)))
    ranges = rows.filter(F.col("mix_source").isin(often)).withColumn("last_epoch", last_epoch)
    ranges = ranges.withColumn("first", F.explode(F.sequence(zero, F.col("last_epoch"), F.lit(REPEATS).cast("long")))).repartition("digest", "first")
    many = ranges.withColumn("mix_epoch", F.explode(F.sequence("first", F.least(F.col("last_epoch"), F.col("first") + (REPEATS - 1)))))
    return few.union(many.drop("first", "last_epoch"))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, int],
    other_weight: int = 1,
    block_rows: int = 16,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """All rows of ``docs`` in a stream that follows ``weights`` (integer shares) slot by slot.

    Adds ``mix_source``, ``mix_epoch``, ``mix_block``, ``mix_slot`` and
    ``mix_position``; order by ``mix_position`` to read the stream. Inside a
    source, rows are in the order of the MD5 of their id and cut into blocks of
    ``block_rows`` (the last may be shorter). The stream ends with the first
    whole cycle by which every source has been used up once; a source that is
    used up earlier starts again (``mix_epoch`` counts from 0). No row is left
    out, and the weights hold over the whole stream.

    Sources not named in ``weights``, and null sources, form one pool named
    ``""`` with ``other_weight``. A named source without rows leaves the cycle.
    Null ids and rows that repeat an id are ordinary rows, ordered by all
    columns among themselves. Empty input gives an empty result. Input columns
    with the names of the added ones are replaced.

    One bounded action runs here: rows per named source and the pool.
    """
    shares = {**weights, "": other_weight}
    if any(not isinstance(w, int) or w < 1 for w in shares.values()) or sum(shares.values()) > MAX_SHARES:
        raise ValueError(f"weights must be positive integers that sum to at most {MAX_SHARES}")
    spark = docs.sparkSession
    docs = docs.drop("mix_source", "mix_epoch", "mix_block", "mix_slot", "mix_position")
    named = F.when(F.col(source_col).isin(*weights), F.col(source_col)).otherwise("") if weights else F.lit("")

    counts = {r["s"]: r["n"] for r in docs.select(named.alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()}
    present = {s: shares[s] for s in counts}
    total = sum(present.values())
    blocks = {s: -(-n // block_rows) for s, n in counts.items()}
    cycles = max((-(-blocks[s] // w) for s, w in present.items()), default=0)
    dealt: dict[str, int] = {}
    cycle = []
    for at, s in enumerate(pfair_cycle(present) if present else []):
        cycle.append((s, dealt.get(s, 0), at))
        dealt[s] = dealt.get(s, 0) + 1
    # at most MAX_SHARES short rows
    slots = F.broadcast(spark.createDataFrame(cycle, "c_source string, c_turn long, c_at long"))
    per_source = F.broadcast(spark.createDataFrame([(s, blocks[s], present[s]) for s in present], "p_source string, p_blocks long, p_weight long"))

    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null "), F.xxhash64(F.struct("*")).cast("string"))))
    rows = docs.select(
        F.struct("*").alias("row"),
        named.alias("mix_source"),
        digest.alias("digest"),
        F.substring(digest, 1, BUCKET_DIGITS).alias("bucket"),
        F.col(id_col).alias("id"),
        F.xxhash64(F.struct("*")).alias("row_hash"),
    )
    rows = ranked(rows, ["mix_source"], "bucket", ["digest", "id", "row_hash"], "rank")
    rows = rows.join(per_source, F.col("mix_source") == F.col("p_source"))
    rows = rows.withColumn("mix_block", F.expr(f"rank div {block_rows}")).withColumn("in_block", F.expr(f"rank % {block_rows}"))
    last_epoch = F.expr(f"({cycles} * p_weight - 1 - mix_block) div p_blocks")
    rows = _repeated(rows, last_epoch, [s for s, w in present.items() if cycles * w > REPEATS * blocks[s]])
    rows = rows.withColumn("dealt", F.expr("mix_epoch * p_blocks + mix_block"))
    rows = rows.join(slots, (F.col("mix_source") == F.col("c_source")) & (F.expr("dealt % p_weight") == F.col("c_turn")))
    rows = rows.withColumn("mix_slot", F.expr(f"(dealt div p_weight) * {total} + c_at"))
    return rows.select(
        "row.*",
        "mix_source",
        "mix_epoch",
        "mix_block",
        "mix_slot",
        (F.col("mix_slot") * block_rows + F.col("in_block")).alias("mix_position"),
    )
