"""Embedding near-dedup: int8 tile products with rigorous error bounds.

Unit vectors are quantised to int8 with a scale of their own; each keeps the
exact length of its quantisation error. For two vectors with errors e and f,
the product of the quantised ones is off the cosine by at most
|e| + |f| * (1 + |e|), so most pairs are decided by the int8 product; only
those within the bound of the threshold are computed again in double precision.

Vectors are grouped around a few centres and cut into blocks. Two blocks meet
in one task unless the angle between their centres, less both cells' radii,
exceeds the threshold's angle, which rules out any link between them. A task
returns one row per linked vector (its number of links, its root in the tile's
own components), never pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import connected_components, discard, ships_package, staged
from paylens.llm.near_dup import local_roots
from paylens.llm.vectors import kmeans, sample_vectors, usable

THRESHOLD = 0.9
#: Centres of the cells at most (no more than there are blocks), fitted on this many vectors. Cells only prune: any centres give the same result.
CELLS = 16
SAMPLE = 4096
#: Vectors of a block; two blocks meet in a task. A vector is dealt once for every block that its own may meet.
BLOCK = 4096
#: Rows of a tile that are multiplied at a time.
ROWS = 512
#: Allowance for rounding in double-precision products of unit vectors.
SLACK = 1e-9


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 rows, each row's scale, and the length of each row's quantisation error."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None])
    error = np.linalg.norm(unit - q * scale[:, None], axis=1)
    return q.astype(np.int8), scale, error


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows over their largest component, so that squares of huge or tiny ones neither overflow nor vanish."""
    return x / np.abs(x).max(axis=1, keepdims=True)


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (float64, not zero) have a cosine of at least ``threshold``."""
    a, b = scaled(a), scaled(b)
    unit_a, unit_b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    (q_a, s_a, e_a), (q_b, s_b, e_b) = quantise(unit_a), quantise(unit_b)
    # int8 products are below 2**24 for up to 1040 dimensions, so float32 sums are exact; beyond, float64 is used
    kind = np.float32 if a.shape[1] <= 1040 else np.float64
    q_b = q_b.astype(kind).T
    lengths_a, lengths_b = (np.sqrt((x**2).sum(axis=1)) for x in (a, b))
    linked = np.zeros((len(a), len(b)), dtype=bool)
    for at in range(0, len(a), ROWS):
        rows = slice(at, at + ROWS)
        near = (q_a[rows].astype(kind) @ q_b).astype(np.float64) * (s_a[rows, None] * s_b[None, :])
        bound = e_a[rows, None] + e_b[None, :] * (1 + e_a[rows, None]) + SLACK
        sure = near - bound >= threshold
        i, j = np.nonzero((near + bound >= threshold) & ~sure)
        linked[rows] = sure
        for k in range(0, len(i), 1 << 16):
            x, y = i[k:k + (1 << 16)] + at, j[k:k + (1 << 16)]
            linked[x, y] = (a[x] * b[y]).sum(axis=1) / (lengths_a[x] * lengths_b[y]) >= threshold
    return linked


@ships_package
def near_duplicate_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Vectors are linked when their cosine in double precision is at least
    ``threshold``. ``n_links`` counts the other rows linked to a row,
    ``component_id`` is the smallest id reachable by links, itself included,
    and ``kept`` marks that row. Every pair is decided, none is sampled.

    A vector that is null, zero, or has a null or non-finite component links
    with nothing; so does a row with a null id (its component is null, it is
    kept). Equal vectors are linked with each other and are compared with
    others once, as one, so a third of all rows may be copies. Rows that repeat
    an id have the links of their own vector each, and one component: that of
    all links of the id's vectors. All vectors that take part have one
    dimension. Other columns are ignored. Empty input gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    takes_part = usable("vector") & F.col("vec_id").isNotNull()
    classes = rows.filter(takes_part).groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")

    sample = sample_vectors(classes, "rep", "vector", SAMPLE)
    sample = scaled(sample) if len(sample) else np.zeros((0, 1))
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    n_cells = min(CELLS, -(-classes.count() // BLOCK))
    centres = kmeans(unit, n_cells) if len(unit) else unit
    centres = centres[np.linalg.norm(centres, axis=1) > 0] if len(centres) else centres
    if len(centres) == 0 and len(unit):
        centres = unit[:1]
    centres = centres / np.linalg.norm(centres, axis=1, keepdims=True) if len(centres) else centres

    def in_cells(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = scaled(np.array(batch["vector"].to_list(), dtype=np.float64))
            cosines = x @ centres.T / np.linalg.norm(x, axis=1, keepdims=True)
            yield batch.assign(cell=cosines.argmax(axis=1), angle=np.arccos(np.clip(cosines.max(axis=1), -1, 1)))

    kinds = "node long, copies long, vector array<double>, cell int, angle double"
    celled = staged(classes.select("node", "copies", "vector").mapInPandas(in_cells, kinds), "vector-cells")
    cells = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")).collect()  # CELLS rows
    blocks = {r["cell"]: -(-r["n"] // BLOCK) for r in cells}
    radius = {r["cell"]: r["radius"] + 1e-6 for r in cells}
    reach = math.acos(threshold)

    def may_meet(p: int, q: int) -> bool:
        apart = math.acos(max(-1.0, min(1.0, float(centres[p] @ centres[q]))))
        return p == q or apart <= radius[p] + radius[q] + reach

    meets = [(p, q, blocks[p], blocks[q]) for p in blocks for q in blocks if may_meet(p, q)]  # CELLS**2 rows at most
    meets = spark.createDataFrame(meets, "p int, q int, p_blocks int, q_blocks int")
    dealt = celled.join(F.broadcast(meets), F.col("cell") == F.col("p"))
    mine = F.pmod(F.xxhash64("node"), F.col("p_blocks")).cast("int")
    dealt = dealt.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)))
    ours, theirs = F.struct(F.col("p").alias("cell"), F.col("mine").alias("block")), F.struct(F.col("q").alias("cell"), F.col("other").alias("block"))
    # each row goes once to every tile that its block is part of
    dealt = dealt.select("node", "copies", "vector", F.least(ours, theirs).alias("tile_a"), F.greatest(ours, theirs).alias("tile_b"), (ours <= theirs).alias("first"))

    def links(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values(["first", "node"], ascending=[False, True])
        first = tile["first"].to_numpy()
        node, copies = tile["node"].to_numpy(), tile["copies"].to_numpy()
        x = np.array(tile["vector"].to_list(), dtype=np.float64)
        n = len(x)
        linked = np.zeros((n, n), dtype=bool)
        if first.all():
            linked = tile_links(x, x, threshold)
            linked |= linked.T
        elif first.any():
            a = int(first.sum())
            linked[:a, a:] = tile_links(x[:a], x[a:], threshold)
            linked[a:, :a] = linked[:a, a:].T
        np.fill_diagonal(linked, False)
        some = np.flatnonzero(linked.any(axis=1))
        linked = linked[np.ix_(some, some)]
        counts = [int(copies[some][row].sum()) for row in linked]
        return pd.DataFrame({"node": node[some], "links": counts, "root": node[some][local_roots(linked)]})

    found = dealt.groupBy("tile_a", "tile_b").applyInPandas(links, "node long, links long, root long")
    found = staged(found, "vector-links")
    discard(celled)
    counts = found.groupBy(F.col("node").alias("l_node")).agg(F.sum("links").alias("links"))

    # ids with several vectors, their nodes, and the links that make each id one
    mine = F.when(takes_part, F.xxhash64("vector"))
    several = rows.filter("vec_id is not null").groupBy(F.col("vec_id").alias("t_id"))
    several = several.agg(F.min(mine).alias("low"), F.max(mine).alias("high"), F.count_if(~takes_part).alias("others"))
    several = several.filter("low < high or (low is not null and others > 0)").select("t_id")
    named = rows.filter(takes_part).join(several, F.col("vec_id") == F.col("t_id")).join(classes.select(F.col("vector").alias("n_vector"), "node"), F.col("vector") == F.col("n_vector"))
    named = staged(named.select("t_id", "node").distinct(), "repeated-ids")
    firsts = named.groupBy(F.col("t_id").alias("f_id")).agg(F.min("node").alias("first"))
    same_id = named.join(firsts, F.col("t_id") == F.col("f_id")).select(F.col("node").alias("a"), F.col("first").alias("b"))
    components = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(same_id))
    components = components.withColumnsRenamed({"node": "m_node", "component": "m_component"})
    judged = classes.join(counts, F.col("node") == F.col("l_node"), "left").join(components, F.col("node") == F.col("m_node"), "left")
    judged = judged.withColumn("group", F.coalesce("m_component", "node"))
    smallest = judged.groupBy(F.col("group").alias("s_group")).agg(F.min("rep").alias("component"))
    judged = judged.join(smallest, F.col("group") == F.col("s_group"))
    by_id = named.join(judged.select(F.col("node").alias("j_node"), F.col("component").alias("j_component")), F.col("node") == F.col("j_node"))
    by_id = by_id.groupBy("t_id").agg(F.min("j_component").alias("id_component"))
    judged = judged.select(F.col("vector").alias("c_vector"), "copies", "links", "component")
    out = rows.withColumn("key", F.when(takes_part, F.col("vector"))).join(judged, F.col("key") == F.col("c_vector"), "left")
    out = out.join(by_id, F.col("vec_id") == F.col("t_id"), "left")
    component = F.coalesce("id_component", "component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce(F.col("links") + F.col("copies") - 1, F.col("copies") - 1, F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
