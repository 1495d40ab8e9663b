"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on a bounded sample and indexes every row: each goes to the
leaf that it reaches from the root by the closest centre. A query walks the
tree through a priority queue of nodes, best inner product with the centre
first, and so meets leaves in the order in which they promise neighbours. How
many leaves it visits is calibrated: for some queries the true neighbours are
found against all rows, and visits widen until the share of them that lies in
visited leaves reaches the target recall.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylens.llm.common import ships_package, staged
from paylens.llm.vectors import closest, kmeans, sample_vectors, usable

#: Vectors that the tree is fitted on at most, children of a node, levels of nodes.
SAMPLE = 8192
BRANCH = 8
LEVELS = 3
#: Queries that calibrate the search at most, and the recall that they must reach.
CALIBRATION = 200
RECALL = 0.97
#: Vectors searched in one task at most; several leaves or a part of one.
SHARD = 4096
#: Queries that a shard's vectors meet in one task, about; more go in slices, each with the vectors again.
SLICE = 4096
#: Queries handed on at once, each with its vector once for every shard that it visits.
HANDED = 1024


@dataclass
class Tree:
    """Node centres; ``children[i]`` are node numbers, empty for a leaf, whose number is ``leaf[i]``."""

    centres: np.ndarray
    children: list[list[int]] = field(default_factory=list)
    leaf: dict[int, int] = field(default_factory=dict)

    @classmethod
    def fit(cls, x: np.ndarray, branch: int = BRANCH, levels: int = LEVELS) -> Tree:
        centres, children, leaf = [x.mean(axis=0)], [[]], {}
        todo = [(0, x, levels)]
        while todo:
            node, rows, left = todo.pop()
            own = kmeans(rows, branch, seed=node) if left and len(rows) >= 2 * branch else rows[:0]
            if len(own) < 2:
                leaf[node] = len(leaf)
                continue
            part = closest(rows, own)
            for i, centre in enumerate(own):
                children[node].append(len(centres))
                children.append([])
                todo.append((len(centres), rows[part == i], left - 1))
                centres.append(centre)
        return cls(np.array(centres), children, leaf)

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.zeros(len(x), dtype=np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
            elif len(rows):
                part = closest(x[rows], self.centres[self.children[node]])
                todo += [(child, rows[part == i]) for i, child in enumerate(self.children[node])]
        return out

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """Leaves in best-bin-first order: always the queued node whose centre has the largest inner product."""
        promise = self.centres @ query
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                yield self.leaf[node]
            for child in self.children[node]:
                heapq.heappush(queue, (-float(promise[child]), child))


def exact_scores(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, alike for equal rows wherever they stand."""
    return (x * query).sum(axis=1)


def best(x: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int, rough: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` best rows for a query, best first, ties to smaller ids; rows of its own id left out."""
    rough = x @ query if rough is None else rough
    others = ids != own
    x, ids, rough = x[others], ids[others], rough[others]
    if len(ids) > k:
        # the matrix product may differ from the exact score in the last places
        floor = np.partition(rough, len(ids) - k)[len(ids) - k]
        close = rough >= floor - 1e-9 * max(1.0, abs(float(floor))) - 1e-12 * float(np.abs(query).sum() * np.abs(x).max(initial=0))
        x, ids = x[close], ids[close]
    scores = exact_scores(x, query)
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


FOUND = "query_id long, vec_id long, score double"


def _top_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def brute_force(vectors: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """Exact ``k`` best of all ``vectors`` (vec_id, vector) for a bounded list of ``queries``; each task keeps its best."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = {q: (np.empty(0, np.int64), np.empty(0)) for q, _ in queries}
        wanted = np.array([v for _, v in queries], dtype=np.float64)
        for batch in batches:
            if not len(batch):
                continue
            x, ids = np.array(batch["vector"].to_list(), dtype=np.float64), batch["vec_id"].to_numpy()
            for (q, _), vector, rough in zip(queries, wanted, wanted @ x.T):
                got_ids, got = best(x, ids, vector, q, k, rough)
                got_ids, got = np.concatenate([held[q][0], got_ids]), np.concatenate([held[q][1], got])
                order = np.lexsort((got_ids, -got))[:k]
                held[q] = got_ids[order], got[order]
        for q, (ids, scores) in held.items():
            yield pd.DataFrame({"query_id": q, "vec_id": ids, "score": scores})

    return _top_of(vectors.select("vec_id", "vector").mapInPandas(scan, FOUND), k)


@ships_package
def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """For each row of ``queries`` the ``k`` rows of ``vectors`` with the largest inner products found.

    Columns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: best first,
    ties to the smaller id. A row never finds its own id. Each query visits the
    calibrated number of leaves, and more until they hold ``k`` other rows or
    no leaf is left, so it gets ``k`` rows whenever there are so many.

    Vectors that are null, zero or hold null or non-finite components take no
    part, nor do rows with a null id. Rows that repeat an id and a vector count
    once. Vectors that take part have one dimension. Other columns are ignored.
    Empty input gives an empty result.

    The driver holds the tree (``BRANCH ** LEVELS`` leaves at most) and one
    count per leaf; a hot leaf is searched in several tasks, and so are the
    queries of a shard that many visit.
    """

    def prepared(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
        return rows.filter(usable("vector") & F.col("vec_id").isNotNull()).distinct()

    spark = vectors.sparkSession
    rows = prepared(vectors)
    sample = sample_vectors(rows, "vec_id", "vector", SAMPLE)
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = Tree.fit(sample)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(leaf=tree.leaves_of(np.array(batch["vector"].to_list(), dtype=np.float64)))

    indexed = staged(rows.mapInPandas(index, "vec_id long, vector array<double>, leaf int"), "leaves")
    asked = staged(prepared(queries), "queries")
    sizes = {r["leaf"]: r["n"] for r in indexed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = calibrated_visits(tree, indexed, asked, k, recall)

    # leaves side by side to shards of SHARD rows; a larger leaf is cut into several
    shards: dict[int, list[int]] = {}
    filled, last = SHARD, -1
    for leaf in sorted(sizes):
        if filled + sizes[leaf] > SHARD:
            filled, last = 0, last + 1
            shards[leaf] = [last + i for i in range(-(-sizes[leaf] // SHARD))]
            last = shards[leaf][-1]
        else:
            shards[leaf] = [last]
        filled += sizes[leaf]
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for vector in batch["vector"]:
                visited, held = [], 0
                for n, leaf in enumerate(tree.visits(np.asarray(vector, dtype=np.float64))):
                    if n >= wanted and held > k:
                        break
                    held += sizes.get(leaf, 0)
                    if leaf in shards:
                        visited.append(leaf)
                out.append(visited)
            yield batch.assign(leaves=out, firsts=[sorted({shards[leaf][0] for leaf in leaves}) for leaves in out])

    walked = staged(asked.mapInPandas(walk, "vec_id long, vector array<double>, leaves array<int>, firsts array<int>"), "walked")
    # leaves share one shard, or one leaf has several that all its queries visit: the first shard's count is that of each
    asks = walked.select(F.explode("firsts").alias("shard")).groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()
    firsts = {r["shard"]: r["n"] for r in asks}
    slices = {s: max(1, -(-firsts.get(parts[0], 0) // SLICE)) for parts in shards.values() for s in parts}

    # at most one row per leaf
    cuts = [(leaf, [(s, slices[s]) for s in parts]) for leaf, parts in shards.items()]
    places = F.broadcast(spark.createDataFrame(cuts, "s_leaf int, parts array<struct<shard int, slices int>>"))
    placed = indexed.join(places, F.col("leaf") == F.col("s_leaf"))
    part = F.get("parts", F.pmod(F.xxhash64("vec_id"), F.size("parts")).cast("int"))
    placed = placed.select("vec_id", "vector", "leaf", part.alias("part"))
    placed = placed.select("vec_id", "vector", "leaf", "part.shard", F.explode(F.sequence(F.lit(0), F.col("part.slices") - 1)).alias("slice"))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["query_id", "query", "shard", "slice", "visited"]
        for batch in batches:
            out = []
            for q, vector, leaves, salt in zip(batch["vec_id"], batch["vector"], batch["leaves"], batch["salt"]):
                visited: dict[int, list[int]] = {}
                for leaf in leaves:
                    for s in shards[leaf]:
                        visited.setdefault(s, []).append(leaf)
                for s, own in visited.items():
                    out.append((q, vector, s, salt % slices[s], own))
                    if len(out) == HANDED:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
            yield pd.DataFrame(out, columns=columns)

    # of the vector too: an id may be repeated with many
    salted = walked.withColumn("salt", F.xxhash64("vec_id", "vector"))
    asking = salted.mapInPandas(ask, "query_id long, query array<double>, shard int, slice int, visited array<int>")

    def search(held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(held) and len(asking):
            x, ids, leaf = np.array(held["vector"].to_list(), dtype=np.float64), held["vec_id"].to_numpy(), held["leaf"].to_numpy()
            wanted_q = np.array(asking["query"].to_list(), dtype=np.float64)
            for at in range(0, len(wanted_q), 256):
                rough = wanted_q[at : at + 256] @ x.T
                for i, (q, leaves) in enumerate(zip(asking["query_id"].iloc[at : at + 256], asking["visited"].iloc[at : at + 256])):
                    here = np.isin(leaf, leaves)
                    got_ids, got = best(x[here], ids[here], wanted_q[at + i], q, k, rough[i][here])
                    found.append(pd.DataFrame({"query_id": q, "vec_id": got_ids, "score": got}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = placed.groupBy("shard", "slice").cogroup(asking.groupBy("shard", "slice")).applyInPandas(search, FOUND)
    return _top_of(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def calibrated_visits(tree: Tree, indexed: DataFrame, asked: DataFrame, k: int, recall: float) -> int:
    """The fewest leaves to visit so that, of the calibration queries' true neighbours, ``recall`` lie in them."""
    some = asked.orderBy(F.xxhash64("vec_id"), "vector").limit(CALIBRATION).collect()
    queries = [(r["vec_id"], r["vector"]) for r in some]
    if not queries:
        return 1
    true = brute_force(indexed, queries, k).select("query_id", "vec_id").join(
        indexed.select(F.col("vec_id").alias("i_id"), "leaf"), F.col("vec_id") == F.col("i_id")
    )
    places = {q: {leaf: n for n, leaf in enumerate(tree.visits(np.array(v)))} for q, v in queries}
    needed = sorted(places[r["query_id"]][r["leaf"]] + 1 for r in true.select("query_id", "leaf").collect())
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))] if needed else 1
