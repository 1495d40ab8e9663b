"""MinHash near-dedup with bottom-k sketches of one hash function.

1. A document's word shingles are hashed; it keeps their number, a digest of
   the whole set and the k smallest hashes. Documents of equal sets form a
   class; from here on each class is one document, its smallest id.
2. Inverted lists of retained values generate candidates. Two sets with
   Jaccard 0.75 share at least ``MIN_SHARED`` of their retained values (fails
   with probability 1e-8 for a pair just at the threshold), so a document need
   only be listed under so many of its rarest values that one of them must be
   shared. Passages that many documents quote thereby drop out.
3. In lists of up to ``SHORT_LIST`` documents all pairs are estimated from the
   union of the two sketches, and those that may reach the threshold are
   verified on the full sets. Longer lists are compared in blocks by matrix
   products of wide sketches, which for most documents are the whole set; of
   the links found only a spanning forest is passed on.
4. Links are closed to components by star contractions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import connected_components, discard, only, ships_package, staged

WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Retained hashes per document.
K = 96
#: Of the retained hashes, those that the inverted lists are made of.
LISTED_OF = 64
#: Of these, linked documents share at least so many: 5.7 standard deviations below the mean of 48.
MIN_SHARED = 28
#: Matches among the K smallest of the union that a candidate needs: 5 deviations below.
MIN_MATCHES = 51
#: Longest inverted list of which all pairs are estimated one by one.
SHORT_LIST = 64
#: Retained hashes by which a document enters longer lists; linked ones share none of them with probability 2e-10.
LONG_OF = 16
#: Documents of a longer list that are compared in one block.
BLOCK = 2048
#: Retained hashes in longer lists; sets up to this size are compared in full there.
WIDE = 1024

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, at least ``n`` of each."""
    global _powers
    if len(_powers[0]) < n:
        n = max(n, 2 * len(_powers[0]))
        inverse = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))
        _powers = tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, x))]) for x in (_MULTIPLIER, inverse))
    return _powers


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word: runs of bytes other than space and 0x09-0x0D, A-Z lower-cased."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    in_word = (raw != 32) & ((raw < 9) | (raw > 13))
    edges = np.flatnonzero(np.diff(in_word, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    lower = raw + np.where((raw >= 65) & (raw <= 90), 32, 0).astype(np.uint8)
    powers, inverses = _power_tables(len(raw))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * powers[: len(raw)])])
    return _mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of the text's ``words``-word shingles; of fewer words, of the whole sequence."""
    w = word_hashes(text) if text else np.empty(0, np.uint64)
    if not len(w):
        return w
    size = min(words, len(w))
    h = np.full(len(w) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        h = _mix(h * _MULTIPLIER + w[i : len(w) - size + 1 + i])
    return np.unique(h)


def _sets(size: int | None, words: int):
    """Per document: id, hash of the text, set size, digest of the set (null if empty) and its ``size`` smallest hashes (None: all)."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                sets = [shingle_set(t, words) for t in part["text"]]
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None),
                        "text_hash": part["text_hash"],
                        "n": [len(s) for s in sets],
                        "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                        "hashes": [s[:size].view(np.int64) for s in sets],
                    }
                )

    return rows


SETS = "doc_id long, text_hash long, n long, digest binary, hashes array<long>"


def _matrix(rows: list[np.ndarray], width: int, fill: int) -> np.ndarray:
    """Rows of uint64 values padded to ``width`` with values found nowhere else (from ``fill`` down)."""
    lens = np.array([min(len(r), width) for r in rows])
    out = np.broadcast_to(np.uint64(fill) - np.arange(width, dtype=np.uint64), (len(rows), width)).copy()
    if len(rows):
        values = np.concatenate([r[:width] for r in rows])
        out[np.arange(width) < lens[:, None]] = values.view(np.uint64 if values.dtype.itemsize == 8 else np.uint32)
    return out


def _matches(a: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: values in both, and those of them among the ``k`` smallest distinct of both."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    same = both[:, 1:] == both[:, :-1]
    distinct = np.arange(2, both.shape[1] + 1) - np.cumsum(same, axis=1)
    return same.sum(axis=1), (same & (distinct <= k)).sum(axis=1)


def may_link(n_a, n_b, shared, matches, percent: int = PERCENT):
    """Whether pairs may reach the threshold: exactly for whole sets, else by the union sketch's matches."""
    whole = (n_a <= K) & (n_b <= K)
    exact = 100 * shared >= percent * (n_a + n_b - shared)
    sized = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    return sized & np.where(whole, exact, matches >= MIN_MATCHES)


def _runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows in frames that never end within a run of equal ``keys``."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        values = batch[keys].to_numpy()
        changes = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        if held and (held[-1][keys].to_numpy()[-1] != values[0]).any():
            yield pd.concat(held, ignore_index=True)
            held = []
        if len(changes):
            yield pd.concat([*held, batch.iloc[: changes[-1]]], ignore_index=True)
            held = [batch.iloc[changes[-1] :]]
        else:
            held.append(batch)
    if held:
        yield pd.concat(held, ignore_index=True)


def _pairs_of_lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Candidate pairs of short lists; rows come sorted by value."""
    for rows in _runs(batches, ["v"]):
        value, node, n = (rows[c].to_numpy() for c in ("v", "node", "n"))
        i = np.arange(len(rows))
        pairs = []
        for step in range(1, len(rows)):
            same = i[:-step][value[:-step] == value[step:]]
            if not len(same):
                break
            pairs.append(np.stack([same, same + step]))
        if not pairs:
            continue
        a, b = np.concatenate(pairs, axis=1)
        fits = (100 * np.minimum(n[a], n[b]) >= PERCENT * np.maximum(n[a], n[b])) & (node[a] != node[b])
        a, b = a[fits], b[fits]
        hashes, before = rows["hashes"].to_list(), rows["before"].to_list()
        pos = np.array([len(x) for x in before])
        for at in range(0, len(a), 8192):
            x, y = a[at : at + 8192], b[at : at + 8192]
            # only in the list of the first value that both are listed under
            width = int(max(pos[x].max(), pos[y].max(), 1))
            left = _matrix([before[k] for k in x], width, (1 << 64) - 1)
            right = _matrix([before[k] for k in y], width, (1 << 64) - 1 - (1 << 20))
            first = _matches(left, right, 0)[0] == 0
            x, y = x[first], y[first]
            if not len(x):
                continue
            left = _matrix([hashes[k] for k in x], K, (1 << 64) - 1)
            right = _matrix([hashes[k] for k in y], K, (1 << 64) - 1 - (1 << 20))
            keep = may_link(n[x], n[y], *_matches(left, right, K))
            if keep.any():
                x, y = node[x[keep]], node[y[keep]]
                yield pd.DataFrame({"a": np.maximum(x, y), "b": np.minimum(x, y)})


def _overlaps(hashes: list[np.ndarray]) -> np.ndarray:
    """The number of common values of every two rows."""
    lens = [len(h) for h in hashes]
    values, place, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(hashes)), lens)
    column = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[place]
    row, column = row[column >= 0], column[column >= 0]
    out = np.zeros((len(hashes), len(hashes)), dtype=np.float32)
    for at in range(0, int(column.max(initial=-1)) + 1, 2048):
        here = (column >= at) & (column < at + 2048)
        has = np.zeros((len(hashes), 2048), dtype=np.float32)
        has[row[here], column[here] - at] = 1
        out += has @ has.T
    return out.astype(np.int64)


def local_roots(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix, the first row it is connected to."""
    root = np.arange(len(linked), dtype=np.int32)
    while True:
        low = root.copy()
        for at in range(0, len(root), 256):
            rows = slice(at, at + 256)
            low[rows] = np.minimum(low[rows], np.where(linked[rows], root, np.int32(len(root))).min(axis=1))
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _links_of_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of every block of a long list: a spanning forest of its certain links, and the uncertain ones across its trees."""
    for rows in _runs(batches, ["v", "block_a", "block_b"]):
        for _, g in rows.groupby(["v", "block_a", "block_b"], sort=False):
            g = g.drop_duplicates("node").sort_values("node")
            node, n = g["node"].to_numpy(), g["n"].to_numpy()
            if len(node) < 2:
                continue
            hashes = g["hashes"].to_list()
            shared = _overlaps(hashes)
            n_a, n_b = n[:, None], n[None, :]
            sized = 100 * np.minimum(n_a, n_b) >= PERCENT * np.maximum(n_a, n_b)
            whole = (n_a <= WIDE) & (n_b <= WIDE)
            linked = sized & whole & (100 * shared >= PERCENT * (n_a + n_b - shared))
            np.fill_diagonal(linked, False)
            unsure = sized & ~whole & (shared >= WIDE // 2)
            likely = np.zeros_like(linked)
            if unsure.any():
                x, y = np.nonzero(np.triu(unsure, 1))
                for at in range(0, len(x), 2048):
                    i, j = x[at : at + 2048], y[at : at + 2048]
                    left = _matrix([hashes[k] for k in i], WIDE, (1 << 64) - 1)
                    right = _matrix([hashes[k] for k in j], WIDE, (1 << 64) - 1 - (1 << 20))
                    share = _matches(left, right, WIDE)[1] / WIDE
                    # six deviations of the estimate
                    likely[i, j] = likely[j, i] = share >= PERCENT / 100 + 0.082
                    unsure[i, j] = unsure[j, i] = share >= PERCENT / 100 - 0.082
            root = local_roots(linked | likely)
            moved = np.flatnonzero(root != np.arange(len(root)))
            # a tree edge is a link if it joins whole sets that are linked; others are verified
            sure = linked[moved, root[moved]]
            yield pd.DataFrame({"a": node[moved[sure]], "b": node[root[moved[sure]]], "verified": True})
            rest = [(i, j) for i, j in _tree(linked | likely, root, moved[~sure])]
            x, y = np.nonzero(np.triu(unsure & ~likely, 1))
            across = root[x] != root[y]
            rest += list(zip(x[across].tolist(), y[across].tolist()))
            if rest:
                i, j = np.array(rest).T
                yield pd.DataFrame({"a": np.maximum(node[i], node[j]), "b": np.minimum(node[i], node[j]), "verified": linked[i, j]})


def _tree(linked: np.ndarray, root: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that join each of ``rows`` to its root, found breadth first from the roots."""
    wanted = np.isin(root, np.unique(root[rows])) if len(rows) else np.zeros(len(root), dtype=bool)
    front = np.flatnonzero(wanted & (root == np.arange(len(root))))
    left = wanted.copy()
    left[front] = False
    while len(front) and left.any():
        todo = np.flatnonzero(left)
        touches = linked[np.ix_(todo, front)]
        reached = touches.any(axis=1)
        if not reached.any():
            return
        yield from zip(todo[reached].tolist(), front[touches[reached].argmax(axis=1)].tolist())
        front = todo[reached]
        left[front] = False


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        shared = np.array([len(np.intersect1d(a, b, assume_unique=True)) for a, b in zip(rows["set_a"], rows["set_b"])], dtype=np.int64)
        n = np.array([len(a) + len(b) for a, b in zip(rows["set_a"], rows["set_b"])], dtype=np.int64)
        yield rows[["a", "b"]][100 * shared >= PERCENT * (n - shared)]


@ships_package
def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``, ``text_kept`` and ``text_hash``.

    Words are runs of characters other than space and 0x09-0x0D, with A-Z
    lower-cased; a document is the set of its 5-word shingles, of fewer words
    the whole sequence. Documents are linked when 100 * intersection >= 75 *
    union of their sets; ``component_id`` is the smallest id reachable by
    links, the document itself included, and ``kept`` marks that document.

    Null, empty and blank texts have an empty set and are linked with nothing.
    A null id takes part in no link: its component is null and it is kept.
    Rows that repeat an id are one document with the links of all its texts:
    they have one component. ``text_kept`` judges texts instead: of each group
    of texts joined by links, ids aside, it marks the rows of one text of one
    id (the smallest; empty texts and null ids: all), so that what it leaves
    holds every group. ``text_hash`` tells the texts of an id apart. Other
    columns are ignored. Empty input gives an empty result.
    """
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    sized = staged(rows.mapInPandas(_sets(0, WORDS), SETS).select("doc_id", "text_hash", "n", "digest"), "digests")
    # a class of equal sets is a node; nodes are numbered in the order of their smallest ids
    classes = (
        sized.filter("digest is not null and doc_id is not null")
        .groupBy(F.col("digest").alias("c_digest"))
        .agg(F.min("doc_id").alias("rep"))
        .orderBy("rep", "c_digest")
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = staged(classes, "classes")
    # hashing the texts again costs less than keeping the sketches of all copies
    reps = rows.mapInPandas(_sets(K, WORDS), SETS).join(classes, (F.col("digest") == F.col("c_digest")) & (F.col("doc_id") == F.col("rep")))
    reps = staged(reps.select("node", "rep", "digest", "n", "hashes").dropDuplicates(["node"]), "representatives")

    # values that two documents retain, rarest first, as many of each document as it must be listed under
    values = reps.select("node", F.explode(F.slice("hashes", 1, LISTED_OF)).alias("v"))
    common = values.groupBy("v").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").withColumnRenamed("v", "c_v")
    shared = values.join(common, F.col("v") == F.col("c_v")).groupBy("node")
    shared = shared.agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("shared")).withColumnRenamed("node", "s_node")
    need = F.least(F.lit(MIN_SHARED), F.ceil(F.col("n") * PERCENT / 100)).cast("int")
    retained = F.least(F.col("n"), F.lit(LISTED_OF)).cast("int")
    # those that no one else retains stand before all others
    listed = retained - need + 1 - (retained - F.size("shared"))
    lists = reps.join(shared, F.col("node") == F.col("s_node")).withColumn("listed", listed).filter("listed > 0")
    lists = staged(lists.select("node", "rep", "digest", "n", "hashes", "shared", F.slice("shared", 1, F.col("listed")).alias("listed")), "lists")

    discard(reps)

    # halves of hashes do for estimates
    halves = F.transform("hashes", lambda x: F.shiftright(x, 32).cast("int"))
    short = lists.select("node", "n", halves.alias("hashes"), F.col("listed.v").alias("before"), F.posexplode("listed").alias("pos", "entry"))
    short = short.filter(F.col("entry.df") <= SHORT_LIST)
    short = short.select("node", "n", "hashes", F.slice("before", 1, F.col("pos")).alias("before"), F.col("entry.v").alias("v"))
    pairs = short.repartition("v").sortWithinPartitions("v").mapInPandas(_pairs_of_lists, "a long, b long")

    # a document under a long list enters those of its smallest hashes, with a wide sketch
    in_long = lists.filter(F.exists("listed", lambda e: e["df"] > SHORT_LIST))
    low = F.slice("hashes", 1, LONG_OF)
    entries = F.filter("shared", lambda e: (e["df"] > SHORT_LIST) & F.array_contains(low, e["v"]))
    in_long = in_long.select("node", F.col("rep").alias("l_rep"), F.col("digest").alias("l_digest"), entries.alias("entries"))
    wide = only(rows, "doc_id", in_long.select("l_rep").distinct()).mapInPandas(_sets(WIDE, WORDS), SETS)
    wide = wide.join(in_long, (F.col("doc_id") == F.col("l_rep")) & (F.col("digest") == F.col("l_digest"))).dropDuplicates(["node"])
    long_entries = wide.select("node", "n", "hashes", F.explode("entries").alias("entry"))
    blocks = F.ceil(F.col("entry.df") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks).cast("int")
    # a block meets every other block of its list; itself if it is the only one
    others = F.when(blocks == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), blocks - 1), lambda b: b != mine))
    long_entries = long_entries.select("node", "n", "hashes", F.col("entry.v").alias("v"), mine.alias("mine"), F.explode(others).alias("other"))
    long_entries = long_entries.select(
        "node", "n", "hashes", "v", F.least("mine", "other").alias("block_a"), F.greatest("mine", "other").alias("block_b")
    )
    keys = ["v", "block_a", "block_b"]
    found = long_entries.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(_links_of_blocks, "a long, b long, verified boolean")

    candidates = pairs.select("a", "b", F.lit(False).alias("verified")).union(found)
    candidates = staged(candidates.groupBy("a", "b").agg(F.max("verified").alias("verified")), "candidates")
    links = candidates.filter("verified").select("a", "b").union(verified_pairs(rows, candidates.filter("not verified"), classes))
    links = staged(links, "links")
    discard(lists, candidates)

    # ids with several texts, their nodes, and the links that make each id one document
    texts_of = sized.filter("doc_id is not null").groupBy(F.col("doc_id").alias("t_id"))
    several = texts_of.agg(F.min("digest").alias("low"), F.max("digest").alias("high"), F.count_if(F.col("digest").isNull()).alias("empty"))
    several = several.filter("low < high or (low is not null and empty > 0)").select("t_id")
    named = sized.join(several, F.col("doc_id") == F.col("t_id")).join(classes, F.col("digest") == F.col("c_digest")).select("t_id", "node").distinct()
    named = staged(named, "repeated-ids")
    firsts = named.groupBy(F.col("t_id").alias("f_id")).agg(F.min("node").alias("first"))
    same_id = named.join(firsts, F.col("t_id") == F.col("f_id")).select(F.col("node").alias("a"), F.col("first").alias("b"))

    of_texts = connected_components(links).select(F.col("node").alias("x_node"), F.col("component").alias("x_first"))
    if same_id.isEmpty():
        of_ids = of_texts.select(F.col("x_node").alias("m_node"), F.col("x_first").alias("m_first"))
    else:
        of_ids = connected_components(links.union(same_id)).select(F.col("node").alias("m_node"), F.col("component").alias("m_first"))
    smallest = classes.select(F.col("node").alias("r_node"), F.col("rep").alias("component"))
    judged = classes.join(of_texts, F.col("node") == F.col("x_node"), "left").join(of_ids, F.col("node") == F.col("m_node"), "left")
    judged = judged.withColumn("first", F.coalesce("m_first", "node")).join(smallest, F.col("first") == F.col("r_node"))
    judged = judged.select("c_digest", "rep", "component", F.coalesce(F.col("x_first") == F.col("node"), F.lit(True)).alias("leads"))
    # empty texts of an id that has others
    by_id = named.join(of_ids, F.col("node") == F.col("m_node"), "left").withColumn("first", F.coalesce("m_first", "node"))
    by_id = by_id.join(smallest, F.col("first") == F.col("r_node")).groupBy("t_id").agg(F.min("component").alias("id_component"))
    members = sized.join(judged, F.col("digest") == F.col("c_digest"), "left").join(by_id, F.col("doc_id") == F.col("t_id"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("id_component", "component", "doc_id"))
    lone = F.col("digest").isNull() | F.col("doc_id").isNull()
    return members.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        F.coalesce(lone | (F.col("leads") & (F.col("doc_id") == F.col("rep"))), F.lit(True)).alias("text_kept"),
        "text_hash",
    )


def verified_pairs(rows: DataFrame, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of nodes whose full shingle sets, made anew from their texts, are linked."""
    nodes = pairs.select(F.col("a").alias("v_node")).union(pairs.select(F.col("b").alias("v_node"))).distinct()
    wanted = staged(classes.join(nodes, F.col("node") == F.col("v_node")).select("node", "rep", "c_digest"), "to-verify")
    texts = only(rows, "doc_id", wanted.select("rep").distinct())
    sets = texts.mapInPandas(_sets(None, WORDS), SETS).join(wanted, (F.col("digest") == F.col("c_digest")) & (F.col("doc_id") == F.col("rep")))
    sets = staged(sets.select("node", "hashes").dropDuplicates(["node"]), "full-sets")
    a = sets.select(F.col("node").alias("a_node"), F.col("hashes").alias("set_a"))
    b = sets.select(F.col("node").alias("b_node"), F.col("hashes").alias("set_b"))
    both = pairs.select("a", "b").join(a, F.col("a") == F.col("a_node")).join(b, F.col("b") == F.col("b_node"))
    return both.select("a", "b", "set_a", "set_b").mapInPandas(_verified, "a long, b long")
