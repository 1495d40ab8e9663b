"""Grouping of spelling variants by a dictionary of trie-node pairs.

The nodes of the words' trie and of the trie of the reversed words are
numbered. Cut anywhere, a word is a pair of integers: the node of what stands
before the cut and the node of what follows. Two words differ by one replaced
code point exactly if they share the pair around it, by one inserted one
exactly if the pair around it is a cut of the shorter word. So an equi join on
integer pairs finds all neighbours and nothing else.

A trie is numbered in one pass over the sorted words: a word adds nodes below
the longest prefix it shares with the word before. Each range of words is
numbered by a task of its own; the nodes that a range shares with the one
before it are few (a path of the trie), and are renamed afterwards.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.llm.common import ships_package, staged

#: Words of a range that one task numbers.
RANGE_WORDS = 200_000
#: A task passes its word counts on when it holds this many words, or has met this many characters in them.
FLUSH_WORDS, FLUSH_CHARS = 200_000, 64 << 20
#: Bits of a node's number within its range.
NODE_BITS = 40


def mutated_words(doc_id: int | None, text: str, min_length: int, every: int) -> Counter:
    """Counts of a text's lower-cased runs, one code point deleted where the hash of id and run says so; short ones left out."""
    # Fixed value: what a word is made of. A greedy match from the left is a maximal run.
    runs = re.findall("[A-Za-z\u00C0-\u00FF]{%d,}" % min_length, text)
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in Counter(runs).items():
        low = run.encode().lower()  # of bytes: A-Z only
        h = zlib.crc32(low, start)
        run = low.decode()
        if h % every == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1:]
        if len(run) >= min_length:
            out[run] += n
    return out


def word_counts(docs: DataFrame, min_length: int, min_count: int, every: int) -> DataFrame:
    """``word``, ``n``: the words of all texts, of ``min_length`` code points and ``min_count`` occurrences at least."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        chars = 0

        def table() -> pd.DataFrame:
            return pd.DataFrame({"word": list(held), "n": list(held.values())}).astype({"word": object, "n": "int64"})

        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["text"]):
                found = mutated_words(doc_id, text, min_length, every)
                chars += sum(map(len, found))
                held.update(found)
                if len(held) >= FLUSH_WORDS or chars >= FLUSH_CHARS:
                    yield table()
                    held.clear()
                    chars = 0
        yield table()

    # ids travel as text: pandas would make longs with nulls into doubles
    pairs = docs.select(F.col("doc_id").cast("string").alias("id"), "text").filter("text is not null")
    counts = pairs.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= min_count)


def shared(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid)
    return lo


def numbered(words: DataFrame, key: Column, ranges: int, label: str) -> DataFrame:
    """``words`` and ``nodes``: the numbers of the trie nodes of the prefixes of ``key``, of length 0 to its own."""
    spread = words.withColumn("spelt", key).repartitionByRange(ranges, "spelt").sortWithinPartitions("spelt")
    spread = spread.withColumn("part", F.spark_partition_id().cast("long"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, path, made = "", None, 0
        for batch in batches:
            out = []
            for word, part in zip(batch["spelt"], batch["part"]):
                if path is None:
                    path, made = [part << NODE_BITS], 1
                keep = shared(last, word)
                new = (part << NODE_BITS) + made
                path = path[:keep + 1] + list(range(new, new + len(word) - keep))
                made += len(word) - keep
                last = word
                out.append(path)
            yield batch.assign(nodes=out)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spread.schema.fields) + ", nodes array<long>"
    table = staged(spread.mapInPandas(walk, schema), label)
    ends = table.groupBy("part").agg(F.min("spelt").alias("first"), F.max(F.struct("spelt", "nodes")).alias("last")).orderBy("part").collect()
    renamed, before = [], None
    for row in ends:
        names: list[int] = []
        if before is not None:
            names = before[1][:shared(before[0], row.first) + 1]
        renamed.append((row.part, names))
        before = (row.last.spelt, names_of(row.last.nodes, row.part, names))
    names = words.sparkSession.createDataFrame(renamed, "part long, names array<long>")
    own = F.shiftleft(F.col("part"), NODE_BITS)
    same = F.transform("nodes", lambda x, i: F.when((i < F.size("names")) & (x == own + i), F.get("names", i)).otherwise(x))
    nodes = F.when(F.size("names") == 0, F.col("nodes")).otherwise(same)
    return table.join(names, "part").withColumn("nodes", nodes).drop("part", "names", "spelt")


def names_of(nodes: list[int], part: int, names: list[int]) -> list[int]:
    """A path's nodes, those it shares with the range before by the names they have there."""
    return [names[i] if i < len(names) and x == (part << NODE_BITS) + i else x for i, x in enumerate(nodes)]


#: Uses of a pair: a cut of the word; what surrounds one of its code points; the same, the first of equal ones in a row.
CUT, AROUND, AROUND_FIRST = 0, 1, 2


def node_pairs(words: DataFrame) -> DataFrame:
    """(before, after, code) for every cut of a word and every code point skipped; ``code`` is 4 times the id plus the use.

    ``words`` holds ``id``, ``word``, ``before`` and ``after``: the nodes of
    its prefixes and of its suffixes, by length. Deleting any of several equal
    code points in a row gives the same word, so only the first makes a link
    to a shorter word.
    """
    each = words.select("id", "word", "after", F.posexplode("before").alias("at", "node"))
    here, ahead = F.col("at"), F.length("word") - F.col("at")
    first = (here == 0) | (F.substring("word", here + 1, F.lit(1)) != F.substring("word", here, F.lit(1)))
    code = F.col("id") * 4
    skip = F.when(ahead > 0, F.struct(F.get("after", ahead - 1).alias("after"), (code + F.when(first, AROUND_FIRST).otherwise(AROUND)).alias("code")))
    cut = F.struct(F.get("after", ahead).alias("after"), (code + CUT).alias("code"))
    return each.select(F.col("node").alias("before"), F.inline(F.array_compact(F.array(cut, skip))))


def neighbours(pairs: DataFrame) -> DataFrame:
    """``id``, ``n_near``, ``near_id``: how many words are near, and the least id of them.

    All words around one pair of nodes are neighbours of each other, and those
    marked first also of the one word cut there. A pair gathers no more words
    than the alphabet has letters, plus one. Counts and least ids of a pair
    say all that its words need, so no pair of words is written out: each word
    learns the least, and the least word hears of each other one.
    """
    dealt = pairs.repartition("before", "after")
    use = F.col("code") % 4
    groups = (
        dealt.groupBy("before", "after")
        .agg(
            F.count_if(use != CUT).alias("n_around"),
            F.count_if(use == AROUND_FIRST).alias("n_longer"),
            F.min(F.when(use != CUT, F.col("code"))).alias("around"),
            F.min(F.when(use == AROUND_FIRST, F.col("code"))).alias("longer"),
            F.min(F.when(use == CUT, F.col("code"))).alias("cut"),
        )
        .filter("n_around > 1 or (n_longer > 0 and cut is not null)")
    )
    joined = dealt.join(groups, ["before", "after"])
    shorter = F.when(use == AROUND_FIRST, F.col("cut"))
    other = F.when(F.col("code") != F.col("around"), F.col("around"))
    is_cut = use == CUT
    told = F.struct(
        F.col("code").alias("to"),
        F.when(is_cut, F.col("n_longer")).otherwise(F.col("n_around") - 1 + shorter.isNotNull().cast("int")).alias("k"),
        F.when(is_cut, F.col("longer")).otherwise(F.least(other, shorter)).alias("best"),
    )
    heard = F.when(~is_cut & other.isNotNull(), F.struct(other.alias("to"), F.lit(0).cast("long").alias("k"), F.col("code").alias("best")))
    rows = joined.select(F.inline(F.array_compact(F.array(told, heard))))
    ids = rows.select(F.shiftright("to", 2).alias("id"), "k", F.shiftright("best", 2).alias("best"))
    return ids.groupBy("id").agg(F.sum("k").alias("n_near"), F.min("best").alias("near_id")).filter("n_near > 0")


@ships_package
def spelling_variants(docs: DataFrame, min_length: int = 7, min_count: int = 2, ratio: int = 10, every: int = 31) -> DataFrame:
    """The words of all texts with their near words, one row each.

    ``docs`` holds ``doc_id`` and ``text``. Words are lower-cased runs (A-Z
    only) of Latin letters; where ``every`` divides the hash of id and run,
    one code point of it is deleted. Gives ``word``, ``form`` (the near word
    with the most occurrences, ties to the smaller, if it has ``ratio`` times
    the word's own; else null), ``root`` (the last form, following forms; the
    word itself if it has none), ``n``, ``n_near``, ``form_n``.

    Null and empty texts have no words; a null id hashes as an empty one;
    repeated rows count each time; other columns play no part. An empty table
    gives an empty result. Words of any length are kept: a word of k code
    points makes 2k + 1 integer pairs.
    """
    counted = staged(word_counts(docs, min_length, min_count, every), "words")
    size = counted.agg(F.count(F.lit(1)).alias("words"), F.max("n").alias("most")).first()
    ranges = size.words // RANGE_WORDS + 1
    # ids rise with the rank of a word as a form
    by_rank = counted.repartitionByRange(ranges, F.desc("n"), "word").sortWithinPartitions(F.desc("n"), "word")
    words = staged(by_rank.withColumn("id", F.monotonically_increasing_id()), "words")
    forward = numbered(words.select("id", "word"), F.col("word"), ranges, "trie").withColumnRenamed("nodes", "before")
    backward = numbered(words.select("id", "word"), F.reverse("word"), ranges, "trie").select("id", F.col("nodes").alias("after"))
    near = neighbours(node_pairs(forward.join(backward, "id")))
    best = words.select(F.col("id").alias("near_id"), F.col("n").alias("near_n"))
    found = staged(
        words.join(near, "id", "left").join(best, "near_id", "left")
        .select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                F.when(F.col("near_n") >= F.col("n") * ratio, F.col("near_id")).alias("form_id")),
        "variants",
    )
    linked = found.filter("form_id is not null")
    roots = chain_ends(linked.select("id", F.col("form_id").alias("end")), size.most or 0, min_count, ratio)
    forms = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    ends = words.select(F.col("id").alias("end"), F.col("word").alias("root"))
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    alone = found.filter("form_id is null").select(
        "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", F.lit(None).cast("long").alias("form_n"))
    return alone.select(columns).union(linked.join(roots, "id").join(forms, "form_id").join(ends, "end").select(columns))


def chain_ends(links: DataFrame, most: int, least: int, ratio: int) -> DataFrame:
    """The last of each chain of ``links`` (id, end), by doubling.

    Every link multiplies the count by ``ratio`` at least, so chains are no
    longer than the logarithm of ``most``, and the rounds its logarithm.
    """
    if ratio < 2:
        raise ValueError("ratio below 2: chains of forms need growing counts")
    length, n = 0, least
    while n * ratio <= most:
        n *= ratio
        length += 1
    for _ in range(max(0, length - 1).bit_length()):
        onward = links.select(F.col("id").alias("end"), F.col("end").alias("further"))
        links = links.join(onward, "end", "left").select("id", F.coalesce("further", "end").alias("end"))
    return links
