"""Language ID by rank-order profiles.

A language's profile is the list of its most frequent letter n-grams (1 to 3
letters, word boundaries marked) in rank order. A document is compared by the
out-of-place distance: for each of its own most frequent n-grams, how far its
rank is from the rank in the profile, a fixed maximum where it is missing. The
language with the smallest distance wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.llm.common import ships_package

#: n-grams per profile.
PROFILE_SIZE = 300
#: Label of texts that are null or have no letter.
UNDETERMINED = "und"
#: Languages whose profiles are held together in memory; more raise an error.
MAX_LANGUAGES = 10_000
#: A task passes on its n-gram counts when it holds this many.
FLUSH_GRAMS = 200_000

_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the lower-cased text's n-grams; both empty without letters.

    A code holds up to three code points of 21 bits; U+0001 marks the edge of
    a word. Grams don't reach over a word's edges.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    is_letter = letter_table()[points]
    if not is_letter.any():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    marked = np.ones(len(points) + 2, dtype=np.uint64)
    marked[1:-1] = np.where(is_letter, points, 1)
    keep = np.ones(len(marked), dtype=bool)
    keep[1:] = (marked[1:] != 1) | (marked[:-1] != 1)
    a = marked[keep]
    shift = np.uint64(21)
    two = (a[:-1] << shift) | a[1:]
    three = (two[:-1] << shift) | a[2:]
    codes = np.concatenate([a[a != 1], two, three[a[1:-1] != 1]])
    return np.unique(codes, return_counts=True)


def top_codes(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes, in rank order; ties by code."""
    if len(codes) > 4 * size:
        floor = np.partition(counts, len(counts) - size)[len(counts) - size]
        codes, counts = codes[counts >= floor], counts[counts >= floor]
    return codes[np.lexsort((codes, -counts))[:size]]


@dataclass(frozen=True)
class Profiles:
    """Ranks of all profiles' n-grams: ``ranks[i, l]`` is that of ``codes[i]`` in ``langs[l]``, ``size`` if missing."""

    langs: tuple[str, ...]
    codes: np.ndarray
    ranks: np.ndarray
    size: int

    @classmethod
    def of(cls, tops: dict[str, list[int]], size: int) -> Profiles:
        langs = tuple(sorted(tops))
        codes = np.unique(np.array([c for top in tops.values() for c in top], dtype=np.uint64))
        ranks = np.full((len(codes), len(langs)), size, dtype=np.int32)
        for at, lang in enumerate(langs):
            ranks[np.searchsorted(codes, np.array(tops[lang], dtype=np.uint64)), at] = np.arange(len(tops[lang]))
        return cls(langs, codes, ranks, size)

    def closest(self, text: str | None) -> tuple[str, float]:
        """The language of the smallest out-of-place distance (ties: first by name) and 1 - distance / maximum."""
        top = top_codes(*gram_counts(text), self.size) if text and self.langs else ()
        if not len(top):
            return UNDETERMINED, 0.0
        at = np.minimum(np.searchsorted(self.codes, top), len(self.codes) - 1)
        known = self.codes[at] == top
        places = np.abs(self.ranks[at] - np.arange(len(top))[:, None])
        places = np.where(known[:, None] & (self.ranks[at] < self.size), places, self.size)
        distance = places.sum(axis=0)
        best = int(distance.argmin())
        return self.langs[best], 1.0 - float(distance[best]) / (len(top) * self.size)


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    grams = 0

    def merged(parts):
        codes = np.concatenate([c for c, _ in parts])
        counts = np.concatenate([n for _, n in parts])
        codes, place = np.unique(codes, return_inverse=True)
        return codes, np.bincount(place, weights=counts).astype(np.int64)

    def passed_on():
        for lang, parts in held.items():
            codes, counts = merged(parts)
            yield pd.DataFrame({"lang": lang, "code": codes.astype(np.int64), "n": counts})

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            codes, counts = gram_counts(text)
            held.setdefault(lang, []).append((codes, counts))
            grams += len(codes)
            if grams > 4 * FLUSH_GRAMS:
                held = {k: [merged(parts)] for k, parts in held.items()}
                grams = sum(len(parts[0][0]) for parts in held.values())
                if grams > FLUSH_GRAMS:
                    yield from passed_on()
                    held, grams = {}, 0
    yield from passed_on()


@ships_package
def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE_SIZE) -> Profiles:
    """Profiles of every language in ``docs``, counted over all their whole texts.

    Rows with a null text or language are left out. Counts are summed inside
    tasks, then by (language, n-gram). The driver gets ``size`` n-grams per
    language; more than ``MAX_LANGUAGES`` languages raise a ValueError.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).dropna()
    counts = rows.mapInPandas(_count_grams, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= size)
    found = top.limit(MAX_LANGUAGES * size + 1).collect()
    if len(found) > MAX_LANGUAGES * size:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    tops: dict[str, list[int]] = {}
    for r in sorted(found, key=lambda r: (r["lang"], r["place"])):
        tops.setdefault(r["lang"], []).append(r["code"])
    return Profiles.of(tops, size)


@ships_package
def identify(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score`` (0 to 1) of every whole text.

    Null texts, texts without a letter, and every text when no language was
    learned get ``und`` and 0. Equal distances go to the first language by
    name. Equal texts get equal results, so repeated rows do. Input columns of
    the added names are replaced.
    """

    @F.pandas_udf("lang string, score double")
    def closest(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([profiles.closest(t) for t in batch], columns=["lang", "score"])

    docs = docs.drop("lang_pred", "lang_score")
    # declared nondeterministic, or a caller's filter on the result would run it again below, in a second worker per task
    found = closest.asNondeterministic()(F.col(text_col))
    return docs.select("*", found.alias("found")).select(
        *docs.columns, F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("lang_score")
    )


def learning_fold(id_col: str = "doc_id", folds: int = 4, held_out: int = 2) -> Column:
    """Whether a row may be learned from: the CRC-32 of its id as text leaves another remainder than ``held_out``."""
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    return F.coalesce(rest != held_out, F.lit(False))
