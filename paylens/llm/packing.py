"""Packing documents into fixed-length token sequences, shortest pack first over the length histogram.

Documents are tokenized and cut into pieces of at most one sequence. Only the
histogram of piece lengths (one number per length) reaches the driver, where
lengths are placed longest first: pieces of a length go, many at once, to the
packs with the most room left, or open new packs. A placement says "pieces
number a to b of length n lie at this offset of these sequences"; pieces are
then numbered within their length on the cluster and joined to it.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import ranked, ships_package, staged
from paylens.llm.token_cache import encoder

SEQUENCE = 2048
#: Id that ends every document.
END_ID = 1
#: Buckets that split the pieces of one length for numbering.
BUCKETS = 256
#: Pieces a tokenizing task hands on at once.
PIECES_A_BATCH = 4_000

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def place(histogram: Mapping[int, int], size: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Placements (length, first, last, first_sequence, offset) of all pieces of ``histogram``.

    Pieces numbered first..last (from 0, within their length) lie at ``offset``
    of as many sequences from ``first_sequence`` on. Sequences are numbered
    gaplessly from 0. Longest lengths go first, each to the packs with the
    most room (the shortest), in order of their numbers; a new pack opens when
    even the shortest has no room. Packs filled alike are one range here, so
    the work depends on the number of lengths, not of pieces.
    """
    open_packs: list[tuple[int, int, int]] = []  # (-room, first sequence, packs)
    placed, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        number, left = 0, histogram[length]
        while left:
            if open_packs and -open_packs[0][0] >= length:
                room, first, packs = heapq.heappop(open_packs)
                room = -room
                take = min(packs, left)
                if take < packs:
                    heapq.heappush(open_packs, (-room, first + take, packs - take))
            else:
                room, first, take = size, sequences, left
                sequences += left
            placed.append((length, number, number + take - 1, first, size - room))
            if room > length:
                heapq.heappush(open_packs, (length - room, first, take))
            number, left = number + take, left - take
    return placed


def tokenized_pieces(
    docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The token pieces of every whole document (columns ``PIECES``): ``size`` ids each, the rest in the last.

    ``ids`` are little-endian uint32. A null text counts as empty; every
    document ends with ``end_id``, so has a piece at least.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = encoder(tokenizer, words=True).ids
        end = np.array([end_id], dtype="<u4").tobytes()
        rows: list[tuple] = []
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"]):
                got = ids(text) + end
                doc = None if pd.isna(doc) else int(doc)
                rows += [(doc, at // 4, len(part) // 4, len(got) // 4, part) for at in range(0, len(got), 4 * size) for part in [got[at : at + 4 * size]]]
                if len(rows) >= PIECES_A_BATCH:
                    yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})
                    rows = []
        yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    columns = ["doc_id", "start", "length", "doc_tokens", "ids"]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(cut, PIECES)


@ships_package
def pack(
    docs: DataFrame,
    tokenizer: str | os.PathLike,
    size: int = SEQUENCE,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All documents' token pieces with their places in sequences of ``size``.

    Columns ``doc_id``, ``start`` (the document's ids before the piece),
    ``length``, ``doc_tokens``, ``ids`` (little-endian uint32), ``ids_crc32``,
    ``sequence_id``, ``offset``. Each id of a document lies in exactly one
    piece; a sequence's pieces fill it from 0 without gaps, and it is padded
    after the last. A null or empty text is the end id alone. Null ids and
    repeated rows are packed like any others, each on its own. Other input
    columns are ignored. Empty input gives an empty result.

    The tokenized pieces are written to the shared folder once. The driver
    gets one count per length, ``size`` at most; the placements, a few per
    length, are joined by Spark, which broadcasts them only if they are small.
    """
    spark = docs.sparkSession
    pieces = tokenized_pieces(docs, os.fspath(tokenizer), size, end_id, id_col, text_col)
    pieces = staged(pieces.withColumn("ids_crc32", F.crc32("ids")), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_length: dict[int, list[tuple]] = {}
    for length, *placement in place(histogram, size):
        by_length.setdefault(length, []).append(tuple(placement))
    places = spark.createDataFrame(
        [(length, got) for length, got in by_length.items()],
        "p_length long, places array<struct<first: long, last: long, first_sequence: long, at: long>>",
    )
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(BUCKETS)))
    rows = ranked(rows, ["length"], "bucket", ["doc_id", "start", "ids_crc32"], "number")
    rows = rows.join(places, F.col("length") == F.col("p_length"))
    mine = F.filter("places", lambda p: (p["first"] <= F.col("number")) & (F.col("number") <= p["last"]))[0]
    return rows.withColumn("place", mine).select(
        "doc_id",
        "start",
        "length",
        "doc_tokens",
        "ids",
        "ids_crc32",
        (F.col("place.first_sequence") + F.col("number") - F.col("place.first")).alias("sequence_id"),
        F.col("place.at").alias("offset"),
    )
