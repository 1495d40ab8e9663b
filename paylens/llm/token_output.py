"""Writing tokenized documents as grammar-compressed shards, and reading them back.

Documents are range-partitioned and sorted by id; each task cuts its run of
documents into shards of about ``shard_ids`` ids and stores each as one row of
a Parquet table: the shard's place, its document ids, how many ids each has,
and the Re-Pair grammar of all their ids (:mod:`paylens.llm.repair`). Reading
decodes whole shards, or any range of one from its own symbols.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylens.llm.common import ship_package, ships_package
from paylens.llm import repair
from paylens.llm.token_cache import encoder

#: Ids a shard holds at least, but for the last of a partition; documents aren't split.
SHARD_IDS = 1 << 22
#: Characters that are encoded together, at least, but for the last of a partition: the more, the fewer words are looked up.
WINDOW_CHARS = 12 << 20
#: Id that ends every document.
END_ID = 2

SHARDS = "part int, shard int, n_ids long, docs binary, tokens binary, ids binary"


@ships_package
def write_shards(
    docs: DataFrame,
    path: str,
    tokenizer: str | os.PathLike,
    shard_ids: int = SHARD_IDS,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every whole document of ``docs`` and write the shards, in ascending id order, to ``path``.

    A null text counts as empty; every document ends with ``end_id``. Null ids
    come first; rows that repeat an id follow each other, ordered by a hash of
    their text. Other columns are ignored. Empty input writes an empty table.
    (``part``, ``shard``) order the shards. The order is global, but no task
    sees more than its range, and a shard is the most that one holds.
    """
    tokenizer = os.fspath(tokenizer)

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer, words=False)
        terminals = max(enc.tokenizer.get_vocab_size(), end_id + 1)
        end = np.array([end_id], dtype="<u4").tobytes()
        part, made = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def stored() -> pd.DataFrame:
            ids = np.frombuffer(b"".join(held), "<u4")
            row = (part, made, len(ids), pack_ids(doc_ids), np.array([len(x) // 4 for x in held], "<u4").tobytes(), repair.compress(ids, terminals))
            return pd.DataFrame([row], columns=["part", "shard", "n_ids", "docs", "tokens", "ids"])

        for some_docs, texts in windows(batches):
            for doc, got in zip(some_docs, enc.batch(texts)):
                got += end
                doc_ids.append(None if pd.isna(doc) else int(doc))
                held.append(got)
                size += len(got) // 4
                if size >= shard_ids:
                    yield stored()
                    made, doc_ids, held, size = made + 1, [], [], 0
        if held:
            yield stored()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    rows.select("doc_id", "text").mapInPandas(shards, SHARDS).write.option("compression", "zstd").parquet(path)


def windows(batches: Iterator[pd.DataFrame], chars: int = WINDOW_CHARS) -> Iterator[tuple[list, list[str | None]]]:
    """Ids and texts of batches in a row that have ``chars`` characters together, the last ones fewer."""
    docs, texts, size = [], [], 0
    for batch in batches:
        docs += batch["doc_id"].tolist()
        texts += batch["text"].tolist()
        size += int(batch["text"].str.len().sum())
        if size >= chars:
            yield docs, texts
            docs, texts, size = [], [], 0
    if docs:
        yield docs, texts


def pack_ids(doc_ids: list[int | None]) -> bytes:
    """Document ids as a byte per id that tells nulls, then int64 values."""
    known = np.array([x is not None for x in doc_ids], dtype=np.uint8)
    return known.tobytes() + np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes()


def unpack_ids(stored: bytes) -> list[int | None]:
    n = len(stored) // 9
    return [x if k else None for x, k in zip(np.frombuffer(stored, "<i8", n, n).tolist(), stored[:n])]


def read_documents(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The documents of the shards at ``path``: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and ``ids``.

    ``start`` counts the ids of all documents before; ``n_tokens`` has the end
    id; ``ids`` are little-endian uint32, decoded from the grammar (left out
    without ``with_ids``). The shards' running count takes one row per shard.
    """
    ship_package(spark)
    shards = spark.read.schema(SHARDS).parquet(path)
    columns = ["part", "shard", "doc_id", "place", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids = repair.Shard(row.ids).ids().astype("<u4", copy=False)
                lengths = np.frombuffer(row.tokens, "<u4").astype(np.int64)
                ends = np.cumsum(lengths)
                parts = [memoryview(ids[a:b]).cast("B") for a, b in zip(ends - lengths, ends)]
                got = {
                    "part": row.part,
                    "shard": row.shard,
                    "doc_id": pd.array(unpack_ids(row.docs), dtype="Int64"),
                    "place": ends - lengths,
                    "n_tokens": lengths,
                    "ids_crc32": [zlib.crc32(x) for x in parts],
                }
                yield pd.DataFrame(got | ({"ids": [bytes(x) for x in parts]} if with_ids else {}), columns=columns)

    kinds = "part int, shard int, doc_id long, place long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    docs = shards.select("part", "shard", "docs", "tokens", "ids").mapInPandas(documents, kinds)
    before = Window.orderBy("s_part", "s_shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select(F.col("part").alias("s_part"), F.col("shard").alias("s_shard"), "n_ids").select(
        "s_part", "s_shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before")
    )
    rows = docs.join(starts, (F.col("part") == F.col("s_part")) & (F.col("shard") == F.col("s_shard")))
    return rows.select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
