"""The corpus pipeline: language ID, line dedup, near-dedup, source mixing, packing.

Each stage is a function of (spark, docs, sf_dir) that works on all its
predecessor kept; its result is written as Parquet in the shared folder and
read back for the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.llm import lang_id, line_dedup, mixing, near_dup, packing
from paylens.llm.common import discard, read_table, ship_package, staged
from paylens.llm.queries import MIX_BLOCK, MIX_WEIGHTS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Texts whose n-grams are further than this from every learned language go; ordinary prose scores 0.4 and more.
MIN_LANGUAGE_SCORE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts of no learned language (null, without letters, or far from all); ``lang`` becomes the language found."""
    ship_package(spark)
    profiles = lang_id.learn_profiles(docs.filter(lang_id.learning_fold()))
    found = lang_id.identify(docs.select(*COLUMNS), profiles)
    found = found.filter((F.col("lang_pred") != lang_id.UNDETERMINED) & (F.col("lang_score") >= MIN_LANGUAGE_SCORE))
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes cross-site boilerplate lines from the texts; ``n_chars`` follows."""
    cleaned = line_dedup.drop_boilerplate(docs.select(*COLUMNS))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates; of one that is repeated with the same text, one row.

    Texts are judged, not ids: where an id has several texts, each goes only if
    another of its group stays. Documents without an id stay.
    """
    ship_package(spark)
    verdicts = staged(near_dup.near_duplicates(docs.select("doc_id", "text")), "verdicts")
    docs = docs.select(*COLUMNS).withColumn("text_hash", F.xxhash64("text"))
    texts = verdicts.filter("doc_id is not null").groupBy(F.col("doc_id").alias("v_id"), F.col("text_hash").alias("v_hash"))
    texts = texts.agg(F.max("text_kept").alias("stays"), F.count(F.lit(1)).alias("rows"))
    same = (F.col("doc_id") == F.col("v_id")) & (F.col("text_hash") == F.col("v_hash"))
    judged = docs.join(texts.filter("not stays or rows > 1"), same, "left")
    once = judged.filter("v_id is null").select(*COLUMNS)
    repeated = judged.filter("stays").dropDuplicates(["doc_id", "text_hash"]).select(*COLUMNS)
    return once.union(repeated)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, and of sources short of their target weight again, in the order of the mixed stream."""
    stream = mixing.mix_sources(docs.select(*COLUMNS), MIX_WEIGHTS, other_weight=1, block_rows=MIX_BLOCK)
    return stream.orderBy("mix_position").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents with their places in sequences."""
    ship_package(spark)
    pieces = packing.pack(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.col("offset").cast("long").alias("offset"))


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mixed", mixed),
    ("packed", packed),
]

#: Learned profiles, shingle components and token ids have no SQL form; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    made = []
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        made.append(docs)
    discard(*made[:-1])
    return docs
