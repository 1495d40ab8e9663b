"""One query per operator, over its whole table with production parameters, and its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.llm import ann, block_labeller, embedding_dedup, infill, lang_id, licenses, line_dedup, mixing, near_dup, packing, quality, spelling, token_output
from paylens.llm.common import read_table, ship_package
from paylens.sinks.writers import scratch_path

#: Target shares of op1: the hot source may take 8 of 27 blocks, each other source one.
MIX_WEIGHTS = {"src0": 8} | {f"src{i}": 1 for i in range(1, 20)}
MIX_BLOCK = 16


def held_out(folds: int, rest: int) -> Column:
    """Whether the CRC-32 of the id as text leaves ``rest``; not so for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == rest, F.lit(False))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    mixed = mixing.mix_sources(docs, MIX_WEIGHTS, other_weight=1, block_rows=MIX_BLOCK)
    return mixed.select("doc_id", "mix_source", "mix_epoch", "mix_block", "mix_slot", "mix_position")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = line_dedup.drop_boilerplate(docs)
    return out.select("doc_id", "n_lines", "n_dropped", "kept_whole", F.md5("text").alias("text_md5"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs).select("doc_id", "text_digest", "license_id", "notice_ids", "n_notices")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    found = near_dup.near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "kept", "text_kept")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    profiles = lang_id.learn_profiles(docs.filter(lang_id.learning_fold()))
    found = lang_id.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return embedding_dedup.near_duplicate_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").filter(lang_id.learning_fold(folds=5, held_out=0))
    scored = quality.score_documents(docs, quality.learn(docs, labels))
    return scored.select(
        "doc_id", held_out(5, 0).alias("held_out"), F.col("quality_score").alias("score"), F.col("quality_predicted").alias("predicted")
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.col("offset").cast("long").alias("offset"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_path(spark, "llm-shards")
    token_output.write_shards(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_output.read_documents(spark, path, with_ids=False)


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = block_labeller.extract_main_text(pages).drop("html").withColumnRenamed("main_text", "text")
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks", "n_main_blocks")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    made = infill.restore(infill.fill_in_middle(docs).drop("text"))
    return made.select(
        "doc_id", F.col("fim_units").alias("n"), F.col("fim_form").alias("form"),
        F.col("fim_prefix_chars").alias("prefix_chars"), F.col("fim_middle_chars").alias("middle_chars"),
        F.sha2("fim_output", 256).alias("output_sha256"), F.sha2("fim_restored", 256).alias("restored_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_line_dedup": op2_line_dedup,
    "op3_nearest": op3_nearest,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_quality": op5_quality,
    "op6_packing": op6_packing,
    "op7_license_scan": op7_license_scan,
    "op8_near_dedup": op8_near_dedup,
    "op9_language_id": op9_language_id,
    "op10_token_output": op10_token_output,
    "op11_html_extraction": op11_html_extraction,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_spelling_variants": op13_spelling_variants,
}


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The licence rule is stated here again, so that a wrong constant in the operator shows.
_YEAR = r"([0-9]{4}|[<\[{]|yyyy|xxxx)"
_NOTICE_LINE = (
    r"^[ \t]*(©|copyright[ \t]*[:,]?[ \t]*(\(c\)|©|&copy;|" + _YEAR + r")|\(c\)[ \t]*(copyright\b|" + _YEAR + r")|all rights reserved[^a-z0-9]*$)"
)
_SHORT_PARAGRAPH = r"^[ \t]{0,8}(copyright|\(c\))[ \t][^\n]{0,72}$"
_MARKS = r"[\x00-\x2f\x3a-\x60\x7b-\x7f\x{a0}\x{a9}\x{2010}-\x{201f}]+"
_SAME_PHRASES = (
    (" sub license", " sublicense"), (" sub licence", " sublicense"), (" non commercial ", " noncommercial "), (" per cent ", " percent "),
    (" copyright owner ", " copyright holder "), (" whilst ", " while "), (" judgement ", " judgment "), (" acknowledgement ", " acknowledgment "),
    (" fulfil ", " fulfill "), (" wilful ", " willful "), (" https ", " http "), (" released under ", " licensed under "), (" distributed under ", " licensed under "),
)
_SAME_ENDINGS = (
    (r"([a-z]{2}en)c(e|es|ed|ing) ", "s"), (r"([a-z]{3})is(e|es|ed|ing|ation|ations) ", "iz"), (r"([a-z]{3})our(s|ed|ite|able|) ", "or"),
)


def _body_lines_sql(text: str) -> str:
    """The lower-cased lines of a text as a list, its notices of copyright empty, in DuckDB."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lines = f"string_split(translate({text}, '{upper}', '{upper.lower()}'), chr(10))"
    return f"""list_transform(range(1, len({lines}) + 1), lambda i:
      CASE WHEN regexp_matches({lines}[i], {_quoted(_NOTICE_LINE)}) THEN ''
           WHEN regexp_matches({lines}[i], {_quoted(_SHORT_PARAGRAPH)})
                AND (i = 1 OR (i >= 3 AND regexp_full_match({lines}[i - 1], '[ \\t\\r]{{0,8}}')))
                AND (i = len({lines}) OR regexp_full_match({lines}[i + 1], '[ \\t\\r]*')) THEN ''
           ELSE {lines}[i] END)"""


def _canonical_sql(words: str) -> str:
    """The canonical form of lower-cased text, in DuckDB."""
    s = f"' ' || trim(regexp_replace({words}, {_quoted(_MARKS)}, ' ', 'g')) || ' '"
    for phrase, same in _SAME_PHRASES:
        s = f"replace({s}, '{phrase}', '{same}')"
    for pattern, middle in _SAME_ENDINGS:
        s = f"regexp_replace({s}, {_quoted(pattern)}, '\\1{middle}\\2 ', 'g')"
    return f"ltrim({s})"


def _digest_sql(words: str) -> str:
    form = _canonical_sql(words)
    return f"CASE WHEN {form} <> '' THEN sha256({form}) END"


# SHA-256 of the canonical forms of whole licences.
_WHOLE_DIGESTS = {
    "0BSD": "94986e2479559292849ef789ea120a418d842d1c1ea8b1c95862dd5328d3e41f",
    "Apache-2.0": "f23f632d75e85b02153b5689b2501dc20f398e8f3280b4394821a8bd7b3f9035",
    "Artistic-1.0-Perl": "ab90bb2ab0a16f6f5c8479843bcd110050fe6a2c8072424cc5fda0b53dc014f2",
    "BSD-2-Clause": "598ae8bac7f1b5cbd0561da45c9f19150f9f7e9561de6db02d6e36dc101b288b",
    "BSD-3-Clause": "63865dba4edb9a6c156dafbd370c19ad21dcebb0d08d6114e23ffea41433c649",
    "CC0-1.0": "6a9479bcf17594da510aa411514be2e9b9357447d1f3837cf59bd9a901e7fa18",
    "GFDL-1.2": "adebe6d6edc6a56c4426f97eced14fb50c1c53573246d5b26a73f94c8eeb1e5a",
    "GFDL-1.3": "a12dca205488c939c8ebdbf3e1e02ec6ce29c4a5442e274bfe0cb9a1c4e8972a",
    "GPL-1.0": "4f5afcdc0d25a316d9a012a3753e4db8e0b77356aba4d701d941b89390d30d1a",
    "GPL-2.0": "fb9eba9b575dc38a5ec88649ae9608e98c1548fbeabacfd785c467b67280b251",
    "GPL-3.0": "938edcd3de63edb9cf6fe3e2a92489f9ec0de51e8fb067e66cef583d8d3093b1",
    "ISC": "d0b8d29e88a8a96b8b5a97323823d684a02122572d4d85b9f5a308991fe666d2",
    "LGPL-2.0": "f61865fd17694ddf3c1123c19566ae880b0ef66a1b2248bdbb088a95a67ab8a2",
    "LGPL-2.1": "eee0684ff88b0ef99802902c20fe6c8cffb8370177c4fe99d8a1ed014082b278",
    "LGPL-3.0": "b7fdfbc1886def2a80f6e0ddff33f2cb7335fefdeaa2ed5b161b0c6ae2ce5679",
    "MIT": "78be8aabab11ea5d9f0d79454acaf4ac1c48bb803a708006b22a3d5d90efc837",
    "MPL-1.1": "61e5b3cbe2c273f053ba5ff6ff8f3e55696812fc87cf37fd5e4c5d6cf26cd52f",
    "MPL-2.0": "47784d02a08f3ab72d6c2c9f1a74967c2b09aebfa747f453ccfd51a26fd1690c",
    "Unlicense": "d96037bf73aed5f35d0ecf5a5213a3296c7bfd9b8d9f6c66d0fd73bd13d02d8b",
    "Zlib": "4e8cde0213cc32db7bcbe8d4ab9484e0cca26c40c45727adb5b44aefe6df269f",
}
# Notices, by licence.
_NOTICES = (
    ("MIT", "Licensed under the MIT License."), ("MIT", "This project is licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "Licensed under the Apache License 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("ISC", "Licensed under the ISC License."), ("ISC", "SPDX-License-Identifier: ISC"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."), ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."), ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"), ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("Unlicense", "SPDX-License-Identifier: Unlicense"), ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC-BY-SA-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
)
_WHOLE_SQL = ", ".join(f"({_quoted(k)}, {_quoted(d)})" for k, d in _WHOLE_DIGESTS.items())
_NOTICES_SQL = ", ".join(f"({_quoted(k)}, {_quoted(v.lower())})" for k, v in _NOTICES)
_WEIGHTS_SQL = ", ".join(f"('{s}', {w})" for s, w in [*MIX_WEIGHTS.items(), ("", 1)])

ORACLE_SQL: dict[str, str] = {
    "op1_mix_sources": f"""
WITH RECURSIVE shares(mix_source, w) AS (VALUES {_WEIGHTS_SQL}),
named AS (
  SELECT doc_id, coalesce(s.mix_source, '') AS mix_source
  FROM documents d LEFT JOIN shares s ON d.source = s.mix_source AND s.mix_source <> ''),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY mix_source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS r FROM named),
sizes AS (
  SELECT mix_source, any_value(w) AS w, (count(*) + {MIX_BLOCK - 1}) // {MIX_BLOCK} AS blocks
  FROM placed JOIN shares USING (mix_source) GROUP BY mix_source),
cycle AS (
  SELECT list(mix_source ORDER BY mix_source) AS names, list(w ORDER BY mix_source) AS ws,
         CAST(sum(w) AS BIGINT) AS total, max((blocks + w - 1) // w) AS cycles FROM sizes),
slots(t, turn, taken, pick) AS (
  SELECT CAST(-1 AS BIGINT), CAST(0 AS BIGINT), list_transform(ws, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM cycle
  UNION ALL
  SELECT t, list_extract(taken, pick), list_transform(range(1, len(taken) + 1),
           lambda i: list_extract(taken, i) + CASE WHEN i = pick THEN 1 ELSE 0 END), pick
  FROM (
    SELECT t + 1 AS t, taken, list_min(list_filter(list_transform(range(1, len(taken) + 1), lambda i:
             CASE WHEN list_extract(taken, i) < list_extract(ws, i)
                   AND (list_extract(taken, i) * total) // list_extract(ws, i) <= t + 1
                  THEN (((list_extract(taken, i) + 1) * total + list_extract(ws, i) - 1) // list_extract(ws, i)) * 1000000 + i
             END), lambda x: x IS NOT NULL)) % 1000000 AS pick
    FROM slots, cycle WHERE t + 1 < total)),
turns AS (SELECT list_extract(names, pick) AS mix_source, turn, t AS place FROM slots, cycle WHERE t >= 0),
epochs AS (
  SELECT p.doc_id, p.mix_source, p.r // {MIX_BLOCK} AS mix_block, p.r % {MIX_BLOCK} AS in_block, s.w, s.blocks, c.total,
         unnest(range(0, (c.cycles * s.w - 1 - p.r // {MIX_BLOCK}) // s.blocks + 1)) AS mix_epoch
  FROM placed p JOIN sizes s USING (mix_source), cycle c),
dealt AS (SELECT *, mix_epoch * blocks + mix_block AS k FROM epochs)
SELECT doc_id, mix_source, CAST(mix_epoch AS BIGINT) AS mix_epoch, CAST(mix_block AS BIGINT) AS mix_block,
       CAST((k // w) * total + place AS BIGINT) AS mix_slot,
       CAST(((k // w) * total + place) * {MIX_BLOCK} + in_block AS BIGINT) AS mix_position
FROM dealt JOIN turns USING (mix_source) WHERE k % w = turn
""",
    "op2_line_dedup": f"""
WITH rows AS (SELECT row_number() OVER () AS rid, doc_id, source, string_split(text, chr(10)) AS lines, text FROM documents),
lines AS (
  SELECT rid, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM rows),
bare AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS s FROM lines),
spread AS (
  SELECT s FROM bare WHERE s <> '' GROUP BY s HAVING count(DISTINCT source) >= 8),
judged AS (SELECT b.*, spread.s IS NOT NULL AS hit FROM bare b LEFT JOIN spread ON b.s = spread.s),
per_row AS (
  SELECT rid, count(*) AS n, count(*) FILTER (hit) AS hits,
         coalesce(sum(length(s)) FILTER (hit), 0) > coalesce(sum(length(s)), 0) * {line_dedup.MAX_SHARE} AS kept_whole,
         string_agg(line, chr(10) ORDER BY pos) FILTER (NOT hit) AS rest
  FROM judged GROUP BY rid)
SELECT doc_id, CAST(coalesce(n, 0) AS INTEGER) AS n_lines,
       CAST(CASE WHEN hits > 0 AND NOT kept_whole THEN hits ELSE 0 END AS INTEGER) AS n_dropped,
       coalesce(kept_whole, false) AS kept_whole,
       md5(CASE WHEN hits > 0 AND NOT kept_whole THEN coalesce(rest, '') ELSE text END) AS text_md5
FROM rows LEFT JOIN per_row USING (rid)
""",
    "op7_license_scan": f"""
WITH whole(license, d) AS (VALUES {_WHOLE_SQL}),
wordings(license, known) AS (VALUES {_NOTICES_SQL}),
notice AS (SELECT d, min(license) AS license FROM (SELECT license, {_digest_sql("known")} AS d FROM wordings) GROUP BY d),
rows AS (SELECT row_number() OVER () AS rid, doc_id, {_body_lines_sql("text")} AS lines FROM documents),
lines AS (SELECT rid, unnest(lines) AS line FROM rows),
notices AS (
  SELECT rid, string_agg(DISTINCT license, ',' ORDER BY license) AS notice_ids, count(*) AS n_notices
  FROM (SELECT rid, {_digest_sql("line")} AS d FROM lines) l JOIN notice k ON l.d = k.d GROUP BY rid),
joined AS (SELECT rid, doc_id, array_to_string(lines, chr(10)) AS body FROM rows),
digests AS (SELECT rid, doc_id, {_digest_sql("body")} AS text_digest FROM joined)
SELECT doc_id, text_digest, k.license AS license_id, coalesce(notice_ids, '') AS notice_ids,
       CAST(coalesce(n_notices, 0) AS BIGINT) AS n_notices
FROM digests LEFT JOIN whole k ON text_digest = k.d LEFT JOIN notices USING (rid)
""",
    "op12_fill_in_middle": """
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS parts,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents),
drawn AS (
  SELECT *, len(parts) - CASE WHEN parts[-1] = '' THEN 1 ELSE 0 END AS n,
         CAST('0x' || hex[1:8] AS BIGINT) AS h1, CAST('0x' || hex[9:16] AS BIGINT) AS h2,
         CAST('0x' || hex[17:24] AS BIGINT) AS h3, CAST('0x' || hex[25:32] AS BIGINT) AS h4 FROM texts),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 AS plain FROM drawn),
heads AS (
  SELECT *, CASE WHEN a = 0 THEN 0 WHEN a = n THEN length(t) ELSE length(array_to_string(parts[1:a], chr(10))) + 1 END AS la,
         CASE WHEN b = 0 THEN 0 WHEN b = n THEN length(t) ELSE length(array_to_string(parts[1:b], chr(10))) + 1 END AS lb FROM cuts),
pieces AS (
  SELECT *, substr(t, 1, la) AS prefix, substr(t, la + 1, lb - la) AS middle, substr(t, lb + 1) AS suffix FROM heads),
formed AS (SELECT *, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM pieces)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN NOT plain THEN CAST(la AS BIGINT) END AS prefix_chars,
       CASE WHEN NOT plain THEN CAST(lb - la AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM formed
""",
}
