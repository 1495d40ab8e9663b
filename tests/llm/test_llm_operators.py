"""Operators on small tables against brute force, with nulls, ties, repeats, empty tables and clashing columns."""

import random
import textwrap
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paylens.llm import ann, embedding_dedup, lang_id, licenses, line_dedup, mixing, near_dup, packing, quality, token_output
from paylens.llm.common import connected_components
from paylens.sinks.writers import scratch_path
from tests.llm.test_llm_helpers import brute_set

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 6))) for _ in range(n))


def components_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_connected_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(170)] + [(400 + i, 401 + i) for i in range(40)] + [(9, 9)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert got == components_of(nodes, edges)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_mixing_keeps_all_and_follows_weights(spark, documents):
    rows = [(i, "x", "en", s) for i, s in enumerate(["a"] * 50 + ["b"] * 7 + [None] * 5 + ["c"] * 3)] + [(None, None, None, "a"), (3, "x", "en", "a")]
    docs = documents(rows).withColumn("mix_slot", F.lit("clash"))
    got = mixing.mix_sources(docs, {"a": 3, "b": 2, "absent": 9}, other_weight=1, block_rows=4).collect()
    assert {(r.doc_id, r.source) for r in got} == {(r[0], r[3]) for r in rows}
    slots = {}
    for r in got:
        assert slots.setdefault(r.mix_slot, r.mix_source) == r.mix_source
        assert r.mix_source == (r.source if r.source in ("a", "b") else "")
    total, weights = 6, {"a": 3, "b": 2, "": 1}
    assert sorted(slots) == list(range(len(slots))) and len(slots) % total == 0
    for t in range(1, len(slots) + 1):
        for s, w in weights.items():
            assert abs(sum(slots[i] == s for i in range(t)) - t * w / total) < 1
    assert sum(r.mix_epoch == 0 for r in got) == len(rows)
    assert mixing.mix_sources(docs.limit(0), {"a": 1}).count() == 0
    with pytest.raises(ValueError):
        mixing.mix_sources(docs, {"a": 0})


def test_mixing_deals_many_repeats_over_tasks(spark, documents, monkeypatch):
    docs = documents([(0, "rare", "en", "a")] + [(i, "x", "en", "b") for i in range(1, 4_000)])
    mixed = mixing.mix_sources(docs, {"a": 5, "b": 1}, block_rows=2)
    whole = sorted(map(tuple, mixed.collect()))
    assert sum(r[0] == 0 for r in whole) == 10_000
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(digest" in plan and "first" in plan
    monkeypatch.setattr(mixing, "REPEATS", 10**9)
    assert sorted(map(tuple, mixing.mix_sources(docs, {"a": 5, "b": 1}, block_rows=2).collect())) == whole


def test_line_dedup(documents):
    rnd = random.Random(0)
    rows = [(i, f"{prose(rnd, 9)}\n  cookie notice \t\n{prose(rnd, 8)}\n\nrare line {i % 4}", "en", f"s{i % 12}") for i in range(60)]
    copy = "\n".join(["whole copied text"] * 2)
    rows += [(100 + i, copy, "en", f"s{i}") for i in range(12)] + [(200, None), (201, ""), (None, "cookie notice"), (0, rows[0][1], "en", None)]
    out = line_dedup.drop_boilerplate(documents(rows).withColumn("n_dropped", F.lit("clash")), min_sites=8)
    assert out.count() == len(rows) and out.columns[-3:] == ["n_lines", "n_dropped", "kept_whole"]
    got = {(r.doc_id, r.source): r for r in out.collect()}
    for i in range(60):
        text = rows[i][1]
        r = got[(i, f"s{i % 12}")]
        assert r.text == text.replace("  cookie notice \t\n", "") and (r.n_lines, r.n_dropped, r.kept_whole) == (5, 1, False)
    assert all(got[(100 + i, f"s{i}")].text == copy and got[(100 + i, f"s{i}")].kept_whole for i in range(12))
    assert got[(200, "s0")].text is None and got[(200, "s0")].n_lines == 0 and got[(201, "s0")].n_lines == 1
    assert line_dedup.drop_boilerplate(documents([])).count() == 0


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 12)).astype(np.float32)
    x[500:560] = x[500]  # copies: ties go to smaller ids
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    bad = [(600, None), (620, [0.0] * 12), (640, [float("nan")] * 12), (660, [None] * 12), (None, rows[0][1]), rows[3]]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df, df.filter("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert sorted(got) == list(range(0, 600, 20))
    hits = 0
    for q, found in got.items():
        assert sorted(found) == list(range(1, 21)) and q not in {v for v, _ in found.values()}
        scores = x.astype(np.float64) @ x[q].astype(np.float64)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(600), -np.round(scores, 9)))[:20]
        hits += len(set(best.tolist()) & {v for v, _ in found.values()})
        ranked = [found[i] for i in range(1, 21)]
        assert ranked == sorted(ranked, key=lambda f: (-f[1], f[0]))
        assert all(abs(scores[v] - s) < 1e-9 for v, s in ranked)
    assert hits / (20 * len(got)) >= 0.9
    few = df.filter("vec_id < 5")
    assert ann.nearest(few, few.filter("vec_id = 0")).count() == 4
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_nearest_searches_bounded_groups(spark, monkeypatch):
    from pyspark.sql import GroupedData

    rng = np.random.default_rng(6)
    x = rng.normal(size=(700, 6)).round(3)
    x[300:] = x[300]  # one hot leaf, asked by all
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(7, r.tolist()) for r in x[8:108]], "vec_id long, embedding array<double>")
    whole = sorted(ann.nearest(df, df, k=5).collect())
    groups, cogroup = [], GroupedData.cogroup
    monkeypatch.setattr(GroupedData, "cogroup", lambda self, other: groups.extend([self, other]) or cogroup(self, other))
    monkeypatch.setattr(ann, "SHARD", 200)
    monkeypatch.setattr(ann, "SLICE", 50, raising=False)
    monkeypatch.setattr(ann, "HANDED", 33, raising=False)
    assert sorted(ann.nearest(df, df, k=5).collect()) == whole
    held, asking = (g.count().agg(F.max("count")).first()[0] for g in groups)
    assert held <= 400 and asking <= 100


def test_embedding_dedup_against_brute_force(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(30, 10))
    x = np.concatenate([base, base * 2, base + rng.normal(size=base.shape) * 0.25, base]).astype(np.float32)
    rows = [(i * 3, [float(v) for v in r]) for i, r in enumerate(x)]
    bad = [(1, None), (4, [0.0] * 10), (7, [float("inf")] + [1.0] * 9), (None, rows[0][1])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicate_vectors(df).collect()}
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    roots = components_of([r[0] for r in rows], [(rows[i][0], rows[j][0]) for i, j in zip(*np.nonzero(linked))])
    for i, (vec, _) in enumerate(rows):
        assert (got[vec].n_links, got[vec].component_id, got[vec].kept) == (linked[i].sum(), roots[vec], roots[vec] == vec)
    assert all((got[v].n_links, got[v].component_id, got[v].kept) == (0, v, True) for v in (1, 4, 7))
    assert got[None].component_id is None and got[None].kept
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


def test_embedding_dedup_of_repeated_ids_and_extreme_sizes(spark, monkeypatch):
    v = [[1.0, 0.1, 0.0], [0.0, 1.0, 0.1], [0.1, 0.0, 1.0]]
    rows = [(3, v[0]), (5, v[0]), (5, v[1]), (9, [x * 2 for x in v[1]]), (5, None), (20, [x * 1e200 for x in v[2]]), (21, [x * 1e-200 for x in v[2]]),
            (22, v[2]), (30, [1.0, 1.0, 1.0]), (30, [1.0, 1.0, 1.0]), (None, v[0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rep", F.lit("clash"))
    for block, cells in ((embedding_dedup.BLOCK, 16), (2, 3)):
        monkeypatch.setattr(embedding_dedup, "BLOCK", block)
        monkeypatch.setattr(embedding_dedup, "CELLS", cells)
        got = sorted((tuple(r) for r in embedding_dedup.near_duplicate_vectors(df).collect()), key=str)
        assert got == sorted([(3, 1, 3, True), (5, 1, 3, False), (5, 1, 3, False), (9, 1, 3, False), (5, 0, 3, False), (20, 2, 20, True), (21, 2, 20, False),
                              (22, 2, 20, False), (30, 1, 30, True), (30, 1, 30, True), (None, 0, None, True)], key=str)


def test_near_duplicates_against_brute_force(documents, monkeypatch):
    rnd = random.Random(9)
    texts = []
    for n in (3, 5, 30, 120, 400):
        for _ in range(4):
            words = prose(rnd, n).split(" ")
            for changes in (0, 0, 1, 2, 6, n // 12):
                w = list(words)
                for _ in range(changes):
                    w[rnd.randrange(len(w))] = "Changed"
                texts.append(" ".join(w))
    passage = prose(rnd, 60)  # quoted by many, so a long list; and a group of many near copies
    texts += [f"{passage} {prose(rnd, 40)}" for _ in range(90)]
    words = prose(rnd, 80).split(" ")
    texts += [" ".join([*words[:i], "other", *words[i + 1:]]) for i in range(80)]
    texts += ["", " \n", "ONE", "one"]
    order = list(range(len(texts)))
    rnd.shuffle(order)
    rows = [(i, texts[t]) for i, t in enumerate(order)] + [(9000, None), (None, texts[0]), (5, texts[order[5]])]
    got = {r.doc_id: r for r in near_dup.near_duplicates(documents(rows)).collect()}
    sets = {i: brute_set(t or "") for i, t in rows if i is not None}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = components_of(sets, links)
    assert {i: r.component_id for i, r in got.items() if i is not None} == want
    assert all(r.n_shingles == len(sets[i]) and r.kept == (want[i] == i) for i, r in got.items() if i is not None)
    assert got[None].component_id is None and got[None].kept
    assert near_dup.near_duplicates(documents([])).count() == 0


def test_near_duplicates_of_repeated_ids(spark, documents):
    import corpus_pipeline as P

    rnd = random.Random(11)
    a, b, c = (prose(rnd, 30) for _ in range(3))
    near_c = c.replace(" ", "  ", 3) + " end"
    rows = [(3, a), (5, a), (5, b), (9, b), (20, c), (21, near_c), (21, ""), (22, None), (30, "one two"), (30, "three"), (31, "three"), (None, a), (40, "alone text"), (40, "alone text")]
    got = sorted(((r.doc_id, r.n_shingles > 0, r.component_id, r.text_kept) for r in near_dup.near_duplicates(documents(rows)).collect()), key=str)
    want = [(3, True, 3, True), (5, True, 3, False), (5, True, 3, True), (9, True, 3, False), (20, True, 20, True), (21, True, 20, False), (21, False, 20, True),
            (22, False, 22, True), (30, True, 30, True), (30, True, 30, True), (31, True, 30, False), (None, True, None, True), (40, True, 40, True), (40, True, 40, True)]
    assert got == sorted(want, key=str)
    left = sorted(((r.doc_id, r.text) for r in P.near_duplicates(spark, documents(rows), "").collect()), key=str)
    assert left == sorted([(3, a), (5, b), (20, c), (21, ""), (22, None), (30, "one two"), (30, "three"), (None, a), (40, "alone text")], key=str)
    many = [(i % 7, prose(rnd, 8) + " " + shared) for shared in (prose(rnd, 60), prose(rnd, 60)) for i in range(90)]
    ids = {r.component_id for r in near_dup.near_duplicates(documents(many)).collect()}
    sets = [(i, brute_set(t)) for i, t in many]
    links = [(x, y) for x, s in sets for y, t in sets if x < y and 100 * len(s & t) >= 75 * len(s | t)]
    assert ids == set(components_of(range(7), links).values())


def test_language_id(documents):
    rnd = random.Random(4)
    alphabets = {"aa": "abcde", "bb": "defgh"}
    rows = [(i, " ".join("".join(rnd.choice(a) for _ in range(5)) for _ in range(20)), lang) for i, (lang, a) in enumerate(list(alphabets.items()) * 40)]
    rows += [(500, None, "aa"), (501, "", None), (502, "12 !", "bb"), (None, rows[0][1], "aa")]
    docs = documents(rows).withColumn("lang_pred", F.lit("clash"))
    profiles = lang_id.learn_profiles(docs.filter(lang_id.learning_fold()))
    got = {r.doc_id: r for r in lang_id.identify(docs, profiles).collect()}
    assert profiles.langs == ("aa", "bb") and len(got) == len(rows)
    assert all(got[r[0]].lang_pred == r[2] and 0 < got[r[0]].lang_score <= 1 for r in rows[:80])
    assert all((got[i].lang_pred, got[i].lang_score) == ("und", 0.0) for i in (500, 501, 502))
    none = lang_id.learn_profiles(docs.limit(0))
    assert {r.lang_pred for r in lang_id.identify(docs, none).collect()} == {"und"}


def test_quality(documents, spark):
    rnd = random.Random(8)
    rows = [(i, "\n".join(prose(rnd, 12).capitalize() + "." if i % 2 else prose(rnd, 12).replace(" ", " | ") for _ in range(4))) for i in range(240)]
    rows += [(900, None), (901, ""), (902, "\n\n"), (None, rows[1][1])]
    docs = documents(rows).withColumn("quality_score", F.lit("clash"))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(160)] + [(3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    field = quality.learn(docs, labels)
    got = {r.doc_id: r for r in quality.score_documents(docs, field).collect()}
    assert len(got) == len(rows) and all(0 <= r.quality_score <= 1 for r in got.values())
    assert all(got[i].quality_predicted == i % 2 for i in range(160, 240))
    assert got[900].quality_score == got[901].quality_score and got[None].quality_score == got[1].quality_score
    one_label = quality.learn(docs, labels.filter("quality = 1"))
    assert {r.quality_predicted for r in quality.score_documents(docs, one_label).collect()} == {1}
    assert quality.score_documents(docs.limit(0), quality.learn(docs.limit(0), labels)).count() == 0


def packed_rows(docs):
    return packing.pack(docs, WORD, size=64).collect()


def test_packing(documents):
    from tokenizers import Tokenizer

    rnd = random.Random(3)
    rows = [(i, prose(rnd, rnd.choice([1, 5, 20, 60]))) for i in range(50)] + [(60, None), (61, ""), (None, "a b"), (7, "seven again")]
    got = packed_rows(documents(rows))
    t = Tokenizer.from_file(WORD)
    want = sorted(t.encode(x or "", add_special_tokens=False).ids + [1] for _, x in rows)
    seqs, texts = {}, {}
    for r in got:
        assert r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids) and r.offset + r.length <= 64
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        texts.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
    for places in seqs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
    assert sorted(seqs) == list(range(len(seqs)))
    assert sorted(np.frombuffer(b"".join(p for _, p in sorted(x)), "<u4").tolist() for x in texts.values()) == want
    assert packed_rows(documents([])) == []


def test_token_output_round_trip(spark, documents):
    from tokenizers import Tokenizer

    rnd = random.Random(3)
    rows = [(i, prose(rnd, 30)) for i in rnd.sample(range(100), 40)] + [(200, None), (201, ""), (None, "x"), (201, "again")]
    path = scratch_path(spark, "t-shards")
    token_output.write_shards(documents(rows), path, BYTE, shard_ids=500)
    got = sorted(token_output.read_documents(spark, path).collect(), key=lambda r: r.start)
    t = Tokenizer.from_file(BYTE)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(r.ids))
        assert ids in [t.encode(x or "", add_special_tokens=False).ids + [2] for i, x in rows if i == r.doc_id]
        at += len(ids)
    assert spark.read.parquet(path).count() > 3
    empty = scratch_path(spark, "t-no-shards")
    token_output.write_shards(documents([]), empty, BYTE)
    assert token_output.read_documents(spark, empty, with_ids=False).count() == 0


def test_license_scan(documents):
    mit = licenses.LICENSE_TEXTS["MIT"]
    respelt = mit.upper().replace("SUBLICENSE", "sub-licence").replace(",", " ;").replace("\n\n", "\n\n\n") + "\n(c) someone else\n"
    rows = [(1, mit), (2, respelt), (3, mit + "and more"), (4, "Prose.\nLicensed under CC BY-NC 4.0.\nreleased under the mit LICENCE\n"),
            (5, None), (6, ""), (7, "!!!"), (None, mit), (1, "Licensed under CC-BY-NC 4.0")]
    out = licenses.scan_licenses(documents(rows).withColumn("license_id", F.lit("clash"))).collect()
    got = sorted((r.doc_id or 0, r.license_id or "", r.notice_ids, r.n_notices) for r in out)
    assert got == sorted([(1, "MIT", "", 0), (2, "MIT", "", 0), (3, "", "", 0), (4, "", "CC-BY-NC-4.0,MIT", 2), (5, "", "", 0), (6, "", "", 0),
                          (7, "", "", 0), (0, "MIT", "", 0), (1, "", "CC-BY-NC-4.0", 1)])
    assert all(r.text_digest is None for r in out if r.doc_id in (5, 6, 7))
    assert licenses.scan_licenses(documents([])).count() == 0


@pytest.mark.parametrize("name", sorted(set(licenses.LICENSE_TEXTS) - {"Unlicense"}))  # it has neither title nor notice
def test_license_form_does_not_depend_on_wrapping(documents, name):
    title, notice, *body = licenses.LICENSE_TEXTS[name].strip().split("\n\n")
    texts = [licenses.LICENSE_TEXTS[name]]
    for holder in ("Copyright (c) 2024 Ada, Bo", "(C) 1995-2024 Ada", "Copyright 2024 Ada\nAll rights reserved.", "Copyright The Authors", "© Ada\r"):
        for width in (30, 44, 60, 70, 78, 79, 80, 100, 10_000):
            wrapped = [textwrap.fill(" ".join(p.split()), width) for p in body]
            texts.append("\n\n".join([title, holder, *wrapped]) + "\n")
    out = licenses.scan_licenses(documents(list(enumerate(texts)))).select("license_id", "text_digest").distinct().collect()
    assert [r.license_id for r in out] == [name]


def license_rows():
    texts = []
    for name in sorted(licenses.LICENSE_TEXTS):
        title, notice, *body = licenses.LICENSE_TEXTS[name].strip().split("\n\n")
        for holder in ("Copyright (c) 2024 Ada", "© Ada", "Copyright The Authors", "Copyright law\nof all lands", "x\n\nCopyright me\n\ny", "(c) Ada\n"):
            for width in (44, 78, 200):
                texts.append("\n\n".join([title, holder, *[textwrap.fill(" ".join(p.split()), width) for p in body]]))
    texts += [f"{line}\n" for known in licenses.LICENSE_NOTICES.values() for line in known]
    return texts + ["Copyright x", "a\nCopyright x\n\nb", "\nCopyright x", "\n \nCopyright (c)\n", " all rights reserved.\nAll rights reserved by x", None, "", "\n"]


def test_license_scan_equals_its_sql(documents):
    import duckdb

    from paylens.llm.queries import ORACLE_SQL

    rows = list(enumerate(license_rows()))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cursor = con.execute(ORACLE_SQL["op7_license_scan"])
    names = [c[0] for c in cursor.description]
    got = licenses.scan_licenses(documents(rows)).select(*names).collect()
    assert sorted(map(tuple, got), key=str) == sorted(cursor.fetchall(), key=str)
    assert sum(r.license_id is not None for r in got) >= 3 * 3 * len(licenses.LICENSE_TEXTS)
    assert all(r.notice_ids for r in got if rows[r.doc_id][1] and len(rows[r.doc_id][1]) < 90 and "icense" in rows[r.doc_id][1])


@pytest.mark.parametrize("name", ["Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "MPL-2.0", "CC0-1.0"])
def test_longer_licenses_are_known(documents, name):
    from pathlib import Path

    path = Path("/usr/share/common-licenses") / name
    if not path.exists():
        pytest.skip("no copy of the licence on this machine")
    text = path.read_text(encoding="utf-8")
    rows = [(0, text), (1, text.upper().replace("\n\n", "\n\n\n")), (2, text + "more")]
    got = {r.doc_id: r.license_id for r in licenses.scan_licenses(documents(rows)).collect()}
    assert got[0] == got[1] and got[0].startswith(name) and got[2] is None


def test_license_body_lines_count(documents):
    rows = [(0, "x\ncopyright notice and this permission notice appear in all copies."), (1, "x"),
            (2, "x\n(c) You must retain, in the Source form of any\nderivative works"), (3, "x\nderivative works")]
    got = {r.doc_id: r.text_digest for r in licenses.scan_licenses(documents(rows)).collect()}
    assert len(set(got.values())) == 4


def test_pipeline_stages(spark, documents, tmp_path):
    import corpus_pipeline as P

    rnd = random.Random(1)
    rows = [(i, f"{prose(rnd, 40)}\n{prose(rnd, 30)}\nsite footer", "en", f"src{i % 20}") for i in range(80)]
    rows += [(100, rows[0][1], "en", "src3"), (101, "123 !?", "en", "src1"), (102, None, None, None), (103, "日本語の文", "ja", "src2"), (None, rows[5][1], "en", "src0")]
    docs = documents(rows).withColumn("extra", F.lit(1))
    kept = P.language(spark, docs, "").collect()
    assert {r.doc_id for r in kept} >= set(range(80)) | {100, None} and not {101, 102} & {r.doc_id for r in kept}
    docs = spark.createDataFrame(kept, docs.select(P.COLUMNS).schema)
    cleaned = P.lines(spark, docs, "")
    assert cleaned.columns == P.COLUMNS and cleaned.filter(F.col("text").contains("site footer")).count() == 0
    left = P.near_duplicates(spark, docs, "")
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in kept} - {100}
    mixed = P.mixed(spark, left, "")
    assert mixed.columns == P.COLUMNS and {r.doc_id for r in mixed.collect()} == {r.doc_id for r in left.collect()}
    pieces = P.packed(spark, mixed, "")
    assert pieces.filter("start = 0").count() == mixed.count()
    assert [n for n, _ in P.STAGES] == ["language", "lines", "near_duplicates", "mixed", "packed"]
