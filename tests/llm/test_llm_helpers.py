"""Parts that run without Spark: schedules, placements, grammars, encoders, hashes, chains."""

import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paylens.llm import embedding_dedup, lang_id, near_dup, packing, quality, repair, token_cache, token_output
from paylens.llm.mixing import pfair_cycle
from paylens.llm.token_cache import encoder

public_tokenizers = pytest.importorskip("public_tokenizers")


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.integers(1, 30), min_size=1, max_size=9))
def test_pfair_stays_within_a_block(weights):
    total, given_to = sum(weights.values()), dict.fromkeys(weights, 0)
    for t, name in enumerate(pfair_cycle(weights), 1):
        given_to[name] += 1
        assert all(abs(given_to[s] * total - t * w) < total for s, w in weights.items())
    assert given_to == weights


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_placements_fill_sequences_without_overlap(histogram):
    filled, seen = {}, dict.fromkeys(histogram, 0)
    for length, first, last, sequence, offset in packing.place(histogram, 64):
        assert first == seen[length]
        seen[length] = last + 1
        for i in range(last - first + 1):
            assert filled.get(sequence + i, 0) == offset
            filled[sequence + i] = offset + length
    assert seen == histogram and all(v <= 64 for v in filled.values())
    assert sorted(filled) == list(range(len(filled)))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=300), st.integers(0, 300), st.integers(0, 300))
def test_grammar_round_trip_and_random_access(ids, a, b):
    x = np.array(ids, dtype=np.uint32)
    shard = repair.Shard(repair.compress(x, 5, rules_a_round=4, min_count=2))
    assert (shard.ids() == x).all() and len(shard.ids()) == len(x)
    assert (shard.ids(min(a, b), max(a, b)) == x[min(a, b):max(a, b)]).all()


def test_grammar_of_wide_vocabulary_and_long_runs():
    x = np.array([70_000, 70_001] * 500 + [9] * 777, dtype=np.uint32)
    stored = repair.compress(x, 100_000, min_count=2)
    assert (repair.Shard(stored).ids() == x).all() and len(stored) < 4 * len(x)


def bytes_of_rules(x, terminals):
    stored = repair.compress(x, terminals)
    assert (repair.Shard(stored).ids() == x).all()
    return len(stored)


def test_grammar_goes_on_until_no_pair_pays():
    rng = np.random.default_rng(2)
    passage = rng.integers(0, 50_000, 3_000).astype(np.uint32)
    assert bytes_of_rules(np.tile(passage, 200), 50_257) < 40_000
    assert bytes_of_rules(np.zeros(1_000_000, np.uint32), 50_257) < 400
    # more rules than 16 bits have numbers for: symbols are widened
    long_passage = rng.integers(0, 50_000, 60_000).astype(np.uint32)
    assert bytes_of_rules(np.tile(long_passage, 20), 50_257) < 1_000_000
    # but not where it doesn't pay
    words = rng.zipf(1.3, 300_000).clip(max=40_000).astype(np.uint32)
    assert bytes_of_rules(words, 65_000) < 2 * len(words)
    # pairs left over are rarer than those that pay, but for chains that overlap
    x = rng.integers(0, 40, 20_000).astype(np.uint32)
    shard = repair.Shard(repair.compress(x, 40))
    counts = np.unique(shard.symbols[:-1].astype(np.int64) << 32 | shard.symbols[1:], return_counts=True)[1]
    assert counts.max() <= 2 * (repair.RULE_BYTES // 2)


def test_last_numbers_of_a_grammar_go_to_pairs_that_pay():
    words = np.random.default_rng(4).zipf(1.2, 800_000).clip(max=60_000).astype(np.uint32)
    stored = repair.compress(words, 64_000)
    shard = repair.Shard(stored)
    assert (shard.ids() == words).all() and shard.symbols.itemsize == 2 and len(shard.left) == repair.NARROW - 1 - 64_000
    assert len(stored) < 1_180_000


def test_stored_document_ids_keep_nulls():
    ids = [None, -3, 0, 2**62, None]
    assert token_output.unpack_ids(token_output.pack_ids(ids)) == ids


@pytest.mark.parametrize("name,words", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_cached_encoder_equals_the_library(name, words):
    enc = encoder(public_tokenizers.path(name), words)
    rnd = random.Random(1)
    alphabet = "ab 'sS\n\t\r.,!09éßÿ \x85́日½²ª_µ<|>\x1c "
    texts = ["", " ", "\n", "a  b", "don't WE'LL", "<|endoftext|> x", "İ ΣΑΣ", "  lead\n\n", "x \ny"]
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 30))) for _ in range(4000)]
    latin = [chr(c) for c in range(256)] + ["a", "B", "'s", " ", "1"] * 20
    texts += ["".join(rnd.choices(latin, k=rnd.randint(1, 12))) for _ in range(4000)]
    assert all(enc.ids(t) == enc.whole(t) for t in texts)


@pytest.mark.parametrize("block", [3, 1 << 20])
@pytest.mark.parametrize("name, words", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_texts_encoded_together_equal_the_library(monkeypatch, name, words, block):
    monkeypatch.setattr(token_cache, "BLOCK_PIECES", block)
    monkeypatch.setattr(token_cache, "CACHE_CUT", 50)
    enc = token_cache.Encoder(public_tokenizers.path(name), words)
    rnd = random.Random(7)
    latin = [chr(c) for c in range(256)] + ["a", "B", "'s", "'ll", "'", " ", "  ", "\n", "\r\n", "1", ","] * 20
    for size in (1, 7, 300):
        texts = ["".join(rnd.choices(latin, k=rnd.randint(0, 25))) for _ in range(size)]
        texts += ["".join(rnd.choices("a1 '.\ns", k=rnd.randint(0, 12))) for _ in range(size)]
        texts += [None, "", " ", "\n\nx", "<|endoftext|> x", "日本 語", "ab,'s 'tis don't\t \u00a0x"]
        rnd.shuffle(texts)
        assert enc.batch(texts) == [enc.whole(t) if t else b"" for t in texts]
    assert enc.batch([]) == [] and enc.batch([None, ""]) == [b"", b""]


def test_texts_encoded_together_look_words_up_once():
    enc = token_cache.Encoder(public_tokenizers.path("byte_bpe_50k.json"), False)
    asked, known = [], enc.latin_pieces.of
    enc.latin_pieces.of = lambda keys: asked.extend(keys) or known(keys)
    texts = ["the cat, the dog and the cat " * 50, "the dog " * 80]
    assert enc.batch(texts) == [enc.whole(t) for t in texts]
    assert len(asked) == len(set(asked)) < 12


@pytest.mark.parametrize("name, words", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_added_tokens_have_their_ids(name, words):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    plain, enc = Tokenizer.from_file(path), encoder(path, words)
    rnd = random.Random(2)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", " ", "\n", "\t", "a", "B's", "é日", "<", "."]
    texts = ["a b <|endoftext|> c", "<|startoftext|>x<|endoftext|>", "<|endoftext|>" * 3]
    texts += ["".join(rnd.choices(bits, k=rnd.randint(1, 8))) for _ in range(3000)]
    assert all(np.frombuffer(enc.ids(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids for t in texts)
    assert plain.token_to_id("<|endoftext|>") in np.frombuffer(enc.ids(texts[0]), "<u4")


def brute_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@settings(max_examples=100, deadline=None)
@given(st.text(" \t\nABabÉ é", max_size=40), st.text(" \t\nABabÉ é", max_size=40))
def test_shingles_are_those_of_the_words(a, b):
    x, y = near_dup.shingle_set(a), near_dup.shingle_set(b)
    p, q = brute_set(a), brute_set(b)
    assert (len(x), len(y), len(np.intersect1d(x, y))) == (len(p), len(q), len(p & q))


def test_quantisation_bound_decides_every_pair_rightly():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    x = np.concatenate([base + rng.normal(size=base.shape) * s for s in (0.0, 0.1, 0.3, 0.4, 0.5)]) * rng.uniform(0.1, 9, (200, 1))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert (embedding_dedup.tile_links(x, x) == (unit @ unit.T >= 0.9)).all()


def test_local_roots():
    m = np.zeros((5, 5), dtype=bool)
    for i, j in ((1, 3), (3, 4)):
        m[i, j] = m[j, i] = True
    assert near_dup.local_roots(m).tolist() == [0, 1, 2, 1, 1]
    assert near_dup.local_roots(np.zeros((0, 0), dtype=bool)).tolist() == []


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    emit, start, between = rng.normal(size=(4, 1)), 0.3, rng.normal(size=(2, 2))

    def weight(path):
        return np.exp(start * path[0] + sum(emit[t, 0] * s for t, s in enumerate(path)) + sum(between[a, b] for a, b in zip(path, path[1:])))

    paths = list(itertools.product((0, 1), repeat=4))
    z = sum(map(weight, paths))
    good, expected, log_z = quality.forward_backward(emit, np.array([4]), start, between)
    assert np.isclose(log_z[0], np.log(z))
    assert np.allclose(good[:, 0], [sum(weight(p) for p in paths if p[t]) / z for t in range(4)])
    assert np.isclose(expected[1, 0], sum(weight(p) * sum(a == 1 and b == 0 for a, b in zip(p, p[1:])) for p in paths) / z)


def test_long_texts_are_scored_in_blocks(monkeypatch):
    rnd = random.Random(6)
    prose = ["\n".join(rnd.choice(["Good line of words.", "x | y | z", "", "SHOUT !!", "a b c d e"]) for _ in range(rnd.randint(1, 90))) for _ in range(40)]
    texts = [*prose, "", "\n", "\n\n\n", "end\n", "x" * 500]
    field = quality.fit(prose, np.array([i % 2 for i in range(40)]), rounds=20)
    together = field.score(texts)
    monkeypatch.setattr(quality, "CHUNK_LINES", 28)
    monkeypatch.setattr(quality, "CHUNK_CHARS", 300)
    assert np.allclose(together, [field.score([t])[0] for t in texts])
    for t in texts:
        blocks = list(quality.blocks_of_lines(t))
        assert [x for lines, skip, n in blocks for x in lines.split("\n")[skip:skip + n]] == t.split("\n")
    order = sorted(range(len(texts)), key=lambda i: texts[i].count("\n"))
    chunks = list(quality.chunks_of(texts, order))
    assert sum(chunks, []) == order and all(len(c) == 1 or len(c) * (texts[c[-1]].count("\n") + 1) <= 28 for c in chunks)


def test_gram_counts_and_out_of_place():
    codes, counts = lang_id.gram_counts("ab ab!")
    one = lambda c: ord(c)
    assert dict(zip(codes.tolist(), counts.tolist()))[one("a")] == 2
    assert len(codes) == 2 + 3 + 2  # a b | _a ab b_ | _ab ab_
    assert len(lang_id.gram_counts("12 !?")[0]) == 0
    profiles = lang_id.Profiles.of({"x": lang_id.top_codes(codes, counts, 5).tolist()}, 5)
    assert profiles.closest("ab") == ("x", 1.0)
    assert profiles.closest(None) == profiles.closest("123") == ("und", 0.0)
