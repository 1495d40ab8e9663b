"""HTML extraction, infilling and spelling variants against brute force, made pages, and odd inputs."""

import hashlib
import html
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paylens.llm import block_labeller, html_blocks, infill, page_layouts, spelling
from paylens.llm.common import ship_package


@pytest.fixture(scope="module")
def labeller(spark):
    ship_package(spark)
    return block_labeller.fit_labeller(spark)


def test_blocks_of_broken_markup():
    page = html_blocks.read_page(
        """<!DOCTYPE html><html><head><title>x</title></head><body><nav><ul><li><a href="/a>b">A</a><li>B</ul></nav>
        <script>var a="</p>"; if (a<b) {}</script><article><h1>T &amp; U</h1><p><b>one<br>two<p>three <i>fo</i>ur 3 < 4 &lt;b&gt;
        <svg><title>no</title></svg> &nbsp; x<div class=ad>buy</div>tail<![CDATA[ a<b ]]></article><textarea>zz</textarea>
        <a title="it's" href='x"y'>l</a><p class="x>y</p> rest<!-- c --> more <!-- unclosed"""
    )
    assert page.texts == ["A", "B", "T & U", "one two", "three four 3 < 4 <b> x", "buy", "tail a<b", "l", "y", "rest more"]
    paths = [{t for t, x in zip(html_blocks.PATH_TAGS, row) if x} for row in page.features()]
    assert paths[0] == paths[1] == {"html", "body", "nav", "ul", "li"} and paths[4] == {"html", "body", "article", "p"}
    assert [html_blocks.read_page(s).texts for s in (None, "", "<p>", "plain\n text", "a < b")] == [[], [], [], ["plain text"], ["a < b"]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<", ">", "/", "a", "p", "div", '"', "'", "=", "<!--", "-->", "<p>", "</p>", "<li>", "<script>", "&amp;", " ", "é"]), max_size=40))
def test_any_markup_is_read(bits):
    page = html_blocks.read_page("".join(bits))
    assert len(page.features()) == len(page.texts) and all(t == " ".join(t.split()) != "" for t in page.texts)


@pytest.mark.parametrize("source", [
    "<div>" * 200_000 + "x" + "</b>" * 100_000, '<a href="' * 200_000, "<a b='" * 100_000 + "<" * 100_000 + '<a x="y>">' * 100_000,
    "<li><ul>" + "<div>" * 100_000 + "<li>a</li>" * 50_000, "<!-" * 200_000,
])
def test_hostile_markup_takes_linear_time(source):
    html_blocks.read_page(source).features()


def test_lstm_gradient_equals_differences():
    rng = np.random.default_rng(1)
    pages = [p for p, _ in page_layouts.training_pages(3, 5)]
    lstm = block_labeller.Direction.random(rng)
    steps = max(len(p.texts) for p in pages)
    x, mask = np.zeros((steps, 3, html_blocks.FEATURES)), np.zeros((steps, 3))
    for i, p in enumerate(pages):
        x[:len(p.texts), i], mask[:len(p.texts), i] = block_labeller.chunk_of(p, 0, len(p.texts), False), 1
    lstm.inputs, lstm.states, lstm.bias = (w.astype(np.float64) for w in (lstm.inputs, lstm.states, lstm.bias))
    pull = rng.normal(size=(steps, 3, block_labeller.HIDDEN)) * mask[:, :, None]
    out, kept = block_labeller.trained_pass(lstm, x, mask)
    slopes = block_labeller.gradient(lstm, x, mask, kept, pull)
    for w, slope in zip((lstm.inputs, lstm.states, lstm.bias), slopes):
        for _ in range(6):
            k = np.unravel_index(rng.choice(np.flatnonzero(np.abs(slope) > np.abs(slope).max() / 50)), w.shape)
            sums = []
            for d in (1e-2, -1e-2):
                w[k] += d
                sums.append((block_labeller.trained_pass(lstm, x, mask)[0].astype(np.float64) * pull).sum())
                w[k] -= d
            assert np.isclose((sums[0] - sums[1]) / 2e-2, slope[k], rtol=0.05, atol=2e-3)


def test_long_pages_are_read_in_chunks(labeller, monkeypatch):
    pages = [p for p, _ in page_layouts.training_pages(12, 77)]
    whole = labeller.scores(pages)
    monkeypatch.setattr(block_labeller, "CHUNK", 7)
    monkeypatch.setattr(block_labeller, "TOGETHER", 20)
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(whole, labeller.scores(pages)))


def test_labeller_on_pages_of_other_layouts(labeller):
    held_out = list(page_layouts.training_pages(300, 4711))
    scores = labeller.scores([p for p, _ in held_out])
    right = np.concatenate([(s >= 0.5) == labels for s, (_, labels) in zip(scores, held_out)])
    assert right.mean() > 0.985


def test_extraction_of_the_pages_table(spark, labeller):
    table = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pandas()
    odd = [(9001, "u", None), (9002, "u", ""), (9003, None, "<nav><a href=x>Menu</a></nav>"), (None, "u", table.html[0]), (9001, "u", None)]
    rows = [*table.itertuples(index=False, name=None), *odd]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("main_text", F.lit("clash"))
    out = block_labeller.extract_main_text(df, labeller).collect()
    assert len(out) == len(rows)
    got = {r.page_id: r.main_text for r in out}
    assert got[9001] == got[9002] == "" and got[None] == got[table.page_id[0]]
    wrong = 0
    for page_id, source in zip(table.page_id, table.html):
        article = re.search(r"<article[^>]*>(.*?)</article>", source, re.S).group(1)
        spaced = re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br|div)\b[^>]*>", " ", article))
        wrong += got[page_id] != " ".join(html.unescape(spaced).split())
    assert wrong <= 2
    assert block_labeller.extract_main_text(df.limit(0), labeller).count() == 0


def infilled(doc_id, text, seed=7, rate=100, spm_rate=50):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm_rate else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return len(units), form, len(p), len(m), out


@pytest.mark.parametrize("block", [5, 1 << 20])
def test_scatter_and_gather_equal_plain_cuts(block, monkeypatch):
    monkeypatch.setattr(infill, "BLOCK", block)
    rnd = random.Random(block)
    for _ in range(150):
        ids = [rnd.choice([None, rnd.randint(-5, 10**12)]) for _ in range(rnd.randint(0, 9))]
        texts = [rnd.choice([None, "", "".join(rnd.choices(["\n", "a", "é", "日", "<", "P>", "<S", "😀", "<P>"], [4, 4, 2, 2, 2, 1, 1, 1, 0.2], k=rnd.randint(0, 30)))]) for _ in ids]
        rate, spm_rate = rnd.choice([(100, 50), (40, 90)])
        made = infill.scatter(ids, *infill.byte_rows(pa.array(texts, pa.string())), 7, rate, spm_rate)
        outputs = infill.text_rows(*made["output"]).to_pylist()
        forms = made["form"].tolist()
        got = list(zip(made["units"].tolist(), forms, made["prefix_chars"].tolist(), made["middle_chars"].tolist(), outputs))
        assert got == [infilled(i, t or "", 7, rate, spm_rate) for i, t in zip(ids, texts)]
        assert infill.text_rows(*infill.gather(forms, *infill.byte_rows(pa.array(outputs, pa.string())))).to_pylist() == [t or "" for t in texts]


def test_fill_in_middle(documents):
    rnd = random.Random(2)
    rows = [(i, "".join(rnd.choices(["line\n", "ü", " x", "\n"], k=rnd.randint(1, 40)))) for i in range(80)]
    rows += [(200, None), (201, ""), (None, "a\nb\n"), (3, rows[3][1]), (202, "x\n" * 300_000), (203, "y" * 3_000_000), (204, "has <M> in it\n")]
    made = infill.restore(infill.fill_in_middle(documents(rows).withColumn("fim_form", F.lit("clash")).withColumn("fim_restored", F.lit("clash"))))
    got = made.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.fim_units, r.fim_form, r.fim_prefix_chars, r.fim_middle_chars, r.fim_output) == infilled(r.doc_id, r.text or "")
        assert r.fim_restored == (r.text or "")
    assert infill.fill_in_middle(documents([])).count() == 0


def variants(rows, min_length=7, min_count=2, ratio=10, every=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(x.lower() if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % every == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    letters = {x for w in words for x in w}
    near, form = {}, {}
    for w, n in words.items():
        edits = {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + x + w[i:] for i in range(len(w) + 1) for x in letters}
        edits |= {w[:i] + x + w[i + 1:] for i in range(len(w)) for x in letters}
        near[w] = (edits & words.keys()) - {w}
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= ratio * n else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words.get(form[w]))
    return out


@pytest.mark.parametrize("range_words", [200_000, 60])
def test_spelling_variants_against_brute_force(documents, monkeypatch, range_words):
    monkeypatch.setattr(spelling, "RANGE_WORDS", range_words)
    monkeypatch.setattr(spelling, "FLUSH_WORDS", 50)
    rnd = random.Random(5)
    stems = ["".join(rnd.choices("abcé×", k=rnd.randint(6, 10))) for _ in range(60)] + ["aaaaaaaaaa", "x" * 2_000]

    def word():
        w = stems[int(rnd.random() ** 3 * len(stems))]
        if rnd.random() < 0.3:
            k = rnd.randrange(len(w))
            w = rnd.choice([w[:k] + w[k + 1:], w[:k] + rnd.choice("abcÉ") + w[k:], w[:k] + rnd.choice("abcé") + w[k + 1:]])
        return w if rnd.random() < 0.9 else w.upper()

    rows = [(i, rnd.choice([" ", ".", "\n", "日"]).join(word() for _ in range(150))) for i in range(40)]
    rows += [(None, "aaaaaaaaaa " * 3), (50, None), (51, ""), (3, "aaaaaaaaa"), rows[6], (60, "klmnopqrst " * 400 + "klmnopqrs " * 30 + "klmnopqr " * 2), (52, "z" * 1_000_000)]
    want = variants(rows[:-1])
    got = spelling.spelling_variants(documents(rows).withColumn("word", F.lit("clash")), every=31).collect()
    assert len(got) == len(want) and {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want
    assert sum(w[0] is not None for w in want.values()) > 50 and want["klmnopqr"][:2] == ("klmnopqrs", "klmnopqrst")


def test_spelling_variants_of_nothing(documents):
    assert spelling.spelling_variants(documents([])).count() == 0
    assert spelling.spelling_variants(documents([(1, None), (2, "short words only")])).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(documents([(1, "lengthy lengthy")]), ratio=1)
