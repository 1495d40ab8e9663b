"""Main-text extraction: a recurrent labeller of page blocks.

A bidirectional LSTM in numpy reads the features of a page's blocks in page
order (see :mod:`paylens.llm.html_blocks`), so every block is judged with the
whole page before and after it, and gives the probability that the block is
part of the article. It is trained on pages made from many layouts, whose
blocks' labels are known (:mod:`paylens.llm.page_layouts`).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from paylens.llm.common import ship_package, ships_package
from paylens.llm.html_blocks import FEATURES, PATH_SIZE, WORD_BUCKETS, Page, read_page
from paylens.llm.page_layouts import training_pages

#: Cells of a direction's state.
HIDDEN = 24
#: Made pages to train on, passes over them, pages of a step.
TRAINING_PAGES, PASSES, STEP_PAGES = 2_400, 9, 32
LEARNING_RATE = 0.01
#: Share of pages that a pass shows without their words, so that unknown words don't matter.
WORDLESS = 0.5
#: Blocks of a page read at a time, and blocks of all pages that are read together.
CHUNK, TOGETHER = 1_024, 32_768

ADDED = ("main_text", "n_blocks", "n_main_blocks")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Direction:
    """One LSTM: input, forget, output gates and candidate, side by side in the columns."""

    inputs: np.ndarray
    states: np.ndarray
    bias: np.ndarray

    @classmethod
    def random(cls, rng: np.random.Generator) -> Direction:
        bias = np.zeros(4 * HIDDEN, np.float32)
        bias[HIDDEN:2 * HIDDEN] = 1
        return cls(rng.normal(0, 0.1, (FEATURES, 4 * HIDDEN)).astype(np.float32), rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32), bias)

    def step(self, projected: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gate values, new cells and new outputs."""
        z = projected + h @ self.states
        gates = np.concatenate([sigmoid(z[:, :3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN:])], axis=1)
        i, f, o, g = np.split(gates, 4, axis=1)
        c = f * c + i * g
        return gates, c, o * np.tanh(c)


def chunk_of(page: Page, lo: int, hi: int, back: bool) -> np.ndarray:
    """Features of blocks lo..hi in reading order, or counted from the page's end."""
    n = len(page.texts)
    lo, hi = min(lo, n), min(hi, n)
    rows = page.features(n - hi, n - lo)[::-1] if back else page.features(lo, hi)
    return rows.astype(np.float32) / 100


@dataclass
class Labeller:
    """Both directions and the output layer over their states."""

    ahead: Direction
    back: Direction
    output: np.ndarray
    output_bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [self.ahead.inputs, self.ahead.states, self.ahead.bias, self.back.inputs, self.back.states, self.back.bias, self.output, self.output_bias]

    def outputs(self, pages: list[Page], back: bool) -> list[np.ndarray]:
        """A direction's outputs for every block of every page, in page order; long pages are read in chunks."""
        lstm = self.back if back else self.ahead
        sizes = np.array([len(p.texts) for p in pages])
        found = [np.empty((n, HIDDEN), np.float32) for n in sizes]
        h = c = np.zeros((len(pages), HIDDEN), np.float32)
        for lo in range(0, int(sizes.max()), CHUNK):
            hi = min(lo + CHUNK, int(sizes.max()))
            x = np.zeros((len(pages), hi - lo, FEATURES), np.float32)
            for i, page in enumerate(pages):
                rows = chunk_of(page, lo, hi, back)
                x[i, :len(rows)] = rows
            projected = np.ascontiguousarray((x.reshape(-1, FEATURES) @ lstm.inputs + lstm.bias).reshape(len(pages), hi - lo, -1).transpose(1, 0, 2))
            states = np.empty((hi - lo, len(pages), HIDDEN), np.float32)
            for t in range(hi - lo):
                _, c, h = lstm.step(projected[t], h, c)
                states[t] = h
            for i, n in enumerate(sizes):
                upto = max(0, min(hi, n) - lo)
                found[i][lo:lo + upto] = states[:upto, i]
        return [f[::-1] for f in found] if back else found

    def scores(self, pages: list[Page]) -> list[np.ndarray]:
        """For each page the probabilities that its blocks are main text."""
        order = sorted((i for i, p in enumerate(pages) if p.texts), key=lambda i: len(pages[i].texts))
        found = [np.empty(0, np.float32)] * len(pages)
        at = 0
        while at < len(order):
            n = 1
            while at + n < len(order) and (n + 1) * min(CHUNK, len(pages[order[at + n]].texts)) <= TOGETHER:
                n += 1
            mine = order[at:at + n]
            together = [pages[i] for i in mine]
            for i, a, b in zip(mine, self.outputs(together, False), self.outputs(together, True)):
                found[i] = sigmoid(a @ self.output[:HIDDEN] + b @ self.output[HIDDEN:] + self.output_bias[0])
            at += n
        return found


def trained_pass(lstm: Direction, x: np.ndarray, mask: np.ndarray):
    """Outputs (steps, pages, cells) and what their gradient needs."""
    steps, pages, _ = x.shape
    projected = (x.reshape(-1, FEATURES) @ lstm.inputs + lstm.bias).reshape(steps, pages, -1)
    h = c = np.zeros((pages, HIDDEN), np.float32)
    kept, out = [], np.empty((steps, pages, HIDDEN), np.float32)
    for t in range(steps):
        gates, c_new, h_new = lstm.step(projected[t], h, c)
        kept.append((gates, c, c_new, h))
        m = mask[t][:, None]
        c, h = m * c_new + (1 - m) * c, m * h_new + (1 - m) * h
        out[t] = h
    return out, kept


def gradient(lstm: Direction, x: np.ndarray, mask: np.ndarray, kept: list, d_out: np.ndarray) -> list[np.ndarray]:
    """Gradients of inputs, states and bias from those of the outputs, back through the steps."""
    steps, pages, _ = x.shape
    dz_all = np.zeros((steps, pages, 4 * HIDDEN), np.float32)
    d_states = np.zeros_like(lstm.states)
    dh = dc = np.zeros((pages, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        gates, c_old, c_new, h_old = kept[t]
        i, f, o, g = np.split(gates, 4, axis=1)
        m = mask[t][:, None]
        dh = dh + d_out[t]
        dh_in, dc_in = dh * m, dc * m
        tanh_c = np.tanh(c_new)
        d_c = dc_in + dh_in * o * (1 - tanh_c**2)
        dz = np.concatenate([d_c * g * i * (1 - i), d_c * c_old * f * (1 - f), dh_in * tanh_c * o * (1 - o), d_c * i * (1 - g**2)], axis=1)
        dz_all[t] = dz
        d_states += h_old.T @ dz
        dh = dz @ lstm.states.T + dh * (1 - m)
        dc = d_c * f + dc * (1 - m)
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    return [x.reshape(-1, FEATURES).T @ flat, d_states, flat.sum(axis=0)]


def train(pages: list[tuple[Page, np.ndarray]], seed: int = 0, passes: int = PASSES) -> Labeller:
    """Fit by back-propagation through each page, with Adam steps over small groups of pages of like length.

    The weights are the mean of those of the last third of the passes.
    """
    rng = np.random.default_rng(seed)
    model = Labeller(Direction.random(rng), Direction.random(rng), rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32), np.zeros(1, np.float32))
    weights = model.weights()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    ordered = sorted((p for p in pages if p[0].texts), key=lambda p: len(p[0].texts))
    groups = [ordered[i:i + STEP_PAGES] for i in range(0, len(ordered), STEP_PAGES)]
    n_steps = n_mean = 0
    mean = [np.zeros_like(w) for w in weights]
    for done in range(passes):
        rate = LEARNING_RATE * 0.5 * (1 + np.cos(np.pi * done / passes))
        for k in rng.permutation(len(groups)):
            group = groups[k]
            steps = len(group[-1][0].texts)
            x, x_back = (np.zeros((steps, len(group), FEATURES), np.float32) for _ in range(2))
            mask, wanted = (np.zeros((steps, len(group)), np.float32) for _ in range(2))
            back_place = np.zeros((steps, len(group)), np.int64)
            for i, (page, labels) in enumerate(group):
                n = len(page.texts)
                x[:n, i] = chunk_of(page, 0, n, False)
                if rng.random() < WORDLESS:
                    x[:n, i, PATH_SIZE:PATH_SIZE + WORD_BUCKETS] = 0
                x_back[:n, i] = x[:n, i][::-1]
                mask[:n, i], wanted[:n, i] = 1, labels
                back_place[:n, i] = np.arange(n)[::-1]
            ahead, kept_ahead = trained_pass(model.ahead, x, mask)
            back, kept_back = trained_pass(model.back, x_back, mask)
            columns = np.arange(len(group))
            both = np.concatenate([ahead, back[back_place, columns]], axis=2)
            error = (sigmoid(both @ model.output + model.output_bias[0]) - wanted) * mask / mask.sum()
            d_both = error[:, :, None] * model.output
            d_back = np.zeros_like(back)
            np.add.at(d_back, (back_place, np.broadcast_to(columns, back_place.shape)), d_both[:, :, HIDDEN:])
            slopes = [
                *gradient(model.ahead, x, mask, kept_ahead, d_both[:, :, :HIDDEN]),
                *gradient(model.back, x_back, mask, kept_back, d_back),
                np.einsum("tb,tbh->h", error, both), error.sum(keepdims=True).reshape(1),
            ]
            n_steps += 1
            for w, slope, a, b in zip(weights, slopes, first, second):
                slope = np.clip(slope, -1, 1) + 1e-5 * w
                a += 0.1 * (slope - a)
                b += 0.001 * (slope**2 - b)
                w -= rate * (a / (1 - 0.9**n_steps)) / (np.sqrt(b / (1 - 0.999**n_steps)) + 1e-8)
            if 3 * done >= 2 * passes:
                n_mean += 1
                for w, total in zip(weights, mean):
                    total += (w - total) / n_mean
    for w, total in zip(weights, mean):
        w[:] = total
    return model


_fitted: dict[tuple[str, int, int], Labeller] = {}


def fit_labeller(spark: SparkSession, pages: int = TRAINING_PAGES, seed: int = 0) -> Labeller:
    """The labeller trained on ``pages`` made pages, in one task of an executor; the same for the same arguments.

    Only its weights come back. They are kept for the application.
    """
    ship_package(spark)
    key = (spark.sparkContext.applicationId, pages, seed)
    if key not in _fitted:

        def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for _ in batches:
                pass
            yield pd.DataFrame({"model": [pickle.dumps(train(list(training_pages(pages, seed)), seed))]})

        (row,) = spark.range(1, numPartitions=1).mapInPandas(fit, "model binary").collect()
        _fitted[key] = pickle.loads(bytes(row.model))
    return _fitted[key]


@ships_package
def extract_main_text(pages: DataFrame, labeller: Labeller | None = None) -> DataFrame:
    """``pages`` (``html``, any others) with the main text of each.

    Adds ``main_text`` (the blocks judged main text, in page order, joined by
    one space; empty if there are none), ``n_blocks`` and ``n_main_blocks``.
    In a block white space is one space and character references are decoded;
    whole pages are read. A null or empty page has no blocks; text without any
    tag is one block; broken markup never fails. Repeated rows give repeated
    rows, columns with the names added are replaced, an empty table gives an
    empty result. Without a ``labeller`` the one of :func:`fit_labeller` is
    used, which trains it first.
    """
    model = labeller or fit_labeller(pages.sparkSession)
    pages = pages.drop(*ADDED)
    others = [c for c in pages.columns if c != "html"]
    schema = T.StructType([
        *pages.schema.fields, T.StructField("main_text", T.StringType()), T.StructField("n_blocks", T.LongType()), T.StructField("n_main_blocks", T.LongType()),
    ])

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            read = [read_page(source) for source in batch["html"]]
            main = [s >= 0.5 for s in model.scores(read)]
            texts = [" ".join(t for t, keep in zip(p.texts, m) if keep) for p, m in zip(read, main)]
            yield batch.assign(main_text=texts, n_blocks=[len(p.texts) for p in read], n_main_blocks=[int(m.sum()) for m in main])

    return pages.select(*others, "html").mapInPandas(label, T.StructType([pages.schema[c] for c in [*others, "html"]] + schema.fields[-3:])).select(*schema.names)
