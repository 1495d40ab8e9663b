"""Document quality by a linear-chain conditional random field over lines.

Every line has features of its own characters and words and those of the lines
before and after it. The field has two states, bad and good, a linear score of
a line's features and weights between neighbouring states. Forward-backward
gives each line's probability of being good; a document's raw quality is their
mean weighted by line length, mapped to a calibrated probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import ships_package
from paylens.llm.lang_id import letter_table
from paylens.llm.near_dup import word_hashes

#: Labelled documents that the field is fitted on at most, and the lines such a document may have.
SAMPLE = 4000
SAMPLE_LINES = 500
#: Scores from here on predict label 1.
CUT = 0.3
#: Documents whose lines are scored together, and the lines (documents times those of the longest) and characters they may have.
CHUNK, CHUNK_LINES, CHUNK_CHARS = 256, 1 << 16, 1 << 22

OWN_FEATURES = ("chars", "letters", "upper", "digits", "symbols", "pipes", "bangs", "stops", "word_length", "distinct", "blank")

_upper: np.ndarray | None = None


def _upper_table() -> np.ndarray:
    global _upper
    if _upper is None:
        _upper = np.fromiter((chr(c).isupper() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _upper


def _edged(values: np.ndarray, docs: np.ndarray, step: int) -> np.ndarray:
    """``values`` of the line ``step`` lines on in the same document, 0 where there is none."""
    out = np.zeros_like(values)
    if step > 0:
        same = docs[:-1] == docs[1:]
        out[:-1][same] = values[1:][same]
    else:
        same = docs[1:] == docs[:-1]
        out[1:][same] = values[:-1][same]
    return out


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of ``texts``, the text each is from, and each line's length.

    An empty text has one empty line. A line's features are its own, those of
    its neighbours, and whether it is the first or last.
    """
    joined = "\n".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    breaks = np.flatnonzero(points == 10)
    starts, ends = np.append(0, breaks + 1), np.append(breaks, len(points))
    n = len(starts)
    lines_per_text = np.array([t.count("\n") + 1 for t in texts])
    docs = np.repeat(np.arange(len(texts)), lines_per_text)

    def per_line(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (sums[ends] - sums[starts]).astype(np.float64)

    space = (points == 32) | ((points >= 9) & (points <= 13))
    letter = letter_table()[points]
    chars = (ends - starts).astype(np.float64)
    solid = np.maximum(per_line(~space), 1)
    begins = ~space & np.concatenate([[True], space[:-1]])
    words = per_line(begins)
    some_words = np.maximum(words, 1)

    hashes = word_hashes(joined)
    at = np.repeat(np.arange(n), words.astype(np.int64))
    order = np.lexsort((hashes, at))
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (at[order][1:] != at[order][:-1])
    distinct = np.bincount(at[order][new], minlength=n)

    def among(marks: str) -> np.ndarray:
        table = np.zeros(128, dtype=bool)
        table[[ord(c) for c in marks]] = True
        return table[np.minimum(points, 127)] & (points < 127)

    own = np.stack(
        [
            np.log1p(chars),
            per_line(letter) / solid,
            per_line(_upper_table()[points]) / np.maximum(per_line(letter), 1),
            per_line((points >= 48) & (points <= 57)) / solid,
            per_line(among("#$%&*@^~<>{}[]\\=+_/")) / some_words,
            per_line(among("|")) / some_words,
            per_line(among("!")) / some_words,
            per_line(among(".,;:?")) / some_words,
            solid / some_words / 10,
            np.where(words > 0, distinct / some_words, 1.0),
            words == 0,
        ],
        axis=1,
    )
    first = np.concatenate([[True], docs[1:] != docs[:-1]])
    last = np.concatenate([docs[1:] != docs[:-1], [True]])
    features = np.concatenate([own, _edged(own, docs, -1), _edged(own, docs, 1), first[:, None], last[:, None]], axis=1)
    return features, docs, chars


def blocks_of_lines(text: str) -> Iterator[tuple[str, int, int]]:
    """A long text as (lines, lines before that are context, lines that count): blocks of whole lines with a line of context around."""
    at = 0
    before = ""
    while at <= len(text):
        end, lines = at, 0
        while lines < CHUNK_LINES // 4 and end - at < CHUNK_CHARS:
            stop = text.find("\n", end)
            lines += 1
            end = len(text) + 1 if stop < 0 else stop + 1
            if stop < 0:
                break
        after = "" if end > len(text) else "\n" + text[end:text.find("\n", end) if text.find("\n", end) >= 0 else len(text)]
        yield (before + "\n" if at else "") + text[at:end - 1] + after, int(at > 0), lines
        before = text[text.rfind("\n", 0, end - 1) + 1:end - 1]
        at = end


def _padded(values: np.ndarray, docs: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines' values as (position, document), and each document's number of lines."""
    counts = np.bincount(docs, minlength=n_docs)
    place = np.arange(len(docs)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = np.zeros((counts.max(initial=0), n_docs))
    out[place, docs] = values
    return out, counts


def forward_backward(emit: np.ndarray, counts: np.ndarray, start: float, between: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of state good, expected transitions per document summed, and log partition sums.

    ``emit`` (position, document): score of state good against bad;
    ``between[s, t]``: score of going from state s to t.
    """
    steps, n = emit.shape
    alpha = np.full((steps, n, 2), -np.inf)
    beta = np.zeros((steps, n, 2))
    alpha[0, :, 0], alpha[0, :, 1] = 0.0, start + emit[0]
    for t in range(1, steps):
        live = counts > t
        into = np.logaddexp(alpha[t - 1, live, 0, None] + between[0], alpha[t - 1, live, 1, None] + between[1])
        into[:, 1] += emit[t, live]
        alpha[t, live] = into
    last = np.maximum(counts - 1, 0)
    log_z = np.logaddexp(alpha[last, np.arange(n), 0], alpha[last, np.arange(n), 1])
    expected = np.zeros((2, 2))
    for t in range(steps - 2, -1, -1):
        live = counts > t + 1
        ahead = beta[t + 1, live].copy()
        ahead[:, 1] += emit[t + 1, live]
        beta[t, live] = np.logaddexp(between[:, 0] + ahead[:, 0, None], between[:, 1] + ahead[:, 1, None])
        joint = alpha[t, live][:, :, None] + between[None] + ahead[:, None, :] - log_z[live][:, None, None]
        expected += np.exp(joint).sum(axis=0)
    good = np.exp(np.minimum(alpha[:, :, 1] + beta[:, :, 1] - log_z[None, :], 0.0))
    return good, expected, log_z


@dataclass(frozen=True)
class LineField:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    start: float
    between: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def raw(self, texts: list[str]) -> np.ndarray:
        """Length-weighted mean of each text's line probabilities."""
        if len(texts) == 1:
            # the scores of a long text's lines are made in blocks; its chain is one
            parts = []
            for lines, skip, n in blocks_of_lines(texts[0]):
                features, _, chars = line_features([lines])
                parts.append((((features - self.mean) / self.scale)[skip:skip + n] @ self.weights + self.bias, chars[skip:skip + n]))
            scores, chars = (np.concatenate(x) for x in zip(*parts))
            docs = np.zeros(len(scores), np.int64)
        else:
            features, docs, chars = line_features(texts)
            scores = ((features - self.mean) / self.scale) @ self.weights + self.bias
        emit, counts = _padded(scores, docs, len(texts))
        good, _, _ = forward_backward(emit, counts, self.start, self.between)
        weight, _ = _padded(chars + 1, docs, len(texts))
        return (good * weight).sum(axis=0) / weight.sum(axis=0)

    def score(self, texts: list[str]) -> np.ndarray:
        raw = np.clip(self.raw(texts), 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.slope * np.log(raw / (1 - raw)) + self.offset)))


def fit(texts: list[str], labels: np.ndarray, rounds: int = 200, rate: float = 0.05, ridge: float = 1e-3) -> LineField:
    """Fit by gradient ascent (Adam) on the likelihood of label sequences; each line has its document's label.

    The last fifth of the documents is kept back to calibrate the score.
    Without both labels the score is the share of label 1.
    """
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        width = 3 * len(OWN_FEATURES) + 2
        share = min(max(share, 0.01), 0.99)
        return LineField(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.0, np.zeros((2, 2)), 0.0, float(np.log(share / (1 - share))))
    cut = max(1, len(texts) * 4 // 5)
    # in chunks: while they are made, features take many times the size of the texts
    parts = [line_features(texts[at : min(at + CHUNK, cut)])[:2] for at in range(0, cut, CHUNK)]
    features = np.concatenate([f for f, _ in parts])
    docs = np.concatenate([d + at * CHUNK for at, (_, d) in enumerate(parts)])
    del parts
    mean, scale = features.mean(axis=0), features.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    features -= mean
    features /= scale
    x, y = features, labels[:cut].astype(np.float64)
    counts = np.bincount(docs, minlength=cut)
    line_y = y[docs]
    seen = np.array([[((1 - y) * (counts - 1)).sum(), 0.0], [0.0, (y * (counts - 1)).sum()]])
    place = np.arange(len(docs)) - np.repeat(np.cumsum(counts) - counts, counts)
    # weights, bias, start, between
    theta = np.zeros(x.shape[1] + 6)
    moment, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w, bias, start, between = theta[:-6], theta[-6], theta[-5], theta[-4:].reshape(2, 2)
        emit, _ = _padded(x @ w + bias, docs, cut)
        good, expected, _ = forward_backward(emit, counts, start, between)
        off = line_y - good[place, docs]
        grad = np.concatenate([x.T @ off, [off.sum(), (y - good[0]).sum()], (seen - expected).ravel()]) / cut - ridge * theta
        moment, square = 0.9 * moment + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        theta += rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    field = LineField(mean, scale, theta[:-6], float(theta[-6]), float(theta[-5]), theta[-4:].reshape(2, 2))
    kept_back = texts[cut:] or texts
    raw = np.concatenate([field.raw(kept_back[i : i + CHUNK]) for i in range(0, len(kept_back), CHUNK)])
    slope, offset = _calibrated(raw, (labels[cut:] if texts[cut:] else labels).astype(np.float64))
    return LineField(field.mean, field.scale, field.weights, field.bias, field.start, field.between, slope, offset)


def _calibrated(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic map from log odds of ``raw`` to the label, by Newton steps with a weak prior."""
    raw = np.clip(raw, 1e-6, 1 - 1e-6)
    z = np.stack([np.log(raw / (1 - raw)), np.ones(len(raw))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(z @ beta)))
        grad = z.T @ (y - p) - 0.5 * (beta - [0.5, 0.0])
        hess = (z * (p * (1 - p))[:, None]).T @ z + 0.5 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(beta[0]), 1e-3), float(beta[1])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> LineField:
    """Fit the field on at most ``sample`` labelled documents, those of the smallest hash of their id.

    ``labels`` (id, label 0 or 1) should hold only rows to learn from; null
    labels are left out. Documents over ``SAMPLE_LINES`` lines aren't learned
    from. Only the sampled documents reach the driver.
    """
    picked = labels.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("label")).dropna()
    picked = picked.orderBy(F.xxhash64("l_id"), "l_id", "label").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(picked), F.col("id") == F.col("l_id")).filter(F.size(F.split("text", "\n")) <= SAMPLE_LINES)
    found = rows.select("id", "text", "label").orderBy(F.xxhash64("id"), "id", "label", "text").limit(sample).collect()
    return fit([r["text"] for r in found], np.array([r["label"] for r in found], dtype=np.int64))


def chunks_of(texts: list[str], order: list[int]) -> Iterator[list[int]]:
    """``order`` (by lines, rising) in chunks of bounded size; a text beyond the bounds is a chunk of its own."""
    here: list[int] = []
    chars = 0
    for i in order:
        lines = texts[i].count("\n") + 1
        if here and (len(here) == CHUNK or (len(here) + 1) * lines > CHUNK_LINES or chars + len(texts[i]) > CHUNK_CHARS):
            yield here
            here, chars = [], 0
        here.append(i)
        chars += len(texts[i])
    if here:
        yield here


@ships_package
def score_documents(docs: DataFrame, field: LineField, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """``docs`` with ``quality_score`` (0 to 1) of every whole text and ``quality_predicted`` (1 from ``cut`` on).

    A null text is scored as an empty one, which has one empty line. Equal
    texts get equal scores. Input columns of the added names are replaced.
    """

    @F.pandas_udf("double")
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            whole = ["" if t is None else t for t in batch]
            # alike in length, so that short documents don't wait for long ones
            order = sorted(range(len(whole)), key=lambda i: whole[i].count("\n"))
            out = np.empty(len(whole))
            for here in chunks_of(whole, order):
                out[here] = field.score([whole[i] for i in here])
            yield pd.Series(out)

    rows = docs.drop("quality_score", "quality_predicted").withColumn("quality_score", scores(F.col(text_col)))
    return rows.withColumn("quality_predicted", (F.col("quality_score") >= cut).cast("int"))
