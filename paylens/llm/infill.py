"""Fill-in-the-middle transformation by displacement scatter.

The texts of a batch lie one after the other in one byte array. A scan of the
line ends gives every text its two cuts, so three pieces. Where a piece
begins, a difference array holds by how much its bytes move further than those
before; its running sum is every byte's displacement, and one numpy scatter
writes all outputs of the batch. The way back finds the marks of an output,
builds the displacements again from them and gathers.

Both directions go through the bytes in blocks of ``BLOCK`` with the running
sum carried over, so besides the texts themselves memory is bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from paylens.llm.common import ships_package

# The marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# The forms.
PLAIN, PSM, SPM = "plain", "psm", "spm"
MARK = 3
#: Bytes moved at a time.
BLOCK = 1 << 20

ADDED = ("fim_units", "fim_form", "fim_prefix_chars", "fim_middle_chars", "fim_output")


def byte_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and the bounds of each; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = pc.fill_null(column, "").cast(pa.large_binary())
    if not len(rows):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = rows.buffers()
    bounds = np.frombuffer(offsets, np.int64)[rows.offset:rows.offset + len(rows) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def text_rows(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The texts that lie in ``data`` between ``bounds``."""
    return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])


def mark_places(data: np.ndarray, letter: int) -> np.ndarray:
    """Where a mark with this letter begins."""
    if len(data) < MARK:
        return np.empty(0, np.int64)
    found = []
    for a in range(0, len(data) - 2, BLOCK):
        part = data[a:a + BLOCK + 2]
        found.append(a + np.flatnonzero((part[:-2] == 60) & (part[1:-1] == letter) & (part[2:] == 62)))
    return np.concatenate(found)


def first_inside(places: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each range the first of the sorted ``places`` whose whole mark lies in it, -1 if none."""
    if not len(places):
        return np.full(len(starts), -1, np.int64)
    at = np.searchsorted(places, starts)
    first = places[np.minimum(at, len(places) - 1)]
    return np.where((at < len(places)) & (first + MARK <= ends), first, -1)


def displacements(begins: np.ndarray, shifts: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(a, b, shift of each byte of a..b) from the bytes where a new shift begins; later entries of one byte win."""
    steps = np.diff(shifts, prepend=0)
    carried = 0
    for a in range(0, size, BLOCK):
        b = min(size, a + BLOCK)
        lo, hi = np.searchsorted(begins, (a, b))
        difference = np.zeros(b - a, np.int64)
        np.add.at(difference, begins[lo:hi] - a, steps[lo:hi])
        difference[0] += carried
        shift = np.cumsum(difference, out=difference)
        carried = int(shift[-1])
        yield a, b, shift


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """The four draws of a document; those of a null id come from the seed alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))


def char_counts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code points in each range: its bytes that continue none."""
    return np.array([np.count_nonzero((data[a:b] & 0xC0) != 0x80) for a, b in zip(starts.tolist(), ends.tolist())], np.int64)


def scatter(ids: list, data: np.ndarray, bounds: np.ndarray, seed: int, rate: int, spm_rate: int) -> dict[str, object]:
    """Units, form, cuts in code points, and outputs of the texts of a batch."""
    starts, ends = bounds[:-1], bounds[1:]
    sizes = ends - starts
    line_ends = np.flatnonzero(data == 10)
    first_line = np.searchsorted(line_ends, starts)
    n_ends = np.searchsorted(line_ends, ends) - first_line
    last = data[np.maximum(ends - 1, 0)] if len(data) else np.zeros(len(sizes), np.uint8)
    units = n_ends + ((sizes > 0) & (last != 10))
    h = np.array([draws(seed, i) for i in ids], np.int64).reshape(-1, 4)
    one, two = h[:, 0] % (units + 1), h[:, 1] % (units + 1)

    def after(k: np.ndarray) -> np.ndarray:
        """The byte after the first ``k`` units."""
        line = first_line + np.minimum(k, n_ends) - 1
        here = line_ends[np.clip(line, 0, max(len(line_ends) - 1, 0))] + 1 if len(line_ends) else starts
        return np.where(k == 0, starts, np.where(k > n_ends, ends, here))

    a, b = after(np.minimum(one, two)), after(np.maximum(one, two))
    plain = (sizes == 0) | (h[:, 2] % 100 >= rate)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain |= first_inside(mark_places(data, mark[1]), starts, ends) >= 0
    spm = ~plain & (h[:, 3] % 100 < spm_rate)
    out_bounds = np.concatenate([[0], np.cumsum(np.where(plain, sizes, sizes + 3 * MARK))])
    base = out_bounds[:-1]
    tail = ends - b
    # where each piece goes in the batch's output
    prefix_to = base + np.where(plain, 0, np.where(spm, 2 * MARK + tail, MARK))
    suffix_to = base + np.where(plain, b - starts, np.where(spm, MARK, 2 * MARK + a - starts))
    middle_to = base + np.where(plain, a - starts, 3 * MARK + tail + a - starts)
    begins = np.stack([starts, a, b], axis=1).ravel()
    shifts = np.stack([prefix_to - starts, middle_to - a, suffix_to - b], axis=1).ravel()
    out = np.empty(int(out_bounds[-1]), np.uint8)
    for lo, hi, shift in displacements(begins, shifts, len(data)):
        shift += np.arange(lo, hi)
        out[shift] = data[lo:hi]
    for mark, to in ((PREFIX, prefix_to), (SUFFIX, suffix_to), (MIDDLE, middle_to)):
        for k, byte in enumerate(mark):
            out[to[~plain] - MARK + k] = byte
    return {
        "units": units,
        "form": np.where(plain, PLAIN, np.where(spm, SPM, PSM)),
        "prefix_chars": np.ma.array(char_counts(data, starts, a), mask=plain),
        "middle_chars": np.ma.array(char_counts(data, a, b), mask=plain),
        "output": (out, out_bounds),
    }


def gather(forms: list, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that the outputs of a batch were made from, by their marks and forms alone."""
    starts, ends = bounds[:-1], bounds[1:]
    spm, psm = (np.array([f == form for f in forms], bool) for form in (SPM, PSM))
    cut = spm | psm
    p, s, m = (first_inside(mark_places(data, mark[1]), starts, ends) for mark in (PREFIX, SUFFIX, MIDDLE))
    if ((p < 0) | (s < 0) | (m < 0))[cut].any():
        raise ValueError("an output lacks a mark of its form")
    sizes = np.where(cut, ends - starts - 3 * MARK, ends - starts)
    text_bounds = np.concatenate([[0], np.cumsum(sizes)])
    base = text_bounds[:-1]
    # lengths of the pieces, and where each lies in the outputs
    prefix_len = np.where(spm, m - p - MARK, np.where(psm, s - p - MARK, sizes))
    middle_len = np.where(cut, ends - m - MARK, 0)
    a, b = base + prefix_len, base + prefix_len + middle_len
    begins = np.stack([base, a, b], axis=1).ravel()
    shifts = np.stack([np.where(cut, p + MARK, starts) - base, np.where(cut, m + MARK, starts) - a, np.where(cut, s + MARK, starts) - b], axis=1).ravel()
    text = np.empty(int(text_bounds[-1]), np.uint8)
    for lo, hi, shift in displacements(begins, shifts, len(text)):
        shift += np.arange(lo, hi)
        text[lo:hi] = data[shift]
    return text, text_bounds


@ships_package
def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, any others) with its texts rearranged for infilling.

    Adds ``fim_units`` (lines, each with its line end), ``fim_form``
    (``plain``, ``psm`` or ``spm``), ``fim_prefix_chars`` and
    ``fim_middle_chars`` (code points; null if plain) and ``fim_output``. Cuts
    and form are drawn from ``seed`` and the document's id alone: ``rate``
    percent are rearranged, ``spm_rate`` percent of these with the suffix
    first. Empty texts and those that hold a mark stay plain.

    A null text counts as empty (output empty); a null id draws from the seed
    alone; repeated rows give repeated rows. Columns of ``docs`` with the
    names added are replaced. An empty table gives an empty result.
    """
    docs = docs.drop(*ADDED)
    fields = [*docs.schema.fields, T.StructField("fim_units", T.LongType()), T.StructField("fim_form", T.StringType()),
              T.StructField("fim_prefix_chars", T.LongType()), T.StructField("fim_middle_chars", T.LongType()),
              T.StructField("fim_output", T.StringType())]

    def rearrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = byte_rows(batch.column("text"))
            made = scatter(batch.column("doc_id").to_pylist(), data, bounds, seed, rate, spm_rate)
            out = {name: batch.column(name) for name in batch.schema.names}
            out["fim_units"] = pa.array(made["units"])
            out["fim_form"] = pa.array(made["form"].tolist(), pa.string())
            out["fim_prefix_chars"] = pa.array(made["prefix_chars"].tolist(), pa.int64())
            out["fim_middle_chars"] = pa.array(made["middle_chars"].tolist(), pa.int64())
            out["fim_output"] = text_rows(*made["output"]).cast(pa.string())
            yield pa.RecordBatch.from_pydict(out)

    return docs.mapInArrow(rearrange, T.StructType(fields))


@ships_package
def restore(rearranged: DataFrame) -> DataFrame:
    """Adds ``fim_restored``: the text, from ``fim_output`` and ``fim_form`` alone. A null output counts as empty and plain."""
    rearranged = rearranged.drop("fim_restored")
    schema = T.StructType([*rearranged.schema.fields, T.StructField("fim_restored", T.StringType())])

    def put_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = byte_rows(batch.column("fim_output"))
            out = {name: batch.column(name) for name in batch.schema.names}
            out["fim_restored"] = text_rows(*gather(batch.column("fim_form").to_pylist(), data, bounds)).cast(pa.string())
            yield pa.RecordBatch.from_pydict(out)

    return rearranged.mapInArrow(put_back, schema)
