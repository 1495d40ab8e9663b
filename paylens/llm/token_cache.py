"""Encoding whole texts with the tokenizers library, a word at a time through a cache.

A library call costs 10 microseconds or more however short its text, and prose
repeats its words. A text is therefore cut where a boundary cannot change the
ids; each piece's ids are looked up, and only new pieces are encoded, through
the library's model. Texts or pieces outside the cases proven safe go through
the library's full pipeline.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

#: Pieces and parts of pieces per generation of a worker's caches, some 200 bytes each.
#: Latin-1 texts need only the parts: words (of the word vocabulary lower-cased) without what stands next to them.
CACHE_PIECES, CACHE_PARTS = 40_000, 200_000
#: The same for pieces cut from a batch.
CACHE_CUT = 400_000

#: Fixed value: the byte-level vocabulary's split of a text before its merges.
BYTE_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fixed value: the word vocabulary's words; what lies between them is dropped.
WORD_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
#: What the classes of that split hold within Latin-1, so that the faster standard library can split such texts alike.
LATIN_CLASSES = {r"\p{L}": "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"\p{N}": "0-9\xb2\xb3\xb9\xbc-\xbe", r"\s": " \t-\r\x85\xa0"}

#: Pieces of a batch that are told apart and put together at a time.
BLOCK_PIECES = 1 << 20


def latin_cuts() -> tuple[np.ndarray, np.ndarray]:
    """The kind of each Latin-1 character, and for two neighbours' kinds (``8 * left + right``) whether to cut between them.

    A cut lies only where ``BYTE_SPLIT`` ends a word whatever stands around
    the two: after a letter or number that none of its kind follows, before
    white space that follows none, and between other characters and a letter
    or number. An apostrophe stays with a letter after it, white space with all
    that follows it.
    """
    letter, number, space, apostrophe, other = range(5)
    kinds = np.full(256, other, dtype=np.uint8)
    for kind, name in ((letter, r"\p{L}"), (number, r"\p{N}"), (space, r"\s")):
        member = re.compile(f"[{LATIN_CLASSES[name]}]").fullmatch
        kinds[[c for c in range(256) if member(chr(c))]] = kind
    kinds[ord("'")] = apostrophe
    cuts = np.zeros(64, dtype=bool)
    for a in (letter, number, apostrophe, other):
        for b in range(5):
            cuts[8 * a + b] = a != b and not {a, b} <= {apostrophe, other} and (a, b) != (apostrophe, letter)
    return kinds, cuts


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others, in order, for
    the code points from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Cache(dict):
    """Keys' values by ``made(key)``. Of two generations of ``size`` keys, the older goes; what is used again stays."""

    def __init__(self, made: Callable[[str], bytes], size: int):
        super().__init__()
        self.made, self.size, self.older = made, size, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        self[key] = value = self.made(key) if value is None else value
        return value

    def of(self, keys: Sequence) -> list:
        """The values of ``keys``, without a call for those at hand."""
        values = list(map(self.get, keys))
        for at, value in enumerate(values):
            if value is None:
                values[at] = self[keys[at]]
        return values


class Encoder:
    """``ids(text)``: the ids of a whole text as little-endian uint32 bytes, no special tokens put around it.

    ``words``: the vocabulary drops white space and lower-cases (word ends
    marked by the model); else it is byte-level and keeps everything.
    """

    def __init__(self, path: str, words: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words = words
        self.model = self.tokenizer.model
        self.split = regex.compile(WORD_SPLIT if words else BYTE_SPLIT).findall
        self.table = byte_letters()
        self.parts = _Cache(self._part, CACHE_PARTS)
        self.pieces = _Cache(self._piece if words else self._spaced, CACHE_PIECES)
        # the file's added tokens (such as an end of text) have ids of their own wherever a text spells them;
        # one that is looked for in normalised text leaves every text to the library
        added = self.tokenizer.get_added_tokens_decoder().values()
        spelt = "" if any(t.normalized for t in added) else "|".join(re.escape(t.content) for t in added) or r"(?!)"
        self.added = re.compile(spelt).search
        # a run of characters with the spaces and line ends before it; no id reaches over its edges
        self.runs = re.compile(r"[ \n]*[^ \n]+|[ \n]+").findall
        # white space other than space and line end could run across an edge
        self.other_space = re.compile(r"[^\S \n]").search
        # outside Latin-1, normalisation and character classes are left to the library
        self.latin = re.compile(r"[\x00-\xff]*+").fullmatch
        classes = WORD_SPLIT if words else BYTE_SPLIT.replace(r"(?!\S)", r"(?![^\s])").replace(r" ?\p{L}", r" ?[\p{L}]").replace(r" ?\p{N}", r" ?[\p{N}]")
        classes = re.sub(r"(?<!\^)\\s\+", r"[\\s]+", classes)
        for name, members in LATIN_CLASSES.items():
            classes = classes.replace(name, members)
        self.latin_words = re.compile(classes).findall
        # cut from a batch, as Latin-1 bytes
        self.latin_pieces = _Cache(self._latin_piece, CACHE_CUT)
        kinds, self.cuts = latin_cuts()
        self.kinds = kinds.tobytes()
        # the usual piece, cut as the vocabulary's split does
        self.usual = re.compile(r"(\n?)( ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,]?)").fullmatch

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _part(self, part: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(part.encode().decode("latin-1").translate(self.table))]).tobytes()

    def _piece(self, piece: str) -> bytes:
        if self.words:
            lower = piece.lower()
            if lower.isalpha() and self.latin(piece):
                return self.parts[lower]
        elif usual := self.usual(piece):
            return b"".join([self.parts[p] for p in usual.groups() if p])
        if not self.latin(piece):
            return self.whole(piece)
        return b"".join([self.parts[p] for p in self.split(lower if self.words else piece)])

    def _spaced(self, piece: str) -> bytes:
        return self._piece(piece if piece[:1] == "\n" else " " + piece)

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.added(text):
            return self.whole(text)
        if self.latin(text):
            return b"".join(map(self.parts.__getitem__, self.latin_words(text.lower() if self.words else text)))
        if self.words:
            return b"".join(map(self.pieces.__getitem__, text.replace("\n", " ").split(" ")))
        if self.other_space(text):
            return self.whole(text)
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
            return b"".join([self._piece(p) for p in self.runs(text)])
        first, *rest = text.replace("\n", " \n").split(" ")
        return b"".join([self._piece(first) if first else b"", *map(self.pieces.__getitem__, rest)])

    def batch(self, texts: Sequence[str | None]) -> list[bytes]:
        """``ids`` of every text; Latin-1 texts of a byte-level vocabulary are cut together."""
        alike = [not self.words and bool(t) and not self.added(t) and bool(self.latin(t)) for t in texts]
        cut = iter(self._latin_batch([t.encode("latin-1") for t, a in zip(texts, alike) if a]) if any(alike) else ())
        return [next(cut) if a else self.ids(t) for t, a in zip(texts, alike)]

    def _latin_piece(self, stored: bytes) -> bytes:
        piece = stored.decode("latin-1")
        # a word with or without a space is one part
        if piece.isalpha() or piece[:1] == " " and piece[1:].isalpha():
            return self._part(piece)
        return b"".join([self._part(p) for p in self.latin_words(piece)])

    def _latin_batch(self, texts: list[bytes]) -> list[bytes]:
        data = b"".join(texts)
        ends = np.cumsum([len(t) for t in texts])
        kinds = np.frombuffer(data.translate(self.kinds), np.uint8)
        cut = np.ones(len(data) + 1, dtype=bool)
        cut[1:-1] = self.cuts[8 * kinds[:-1] + kinds[1:]]
        cut[ends] = True
        bounds = np.flatnonzero(cut).astype(np.int64, copy=False)
        ids, lengths = [], []
        for at in range(0, len(bounds) - 1, BLOCK_PIECES):
            some = bounds[at:at + BLOCK_PIECES + 1]
            pieces = pa.Array.from_buffers(pa.large_binary(), len(some) - 1, [None, pa.py_buffer(some), pa.py_buffer(data)]).dictionary_encode()
            made = self.latin_pieces.of(pieces.dictionary.to_numpy(zero_copy_only=False))
            number = pieces.indices.to_numpy()
            sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
            n = sizes[number]
            # each piece's ids lie one after the other among those of the distinct pieces
            places = np.repeat((np.cumsum(sizes) - sizes)[number] - (np.cumsum(n) - n), n)
            places += np.arange(len(places))
            ids.append(np.frombuffer(b"".join(made), "<u4")[places])
            lengths.append(n.astype(np.int32))
        upto = np.cumsum(np.concatenate(lengths), dtype=np.int64)[np.searchsorted(bounds, ends) - 1]
        return [x.tobytes() for x in np.split(np.concatenate(ids), upto[:-1])]


@lru_cache(maxsize=4)
def encoder(path: str, words: bool) -> Encoder:
    """The worker's encoder of a vocabulary file; it stays between tasks."""
    return Encoder(path, words)
