"""A page's text blocks in page order, with the features that the block labeller reads.

A block is a run of text between block-level tags. For each, the open elements
around it (their tags, and hashed words of their class, id and role) and its
own hashed words are counted; counts are stored as bytes, so that pages of
very many blocks stay small.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from dataclasses import dataclass, field

import numpy as np

#: Hashed words of classes and ids, and of the text.
NAME_BUCKETS, WORD_BUCKETS = 256, 64
#: Counts are stored as ``SCALE * log(1 + count)`` in a byte.
SCALE = 24

# Element names, by what they mean for a reader of the page.
#: Elements around text that the path counts by name; others share a bucket.
PATH_TAGS = (
    "html", "body", "main", "article", "section", "div", "header", "footer", "nav", "aside", "form", "fieldset", "ul", "ol", "li",
    "dl", "dt", "dd", "p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figure", "figcaption", "table", "caption", "tr", "td",
    "th", "details", "summary", "dialog", "address", "button", "select", "option", "textarea", "menu", "hgroup", "center",
)
#: Elements that start and end a block but stay out of the path's names.
OTHER_BLOCKS = ("hr", "thead", "tbody", "tfoot", "optgroup", "legend", "search", "frameset", "noframes", "head", "datalist", "video", "audio", "canvas")
#: Elements whose content is no text of the page.
HIDDEN = ("script", "style", "template", "title", "svg", "math", "iframe", "object", "noscript", "textarea", "select", "xmp", "noembed", "audio", "video", "canvas")
#: Of the hidden ones, those whose content is not parsed as markup.
RAW = ("script", "style", "title", "iframe", "noscript", "textarea", "xmp", "noembed")
#: Elements without content.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
#: Opening one of these closes an open one of the second kind, up to the container named last.
IMPLIED_END = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
#: Elements that stay open when a paragraph or heading starts: it closes only an open paragraph.
CLOSES_P = frozenset(PATH_TAGS) - {"button", "option", "td", "th", "tr", "summary", "figcaption", "caption"}

_PATH_SLOT = {t: i for i, t in enumerate(PATH_TAGS)}
_BLOCKS = frozenset(PATH_TAGS) | frozenset(OTHER_BLOCKS)
PATH_SIZE = len(PATH_TAGS) + 1 + NAME_BUCKETS
#: Numbers besides counts: lengths, shares, position.
NUMBERS = 10
FEATURES = PATH_SIZE + WORD_BUCKETS + NUMBERS

#: A tag with its attributes; quoted values may hold ``>``. Possessive, so that it fails in one pass.
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|(?<==)"[^"]*+"|(?<==)'[^']*+'|(?<==\s)"[^"]*+"|["'])*+)>""")
#: The same without quotes.
_PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([A-Za-z][-\w]*)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|\b(hidden)\b""")
_NAME_WORD = re.compile(r"[A-Za-z]+")
_WORD = re.compile(r"\w+")


def bucket(word: str, buckets: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % buckets


class _Buckets(dict):
    """Buckets of words; a bounded number is remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        found = self[word] = bucket(word, WORD_BUCKETS)
        return found


_word_buckets = _Buckets()


def levels(counts: np.ndarray) -> np.ndarray:
    """Counts as stored: ``SCALE * log(1 + count)`` in a byte."""
    return np.minimum(255, np.rint(SCALE * np.log1p(counts.astype(np.float32)))).astype(np.uint8)


@dataclass
class Page:
    """The blocks of a page: their texts, and what their features are made of (words as their buckets)."""

    texts: list[str] = field(default_factory=list)
    paths: list[bytes] = field(default_factory=list)
    words: list[bytes] = field(default_factory=list)
    numbers: list[bytes] = field(default_factory=list)

    def features(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """One row of bytes for each of the blocks lo..hi; see ``FEATURES``."""
        paths, mine, numbers = (x[lo:hi] for x in (self.paths, self.words, self.numbers))
        n = len(mine)
        if not n:
            return np.empty((0, FEATURES), np.uint8)
        path = np.frombuffer(b"".join(paths), np.uint8).reshape(n, PATH_SIZE)
        words = np.frombuffer(b"".join(mine), np.uint8).astype(np.int64)
        words += WORD_BUCKETS * np.repeat(np.arange(n), np.fromiter(map(len, mine), np.int64, n))
        counts = np.bincount(words, minlength=n * WORD_BUCKETS).reshape(n, WORD_BUCKETS)
        return np.concatenate([levels(path), levels(counts), np.frombuffer(b"".join(numbers), np.uint8).reshape(n, NUMBERS)], axis=1)


def _level(x: float) -> int:
    return min(255, round(SCALE * math.log1p(x)))


class _Reader:
    """Collects the blocks of one page while its tags go by."""

    def __init__(self) -> None:
        self.page = Page()
        self.path = bytearray(PATH_SIZE)
        self.path_now: bytes | None = None
        self.beyond: dict[int, int] = {}  # of counts that don't fit a byte, the rest
        self.open: list[tuple[str, tuple[int, ...]]] = []
        self.places: dict[str, list[int]] = {}
        self.parts: list[str] = []
        self.linked = 0
        self.in_link = False

    def text(self, raw: str) -> None:
        if self.in_link:
            self.linked += len(raw.strip())
        self.parts.append(raw)

    def end_block(self) -> None:
        if not self.parts:
            return
        raw = "".join(self.parts)
        text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
        linked, self.parts, self.linked = self.linked, [], 0
        if not text:
            return
        page = self.page
        if self.path_now is None:
            self.path_now = bytes(self.path)
        page.paths.append(self.path_now)
        words = bytes(map(_word_buckets.__getitem__, _WORD.findall(text.lower())))
        page.words.append(words)
        n = len(text)
        stops = sum(map(text.count, ".,;:!?"))
        page.numbers.append(bytes((
            _level(n), _level(len(words)), min(255, round(200 * min(1, linked / n))), min(255, round(2000 * min(0.12, stops / n))),
            round(200 * sum(map(text.count, "0123456789")) / n), round(200 * sum(map(text.count, "|»›·•©/")) / n),
            200 if text[-1] in ".!?。…\"”" else 0, _level(len(page.texts)), _level(len(self.open)), 200 if linked else 0,
        )))
        page.texts.append(text)

    def push(self, tag: str, attributes: str) -> None:
        slots = [_PATH_SLOT.get(tag, len(PATH_TAGS))]
        if attributes:
            for name, value, hidden in _ATTRIBUTE.findall(attributes):
                name = name.lower()
                if hidden or name == "hidden":
                    slots.append(len(PATH_TAGS) + 1 + bucket("hidden", NAME_BUCKETS))
                elif name in ("class", "id", "role", "itemprop", "aria-label"):
                    slots += [len(PATH_TAGS) + 1 + bucket(w.lower(), NAME_BUCKETS) for w in _NAME_WORD.findall(value)]
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, tuple(slots)))
        self.path_now = None
        for s in slots:
            if self.path[s] < 255:
                self.path[s] += 1
            else:
                self.beyond[s] = self.beyond.get(s, 0) + 1

    def pop_to(self, size: int) -> None:
        while len(self.open) > size:
            tag, slots = self.open.pop()
            self.places[tag].pop()
            self.path_now = None
            for s in slots:
                if self.beyond.get(s):
                    self.beyond[s] -= 1
                else:
                    self.path[s] -= 1

    def innermost(self, tags: tuple[str, ...]) -> int:
        """Place of the innermost open one of ``tags``, -1 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def close(self, tag: str) -> None:
        """Close the innermost open ``tag`` and all inside it; nothing if none is open."""
        place = self.innermost((tag,))
        if place >= 0:
            self.pop_to(place)

    def imply_ends(self, tag: str) -> None:
        if tag in CLOSES_P and self.open and self.open[-1][0] == "p":
            self.pop_to(len(self.open) - 1)
        if tag in IMPLIED_END:
            ends, within = IMPLIED_END[tag]
            inside = self.innermost(within)
            first = min((p for t in ends for p in self.places.get(t, ())[-1:] if p > inside), default=-1)
            if first >= 0:
                self.pop_to(first)


def read_page(source: str | None) -> Page:
    """The blocks of an HTML text; none for a null or empty one.

    Broken markup is read as far as it can be: unknown end tags are passed
    over, open elements end with the page, a ``<`` that begins no tag is text.
    """
    reader = _Reader()
    source = source or ""
    at = done = 0  # before ``done`` all is read; the next ``<`` is looked for from ``at``
    hidden, depth = "", 0
    pattern, size = _TAG, len(source)
    while True:
        at = source.find("<", at)
        if at < 0:
            break
        after = source[at + 1:at + 2]
        if after in "!?" and after:
            found, raw = None, ""
            if source.startswith("<!--", at):
                end = source.find("-->", at + 4)
                upto = end + 3 if end >= 0 else size
            elif source.startswith("<![CDATA[", at):
                end = source.find("]]>", at)
                raw, upto = source[at + 9:end if end >= 0 else size], end + 3 if end >= 0 else size
            else:
                end = source.find(">", at)
                upto = end + 1 if end >= 0 else size
            if not hidden:
                if at > done:
                    reader.text(source[done:at])
                if raw:
                    reader.text(html.escape(raw))
            at = done = upto
            continue
        if not (after.isascii() and after.isalpha()) and after != "/":
            at += 1
            continue
        found = pattern.match(source, at)
        if not found and pattern is _TAG and _PLAIN_TAG.match(source, at):
            # a quote left open to the end of the page: from here on quotes don't count
            pattern = _PLAIN_TAG
            found = pattern.match(source, at)
        if not found:
            if after == "/" or source.find(">", at) >= 0:
                at += 1
                continue
            break
        if not hidden and at > done:
            reader.text(source[done:at])
        at = done = found.end()
        slash, tag, attributes = found.groups()
        tag = tag.lower()
        if hidden:
            if tag == hidden:
                depth += -1 if slash else (not attributes.endswith("/"))
                if depth <= 0:
                    hidden = ""
            continue
        if not slash and tag in HIDDEN:
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = done = end.end() if end else size
            elif not attributes.endswith("/"):
                hidden, depth = tag, 1
            continue
        if tag == "a":
            reader.in_link = not slash
        if tag == "br":
            reader.text(" ")
        elif tag in _BLOCKS:
            reader.end_block()
            if slash:
                reader.close(tag)
            elif tag not in VOID:
                reader.imply_ends(tag)
                reader.push(tag, attributes)
    if not hidden and done < size:
        reader.text(source[done:])
    reader.end_block()
    return reader.page
