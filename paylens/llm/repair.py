"""Re-Pair grammar compression of id sequences, in rounds over whole arrays.

A round finds the most frequent pairs of neighbouring symbols, gives each a
new nonterminal and replaces all their occurrences at once; pairs of a round
share no symbol in a way that lets two occurrences overlap. Rounds go on until
no pair occurs often enough to save more bytes than its rule costs. Frequent
pairs go first: the count that a pair needs halves from round to round as long
as more frequent ones become rare.

A shard is stored as::

    magic "RPG1" | uint32 terminals | uint32 rules | uint64 symbols | uint64 ids | uint32 bytes per symbol
    left[rules], right[rules]      the pair each nonterminal stands for (uint32)
    length[rules]                  how many ids it expands to (uint32)
    symbols                        terminals and, from ``terminals`` on, nonterminals (uint16 or uint32)

all little-endian. The expansion lengths give each symbol's place among the
ids without expanding it, so any range of ids is decoded from its own symbols.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"RPG1"
_HEAD = struct.Struct("<4sIIQQI")
#: Bytes of a rule: its pair and its length.
RULE_BYTES = 12
#: Rules a round may add; what is left over waits for the next round.
RULES_A_ROUND = 6000
#: Pairs that a round looks at, at least (twice this).
CANDIDATES = 4096
#: Where narrow numbers run out, a round takes half of those left, or this many.
LAST_NUMBERS = 512
#: Bits of the table in which a round counts pairs by hash.
HASH_BITS = 20
#: By how much the count asked for falls from round to round.
STEP = 16
#: Symbols below this are stored in 16 bits.
NARROW = 1 << 16
#: When narrow symbols run out, rules go on in 32 bits if at least this share of places still has a pair that pays: each
#: symbol then doubles, so the rest must shrink to less than half.
WIDEN_SHARE = 0.75
#: Odd factors that rounds hash with in turn, so that pairs which share a bin in one round don't in the next.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


def _compatible(codes: list[int], shift: int) -> list[bool]:
    """For pairs (left << shift | right) in order, whether each is taken: no symbol may end one taken pair and begin another."""
    lefts: set[int] = set()
    rights: set[int] = set()
    taken = []
    for code in codes:
        left, right = code >> shift, code & ((1 << shift) - 1)
        fits = left not in rights and right not in lefts and not (left == right and (left in lefts or right in rights))
        if fits:
            lefts.add(left)
            rights.add(right)
        taken.append(fits)
    return taken


def _frequent(codes: np.ndarray, bits: int, floor: int, pays: int, most: int, factor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Codes that may be frequent, most frequent first, the places that may have one, their codes' numbers, and the count asked for.

    Codes are counted by hash, and a bin stands for one code that falls into
    it. Asked for is ``floor``, at most a fraction of the fullest bin, at least
    ``pays``; a bin with fewer holds no code that is more frequent.
    """
    kind = codes.dtype.type
    hashed = codes * kind((factor >> (64 - bits)) | 1)
    hashed >>= kind(bits - HASH_BITS)
    hashed = hashed.astype(np.int32 if HASH_BITS < 31 else np.int64)
    table = np.bincount(hashed, minlength=1 << HASH_BITS)
    floor = max(pays, min(floor, int(table.max()) // STEP + 1))
    bins = np.flatnonzero(table >= floor)
    if len(bins) > most:
        bins = bins[np.argpartition(table[bins], len(bins) - most)[-most:]]
    bins = bins[np.lexsort((bins, -table[bins]))]
    wanted = np.zeros(len(table), dtype=bool)
    wanted[bins] = True
    places = np.flatnonzero(wanted[hashed])
    number = np.zeros(len(table), dtype=np.int32)
    number[bins] = np.arange(len(bins), dtype=np.int32)
    of_bin = number[hashed[places]]
    # any code of a bin stands for it; frequent ones turn up soon
    nowhere = kind((1 << bits) - 1)
    values = np.full(len(bins), nowhere, dtype=kind)
    at, size = 0, 1 << 16
    while (values == nowhere).any():
        values[of_bin[at:at + size]] = codes[places[at:at + size]]
        at, size = at + size, 4 * size
    return values, places, of_bin, floor


def _frequent_exactly(codes: np.ndarray, pays: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The same for all codes that occur ``pays`` times or more, counted one by one."""
    values, place, counts = np.unique(codes, return_inverse=True, return_counts=True)
    picked = np.flatnonzero(counts >= pays)
    picked = picked[np.lexsort((values[picked], -counts[picked]))[:most]]
    number = np.full(len(values), -1, dtype=np.int32)
    number[picked] = np.arange(len(picked), dtype=np.int32)
    number = number[place]
    places = np.flatnonzero(number >= 0)
    return values[picked], places, number[places], pays


def _occurrences(codes: np.ndarray, places: np.ndarray, of_code: np.ndarray, pairs: np.ndarray, taken: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the occurrences of the ``taken`` pairs and each one's number; in a run of one symbol every other."""
    kind = codes.dtype.type
    # in place of the others, a code that no pair of symbols has
    wanted = np.where(taken, pairs, kind((1 << 2 * shift) - 1))
    hits = np.flatnonzero(codes[places] == wanted[of_code])
    at, number = places[hits], of_code[hits]
    if (taken & (pairs >> kind(shift) == pairs & kind((1 << shift) - 1))).any():
        # no two hits of other pairs are neighbours
        after = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        run_start = np.repeat(after, np.diff(after, append=len(at)))
        even = (np.arange(len(at)) - run_start) % 2 == 0
        at, number = at[even], number[even]
    return at, number


def _paying_share(s: np.ndarray, pays: int) -> float:
    """The share of places whose pair of narrow symbols may occur ``pays`` times or more, by hashed counts."""
    codes = (s[:-1] << np.uint32(16)) | s[1:]
    table = np.bincount(((codes * np.uint32(FACTORS[0] >> 32 | 1)) >> np.uint32(32 - HASH_BITS - 2)).astype(np.int32), minlength=4 << HASH_BITS)
    return table[table >= pays].sum() / max(1, len(codes))


def compress(ids: np.ndarray, terminals: int, rules_a_round: int = RULES_A_ROUND, min_count: int | None = None) -> bytes:
    """The shard of ``ids`` (each below ``terminals``). ``min_count`` replaces the count from which a rule pays."""
    s = np.array(ids, dtype=np.uint32)
    left: list[int] = []
    right: list[int] = []
    lengths: list[int] = []

    def length(x: int) -> int:
        return 1 if x < terminals else lengths[x - terminals]

    narrow_form = None  # where symbols were widened, the number of rules and the symbols before
    wide = terminals >= NARROW - 1
    shift, kind = (32, np.uint64) if wide else (16, np.uint32)
    pays = min_count or RULE_BYTES // (4 if wide else 2) + 1
    floor, exactly, rounds = len(s), False, 0
    while len(s) > 1:
        room = min(rules_a_round, (1 << shift) - 1 - terminals - len(left))
        if room <= 0:
            if wide:
                break
            wide, narrow_form = True, (len(left), s)
            shift, kind, pays = 32, np.uint64, min_count or RULE_BYTES // 4 + 1
            if _paying_share(s, pays) < WIDEN_SHARE:
                break
            floor, exactly = len(s), False
            continue
        codes = s[:-1].astype(kind) << kind(shift)
        codes |= s[1:].astype(kind, copy=False)
        rounds += 1
        # enough of them that the last numbers go in few rounds, though pairs exclude each other
        most = 2 * max(room, min(rules_a_round, CANDIDATES))
        if exactly:
            pairs, places, of_code, floor = _frequent_exactly(codes, pays, most)
        else:
            pairs, places, of_code, floor = _frequent(codes, 2 * shift, floor, pays, most, FACTORS[rounds % len(FACTORS)])
        taken = np.array(_compatible(pairs.tolist(), shift), dtype=bool)
        at, number = _occurrences(codes, places, of_code, pairs, taken, shift)
        enough = np.bincount(number, minlength=len(pairs)) >= pays
        # the limit holds for pairs that pay; of the last numbers some are kept for pairs of a later count
        enough &= np.cumsum(enough) <= (room if room == rules_a_round else min(room, max(room // 2, LAST_NUMBERS)))
        if not enough.any():
            if exactly:
                break  # no pair is left that pays
            exactly, floor = floor == pays, max(pays, floor // STEP)
            continue
        floor = max(pays, floor // STEP)
        hit = enough[number]
        at, number = at[hit], (np.cumsum(enough) - 1)[number[hit]]
        first = terminals + len(left)
        for code in pairs[enough].tolist():
            a, b = code >> shift, code & ((1 << shift) - 1)
            n = length(a) + length(b)
            left.append(a)
            right.append(b)
            lengths.append(n)
        s[at] = (first + number).astype(np.uint32)
        keep = np.ones(len(s), dtype=bool)
        keep[at + 1] = False
        s = s[keep]
    if narrow_form and 2 * len(narrow_form[1]) + RULE_BYTES * narrow_form[0] <= 4 * len(s) + RULE_BYTES * len(left):
        wide, rules, s = False, *narrow_form
        left, right, lengths = left[:rules], right[:rules], lengths[:rules]
    return b"".join(
        [
            _HEAD.pack(MAGIC, terminals, len(left), len(s), len(ids), 4 if wide else 2),
            np.array(left, "<u4").tobytes(),
            np.array(right, "<u4").tobytes(),
            np.array(lengths, "<u4").tobytes(),
            s.astype("<u4" if wide else "<u2").tobytes(),
        ]
    )


class Shard:
    """Reads a stored shard; ``ids(first, stop)`` decodes a range of its ids."""

    def __init__(self, stored: bytes):
        magic, self.terminals, rules, symbols, self.n_ids, width = _HEAD.unpack_from(stored)
        if magic != MAGIC:
            raise ValueError("not a grammar-compressed shard")
        at = _HEAD.size
        self.left, self.right, self.lengths = (np.frombuffer(stored, "<u4", rules, at + 4 * rules * i) for i in range(3))
        self.symbols = np.frombuffer(stored, f"<u{width}", symbols, at + 12 * rules)
        self.all_lengths = np.concatenate([np.ones(self.terminals, np.int64), self.lengths.astype(np.int64)])
        # every nonterminal's ids, one after the other; rules only name earlier symbols
        self.starts = np.concatenate([np.arange(self.terminals, dtype=np.int64), self.terminals + np.cumsum(self.lengths, dtype=np.int64) - self.lengths])
        self.flat = np.empty(self.terminals + int(self.lengths.sum(dtype=np.int64)), dtype=np.uint32)
        self.flat[: self.terminals] = np.arange(self.terminals)
        for i in range(rules):
            to = int(self.starts[self.terminals + i])
            for x in (int(self.left[i]), int(self.right[i])):
                n = int(self.all_lengths[x])
                self.flat[to : to + n] = self.flat[self.starts[x] : self.starts[x] + n]
                to += n
        self._ends: np.ndarray | None = None

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        lengths = self.all_lengths[symbols]
        ends = np.cumsum(lengths)
        # half as wide where places fit
        kind = np.int32 if max(len(self.flat), int(ends[-1])) < 1 << 31 else np.int64
        places = np.repeat((self.starts[symbols] - (ends - lengths)).astype(kind), lengths)
        places += np.arange(len(places), dtype=kind)
        return self.flat[places]

    def ids(self, first: int = 0, stop: int | None = None) -> np.ndarray:
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if first >= stop:
            return np.empty(0, dtype=np.uint32)
        if self._ends is None:
            self._ends = np.cumsum(self.all_lengths[self.symbols])
        a = int(np.searchsorted(self._ends, first, side="right"))
        b = int(np.searchsorted(self._ends, stop, side="left")) + 1
        before = int(self._ends[a - 1]) if a else 0
        return self._expand(self.symbols[a:b])[first - before : stop - before]
