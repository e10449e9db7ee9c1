"""Alignment of two token streams over the same bytes, and the monoid of its fragments.

A *fragment* covers a byte range of a document: the tokens of both streams that end in it.
Where a token of each ends at the same byte, a group closes. So a fragment is an open
head (its tokens up to the first common end), counts and texts of the closed groups, and
an open tail (its tokens after the last common end); without a common end all is open.
``compose`` joins neighbours: the tail of one and the head of the next become a group.
It is associative, so ranges may be cut anywhere and composed in any order of pairs.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tokens:
    """Tokens of both streams: ids, and the bytes of the document they end before."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def __add__(self, other: Tokens) -> Tokens:
        if not len(other.a) and not len(other.b):
            return self
        mine, its = vars(self), vars(other)
        return Tokens(**{name: np.concatenate([mine[name], its[name]]) for name in mine})

    def __bool__(self) -> bool:
        return bool(len(self.a) or len(self.b))


def no_tokens() -> Tokens:
    return Tokens(*(np.zeros(0, np.int64) for _ in range(4)))


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for a pair of ids; those of one A id are neighbours."""
    return a.astype(np.int64) << 32 | b.astype(np.int64)


def count_pairs(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their times."""
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, times, minlength=len(found)).astype(np.int64)


@dataclass
class Aligned:
    """What closed groups give: link pairs in order, groups, and their text if wanted."""

    links: np.ndarray
    link_ends: np.ndarray
    common: np.ndarray
    text: bytes
    text_ends: np.ndarray  # of each group


_decimals: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.uint8), np.zeros(1, np.int64))


def _decimal_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal texts of all numbers below a power of two: bytes and offsets."""
    global _decimals
    if len(_decimals[1]) <= size:
        texts = [str(i).encode() for i in range(1 << (size - 1).bit_length())]
        ends = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=ends[1:])
        _decimals = np.frombuffer(b"".join(texts), np.uint8), ends
    return _decimals


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of all spans, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def align(t: Tokens) -> Aligned:
    """Groups and links of streams that begin at one byte and end at another.

    Ends of either stream cut the bytes into segments, and a segment lies in one token of
    each: every overlapping pair is one segment. Many documents may stand one after the
    other, each with its last end common.
    """
    n_a, n_b = len(t.a), len(t.b)
    both = np.concatenate([t.a_ends, t.b_ends])
    order = np.argsort(both, kind="stable")  # two sorted runs, which it merges
    new = np.diff(both[order], prepend=-1) != 0
    segment = np.empty(n_a + n_b, np.int64)
    segment[order] = np.cumsum(new) - 1
    ends = both[order][new]
    a_here, b_here = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
    a_here[segment[:n_a]] = 1
    b_here[segment[n_a:]] = 1
    links = pair_keys(t.a[np.cumsum(a_here) - a_here], t.b[np.cumsum(b_here) - b_here])
    shared = a_here & b_here
    common, group = ends[shared > 0], np.cumsum(shared) - shared
    a_group, b_group = group[segment[:n_a]], group[segment[n_a:]]
    # Each token with the letter after it: groups as a1,a2|b1; in the order of the bytes.
    order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
    ids = np.concatenate([t.a, t.b])[order]
    data, offsets = _decimal_table(int(ids.max()) + 1 if len(ids) else 1)
    sizes = offsets[ids + 1] - offsets[ids] + 1
    text = data[np.minimum(spans(offsets[ids], sizes), len(data) - 1)]
    closing = np.cumsum(sizes) - 1
    after = np.full(n_a + n_b, ord(","), np.uint8)
    last_a = np.ones(n_a, bool)
    last_a[:-1] = a_group[1:] != a_group[:-1]
    last_b = np.ones(n_b, bool)
    last_b[:-1] = b_group[1:] != b_group[:-1]
    marks = np.concatenate([np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))])
    after = marks[order].astype(np.uint8)
    text[closing] = after
    return Aligned(links, ends, common, text.tobytes(), closing[after == ord(";")] + 1)


@dataclass
class Fragment:
    """One range; ``closed`` tells whether it holds a common end, else all is in ``head``."""

    closed: bool = True
    head: Tokens = field(default_factory=no_tokens)
    tail: Tokens = field(default_factory=no_tokens)
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    valid: bool = True

    def pack(self) -> bytes:
        """As bytes; tokens that are open, and pairs with their links."""
        arrays = [*vars(self.head).values(), *vars(self.tail).values(), self.keys, self.times]
        sizes = [len(x) for x in arrays]
        numbers = (self.closed, self.valid, self.n_a, self.n_b, self.n_groups, *sizes)
        return struct.pack("<15q", *numbers) + b"".join(x.astype("<i8").tobytes() for x in arrays)

    @staticmethod
    def unpack(body: bytes) -> Fragment:
        closed, valid, n_a, n_b, n_groups, *sizes = struct.unpack_from("<15q", body)
        parts = np.split(np.frombuffer(body, "<i8", offset=120), np.cumsum(sizes)[:-1])
        return Fragment(
            bool(closed), Tokens(*parts[:4]), Tokens(*parts[4:8]), n_a, n_b, n_groups, parts[8], parts[9], bool(valid)
        )


def fragment(t: Tokens) -> tuple[Fragment, bytes]:
    """The fragment of a range from the tokens that end in it, and the text of its closed groups."""
    common = np.intersect1d(t.a_ends, t.b_ends, assume_unique=True)
    if not len(common):
        return Fragment(False, t), b""
    first, last = common[0], common[-1]

    def between(low: int | None, high: int | None) -> Tokens:
        def cut(ends: np.ndarray) -> slice:
            a = 0 if low is None else np.searchsorted(ends, low, "right")
            return slice(a, len(ends) if high is None else np.searchsorted(ends, high, "right"))

        a, b = cut(t.a_ends), cut(t.b_ends)
        return Tokens(t.a[a], t.a_ends[a], t.b[b], t.b_ends[b])

    inner = between(first, last)
    found = Fragment(True, between(None, first), between(last, None))
    text = b""
    if inner:
        aligned = align(inner)
        found.n_a, found.n_b, found.n_groups = len(inner.a), len(inner.b), len(aligned.common)
        found.keys, found.times = count_pairs(aligned.links, np.ones(len(aligned.links)))
        text = aligned.text
    return found, text


def compose(one: Fragment, two: Fragment) -> tuple[Fragment, bytes]:
    """Two neighbours as one, and the text of the group that closes between them."""
    valid = one.valid and two.valid
    if not one.closed:
        head = one.head + two.head
        return Fragment(two.closed, head, two.tail, two.n_a, two.n_b, two.n_groups, two.keys, two.times, valid), b""
    if not two.closed:
        tail = one.tail + two.head
        return Fragment(True, one.head, tail, one.n_a, one.n_b, one.n_groups, one.keys, one.times, valid), b""
    middle = one.tail + two.head
    links, text = np.zeros(0, np.int64), b""
    if middle and valid:
        aligned = align(middle)
        links, text = aligned.links, aligned.text
    keys, times = count_pairs(
        np.concatenate([one.keys, links, two.keys]), np.concatenate([one.times, np.ones(len(links)), two.times])
    )
    return Fragment(
        True, one.head, two.tail, one.n_a + len(middle.a) + two.n_a, one.n_b + len(middle.b) + two.n_b,
        one.n_groups + bool(middle) + two.n_groups, keys, times, valid,
    ), text
