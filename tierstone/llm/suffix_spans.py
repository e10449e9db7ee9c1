"""Byte-level steps of the suffix-array dedup, vectorised over the texts of a piece.

Texts lie one after the other in ``data``; ``offsets`` parts them. Two equal strings of
``match`` bytes hold the same *anchor*: the start, leftmost on ties, of the smallest
fingerprint among its substrings of a token's size (``token_bytes``). So a string can
occur again only if its anchor's fingerprint does.
"""

from __future__ import annotations

import numpy as np

from .textbytes import SpanHash, mix



def token_bytes(match: int) -> int:
    """Size of a token: two of them, overlapping, cover a match. Longer tokens make more
    anchors and fewer strings that share an anchor by chance."""
    return max(1, match * 5 // 8)


_SEGMENT = np.uint64(0x5851F42D4C957F2D)


def _sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, from prefix and suffix minima of blocks."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


class Spans:
    """Anchors, segments and windows of the texts of a piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, match: int):
        self.data, self.offsets, self.match = data, offsets, match
        self.token = token_bytes(match)
        self.hashes = SpanHash(data)
        self.grams = self.hashes.windows(self.token)
        # Starts of strings of ``match`` bytes that end within their text.
        sizes = np.maximum(np.diff(offsets) - match + 1, 0)
        first = np.concatenate([[0], np.cumsum(sizes)])
        self.row_of_start = np.repeat(np.arange(len(sizes)), sizes)
        self.starts = np.arange(first[-1]) + np.repeat(offsets[:-1] - first[:-1], sizes)
        bits = np.uint64(max(20, int(len(data)).bit_length()))
        low = (np.uint64(1) << bits) - np.uint64(1)
        ranked = (self.grams & ~low) | np.arange(len(self.grams), dtype=np.uint64)
        least = _sliding_minimum(ranked, match - self.token + 1)
        #: The anchor of each start, ascending.
        self.anchor = (least[self.starts] & low).astype(np.int64)
        new = np.ones(len(self.starts), bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.row_of_start[1:] != self.row_of_start[:-1])
        first_of = np.flatnonzero(new)
        self.anchor_rows = self.row_of_start[first_of]
        self.anchors = self.anchor[first_of]
        self.anchor_hashes = self.grams[self.anchors]
        #: First and last start of each anchor; the starts of one anchor are neighbours.
        self.anchor_first = self.starts[first_of]
        self.anchor_last = self.starts[np.append(first_of[1:], len(self.starts)) - 1] if len(first_of) else first_of
        self._segments()

    def _segments(self) -> None:
        """Spans of ``match`` bytes or a little more between anchors, or the ends of a text."""
        long = np.flatnonzero(np.diff(self.offsets) >= self.match)
        ends = [self.offsets[long], self.offsets[long + 1] - self.token]
        points = np.concatenate([self.anchors, *ends])
        rows = np.concatenate([self.anchor_rows, long, long])
        points, at = np.unique(points, return_index=True)
        rows = rows[at]
        until = np.searchsorted(points, points + self.match - self.token)
        inside = until < len(points)
        inside[inside] &= rows[until[inside]] == rows[inside]
        # The last segment of a text ends with it, wherever the one before did.
        last = ends[1]
        back = np.searchsorted(points, last - (self.match - self.token), "right") - 1
        new = until[back] != np.searchsorted(points, last)
        last, back, long = last[new], back[new], long[new]
        self.segment_rows = np.concatenate([rows[inside], long])
        self.segment_starts = np.concatenate([points[inside], points[back]])
        self.segment_ends = np.concatenate([points[until[inside]], last]) + self.token
        self.segment_hashes = mix(self.hashes.spans(self.segment_starts, self.segment_ends) ^ _SEGMENT)

    def marks(self) -> tuple[np.ndarray, ...]:
        """Row, fingerprint, kind and three places, counted from the start of the row: of each
        anchor (kind 0) its first and last start and itself, of each segment (kind 1) its
        start, its end and 0."""
        rows = np.concatenate([self.anchor_rows, self.segment_rows])
        base = self.offsets[rows]
        low = np.concatenate([self.anchor_first, self.segment_starts]) - base
        high = np.concatenate([self.anchor_last, self.segment_ends]) - base
        at = np.concatenate([self.anchors - self.offsets[self.anchor_rows], np.zeros(len(self.segment_rows), np.int64)])
        kind = np.repeat([0, 1], [len(self.anchor_rows), len(self.segment_rows)])
        return rows, np.concatenate([self.anchor_hashes, self.segment_hashes]), kind, low, high, at

    def tokens(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two leading tokens of the suffixes at ``starts``: their first and last of ``match`` bytes."""
        return self.grams[starts], self.grams[starts + self.match - self.token]


def union_spans(opens: np.ndarray, closes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The union of spans of a text of ``size`` bytes: its starts, its ends, and how many
    bytes before each place are outside of it."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, opens, 1)
    np.add.at(step, closes, -1)
    inside = np.cumsum(step[:-1]) > 0
    edges = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    outside = np.concatenate([[0], np.cumsum(~inside)])
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), outside
