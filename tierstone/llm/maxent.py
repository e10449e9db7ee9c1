"""The hashed maximum-entropy model: class-factored softmax over n-gram and skip features.

``P(word | history) = P(class | history) * P(word | class, history)``. Both are softmax
models whose inputs are hashed features of the history: the last word, the last two,
and the words two and three back. Words are put into classes by frequency: the most
frequent ones in classes of ``HEAD_WIDTH``, whose words depend on the history too; then
``MIDDLE`` classes of equal mass and a last class for all other and unknown words, in
which words have their smoothed share of the class. All weights at zero give the
smoothed unigram model, so training starts from there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .textbytes import mix

HEAD_CLASSES = 31
HEAD_WIDTH = 32
MIDDLE = 16
CLASSES = HEAD_CLASSES + MIDDLE + 1
FEATURES = 4
BUCKETS = 1 << 13
BATCH = 8192
#: Positions scored at a time; unlike ``BATCH`` it changes no result.
SCORED = 1024
RATE = 0.15

_SALTS = [np.uint64(s) for s in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89)]


@dataclass
class Vocabulary:
    """The most frequent words, by sorted fingerprint, and the sums that smoothing needs."""

    hashes: np.ndarray
    rank: np.ndarray
    counts: np.ndarray
    n: int
    v: int

    def __post_init__(self) -> None:
        by_rank = np.zeros(len(self.hashes))
        by_rank[self.rank] = self.counts
        smooth = by_rank + 0.5
        head = HEAD_CLASSES * HEAD_WIDTH
        classes = np.minimum(np.arange(len(smooth)) // HEAD_WIDTH, HEAD_CLASSES)
        middle = smooth[head:]
        if len(middle):
            share = (np.cumsum(middle) - middle) / middle.sum()
            classes[head:] = HEAD_CLASSES + np.minimum((share * MIDDLE).astype(int), MIDDLE - 1)
        self.class_of_rank = classes
        mass = np.bincount(classes, smooth, minlength=CLASSES)
        #: What the words outside of this vocabulary have together, with one unknown word.
        self.rest = self.n - by_rank.sum() + 0.5 * (self.v - len(smooth) + 1)
        mass[-1] = self.rest
        self.class_bias = np.log(np.maximum(mass, 1e-20)).astype(np.float32)
        self.word_bias = np.full((HEAD_CLASSES, HEAD_WIDTH), -60, np.float32)
        top = smooth[:head]
        self.word_bias.ravel()[: len(top)] = np.log(top)
        # Log share of a word in its class where the history has no say in it.
        self.share = np.log(smooth) - np.log(np.maximum(mass, 1e-20))[classes]
        self.log_smooth = np.log(smooth)
        # Where the fingerprints of each leading 16 bits begin.
        leads = (self.hashes >> np.uint64(48)).astype(np.int64)
        self._begin = np.searchsorted(leads, np.arange((1 << 16) + 1))
        self._longest = int(np.diff(self._begin).max())

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each word, -1 for those outside."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        lead = (hashes >> np.uint64(48)).astype(np.int64)
        low, size = self._begin[lead], self._longest
        # The last fingerprint of its lead that is not larger: halving, for all words at once.
        end = self._begin[lead + 1]
        while size > 1:
            half = size // 2
            ahead = low + half
            inside = ahead < end
            inside &= self.hashes[np.minimum(ahead, len(self.hashes) - 1)] <= hashes
            low = np.where(inside, ahead, low)
            size -= half
        low = np.minimum(low, len(self.hashes) - 1)
        return np.where(self.hashes[low] == hashes, self.rank[low], -1)


def features(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Fingerprints of the features of each position's history, within its row."""

    def back(k: int) -> np.ndarray:
        out = np.zeros(len(hashes), np.uint64)
        if len(hashes) > k:
            same = rows[k:] == rows[:-k]
            out[k:][same] = hashes[:-k][same]
        return out

    one, two, three = back(1), back(2), back(3)
    history = (one, one * np.uint64(3) + mix(two), two, three)
    return np.stack([mix(h ^ s) for h, s in zip(history, _SALTS, strict=True)])


@dataclass
class Weights:
    classes: np.ndarray
    words: np.ndarray

    @staticmethod
    def zeros() -> Weights:
        return Weights(
            np.zeros((FEATURES * BUCKETS, CLASSES), np.float32),
            np.zeros((FEATURES * BUCKETS, HEAD_WIDTH), np.float32),
        )


def _slots(found: np.ndarray) -> np.ndarray:
    block = np.arange(FEATURES, dtype=np.int64)[:, None] * BUCKETS
    return (found & np.uint64(BUCKETS - 1)).astype(np.int64) + block


def _added(start: np.ndarray, table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """``start`` plus the rows of a table in each of the slots of a position."""
    total, rows = np.take(table, slots[0], 0), np.empty((slots.shape[1], table.shape[1]), table.dtype)
    for own in slots[1:]:
        total += np.take(table, own, 0, out=rows, mode="clip")
    total += start
    return total


def _shifted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows less their maximum, in place, and the logarithms of the sums of their exponentials."""
    x -= x.max(1, keepdims=True)
    return x, np.log(np.exp(x).sum(1, keepdims=True))


class Step:
    """Log probabilities of a batch of words given their histories, and their gradient."""

    def __init__(self, vocabulary: Vocabulary, weights: Weights, rank: np.ndarray, found: np.ndarray):
        self.weights = weights
        self.target = np.where(rank >= 0, vocabulary.class_of_rank[np.maximum(rank, 0)] if len(vocabulary.hashes) else CLASSES - 1, CLASSES - 1)
        self.class_slots = _slots(found)
        self.classes, self.class_sums = _shifted(_added(vocabulary.class_bias, weights.classes, self.class_slots))
        self.head = np.flatnonzero(self.target < HEAD_CLASSES)
        group = self.target[self.head]
        self.word = rank[self.head] - group * HEAD_WIDTH
        self.word_slots = _slots(mix(found[:, self.head] ^ mix(group.astype(np.uint64) + np.uint64(1))))
        self.words, self.word_sums = _shifted(_added(vocabulary.word_bias[group], weights.words, self.word_slots))

    def log_probability(self, vocabulary: Vocabulary, rank: np.ndarray) -> np.ndarray:
        """Natural logarithm; of a word outside the vocabulary without its own share."""
        out = (self.classes[np.arange(len(rank)), self.target] - self.class_sums[:, 0]).astype(float)
        within = np.full(len(rank), -np.log(vocabulary.rest))
        known = rank >= 0
        if known.any():
            within[known] = vocabulary.share[rank[known]]
        within[self.head] = self.words[np.arange(len(self.head)), self.word] - self.word_sums[:, 0]
        return out + within

    def descend(self, squares: list[np.ndarray], touched: list[np.ndarray]) -> None:
        """One gradient step, scaled by the past gradients of each weight."""
        g = np.exp(self.classes - self.class_sums)
        g[np.arange(len(self.target)), self.target] -= 1
        _apply(self.weights.classes, squares[0], self.class_slots, g, touched[0])
        if len(self.head):
            g = np.exp(self.words - self.word_sums)
            g[np.arange(len(self.head)), self.word] -= 1
            _apply(self.weights.words, squares[1], self.word_slots, g, touched[1])


def _apply(table: np.ndarray, squares: np.ndarray, slots: np.ndarray, g: np.ndarray, touched: np.ndarray) -> None:
    """Add up the gradients of each slot and move its weights; only slots that were met.

    ``squares`` is kept in rows like those of ``table``, whatever its shape.
    """
    width = g.shape[1]
    column, g, past = np.arange(width), g.ravel().astype(np.float64), squares.reshape(table.shape)
    for number, own in enumerate(slots):
        own = own - number * BUCKETS
        n = np.bincount(own, minlength=BUCKETS)
        met = np.flatnonzero(n)
        place = np.zeros(BUCKETS, np.int64)
        place[met] = np.arange(0, len(met) * width, width)
        total = np.bincount((place[own][:, None] + column).ravel(), g, len(met) * width)
        total = total.astype(np.float32).reshape(-1, width)
        rows = met + number * BUCKETS
        square = total * total
        square += past[rows]
        past[rows] = square
        square += 1.0
        total *= RATE
        total /= np.sqrt(square, out=square)
        table[rows] -= total
        touched[rows] += n[met]
