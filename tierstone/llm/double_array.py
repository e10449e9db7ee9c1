"""Double-array tries over sequences of numbers, built and walked with numpy.

A number is read as digits of ``DIGIT_BITS`` bits, so that a node's children lie within a
short stretch of the array. A state is a slot; the child by a digit lies at ``base`` of its
parent plus the digit, and is a child only if ``check`` there names the parent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

DIGIT_BITS = 10
_TRIES = 32


def digits(numbers: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` digits of each number, the largest first, as a further axis."""
    shifts = DIGIT_BITS * np.arange(n - 1, -1, -1)
    return numbers[..., None] >> shifts & (1 << DIGIT_BITS) - 1


def digits_for(largest: int) -> int:
    return max(1, -(-int(largest).bit_length() // DIGIT_BITS))


@dataclass
class Trie:
    """``value`` is the number of the sequence that ends in a slot, or -1."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    def step(self, states: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after a digit, and which there are."""
        to = self.base[states] + digit
        inside = np.flatnonzero((to >= 0) & (to < len(self.check)))
        alive = inside[self.check[to[inside]] == states[inside]]
        return to[alive], alive


def build(sequences: np.ndarray, n_digits: int) -> Trie:
    """The trie of distinct rows in lexical order; row ``i`` ends in a slot of value ``i``."""
    n, length = sequences.shape
    path = digits(sequences.astype(np.int64), n_digits).reshape(n, length * n_digits)
    size = 2 * n * path.shape[1] + (4 << DIGIT_BITS)
    base, check, used = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.zeros(size, bool)
    value = np.full(size, -1, np.int64)
    used[0] = True  # the root
    top, low = 1, 1
    slot = np.zeros(n, np.int64)  # of the prefix that each row has so far
    for depth in range(path.shape[1]):
        digit = path[:, depth]
        new = np.ones(n, bool)
        new[1:] = (slot[1:] != slot[:-1]) | (digit[1:] != digit[:-1])
        first = np.flatnonzero(new)
        parent, letter = slot[first], digit[first]
        starts = np.flatnonzero(np.diff(parent, prepend=-1))
        sizes = np.diff(np.append(starts, len(parent)))
        place = np.zeros(len(parent), np.int64)
        # Wide nodes first; what they leave free is filled by the nodes of one child.
        for i in np.argsort(-sizes, kind="stable"):
            m = sizes[i]
            if m == 1:
                break
            mine = slice(starts[i], starts[i] + m)
            letters = letter[mine]
            free = np.flatnonzero(~used[low : low + (8 << DIGIT_BITS)])[:_TRIES] + low
            offsets = free - letters[0]
            fits = ~used[np.minimum(offsets[:, None] + letters, size - 1)].any(1) & (offsets + letters[-1] < size)
            at = offsets[np.argmax(fits)] if fits.any() else max(top - letters[0], 1 - letters[0])
            if not fits.any():
                low = min(top, low + (1 << DIGIT_BITS))
            place[mine] = at + letters
            if at + letters[-1] >= size:
                grow = at + letters[-1] + 1 - size + n
                base, check, value = (np.concatenate([x, np.full(grow, f)]) for x, f in ((base, 0), (check, -1), (value, -1)))
                used, size = np.concatenate([used, np.zeros(grow, bool)]), size + grow
            used[place[mine]] = True
            base[parent[starts[i]]] = at
            top = max(top, at + letters[-1] + 1)
        single = starts[sizes == 1]
        if len(single):
            found = np.flatnonzero(~used[1:])[: len(single)] + 1
            if len(found) < len(single):
                grow = len(single) - len(found)
                found = np.append(found, size + np.arange(grow))
                base, check, value = (np.concatenate([x, np.full(grow, f)]) for x, f in ((base, 0), (check, -1), (value, -1)))
                used, size = np.concatenate([used, np.zeros(grow, bool)]), size + grow
            place[single] = found
            used[found] = True
            base[parent[single]] = found - letter[single]
            top = max(top, found[-1] + 1)
        check[place] = parent
        slot = place[np.cumsum(new) - 1]
    value[slot] = np.arange(n)
    return Trie(base[:top].astype(np.int32), check[:top].astype(np.int32), value[:top].astype(np.int32))


def joined(tries: list[Trie], first_values: list[int]) -> tuple[Trie, np.ndarray]:
    """Several tries in one, values counted on from the given numbers, and their roots."""
    roots = np.cumsum([0, *(len(t.base) for t in tries)])
    parts: list[list[np.ndarray]] = [[], [], []]
    for trie, root, first in zip(tries, roots, first_values, strict=False):
        parts[0].append(trie.base + root)
        parts[1].append(np.where(trie.check >= 0, trie.check + root, -1))
        parts[2].append(np.where(trie.value >= 0, trie.value.astype(np.int64) + first, -1))
    return Trie(*(np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts)), roots[:-1]


def walk(
    trie: Trie, roots: np.ndarray, words: np.ndarray, positions: np.ndarray, length: int, n_digits: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sequences of ``length`` words that begin at ``positions``: values, and where.

    All positions go through the trie together, a digit at a time; those without a state drop out.
    """
    states = roots
    for j in range(length):
        steps = digits(words[positions + j].astype(np.int64), n_digits)
        for d in range(n_digits):
            states, alive = trie.step(states, steps[:, d])
            positions, steps = positions[alive], steps[alive]
    yield trie.value[states], positions
