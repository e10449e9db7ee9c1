"""Canonical length-limited Huffman coding of token ids, vectorised over many blocks.

A block codes up to ``BLOCK`` ids on their own: the number of ids, the bit offset of
every ``CHECKPOINT``-th id after the first, and the bits. Decoding looks the next
``MAX_BITS`` bits up in a table that gives the id and the length of its code; runs
between checkpoints decode side by side, each step one id of every run.
"""

from __future__ import annotations

import heapq

import numpy as np

MAX_BITS = 16
BLOCK = 1 << 16
CHECKPOINT = 256


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Code length of each id, 0 for ids that never occur.

    Plain Huffman lengths first. Lengths beyond the limit are cut to it, which
    overdraws Kraft's sum; it is repaid by lengthening the codes of the rarest ids that
    have room, and what is left over shortens the codes of the most frequent ones.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids do not fit into codes of {max_bits} bits")
    heap = [(int(counts[i]), n) for n, i in enumerate(used)]
    heapq.heapify(heap)
    parent = np.zeros(2 * len(used) - 1, np.int64)
    top = len(used)
    while len(heap) > 1:
        (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
        parent[i] = parent[j] = top
        heapq.heappush(heap, (a + b, top))
        top += 1
    depth = np.zeros(top, np.int64)
    for node in range(top - 2, -1, -1):
        depth[node] = depth[parent[node]] + 1
    own = np.minimum(depth[: len(used)], max_bits)
    order = np.argsort(counts[used], kind="stable")
    room = (1 << max_bits) - int((1 << (max_bits - own)).sum())
    while room < 0:
        for i in order:
            if own[i] < max_bits and room < 0:
                own[i] += 1
                room += 1 << int(max_bits - own[i])
    for i in order[::-1]:
        gain = 1 << int(max_bits - own[i])
        while own[i] > 1 and gain <= room:
            own[i] -= 1
            room -= gain
            gain *= 2
    lengths[used] = own
    return lengths


class Codec:
    """Canonical codes from their lengths: by length, then by id."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        spans = 1 << (MAX_BITS - self.lengths[order])
        starts = np.concatenate([[0], np.cumsum(spans)])[:-1]
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = (starts >> (MAX_BITS - self.lengths[order])).astype(np.uint64)
        self._symbol = np.zeros(1 << MAX_BITS, np.uint32)
        self._step = np.ones(1 << MAX_BITS, np.int64)
        filled = int(spans.sum())
        self._symbol[:filled] = np.repeat(order, spans)
        self._step[:filled] = np.repeat(self.lengths[order], spans)

    def encode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """A block for each run of ``sizes`` ids, none longer than ``BLOCK``."""
        first = np.concatenate([[0], np.cumsum(sizes)])
        length = self.lengths[ids]
        ends = np.cumsum(length)
        begins = ends - length
        bits = np.concatenate([[0], ends])[first]
        base = np.repeat(bits[:-1], sizes)
        words = (np.diff(bits) + 63) // 64
        word_first = np.concatenate([[0], np.cumsum(words)])
        at = begins - base + np.repeat(word_first[:-1] * 64, sizes)
        word, end = at >> 6, (at & 63) + length
        code = self.codes[ids]
        spill = np.maximum(end - 64, 0).astype(np.uint64)
        whole = np.where(end <= 64, code << np.maximum(64 - end, 0).astype(np.uint64), code >> spill)
        out = np.zeros(int(word_first[-1]) + 1, np.uint64)
        if len(ids):
            change = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
            out[word[change]] = np.add.reduceat(whole, change)
            over = np.flatnonzero(spill)
            out[word[over] + 1] += code[over] << (np.uint64(64) - spill[over])
        raw = out.astype(">u8").tobytes()
        offsets = (begins - base).astype("<u4")
        return [
            np.array([sizes[i]], "<u4").tobytes()
            + offsets[first[i] + CHECKPOINT : first[i + 1] : CHECKPOINT].tobytes()
            + raw[8 * word_first[i] : 8 * word_first[i] + (int(bits[i + 1] - bits[i]) + 7) // 8]
            for i in range(len(sizes))
        ]

    def decode(self, blocks: list[bytes]) -> list[np.ndarray]:
        """The ids of each block."""
        if not blocks:
            return []
        sizes = np.array([int.from_bytes(b[:4], "little") for b in blocks], np.int64)
        marks = np.maximum((sizes + CHECKPOINT - 1) // CHECKPOINT - 1, 0)
        bodies = [b[4 + 4 * int(m) :] for b, m in zip(blocks, marks, strict=True)]
        start = np.concatenate([[0], np.cumsum([len(b) for b in bodies])])
        data = np.frombuffer(b"".join(bodies) + bytes(4), np.uint8).astype(np.uint32)
        runs = np.where(sizes > 0, marks + 1, 0)
        begin, n_ids, into = [], [], []
        first = np.concatenate([[0], np.cumsum(sizes)])
        for i, b in enumerate(blocks):
            if not sizes[i]:
                continue
            offsets = np.frombuffer(b[4 : 4 + 4 * int(marks[i])], "<u4").astype(np.int64)
            begin.append(np.concatenate([[0], offsets]) + 8 * start[i])
            steps = np.full(runs[i], CHECKPOINT)
            steps[-1] = sizes[i] - CHECKPOINT * (runs[i] - 1)
            n_ids.append(steps)
            into.append(first[i] + CHECKPOINT * np.arange(runs[i]))
        out = np.zeros(int(first[-1]), np.uint32)
        if begin:
            at, left, to = np.concatenate(begin), np.concatenate(n_ids), np.concatenate(into)
            order = np.argsort(-left, kind="stable")
            at, left, to = at[order], left[order], to[order]
            for step in range(int(left[0])):
                if left[-1] <= step:
                    n = int(np.searchsorted(-left, -step, "left"))
                    at, left, to = at[:n], left[:n], to[:n]
                byte = at >> 3
                window = (data[byte] << 16) | (data[byte + 1] << 8) | data[byte + 2]
                peek = (window >> (8 - (at & 7)).astype(np.uint32)) & 0xFFFF
                out[to + step] = self._symbol[peek]
                at = at + self._step[peek]
        return [out[first[i] : first[i + 1]] for i in range(len(blocks))]
