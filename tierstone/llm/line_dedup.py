"""Fuzzy line dedup: SimHash of normalised lines, joined on blocks, edit similarity, connected groups.

A line is normalised to its words in lower case (A-Z) without ASCII punctuation, digits
all alike; a line of nothing else, such as a ruler, is taken as it is. Every line with a
character besides white space takes part, headings and text without spaces included;
blank lines always stay. Equal normalised lines are one from the start.

The fingerprint has ``BLOCKS`` blocks of 64 bits. The ``GRAM``-byte strings of a line are
dealt to the blocks by hash, and a bit of a block is 1 if it is set in over half the
hashes of the block's ``VOTES`` least strings. Were every string to vote on every bit, an
edit would change some bits of all blocks; dealt out, it leaves the blocks whole whose
voters it spares, the pigeonholes on which lines are joined. A block of fewer than three
voters is joined together with the next one, an empty block not at all. Lines that share
a block are a shard, shards of the same lines are one, and in a shard lines are linked
where the edit similarity is at least ``SIMILARITY``; a pair is compared only if no links
connect it yet, which loses no group. A shard is parted where the lengths of its lines
leave a gap that no similar pair spans, and a pair is left as soon as no path through the table
of its distances can end in time; both are exact. Similar lines without a common block are missed;
README has the measured share. Of each connected group the occurrence with the smallest
document id, then hash of the row, then line number stays.

Blocks travel in packs of numbers by slot and texts only to shards. A task holds one slot
(about ``SLOT_KEYS`` blocks, a crowded one leaves it in parts) or two parts of a shard,
``PART`` lines each; a shard of n lines is n / ``PART`` parts, which all meet, so its work
grows with its square as long as its lines are distinct.

What goes over single bytes or letters runs in the JVM, by ``LineBlocks.java`` and
``LineLinks.java``; the functions here that do the same in Python are what tests hold it to.

Cases: a null text is an empty one, with one empty line. A null id comes after all
others. Rows equal in id and text are one document here and keep the same lines. Very
long lines are compared like others, in time that grows with the product of their
lengths. An empty table gives an empty result. ``dedup_lines`` keeps all columns, whatever
their names; it replaces ``text``.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..jvm import map_partitions
from ..session import shared_scratch
from . import bloom
from . import textbytes as tb
from .components import components

GRAM = 5
BLOCKS = 16
VOTES = 5
SIMILARITY = 0.8
PART = 2048
SLOT_KEYS = 1 << 21
CLASSES = 5
#: Texts and characters whose pairs are compared together, and the letters of a piece of a text.
CHUNK_TEXTS, CHUNK_CHARS, PIECE, LETTERS = 32768, 1 << 24, 64, 32

#: Lower case, one digit for all, one white space; punctuation is dropped.
_NORMAL = tb.LOWER.copy()
_NORMAL[48:58] = 48
_NORMAL[[9, 11, 12, 13]] = 32
_TABLE = _NORMAL.tobytes()
_DROPPED = bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
_LOW = np.uint64((1 << 48) - 1)
_ONE, _TOP = np.uint64(1), np.uint64(PIECE - 1)
_JAVA = Path(__file__).parent


def normalise(line: str) -> str:
    """The normalised line: its words, joined by single spaces."""
    body = line.encode()
    return b" ".join(body.translate(_TABLE, _DROPPED).split() or body.split()).decode(errors="replace")


def _majority(votes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The bits set in over half of the first ``n`` of up to seven numbers a row, the rest zeros."""
    ones, twos, fours = (np.zeros(len(votes), np.uint64) for _ in range(3))
    for vote in votes.T:
        carry = ones & vote
        ones ^= vote
        fours ^= twos & carry
        twos ^= carry
    out = np.zeros(len(votes), np.uint64)
    reached = {1: ones | twos | fours, 2: twos | fours, 3: fours | twos & ones, 4: fours}
    for least, bits in reached.items():
        here = n // 2 + 1 == least
        out[here] = bits[here]
    out[n == 0] = 0
    return out


def _blocks(grams: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """The join keys of the blocks of each row, 0 for an empty block, from the hashes of the rows' strings."""
    cell = row.astype(np.uint64) * np.uint64(BLOCKS) + ((grams >> np.uint64(48)) * np.uint64(BLOCKS) >> np.uint64(16))
    # At most 2^16 cells: cell and hash sort as one number.
    drawn = np.sort(cell << np.uint64(48) | grams & _LOW)
    drawn = drawn[np.append(True, drawn[1:] != drawn[:-1])] if len(drawn) else drawn
    cell = (drawn >> np.uint64(48)).astype(np.int64)
    starts = np.flatnonzero(np.diff(cell, prepend=-1))
    rank = np.arange(len(cell)) - np.repeat(starts, np.diff(np.append(starts, len(cell))))
    voting = rank < VOTES
    votes = np.zeros((n_rows * BLOCKS, VOTES), np.uint64)
    votes[cell[voting], rank[voting]] = tb.mix(drawn[voting] & _LOW)
    n = np.bincount(cell[voting], minlength=n_rows * BLOCKS)
    bits = _majority(votes, n).reshape(-1, BLOCKS)
    n = n.reshape(-1, BLOCKS)
    own = tb.mix(bits + np.arange(1, BLOCKS + 1, dtype=np.uint64))
    both = tb.mix(own ^ np.roll(bits, -1, 1))
    keys = np.maximum(np.where(n < 3, both, own), np.uint64(1))
    keys[n == 0] = 0
    return keys


_CLASSES_OF_LOG = 4 / -float(np.log(SIMILARITY))


def length_class(length: np.ndarray) -> np.ndarray:
    """A class of a length in letters; those of lines that can be similar are at most ``CLASSES`` apart."""
    return np.minimum(np.log(np.maximum(length, 1)) * _CLASSES_OF_LOG, 255).astype(np.uint8)


def _fingerprints(hashes: tb.SpanHash, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The join keys of the lines that span these places of normalised bytes."""
    grams = hashes.windows(GRAM)
    out = np.zeros((len(low), BLOCKS), np.uint64)
    n = np.maximum(high - low - GRAM + 1, 0)
    total = np.cumsum(n)
    done = 0
    while done < len(low):
        until = int(np.searchsorted(total, (total[done - 1] if done else 0) + (1 << 18)))
        until = max(done + 1, min(done + 4096, until, len(low)))
        size, start = n[done:until], low[done:until]
        row = np.repeat(np.arange(until - done), size)
        found = grams[np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())]
        short = np.flatnonzero(size == 0)
        row = np.append(row, short)
        found = np.append(found, hashes.spans(start[short], high[done:until][short]))
        out[done:until] = _blocks(found, row, until - done)
        done = until
    return out


def _normal_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Row, number, first and last place of each line that takes part, and the normalised bytes."""
    # Rows end in a line break of their own, so lines never cross rows.
    data = np.insert(data, offsets[1:], 10)
    body = data.tobytes().translate(_TABLE, _DROPPED)
    normal = np.frombuffer(body, np.uint8)
    # Of white space in a run the last stays, and none at the ends of a line.
    blank = normal == 32
    edge = blank | (normal == 10)
    keep = ~blank
    keep[:-1] |= ~edge[1:]
    normal = normal[keep]
    keep = normal != 32
    keep[1:] |= normal[:-1] != 10
    normal = normal[keep]
    breaks, was = np.flatnonzero(normal == 10), np.flatnonzero(data == 10)
    low, high = np.insert(breaks[:-1] + 1, 0, 0)[: len(breaks)], breaks
    row = np.searchsorted(offsets[1:] + np.arange(len(offsets) - 1), was)
    number = np.arange(len(was)) - np.searchsorted(row, row)
    # Lines of punctuation only, such as rulers, are taken as they are.
    before = np.insert(was[:-1] + 1, 0, 0)[: len(was)]
    rulers, at = [], len(normal)
    for line in np.flatnonzero((low == high) & (before < was)):
        own = b" ".join(data[before[line] : was[line]].tobytes().split())
        if own:
            rulers.append(own)
            low[line], high[line] = at, at + len(own)
            at += len(own)
    used = np.flatnonzero(high > low)
    return row[used], number[used], low[used], high[used], normal.tobytes() + b"".join(rulers)


def _in_java(rows: DataFrame, wanted: str, schema: str, slots: int = 0, known: bloom.BloomFilter | None = None) -> DataFrame:
    """What ``LineBlocks.java`` gives for ``text`` and the columns behind it."""
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")).cast("binary"))
    bits = known.bits.tobytes() if known else b""
    return map_partitions(
        rows, _JAVA / "LineBlocks.java", "tierstone.LineBlocks", schema,
        wanted, slots, SLOT_KEYS, bits, bloom.CHUNK_BYTES, bloom.PROBES, _TABLE, _DROPPED, *tb.hash_numbers(),
        GRAM, BLOCKS, VOTES, _CLASSES_OF_LOG,
    )


def _lines(rows: DataFrame) -> DataFrame:
    """``doc_id, row, line, text_hash`` of every line that takes part."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    return _in_java(rows.select("text", "doc_id", "row"), "lines", f"doc_id {kind}, row bigint, line int, text_hash bigint")


def _dealt(rows: DataFrame, slots: int) -> DataFrame:
    """``slot, keys, hashes, classes``: the blocks of all lines, in packs of numbers by slot."""
    return _in_java(rows.select("text"), "packs", "slot bigint, keys binary, hashes binary, classes binary", slots)


class _Slot:
    """The blocks of one slot; gives ``lead, shard, text_hash`` of those that different texts share.

    Where no length class leads from one text of a block to another, its shard is parted.
    """

    def __init__(self):
        self._held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._crowded = np.zeros(0, np.uint32)

    def add(self, slot: int, keys: bytes, hashes: bytes, classes: bytes = b"") -> Iterator[pa.RecordBatch]:
        """``classes``: the length classes; all the same where none are given."""
        length = np.frombuffer(classes or bytes(len(keys) // 4), "u1")
        self._held.append((np.frombuffer(keys, "<u4"), np.frombuffer(hashes, "<i8"), length))
        if sum(len(h[0]) for h in self._held) > 2 * SLOT_KEYS:
            yield from self.settle(slot, False)

    def settle(self, slot: int, last: bool) -> Iterator[pa.RecordBatch]:
        """All shards at the end; before it those of two texts or more, whose block stays open."""
        if not self._held:
            return
        keys, text, length = (np.concatenate(c) for c in zip(*self._held, strict=True))
        order = np.lexsort((text, keys.astype(np.uint64) << np.uint64(8) | length))
        keys, text, length = keys[order], text[order], length[order]
        new = np.append(True, (keys[1:] != keys[:-1]) | (text[1:] != text[:-1]))
        keys, text, length = keys[new], text[new], length[new]
        # A block that stays open is whole, others are parted where lengths leave a gap.
        parted = np.diff(length.astype(np.int64)) > CLASSES
        parted &= last & ~np.isin(keys[1:], self._crowded)
        starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | parted))
        n = np.diff(np.append(starts, len(keys)))
        opened = np.isin(keys[starts], self._crowded)
        # Shards of the same texts get the same name.
        name = tb.mix(np.add.reduceat(tb.mix(text.view(np.uint64)), starts))
        own = tb.mix(keys[starts].astype(np.uint64) + tb.mix(np.full(1, slot, np.uint64)))
        shared = (n > 1) | opened
        lead = np.minimum.reduceat(text, starts).view(np.uint64)
        name, lead = (np.where(opened | (not last), own, x) for x in (name, lead))
        out = np.repeat(shared, n)
        self._held = []
        if not last:
            self._crowded = np.union1d(self._crowded, keys[starts[shared]])
            self._held.append((keys[~out], text[~out], length[~out]))
        if out.any():
            columns = [np.repeat(x, n)[out].view(np.int64) for x in (lead, name)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(text[out])], ["lead", "shard", "text_hash"])


def _shards(rows: DataFrame, slots: int) -> DataFrame:
    """``lead, text_hash, shards`` of the texts that share a block.

    ``lead`` is the smallest text of a shard, or stands for a crowded one: shards of one lead
    meet in a task, at most ``BLOCKS`` of them, and a pair that several hold is compared once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, _Slot()
        for batch in batches:
            for slot, *pack in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if slot != at:
                    if at is not None:
                        yield from held.settle(at, True)
                    at, held = slot, _Slot()
                yield from held.add(slot, *pack)
        if at is not None:
            yield from held.settle(at, True)

    dealt = _dealt(rows, slots).repartition("slot").sortWithinPartitions("slot")
    found = dealt.mapInArrow(run, "lead bigint, shard bigint, text_hash bigint")
    return found.groupBy("lead", "text_hash").agg(F.collect_set("shard").alias("shards"))


def _texts(rows: DataFrame, wanted: bloom.BloomFilter) -> DataFrame:
    """``text_hash, text`` of the normalised lines that the filter lets through, each once."""
    found = _in_java(rows.select("text"), "texts", "text_hash bigint, text string", known=wanted)
    return found.groupBy("text_hash").agg(F.any_value("text").alias("text"))


def _shared_start(a: str, b: str) -> int:
    low, size = 0, min(len(a), len(b))
    while size:
        if a[low : low + size] == b[low : low + size]:
            low += size
            size = min(size, len(a) - low, len(b) - low)
        else:
            size //= 2
    return low


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance: the columns of its table as bits of whole numbers."""
    low = _shared_start(a, b)
    a, b = a[low:], b[low:]
    high = _shared_start(a[::-1], b[::-1])
    a, b = a[: len(a) - high], b[: len(b) - high]
    if not a or not b:
        return len(a) + len(b)
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = full, 0, len(a)
    for c in b:
        same = places.get(c, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right_up = down | ~(diagonal | up) & full
        right_down = up & diagonal
        distance += bool(right_up & top) - bool(right_down & top)
        right_up = (right_up << 1 | 1) & full
        right_down = right_down << 1 & full
        up = right_down | ~(diagonal | right_up) & full
        down = right_up & diagonal
    return distance


def common_length(a: list[str] | str, b: list[str] | str) -> int:
    """Length of the longest common subsequence, by the bits of whole numbers."""
    places = dict.fromkeys([*a, *b], 0)
    for i, c in enumerate(a):
        places[c] |= 1 << i
    full = (1 << len(a)) - 1
    left = full
    for place in map(places.__getitem__, b):
        taken = left & place
        if taken:
            left = left + taken & full | left - taken
    return len(a) - left.bit_count()


def _edits_found(a: str, b: str, most: float) -> float:
    """An upper bound of the edit distance: after each difference, the next place where both go on alike."""
    i = j = edits = 0
    while True:
        same = _shared_start(a[i : i + 64], b[j : j + 64])
        i, j = i + same, j + same
        if same == 64:
            continue
        rest = max(len(a) - i, len(b) - j)
        if min(len(a) - i, len(b) - j) <= 12 or edits + rest <= most:
            return edits + rest
        for step in (1, 2, 4, 8, 16, 32):
            at = b.find(a[i + step : i + step + 12], j, j + step + 44)
            if at >= 0 and i + step + 12 <= len(a):
                break
        else:
            return edits + rest
        back = _shared_start(a[i : i + step][::-1], b[j:at][::-1])
        edits += max(step, at - j) - back
        if edits > most:
            return edits
        i, j = i + step, at


def similar(a: str, b: str, least: float = SIMILARITY) -> bool:
    """Whether the edit similarity reaches ``least``; bounds of the distance decide most pairs before it."""
    longest = max(len(a), len(b))
    most = (1 - least) * longest
    if abs(len(a) - len(b)) > most:
        return False
    if _edits_found(a, b, most) <= most:
        return True
    common = common_length(a, b)
    if longest - common > most:
        return False
    return len(a) + len(b) - 2 * common <= most or edit_distance(a, b) <= most


def _least_costs(codes: np.ndarray, at: np.ndarray, width: np.ndarray, window_at: np.ndarray, window: np.ndarray) -> np.ndarray:
    """The least edits that turn each span of at most ``PIECE`` letters into some part of its window.

    All spans move through their windows together, the columns of their tables as bits of
    64-bit numbers. A shorter span stands in the high bits; what is below matches all.
    """
    out = np.zeros(len(at), np.int64)
    order = np.argsort(-window, kind="stable")
    for low in range(0, len(order), 8192):
        rows = order[low : low + 8192]
        n_rows, size, place = len(rows), width[rows], window_at[rows]
        free = (np.uint64(1) << (PIECE - size).astype(np.uint64)) - np.uint64(1)
        places = np.repeat(free[:, None], LETTERS, 1)
        each = np.arange(n_rows)
        for bit in range(PIECE):
            column = np.maximum(bit - PIECE + size, 0)
            places[each, codes[at[rows] + column]] |= np.uint64(1 << bit)
        places, base = places.ravel(), each * LETTERS
        up, down = ~free, np.zeros(n_rows, np.uint64)
        cost = size.astype(np.int64)
        least = cost.copy()
        active = n_rows - np.searchsorted(window[rows][::-1], np.arange(window[rows[0]]), "right")
        for step, n in enumerate(active):
            same = places.take(base[:n] + codes.take(place[:n] + step, mode="clip"), mode="clip")
            u, d = up[:n], down[:n]
            vertical = same | d
            diagonal = same & u
            diagonal += u
            diagonal ^= u
            diagonal |= same
            right_down = u & diagonal
            diagonal |= u
            right_up = ~diagonal
            right_up |= d
            cost[:n] += (right_up >> _TOP).view(np.int64) - (right_down >> _TOP).view(np.int64)
            np.minimum(least[:n], cost[:n], out=least[:n])
            right_up <<= _ONE
            right_down <<= _ONE
            np.bitwise_and(right_up, vertical, out=d)
            vertical |= right_up
            np.bitwise_or(right_down, ~vertical, out=u)
        out[rows] = least
    return out


def _unlike(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which pairs of texts a lower bound of their edit distance shows to be below ``SIMILARITY``.

    An alignment of few edits never leaves a band of shifts, so each piece of the shorter text
    costs at least what it costs where it fits best within its band; the pieces add up.
    ``codes`` may give several letters one code, which only makes the bound smaller.
    """
    shorter = sizes[one] <= sizes[other]
    one, other = np.where(shorter, one, other), np.where(shorter, other, one)
    most = np.floor((1 - SIMILARITY) * sizes[other] + 1e-9).astype(np.int64)
    apart = sizes[other] - sizes[one]
    bound = np.where(apart > most, most + 1, 0)
    n = -(-sizes[one] // PIECE)
    low = np.zeros(len(n), np.int64)
    # Five eighths of the pieces decide most pairs.
    for share in (5, 8):
        high = -(-n * share // 8)
        now = np.flatnonzero((bound <= most) & (high > low))
        count = (high - low)[now]
        pair = np.repeat(now, count)
        first = PIECE * (np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count) + low[pair])
        width = np.minimum(PIECE, sizes[one][pair] - first)
        left = np.maximum(first - ((most - apart) // 2)[pair], 0)
        right = np.minimum(first + width + ((most + apart) // 2)[pair], sizes[other][pair])
        cost = _least_costs(codes, starts[one][pair] + first, width, starts[other][pair] + left, right - left)
        bound += np.bincount(pair, cost, len(bound)).astype(np.int64)
        low = high
    return bound > most


def _shard_links(texts: list[str], hashes: np.ndarray, shards: list[list[int]]) -> list[tuple[int, int]]:
    """Links that connect what is similar in each of some shards of these texts."""
    root = np.arange(len(texts))
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes) - sizes
    codes = (np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32) % np.uint32(LETTERS)).astype(np.uint8)
    members = np.array([i for shard in shards for i in shard])
    shard = np.repeat(np.arange(len(shards)), [len(s) for s in shards])
    order = np.lexsort((sizes[members], shard))
    members, shard = members[order], shard[order] << 40
    # In a shard by length, what is not too short to be similar is a run before each text.
    shortest = np.ceil(SIMILARITY * sizes[members] - 1e-6).astype(np.int64)
    before = np.arange(len(members)) - np.searchsorted(shard + sizes[members], shard + shortest)
    seen = np.zeros(0, np.int64)
    out = []
    back = 1
    while len(live := np.flatnonzero(before >= back)):
        # Neighbours first, then ever wider steps: links spare most pairs of a group.
        width = max(1, min(3 * back, (1 << 19) // len(live)))
        n = np.minimum(before[live] - back + 1, width)
        at = np.repeat(live, n)
        to = at - back - np.arange(len(at)) + np.repeat(np.cumsum(n) - n, n)
        back += width
        one, other = members[at], members[to]
        new = root[one] != root[other]
        pairs = np.unique(np.minimum(one, other)[new] * len(texts) + np.maximum(one, other)[new])
        pairs = np.setdiff1d(pairs, seen, assume_unique=True)
        if not len(pairs):
            continue
        seen = np.append(seen, pairs)
        pairs = pairs[~_unlike(codes, starts, sizes, pairs // len(texts), pairs % len(texts))]
        for i, j in zip((pairs // len(texts)).tolist(), (pairs % len(texts)).tolist(), strict=True):
            if root[i] != root[j] and similar(texts[i], texts[j]):
                root[root == root[i]] = root[j]
                out.append((int(hashes[i]), int(hashes[j])))
    return out


def _verified(shards: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``a, b`` between the hashes of similar texts in the same shard."""
    # Many texts of one lead: each pair of their parts has a task of its own.
    crowded = shards.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")).where("parts > 1")
    part = F.pmod(F.xxhash64("text_hash"), "parts").cast("int")
    pair = F.xxhash64("lead", F.least("part", "other"), F.greatest("part", "other"))
    others = F.when(F.col("parts") > 1, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.lit(0)))
    dealt = (
        shards.join(crowded, "lead", "left")
        .withColumn("part", part)
        .withColumn("other", F.explode(others))
        .select("text_hash", "shards", F.when(F.col("parts") > 1, pair).otherwise(F.col("lead")).alias("lead"))
        .join(texts, "text_hash")
        .select("lead", "text_hash", "shards", "text")
    )

    whole = dealt.repartition("lead").sortWithinPartitions("lead")
    return map_partitions(whole, _JAVA / "LineLinks.java", "tierstone.LineLinks", "a bigint, b bigint", 1 - SIMILARITY)


def removed_lines(docs: DataFrame) -> DataFrame:
    """``row, lines``: the numbers of the lines to remove from the rows with that hash."""
    spark = docs.sparkSession
    base = shared_scratch(spark, "line_dedup")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "row")
    _lines(rows).write.parquet(f"{base}/lines")
    lines = spark.read.parquet(f"{base}/lines")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = max(partitions, -(-lines.count() * BLOCKS // SLOT_KEYS))
    _shards(rows, slots).write.parquet(f"{base}/shards")
    shards = spark.read.parquet(f"{base}/shards")
    texts = _texts(rows, bloom.build(shards.select("text_hash").distinct()))
    _verified(shards, texts).write.parquet(f"{base}/links")
    roots = components(spark.read.parquet(f"{base}/links")).withColumnRenamed("id", "text_hash")

    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "line")
    distinct = lines.groupBy("text_hash").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    groups = distinct.join(roots, "text_hash", "left").where("n > 1 or root is not null")
    groups = groups.withColumn("root", F.coalesce("root", "text_hash"))
    groups.write.parquet(f"{base}/groups")
    groups = spark.read.parquet(f"{base}/groups")
    best = groups.groupBy("root").agg(F.min("first").alias("best"))
    kept = groups.join(best, "root").select(
        "text_hash", F.col("best.row").alias("kept_row"), F.col("best.line").alias("kept_line")
    )
    gone = (F.col("row") != F.col("kept_row")) | (F.col("line") != F.col("kept_line"))
    found = lines.select("row", "line", "text_hash").join(kept, "text_hash").where(gone)
    found.groupBy("row").agg(F.collect_set("line").alias("lines")).write.parquet(f"{base}/removed")
    return spark.read.parquet(f"{base}/removed")


def _with_removed(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows with their removed lines; only rows that may have some are shuffled."""
    rows = rows.withColumn("cut", bloom.build(gone.select("row")).column(F.col("row"), rows))
    whole = rows.where(~F.col("cut")).withColumn("lines", F.lit(None).cast("array<int>"))
    return rows.where("cut").join(gone, "row", "left").unionByName(whole).drop("cut")


def _kept_text(text, gone):
    parts, numbers = F.split(text, "\n", -1), F.map_from_arrays(gone, gone)
    kept = F.transform(F.array(F.struct(parts.alias("parts"), numbers.alias("gone"))), lambda x: F.filter(
        x["parts"], lambda _, i: F.try_element_at(x["gone"], i).isNull()))
    return F.array_join(kept[0], "\n")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents without the removed lines, with all their columns."""
    names = docs.columns
    rows = docs.select(F.struct("*").alias("doc"), F.xxhash64("doc_id", "text").alias("row"))
    found = _with_removed(rows, removed_lines(rows.select("doc.doc_id", "doc.text", "row")))
    text = F.when(F.col("lines").isNull(), F.col("doc.text")).otherwise(_kept_text(F.col("doc.text"), F.col("lines")))
    return found.select(*(text.alias(c) if c == "text" else F.col(f"doc.`{c}`") for c in names))


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, kept_sha256`` (of the text that stays) for every document."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", "text").alias("row"))
    found = _with_removed(rows, removed_lines(docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))))
    kept = F.when(F.col("lines").isNull(), F.col("text")).otherwise(_kept_text(F.col("text"), F.col("lines")))
    return found.select(
        "doc_id",
        F.size(F.split("text", "\n", -1)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )
