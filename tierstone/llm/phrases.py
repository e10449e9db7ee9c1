"""Phrase collocations of each language, counted by broadcast double-array tries.

Level by level, from words to phrases of five: a phrase can be frequent only if what it is
without its last word is, and without its first. So candidates of a level are frequent
phrases seen in the texts with a frequent word after them (and, where all tries of the
level are at hand, with a frequent phrase one word on); tasks add up how often they saw
each, and what was seen too seldom goes. Candidates are dealt to shards by their first
words; a task builds the trie of each shard (``double_array``). Tries are broadcast, as
many at once as fit in ``BROADCAST_BYTES``, and each broadcast is one pass over the texts:
tasks walk all positions through them together, count the accepting states, and the sums
of all tasks are the frequencies.

The texts are read twice, for the words and to replace them by numbers; runs of frequent
words are then kept as numbers in a table, which is all that later passes read. Their
number for a word is found by two 64-bit hashes of it and its language, sorted in one
array: 16 bytes a frequent word, of which there are at most a hundredth of all words at the
default threshold, and far fewer in prose. That array and the tries are what is broadcast.

Every product is exact (decimals of 38 digits). A candidate lies within a longer one as
often as it occurs only if it lies so within one that is longer by a word, as each phrase
is at least as frequent as those that hold it; so only neighbours in length are compared.

Cases: a null text is empty, a null language is ``und``. Repeated rows count as often as
they are there; ties in rank go by the phrase, in the order of its UTF-8 bytes. Words may
hold any character that is no separator. An empty table, or one without a frequent phrase,
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_scratch
from . import textbytes as tb
from .double_array import Trie, build, digits_for, joined, walk

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
SHARD = 1 << 17
BROADCAST_BYTES = 64 << 20
PIECE = 1 << 20
GATHERED = 1 << 20
SLOT_KEYS = 1 << 20

# What parts words, and what ends a piece of text.
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09]] = True
_END = np.zeros(256, bool)
_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True

RESULT = "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"


class _Words:
    """The words of a piece of text, as spans, with two hashes that also tell languages apart."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, languages: np.ndarray, salt: int):
        self.data = data = tb.LOWER[data]
        ends = _END[data]
        inside = ~(ends | _GAP[data])
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        opens[edges] |= inside[edges]
        closes[edges - 1] |= inside[edges - 1]
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.rows = np.searchsorted(offsets, self.starts, "right") - 1
        self.hashes = [
            tb.mix(tb.SpanHash(data, salt + k).spans(self.starts, self.ends) + languages[k][self.rows]) for k in (0, 1)
        ]
        sums = np.cumsum(ends)
        #: Whether a word and the next are parted by the end of a piece or of the text.
        self.parted = np.ones(len(self.starts), bool)
        if len(self.starts) > 1:
            self.parted[:-1] = (sums[self.starts[1:]] != sums[self.ends[:-1] - 1]) | (self.rows[1:] != self.rows[:-1])


def _language_hashes(languages: list[str]) -> np.ndarray:
    codes = [np.frombuffer(name.encode(), np.uint8) for name in languages]
    out = np.zeros((2, len(codes)), np.uint64)
    for i, code in enumerate(codes):
        for k in (0, 1):
            out[k, i] = tb.SpanHash(code, 8 + k).spans(np.array([0]), np.array([len(code)]))[0]
    return out


def _pieces(batch: pa.RecordBatch, salt: int) -> Iterator[tuple[_Words, np.ndarray, list[str]]]:
    """The words of a batch by pieces, with the language of each row."""
    coded = batch.column("lang").dictionary_encode()
    names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    hashes = _language_hashes(names)
    data, offsets = tb.text_arrays(batch.column("text"))
    for low, high, part, ends in tb.pieces(data, offsets, PIECE):
        yield _Words(part, ends, hashes[:, code[low:high]], salt), code[low:high], names


def word_counts(docs: DataFrame, salt: int = 0) -> DataFrame:
    """``lang, word, f, one, two``; a row without a word has the words of its language in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, code, names in _pieces(batch, salt):
                _, first, which = np.unique(words.hashes[0], return_index=True, return_inverse=True)
                if not np.array_equal(words.hashes[1], words.hashes[1][first][which]):
                    both = np.stack(words.hashes, 1)
                    _, first, which = np.unique(both, axis=0, return_index=True, return_inverse=True)
                sizes = words.ends[first] - words.starts[first]
                ends = np.concatenate([[0], np.cumsum(sizes)])
                at = np.arange(ends[-1]) + np.repeat(words.starts[first] - ends[:-1], sizes)
                text = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(first), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(words.data[at].tobytes())]
                )
                totals = np.bincount(code[words.rows], minlength=len(names))
                used = np.flatnonzero(totals)
                lang = [*code[words.rows[first]].tolist(), *used.tolist()]
                none = [0] * len(used)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[c] for c in lang], pa.string()),
                        pa.concat_arrays([text.cast(pa.binary()), pa.nulls(len(used), pa.binary())]),
                        pa.array(np.concatenate([np.bincount(which, minlength=len(first)), totals[used]]).astype(np.int64)),
                        *(pa.array(np.concatenate([h[first].view(np.int64), none]).astype(np.int64)) for h in words.hashes),
                    ],
                    ["lang", "word", "f", "one", "two"],
                )

    found = docs.mapInArrow(count, "lang string, word binary, f bigint, one bigint, two bigint")
    return found.groupBy("lang", "word").agg(F.sum("f").alias("f"), F.max("one").alias("one"), F.max("two").alias("two"))


def _encoded(docs: DataFrame, shared, salt: int) -> DataFrame:
    """Runs of two or more frequent words as numbers, a zero after each run."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = shared.value
        for batch in batches:
            for words, _, _ in _pieces(batch, salt):
                at = np.minimum(np.searchsorted(one, words.hashes[0]), len(one) - 1)
                known = (one[at] == words.hashes[0]) & (two[at] == words.hashes[1])
                linked = known & ~words.parted
                linked[:-1] &= known[1:]
                linked[-1:] = False
                kept = linked.copy()
                kept[1:] |= linked[:-1]
                if not kept.any():
                    continue
                closes = ~linked[kept]
                out = np.zeros(len(closes) + closes.sum(), np.int32)
                out[np.arange(len(closes)) + np.cumsum(closes) - closes] = at[kept] + 1
                yield pa.RecordBatch.from_pydict({"numbers": [out.tobytes()]}, _NUMBERS)

    return docs.mapInArrow(encode, "numbers binary")


_NUMBERS = pa.schema([("numbers", pa.binary())])
_SEEN = pa.schema([("kind", pa.int32()), ("slot", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())])
_SEEN_COLUMNS = "kind int, slot bigint, keys binary, n binary"
COUNTED, FOLLOWED = 0, 1


def _blocks(kind: int, keys: np.ndarray, n: np.ndarray, slots: int) -> Iterator[pa.RecordBatch]:
    """Keys with their counts, dealt to slots by hash: one row for each slot that gets any."""
    slot = (tb.mix(keys.view(np.uint64)) % np.uint64(slots)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    slot, keys, n = slot[order], keys[order], n[order]
    starts = np.flatnonzero(np.diff(slot, prepend=-1))
    ends = np.append(starts[1:], len(slot))
    if len(starts):
        bodies = ([x[i:j].astype(np.int64).tobytes() for i, j in zip(starts, ends, strict=True)] for x in (keys, n))
        columns = [pa.array(np.full(len(starts), kind, np.int32)), pa.array(slot[starts]), *map(pa.array, bodies)]
        yield pa.RecordBatch.from_arrays(columns, schema=_SEEN)


class _Seen:
    """Keys seen by a task, added up whenever many have gathered."""

    def __init__(self, slots: int):
        self._slots = slots
        self._parts: list[np.ndarray] = []
        self._held = 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self._parts.append(keys)
        self._held += len(keys)
        if self._held > GATHERED:
            yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        keys, n = np.unique(np.concatenate([np.zeros(0, np.int64), *self._parts]), return_counts=True)
        self._parts, self._held = [], 0
        yield from _blocks(FOLLOWED, keys, n, self._slots)


def _follows(ids: np.ndarray, words: np.ndarray, positions: np.ndarray, length: int, strict: bool) -> np.ndarray:
    """Keys of phrases that could go on: the phrase's number and the word that follows it."""
    following = words[positions + length]
    go_on = following > 0
    if strict:  # the phrase one word on is frequent too
        there = np.zeros(len(words) + 1, bool)
        there[positions] = True
        go_on &= there[positions + 1]
    return ids[go_on].astype(np.int64) << 32 | following[go_on].astype(np.int64)


def _pairs_seen(encoded: DataFrame, slots: int) -> DataFrame:
    def see(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen(slots)
        for batch in batches:
            for body in batch.column("numbers").to_pylist():
                words = np.frombuffer(body, np.int32)
                at = np.flatnonzero(words[:-1] > 0)
                yield from seen.add(_follows(words[at], words, at, 1, False))
        yield from seen.rows()

    return encoded.mapInArrow(see, _SEEN_COLUMNS)


def shard_of(first, second, shards: int):
    """By the first two words, the same for columns and arrays."""
    return (first * 1_000_003 + second * 7919) % shards


def _tries(candidates: DataFrame, length: int, n_digits: int) -> DataFrame:
    """The trie of each shard; a phrase's value is its ``place`` in the shard."""

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        trie = build(np.stack(rows["words"].to_list()).reshape(-1, length), n_digits)
        body = {k: [v.tobytes()] for k, v in vars(trie).items()}
        return pd.DataFrame({"shard": rows["shard"].iloc[:1].to_numpy(), "n": [len(rows)], **body})

    schema = "shard bigint, n bigint, base binary, check binary, value binary"
    return candidates.select("shard", "place", "words").groupBy("shard").applyInPandas(one, schema)


def _count_pass(
    encoded: DataFrame, tries: list, length: int, shards: int, firsts: dict[int, int], n_digits: int, last: bool, slots: int
) -> DataFrame:
    """Frequencies of the phrases of some shards, and what could follow them."""
    whole = len(tries) == len(firsts)
    arrays = [Trie(*(np.frombuffer(r[k], np.int32) for k in ("base", "check", "value"))) for r in tries]
    root = np.full(shards, -1, np.int64)
    trie, roots = joined(arrays, [firsts[r["shard"]] for r in tries])
    root[[r["shard"] for r in tries]] = roots
    low = min((firsts[r["shard"]] for r in tries), default=0)
    high = max((firsts[r["shard"]] + r["n"] for r in tries), default=0)
    shared = encoded.sparkSession.sparkContext.broadcast((trie, root))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, root = shared.value
        total, seen = np.zeros(high - low, np.int64), _Seen(slots)
        for batch in batches:
            for body in batch.column("numbers").to_pylist():
                words = np.frombuffer(body, np.int32)
                inside = words > 0
                here = inside.copy()
                for j in range(1, length):
                    here[:-j] &= inside[j:]
                    here[-j:] = False
                at = np.flatnonzero(here)
                states = root[shard_of(words[at].astype(np.int64), words[at + 1].astype(np.int64), shards)]
                at, states = at[states >= 0], states[states >= 0]
                for ids, positions in walk(trie, states, words, at, length, n_digits):
                    total += np.bincount(ids - low, minlength=high - low)
                    if not last:
                        yield from seen.add(_follows(ids, words, positions, length, whole))
        yield from seen.rows()
        found = np.flatnonzero(total)
        yield from _blocks(COUNTED, found + low, total[found], slots)

    return encoded.mapInArrow(count, _SEEN_COLUMNS)


def _summed(seen: DataFrame, path: str, min_count: int) -> tuple[DataFrame, DataFrame]:
    """Frequencies by number, and what was seen often enough to be a candidate."""

    def add(blocks: pd.DataFrame) -> pd.DataFrame:
        keys, n = (np.frombuffer(b"".join(blocks[c]), np.int64) for c in ("keys", "n"))
        keys, at = np.unique(keys, return_inverse=True)
        sums = np.bincount(at, n, minlength=len(keys)).astype(np.int64)
        often = sums >= min_count
        return pd.DataFrame({"kind": blocks["kind"].iloc[0], "key": keys[often], "n": sums[often]})

    seen.groupBy("kind", "slot").applyInPandas(add, "kind int, key bigint, n bigint").write.parquet(path)
    found = seen.sparkSession.read.parquet(path)
    frequencies, followed = found.where(F.col("kind") == COUNTED), found.where(F.col("kind") == FOLLOWED)
    return frequencies.select("key", "n"), followed.select("key")


def frequent_phrases(
    docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
    *, shard_size: int = SHARD, broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, list[DataFrame]]:
    """``lang, n`` and, for each length, ``lang, words, phrase, f`` of all frequent phrases.

    ``words`` are numbers that stand for a word in a language.
    """
    spark, scratch = docs.sparkSession, shared_scratch(docs.sparkSession, "phrases")
    docs = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    for salt in range(0, 8, 2):  # another hash in the case, never met, that two frequent words have one
        path = f"{scratch}/words{salt}"
        word_counts(docs, salt).where((F.col("f") >= min_count) | F.col("word").isNull()).write.parquet(path)
        counted = spark.read.parquet(path)
        table = counted.where(F.col("word").isNotNull())
        hashes = table.select("one", "two").toPandas().to_numpy(np.int64).view(np.uint64)
        hashes = hashes[np.argsort(hashes[:, 0], kind="stable")]
        if len(hashes) < 2 or (hashes[1:, 0] != hashes[:-1, 0]).all():
            break
    totals = counted.where(F.col("word").isNull()).select("lang", F.col("f").alias("n"))
    n_digits = digits_for(len(hashes) + 1)
    shared = spark.sparkContext.broadcast((np.ascontiguousarray(hashes[:, 0]), np.ascontiguousarray(hashes[:, 1])))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one = batch.column("one").to_numpy(zero_copy_only=False).view(np.uint64)
            ids = np.searchsorted(shared.value[0], one) + 1
            columns = [batch.column("lang"), batch.column("phrase"), batch.column("f"), pa.array(ids.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "f", "id"])

    words = table.select("lang", F.col("word").cast("string").alias("phrase"), "f", "one")
    words.mapInArrow(number, "lang string, phrase string, f bigint, id bigint").withColumn(
        "words", F.array(F.col("id").cast("int"))
    ).write.parquet(f"{scratch}/phrases1")
    levels = [spark.read.parquet(f"{scratch}/phrases1")]
    if not len(hashes):
        return totals, levels
    _encoded(docs, shared, salt).write.option("compression", "zstd").parquet(f"{scratch}/numbers")
    encoded = spark.read.schema("numbers binary").parquet(f"{scratch}/numbers")
    # So many slots that the keys of one, at most all positions over the slots, suit a task.
    positions = encoded.agg(F.sum(F.octet_length("numbers"))).first()[0] or 0
    slots = 1 + positions // (4 * SLOT_KEYS)
    _, candidates = _summed(_pairs_seen(encoded, slots), f"{scratch}/seen1", min_count)
    follow = levels[0].select(F.col("id").alias("next"), F.col("phrase").alias("word"))
    for length in range(2, max_words + 1):
        n = candidates.count()
        if not n:
            break
        shards = -(-n // shard_size)
        before = levels[-1].select("id", "lang", F.col("words").alias("first"), F.col("phrase").alias("start"))
        chosen = (
            candidates.select(F.shiftright("key", 32).alias("id"), F.col("key").bitwiseAND(0xFFFFFFFF).alias("next"))
            .join(before, "id")
            .join(follow, "next")
            .select(
                "lang",
                F.concat("first", F.array(F.col("next").cast("int"))).alias("words"),
                F.concat_ws(" ", "start", "word").alias("phrase"),
            )
        )
        shard = shard_of(F.col("words")[0].cast("bigint"), F.col("words")[1].cast("bigint"), shards)
        place = F.row_number().over(Window.partitionBy("shard").orderBy("words")) - 1
        chosen = chosen.withColumn("shard", shard.cast("bigint")).withColumn("place", place)
        chosen.write.parquet(f"{scratch}/candidates{length}")
        chosen = spark.read.parquet(f"{scratch}/candidates{length}")
        _tries(chosen, length, n_digits).write.parquet(f"{scratch}/tries{length}")
        tries = spark.read.parquet(f"{scratch}/tries{length}")
        sizes = tries.select("shard", "n", F.octet_length("base").alias("size")).orderBy("shard").collect()
        firsts, total, groups, held = {}, 0, [[]], 0
        for row in sizes:
            firsts[row["shard"]] = total
            total += row["n"]
            if groups[-1] and held + 4 * row["size"] > broadcast_bytes:
                groups.append([])
                held = 0
            groups[-1].append(row["shard"])
            held += 4 * row["size"]
        passes = None
        for group in groups:
            held = tries.where(F.col("shard").isin(group)).orderBy("shard").collect()
            found = _count_pass(encoded, held, length, shards, firsts, n_digits, length == max_words, slots)
            passes = found if passes is None else passes.unionByName(found)
        frequencies, candidates = _summed(passes, f"{scratch}/seen{length}", min_count)
        first_of = spark.createDataFrame(list(firsts.items()), "shard bigint, offset bigint")
        numbered = chosen.join(F.broadcast(first_of), "shard").withColumn("id", F.col("offset") + F.col("place"))
        numbered.join(frequencies.withColumnRenamed("key", "id"), "id").select(
            "id", "lang", "words", "phrase", F.col("n").alias("f")
        ).write.parquet(f"{scratch}/phrases{length}")
        levels.append(spark.read.parquet(f"{scratch}/phrases{length}"))
    return totals, [level.select("id", "lang", "words", "phrase", "f") for level in levels]


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, **sizes: int) -> DataFrame:
    """The ``top`` phrases of each language by their score: see ``RESULT``."""
    spark = docs.sparkSession
    totals, levels = frequent_phrases(docs, min_count, **sizes)
    if len(levels) < 2:
        return spark.createDataFrame([], RESULT)
    scored = [_scored(level, length, levels, totals) for length, level in enumerate(levels[1:], 2)]
    every = scored[0]
    for part in scored[1:]:
        every = every.unionByName(part)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = every.withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _scored(level: DataFrame, length: int, levels: list[DataFrame], totals: DataFrame) -> DataFrame:
    """Phrases of one length that no longer one stands for, with their lowest cut."""
    if length < len(levels):
        longer = levels[length]
        inner = F.explode(F.array(F.slice("words", 1, length), F.slice("words", 2, length))).alias("words")
        within = longer.select(inner, "f").groupBy("words").agg(F.max("f").alias("within"))
        level = level.join(within, "words", "left").where(F.coalesce(F.col("within") < F.col("f"), F.lit(True)))
    cuts = None
    for k in range(1, length):
        left = levels[k - 1].select(F.col("words").alias("left"), F.col("f").alias("l"))
        right = levels[length - k - 1].select(F.col("words").alias("right"), F.col("f").alias("r"))
        part = (
            level.select("lang", "phrase", F.col("f").alias("a"), F.slice("words", 1, k).alias("left"), F.slice("words", k + 1, length - k).alias("right"))
            .join(left, "left")
            .join(right, "right")
            .select("lang", "phrase", "a", "l", "r", F.lit(k).alias("cut"))
        )
        cuts = part if cuts is None else cuts.unionByName(part)
    exact = "CAST({} AS DECIMAL(19, 0))"
    score = F.expr(
        f"CAST((1000 * ({exact.format('a')} * {exact.format('n')})) div ({exact.format('l')} * {exact.format('r')}) AS BIGINT)"
    )
    cuts = cuts.join(totals, "lang").withColumn("score", score)
    lowest = F.min(F.struct("score", "cut", "l", "r")).alias("lowest")
    return cuts.groupBy("lang", "phrase", "a", "n").agg(lowest).select(
        "lang", "phrase", "a", "n", "lowest.l", "lowest.r", "lowest.score"
    )
