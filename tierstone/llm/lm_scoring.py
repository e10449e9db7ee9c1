"""Language-model scores of whole documents by a hashed maximum-entropy model (``maxent``).

Word counts cover all training documents. The ``KNOWN`` most frequent words, a table of
bounded size, are broadcast; the counts of all others stay distributed and are joined to
the documents that use them. Training visits every training document once, in
``ROUNDS`` rounds: each task descends from the broadcast weights over its own share,
and the weights of all tasks are averaged slot by slot, by how often each task met the
slot. Weights are two tables of a fixed size, and no gradient is larger.

Tokens: words ``[^\\x20\\x09-\\x0D]+`` in lower case (A-Z), then one end of text.

Cases: a null or empty text has the end only. Rows that are repeated train as often as
they are there and get equal scores. A null id counts as the empty text for the fold.
Without training documents all words are equally unknown. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_scratch
from . import maxent
from . import textbytes as tb
from .quality_classifier import fold

KNOWN = 1 << 18
ROUNDS = 2
END = np.uint64(1)
CHUNKS = 32


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and row of each token of a piece, the end of each row included."""
    lower = tb.LOWER[data]
    starts, ends, rows = tb.word_spans(lower, offsets)
    words = tb.SpanHash(lower).spans(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    n = np.bincount(rows, minlength=len(offsets) - 1)
    after = np.cumsum(n)
    return np.insert(words, after, END), np.insert(rows, after, np.arange(len(n)))


def count_words(texts: DataFrame) -> DataFrame:
    """``word, c``: the count of each token of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            words, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "c"])

        for batch in batches:
            data, offsets = tb.text_arrays(batch.column("text"))
            for _, _, part, ends in tb.pieces(data, offsets):
                held.append(token_hashes(part, ends)[0])
                size += len(held[-1])
                if size > 1 << 22:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return texts.select("text").mapInArrow(run, "word bigint, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame, known: int = KNOWN) -> maxent.Vocabulary:
    """The ``known`` most frequent words, ties by fingerprint, and the sums over all."""
    sums = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("c"), "word").limit(known).toArrow()
    hashes, found = (top.column(c).to_numpy() for c in ("word", "c"))
    hashes = hashes.view(np.uint64)
    rank = np.lexsort((hashes, -found))
    hashes, found = hashes[rank], found[rank]
    order = np.argsort(hashes)
    return maxent.Vocabulary(hashes[order], order, found[order], int(sums[0] or 0), int(sums[1]))


def _packed(part: int, table: np.ndarray, touched: np.ndarray) -> Iterator[dict]:
    """Chunks of a table of weights, each row times how often it was met."""
    for chunk, (rows, n) in enumerate(zip(np.array_split(table, CHUNKS), np.array_split(touched, CHUNKS), strict=True)):
        yield {"part": part, "chunk": chunk, "n": n.astype(np.float32).tobytes(), "w": rows.astype(np.float16).tobytes()}


def train(texts: DataFrame, words: maxent.Vocabulary, rounds: int = ROUNDS) -> maxent.Weights:
    """Weights from rows ``text, round``."""
    spark = texts.sparkSession
    model = maxent.Weights.zeros()
    shared = spark.sparkContext.broadcast(words)
    schema = pa.schema([("part", "int32"), ("chunk", "int32"), ("n", "binary"), ("w", "binary")])
    kind = "part int, chunk int, n binary, w binary"
    for number in range(rounds):
        start = spark.sparkContext.broadcast(model)

        def descend(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            known = shared.value
            own = maxent.Weights(start.value.classes.copy(), start.value.words.copy())
            squares = [np.zeros(t.shape, np.float32) for t in (own.classes, own.words)]
            touched = [np.zeros(len(own.classes)), np.zeros(len(own.words))]
            any_rows = False
            for batch in batches:
                data, offsets = tb.text_arrays(batch.column("text"))
                for _, _, part, ends in tb.pieces(data, offsets):
                    hashes, rows = token_hashes(part, ends)
                    rank, found = known.find(hashes), maxent.features(hashes, rows)
                    for low in range(0, len(rank), maxent.BATCH):
                        now = slice(low, low + maxent.BATCH)
                        maxent.Step(known, own, rank[now], found[:, now]).descend(squares, touched)
                        any_rows = True
            if any_rows:
                rows = [*_packed(0, own.classes, touched[0]), *_packed(1, own.words, touched[1])]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple, list[np.ndarray]] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    n = np.frombuffer(row["n"], np.float32)
                    w = np.frombuffer(row["w"], np.float16).reshape(len(n), -1).astype(np.float32)
                    held = sums.setdefault((row["part"], row["chunk"]), [np.zeros_like(n), np.zeros_like(w)])
                    held[0] += n
                    held[1] += w * n[:, None]
            rows = [
                {"part": p, "chunk": c, "n": n.tobytes(), "w": (w / np.maximum(n, 1)[:, None]).astype(np.float16).tobytes()}
                for (p, c), (n, w) in sums.items()
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

        share = texts.where(F.col("round") == number).select("text")
        # Fewer, larger tasks: each one sends weights of a fixed size.
        tasks = max(2, -(-share.rdd.getNumPartitions() // 4))
        found = share.coalesce(tasks).mapInArrow(descend, kind).repartition("part", "chunk").mapInArrow(average, kind)
        new = maxent.Weights(model.classes.copy(), model.words.copy())
        places = [np.array_split(np.arange(len(t)), CHUNKS) for t in (new.classes, new.words)]
        for row in found.collect():
            table = (new.classes, new.words)[row["part"]]
            n = np.frombuffer(row["n"], np.float32)
            w = np.frombuffer(row["w"], np.float16).reshape(len(n), -1).astype(np.float32)
            at = places[row["part"]][row["chunk"]]
            table[at[n > 0]] = w[n > 0]
        model = new
    return model


def score(docs: DataFrame, held_out_of: int = 5, held_out: int = 1, known: int = KNOWN) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    spark = docs.sparkSession
    base = shared_scratch(spark, "lm_scoring")
    remainder = fold() % held_out_of
    train_texts = docs.where(remainder != held_out).select(
        "text", (F.floor(fold() / held_out_of) % ROUNDS).alias("round")
    )
    count_words(train_texts).write.parquet(f"{base}/counts")
    counts = spark.read.parquet(f"{base}/counts")
    words = vocabulary(counts, known)
    shared = spark.sparkContext.broadcast((words, train(train_texts, words)))
    keyed = docs.select(
        "doc_id", "text", (remainder == held_out).alias("held_out"), F.xxhash64("doc_id", "text").alias("row")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words, weights = shared.value
        for batch in batches:
            data, offsets = tb.text_arrays(batch.column("text"))
            for first, until, part, ends in tb.pieces(data, offsets):
                n = until - first
                hashes, rows = token_hashes(part, ends)
                rank, found = known_words.find(hashes), maxent.features(hashes, rows)
                logs = np.zeros(len(rank))
                for low in range(0, len(rank), maxent.SCORED):
                    now = slice(low, low + maxent.SCORED)
                    step = maxent.Step(known_words, weights, rank[now], found[:, now])
                    logs[now] = step.log_probability(known_words, rank[now])
                inside = rank >= 0
                smooth = known_words.log_smooth[rank[inside]] if inside.any() else np.zeros(0)
                out_rows, out_words = rows[~inside], hashes[~inside]
                order = np.lexsort((out_words, out_rows))
                out_rows, out_words = out_rows[order], out_words[order]
                new = np.ones(len(order), bool)
                new[1:] = (out_rows[1:] != out_rows[:-1]) | (out_words[1:] != out_words[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(order)))
                lists = pa.array(
                    np.concatenate([[0], np.cumsum(np.bincount(out_rows[at], minlength=n))]), pa.int32()
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(first, n) for c in ("doc_id", "held_out", "row")),
                        pa.array(np.bincount(rows, minlength=n)),
                        pa.array(np.bincount(rows[inside], minlength=n)),
                        pa.array(np.bincount(rows[inside], smooth, minlength=n)),
                        pa.array(np.bincount(rows, logs, minlength=n)),
                        pa.ListArray.from_arrays(lists, pa.array(out_words[at].view(np.int64))),
                        pa.ListArray.from_arrays(lists, pa.array(times.astype(np.int32))),
                    ],
                    ["doc_id", "held_out", "row", "n_tokens", "n_inside", "smooth", "logs", "words", "times"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed.mapInArrow(
        run,
        f"doc_id {kind}, held_out boolean, row bigint, n_tokens bigint, n_inside bigint, smooth double, "
        "logs double, words array<bigint>, times array<int>",
    ).write.parquet(f"{base}/parts")
    parts = spark.read.parquet(f"{base}/parts")
    rare = parts.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select(
        "row", F.col("x.words").alias("word"), F.col("x.times").alias("times")
    )
    seen = F.coalesce("c", F.lit(0))
    # Counts are from training texts; the words looked up are rare ones, so no key is hot.
    outside = (
        rare.join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log(seen + 0.5)).alias("rare_smooth"),
            F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    ten, total = F.lit(log(10)), float(np.log(words.n + 0.5 * (words.v + 1)))
    copies = parts.groupBy("row", "doc_id", "held_out").agg(
        F.count(F.lit(1)).cast("int").alias("copies"),
        *(F.any_value(c).alias(c) for c in ("n_tokens", "n_inside", "smooth", "logs")),
    )
    rare_smooth = F.coalesce(F.col("rare_smooth") / F.col("copies"), F.lit(0.0))
    rare_known = F.coalesce((F.col("rare_known") / F.col("copies")).cast("bigint"), F.lit(0))
    return copies.join(outside, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_inside") + rare_known).alias("n_known"),
        F.lit(words.n).cast("bigint").alias("train_tokens"),
        ((F.col("smooth") + rare_smooth - F.col("n_tokens") * F.lit(total)) / ten).alias("base_score"),
        ((F.col("logs") + rare_smooth) / ten).alias("score"),
        F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("_copy"),
    ).drop("_copy")
