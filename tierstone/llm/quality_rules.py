"""Quality rules: two plain rules, and an isolation forest over rule statistics.

An isolation forest cuts small random draws of rows by random features at random places
until their rows are apart. A document that ends in a shallow leaf on average is easy to
isolate, which makes it anomalous. All labelled rows take part, but for those that the
base rules reject: each tree draws its own ``TREE_ROWS`` from all of them, as the method
has it; how full a leaf is follows from where all of them end; and the threshold is the
lowest of ``LEVELS`` steps that rejects no more than ``MAX_LOSS`` of all good rows, and
only where at least half of what it rejects is labelled bad. Statistics of the texts, some
hundred bytes a row, go to a table; the driver gets the trees and one count a leaf and a
step, whatever the number of rows. Verdicts are given on whole texts of all rows.

Cases: a null text has no words and fails the base rules, as an empty one does. Rows
that are repeated get equal verdicts. Without labels only the base rules reject. An
empty table gives an empty result. Other columns of the input are carried along by
``filter_quality`` and ignored by ``rate``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_scratch
from .labelled import STATISTICS, label_rows, ratios, statistics, with_statistics

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
TREES = 128
TREE_ROWS = 256
MAX_LOSS = 0.01
#: Steps from 0 to 1 at which a threshold can stand.
LEVELS = 1 << 16

_AT = {name: i for i, name in enumerate(STATISTICS)}


def base_failed(stats: np.ndarray) -> np.ndarray:
    """Too few words, or too many of them in repeated windows."""
    words, repeats = stats[:, _AT["n_words"]], stats[:, _AT["n_repeat_words"]]
    return (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)


def rule_features(stats: np.ndarray) -> np.ndarray:
    """Ratios only: a long text is not an odd one."""
    return ratios(stats)[:, 1:]


def mean_path(n: np.ndarray | int) -> np.ndarray:
    """Mean depth at which a random binary search tree of ``n`` rows ends."""
    n = np.maximum(np.asarray(n, float), 1)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays: node ``i`` sends a row left where ``row[feature] < cut``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    depth: np.ndarray
    rows: int
    threshold: float = 1.0

    def leaves(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """For each tree the node in which each row ends."""
        here = np.arange(len(x))
        for feature, cut, left in zip(self.feature, self.cut, self.left, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.ceil(np.log2(max(self.rows, 2)))) + 1):
                split = feature[node] >= 0
                right = x[here, np.maximum(feature[node], 0)] >= cut[node]
                node = np.where(split, left[node] + right, node)
            yield node

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly of each row, from 0 to 1: the shorter its mean path, the higher."""
        total = np.zeros(len(x))
        for node, depth in zip(self.leaves(x), self.depth, strict=True):
            total += depth[node]
        norm = max(float(mean_path(self.rows)), 1e-9)
        return 2.0 ** (-total / max(len(self.feature), 1) / norm)


Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def grow_tree(x: np.ndarray, drawn: np.ndarray, rng: np.random.Generator) -> Tree:
    """``feature, cut, left, depth`` of a tree over the rows ``drawn`` of ``x``."""
    limit = int(np.ceil(np.log2(max(len(drawn), 2))))
    feature, cut, left, depth = [-1], [0.0], [0], [0.0]
    todo = [(0, drawn, 0)]
    while todo:
        node, rows, level = todo.pop()
        part = x[rows]
        usable = np.flatnonzero(part.max(0) > part.min(0)) if len(rows) > 1 and level < limit else []
        if not len(usable):
            depth[node] = level + float(mean_path(len(rows)))
            continue
        f = int(rng.choice(usable))
        c = rng.uniform(part[:, f].min(), part[:, f].max())
        c = c if c > part[:, f].min() else part[:, f].max()
        feature[node], cut[node], left[node] = f, c, len(feature)
        right = part[:, f] >= c
        for side in (rows[~right], rows[right]):
            feature.append(-1), cut.append(0.0), left.append(0), depth.append(0.0)
            todo.append((len(feature) - 1, side, level + 1))
    return np.array(feature), np.array(cut), np.array(left), np.array(depth)


def grow_forest(x: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 11) -> Forest:
    """A forest over the rows of ``x``; equal input gives an equal forest."""
    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(x))
    grown = [grow_tree(x, rng.choice(len(x), size, replace=False), rng) for _ in range(trees)]
    columns = list(zip(*grown, strict=True)) if grown else [[], [], [], []]
    return Forest(*(list(c) for c in columns), rows=size)


def fill_leaves(forest: Forest, ends: list[np.ndarray], n: int) -> None:
    """Depths by how many of ``n`` rows end in each node, in place of those drawn.

    A leaf stands for as many rows of a draw as fall into it on average.
    """
    full = np.arange(forest.rows + 1)
    for feature, left, depth, count in zip(forest.feature, forest.left, forest.depth, ends, strict=True):
        level = np.zeros(len(feature))
        for node in np.flatnonzero(feature >= 0):  # a node comes before those below it
            level[left[node] : left[node] + 2] = level[node] + 1
        depth[:] = np.where(feature < 0, level + np.interp(count * forest.rows / n, full, mean_path(full)), 0.0)


def calibrate(scores: np.ndarray, good: np.ndarray, max_loss: float = MAX_LOSS) -> float:
    """The lowest threshold within ``max_loss`` of the good rows whose rejects are mostly bad."""
    levels, at = np.unique(scores, return_inverse=True)
    n_good = np.bincount(at, good.astype(bool), minlength=len(levels))
    return calibrate_counts(levels, n_good, np.bincount(at, minlength=len(levels)) - n_good, max_loss)


def calibrate_counts(levels: np.ndarray, good: np.ndarray, bad: np.ndarray, max_loss: float = MAX_LOSS) -> float:
    """The same from the numbers of good and bad rows at each of some ascending levels."""
    lost, hit = np.cumsum(good[::-1])[::-1], np.cumsum(bad[::-1])[::-1]
    fits = (lost <= max_loss * max(int(good.sum()), 1)) & (hit >= lost) & (good + bad > 0)
    return float(levels[np.flatnonzero(fits)[0]]) if fits.any() else np.inf


def _features(batch: pa.RecordBatch) -> np.ndarray:
    return rule_features(_stats(batch))


def _stats(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    lists = batch.column("stats")
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def _tally(rows: DataFrame, size: int, slots: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """How often each of ``size`` slots occurs in ``slots(batch)`` over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(slots(batch), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["slot", "n"])

    sums = rows.mapInArrow(run, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    total = np.zeros(size, np.int64)
    for r in sums.collect():
        total[r["slot"]] = r["n"]
    return total


def _usual_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, label, stats`` of the labelled rows that pass the base rules, from a table.

    Rows equal in id and statistics are one. Statistics meet the labels, never texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~base_failed(_stats(batch))))

    found = with_statistics(docs, ["doc_id"]).join(labels, "doc_id").select("doc_id", "label", "stats")
    path = shared_scratch(docs.sparkSession, "quality_rules")
    found.distinct().mapInArrow(run, found.schema).write.parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


def _grow(rows: DataFrame, n: int, tree_rows: int) -> Forest:
    """A tree for each of ``TREES`` draws of ``tree_rows`` out of ``n`` rows, by hashes of row and tree."""
    draws = rows.select(
        "doc_id", "stats", F.xxhash64("doc_id", "stats").alias("key"),
        F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"),
    ).withColumn("draw", F.xxhash64("key", "tree"))
    if n > 4 * tree_rows:
        # About four times as many as a tree draws; the least hashes are among them.
        draws = draws.where(F.col("draw") < int((4 * tree_rows / n - 0.5) * 2**64))
    order = Window.partitionBy("tree").orderBy("draw", "doc_id", "stats")
    draws = draws.withColumn("at", F.row_number().over(order)).where(F.col("at") <= tree_rows)

    def grow(found: pa.Table) -> pa.Table:
        found = found.sort_by("at")
        tree = found.column("tree")[0].as_py()
        x = rule_features(_stats(found))
        grown = grow_tree(x, np.arange(len(x)), np.random.default_rng([11, tree]))
        return pa.table({"tree": [tree], **{k: [v.tolist()] for k, v in zip(names, grown, strict=True)}}, schema=schema)

    names = ("feature", "cut", "left", "depth")
    kinds = (pa.int64(), pa.float64(), pa.int64(), pa.float64())
    schema = pa.schema([("tree", pa.int32()), *((k, pa.list_(t)) for k, t in zip(names, kinds, strict=True))])
    grown = draws.select("tree", "at", "stats").groupBy("tree").applyInArrow(
        grow, "tree int, feature array<bigint>, cut array<double>, left array<bigint>, depth array<double>"
    )
    trees = sorted(grown.collect(), key=lambda r: r["tree"])
    return Forest(*([np.array(r[k]) for r in trees] for k in names), rows=min(tree_rows, n))


def fit(docs: DataFrame, labels: DataFrame, sample: int = TREE_ROWS) -> Forest | None:
    """Forest and threshold from all labelled documents; None without any.

    ``sample`` is what one tree draws.
    """
    labelled = label_rows(labels, "quality")
    if labelled.isEmpty():
        return None
    rows = _usual_rows(docs, labelled)
    n = rows.count()
    if not n:
        return None
    forest = _grow(rows, n, sample)
    model = docs.sparkSession.sparkContext.broadcast(forest)
    starts = np.cumsum([0, *map(len, forest.feature)])

    def ends(batch: pa.RecordBatch) -> np.ndarray:
        found = model.value.leaves(_features(batch))
        return np.concatenate([node + start for node, start in zip(found, starts, strict=False)])

    fill_leaves(forest, np.split(_tally(rows, starts[-1], ends), starts[1:-1]), n)
    filled = docs.sparkSession.sparkContext.broadcast(forest)

    def levels(batch: pa.RecordBatch) -> np.ndarray:
        level = (filled.value.score(_features(batch)) * LEVELS).astype(np.int64)
        return 2 * level + (batch.column("label").to_numpy() == 1)

    bad, good = _tally(rows, 2 * LEVELS + 2, levels).reshape(-1, 2).T
    forest.threshold = calibrate_counts(np.arange(LEVELS + 1) / LEVELS, good, bad)
    return forest


def verdict(stats: np.ndarray, forest: Forest | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(base_failed, anomaly, kept)`` of each row of statistics."""
    failed = base_failed(stats)
    if forest is None:
        return failed, np.zeros(len(stats)), ~failed
    anomaly = forest.score(rule_features(stats))
    return failed, anomaly, ~failed & (anomaly < forest.threshold)


def rate(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """Base statistics, anomaly and verdict of every document; no shuffle."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(forest)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = statistics(batch.column("text"))
            failed, anomaly, kept = verdict(stats, model.value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(stats[:, _AT[n]]) for n in names),
                    pa.array(failed), pa.array(anomaly), pa.array(kept),
                ],
                ["doc_id", *names, "base_failed", "anomaly", "kept"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + "".join(f"{n} bigint, " for n in names)
    return docs.select("doc_id", "text").mapInArrow(
        run, schema + "base_failed boolean, anomaly double, kept boolean"
    )


def filter_quality(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """The rows whose text passes, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = verdict(statistics(batch.column("text")), model.value)[2]
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
