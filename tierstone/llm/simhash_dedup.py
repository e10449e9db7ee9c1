"""SimHash near-dedup: BK-trees over fingerprints that share blocks of bits.

Fingerprints within ``radius`` bits of each other agree on ``BLOCKS - radius`` of
``BLOCKS`` bit blocks at least, so each choice of that many blocks is a table whose
shards hold the fingerprints that agree there. A shard's fingerprints form a BK-tree:
children are keyed by their whole-number distance to the parent, and a search follows
the edges within the radius of its own distance only. Copies of a fingerprint are one
row from the start.

A tree holds at most ``TREE`` fingerprints. It would be broadcast if all trees of a
table together had a proven bound; they grow with the corpus, so a shuffle brings each
tree to the searches that need it. A shard with more fingerprints than that is cut into
several trees, and its searches are dealt to each of them. Tasks return links that
span what they found linked, never all pairs.

Cases: a null text counts as an empty one; all texts without words have the
fingerprint zero and are linked like others, so they form one group. Rows that are
repeated share a fingerprint. A null ``doc_id`` is in its group but never its
smallest id unless the group has no other. An empty table gives an empty result. In
``drop_near_copies`` the row with the smallest ``doc_id`` of a group stays, ties going
to the smallest hash of its columns and then to one of the equal rows; other columns
are carried along whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_scratch
from .components import components

SHINGLE = 4
RADIUS = 4
BLOCKS = 6
TREE = 4096

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shingle_hashes(text: Column, words: int = SHINGLE) -> Column:
    """XXH64 with seed 42 of each run of ``words`` words, as Spark's own function gives it."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    tokens = F.regexp_extract_all(lower, F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    # As the variable of a lambda the words are taken out once, not for each window.
    return F.transform(F.array(tokens), lambda found: _window_hashes(found, words))[0]


def _window_hashes(tokens: Column, words: int) -> Column:
    n = F.size(tokens)
    windows = F.transform(
        F.sequence(F.lit(1), n - words + 1),
        lambda i: F.xxhash64(F.concat_ws(" ", F.slice(tokens, i, words))),
    )
    whole = F.when(n > 0, F.array(F.xxhash64(F.concat_ws(" ", tokens))))
    return F.when(n >= words, windows).otherwise(F.coalesce(whole, F.array().cast("array<bigint>")))


def majority_bits(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprint of each row: the bits that over half of the row's hashes have."""
    counts = np.diff(offsets)
    out = np.zeros(len(counts), np.uint64)
    step = 1 << 15
    for row in np.flatnonzero(counts > step):
        total = np.zeros(64, np.int64)
        for low in range(offsets[row], offsets[row + 1], step):
            part = hashes[low : min(low + step, offsets[row + 1])]
            total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0)
        out[row] = np.packbits(2 * total > counts[row]).view(np.uint64)[0]
    rows = np.flatnonzero((counts > 0) & (counts <= step))
    while len(rows):
        take = max(1, int(np.searchsorted(np.cumsum(counts[rows]), step, "right")))
        now, rows = rows[:take], rows[take:]
        at = np.concatenate([[0], np.cumsum(counts[now])])
        index = np.repeat(offsets[now] - at[:-1], counts[now]) + np.arange(at[-1])
        bits = np.unpackbits(hashes[index].view(np.uint8).reshape(-1, 8), axis=1)
        sums = np.add.reduceat(bits, at[:-1], axis=0, dtype=np.int32)
        packed = np.packbits(2 * sums > counts[now][:, None], axis=1)
        out[now] = np.ascontiguousarray(packed).view(np.uint64)[:, 0]
    return out


def with_fingerprints(docs: DataFrame, keep: list[str], words: int = SHINGLE) -> DataFrame:
    """Columns ``keep`` and the fingerprint ``fp``, a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("hashes")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy(zero_copy_only=False)
            found = majority_bits(values.view(np.uint64), offsets)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(found.view(np.int64))], [*keep, "fp"]
            )

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    rows = docs.select(*keep, shingle_hashes(F.col("text"), words).alias("hashes"))
    return rows.mapInArrow(run, ", ".join([*fields, "fp bigint"]))


class BkForest:
    """BK-trees of many groups at once, grown and searched level by level.

    ``groups`` are sorted group numbers of ``values``; each group becomes one tree.
    """

    def __init__(self, values: np.ndarray, groups: np.ndarray):
        self.values = values
        n = len(values)
        self.root_of_group, first = np.unique(groups, return_index=True)
        self.roots = first
        parent = np.full(n, -1, np.int64)
        key = np.zeros(n, np.int64)
        rest = np.ones(n, bool)
        rest[first] = False
        left = np.flatnonzero(rest)
        above = first[np.searchsorted(self.root_of_group, groups[left])]
        while len(left):
            distance = np.bitwise_count(values[left] ^ values[above]).astype(np.int64)
            # The first of those at one distance below a node is its child there.
            order = np.lexsort((left, distance, above))
            left, above, distance = left[order], above[order], distance[order]
            new = np.ones(len(left), bool)
            new[1:] = (above[1:] != above[:-1]) | (distance[1:] != distance[:-1])
            parent[left[new]], key[left[new]] = above[new], distance[new]
            below = left[new][np.cumsum(new) - 1]
            left, above = left[~new], below[~new]
        children = np.flatnonzero(parent >= 0)
        self._slots = np.sort(parent[children] * 65 + key[children])
        self._children = children[np.argsort(parent[children] * 65 + key[children])]

    def search(
        self, queries: np.ndarray, groups: np.ndarray, radius: int, step: int = 1 << 20
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query position, node) within the radius; ``groups`` names each query's tree."""
        stack = [(np.arange(len(queries)), self.roots[np.searchsorted(self.root_of_group, groups)])]
        while stack:
            query, node = stack.pop()
            if len(query) > step:
                stack += [(query[step:], node[step:])]
                query, node = query[:step], node[:step]
            distance = np.bitwise_count(queries[query] ^ self.values[node]).astype(np.int64)
            near = distance <= radius
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(self._slots, node * 65 + np.maximum(distance - radius, 0), "left")
            high = np.searchsorted(self._slots, node * 65 + np.minimum(distance + radius, 64), "right")
            n = high - low
            if n.any():
                at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                stack.append((np.repeat(query, n), self._children[at]))


def _find(root: np.ndarray) -> np.ndarray:
    while True:
        up = root[root]
        if (up == root).all():
            return root
        root = up


def spanning_links(values: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Of each value the smallest position that the pairs connect it with."""
    root = np.arange(len(values))
    for a, b in pairs:
        while True:
            ra, rb = root[a], root[b]
            differ = ra != rb
            if not differ.any():
                break
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            root = _find(root)
    return root


def _link_batch(shard: np.ndarray, side: np.ndarray, fp: np.ndarray, radius: int) -> np.ndarray:
    """Links of sorted shards. Rows of side 0 form the tree and search it, those of 1 only search."""
    tree = np.flatnonzero(side == 0)
    if not len(tree):
        return np.zeros((0, 2), np.int64)
    values = fp.view(np.uint64)
    forest = BkForest(values[tree], shard[tree])
    searching = np.isin(shard, forest.root_of_group)
    asked = np.flatnonzero(searching)
    pairs = ((asked[q], tree[n]) for q, n in forest.search(values[asked], shard[asked], radius))
    root = spanning_links(values, pairs)
    moved = np.flatnonzero(root != np.arange(len(root)))
    return np.stack([fp[moved], fp[root[moved]]], 1)


def _shards(fp: Column, blocks: int, radius: int) -> Column:
    """A shard key for each choice of blocks: the choice's number and the bits of the blocks."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum((1 << edges[i + 1]) - (1 << edges[i]) for i in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(number).alias("t"), fp.bitwiseAND(F.lit(signed)).alias("k")))
    return F.explode(F.array(*keys))


def links(fingerprints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tree: int = TREE) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints ``fp`` that connect all within ``radius`` bits."""
    rows = fingerprints.select("fp", _shards(F.col("fp"), blocks, radius).alias("s")).select(
        "fp", "s.t", "s.k"
    )
    sizes = rows.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(sizes, ["t", "k"])
    # A large shard: its rows fall into parts; each pair of parts is a tree and its searches.
    parts = F.ceil(F.col("n") / tree).cast("int")
    part = F.pmod(F.xxhash64("fp"), parts).cast("int")
    rows = rows.withColumn("parts", parts).withColumn("part", part)
    dealt = rows.select(
        "fp", "t", "k", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    ).select(
        "fp",
        F.xxhash64("t", "k", F.least("part", "other"), F.greatest("part", "other")).alias("shard"),
        F.when(F.col("part") <= F.col("other"), 0).otherwise(1).alias("side"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def work(columns: list[np.ndarray]) -> pa.RecordBatch:
            found = np.unique(_link_batch(*columns, radius), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

        rows_held = 0
        for batch in batches:
            held.append([batch.column(i).to_numpy() for i in range(3)])
            rows_held += batch.num_rows
            if rows_held < 1 << 16:
                continue
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            # Whole shards only: what follows the last change of shard waits.
            cut = int(np.searchsorted(columns[0], columns[0][-1], "left"))
            if cut:
                yield work([c[:cut] for c in columns])
            held = [[c[cut:] for c in columns]]
            rows_held = len(columns[0]) - cut
        if rows_held:
            yield work([np.concatenate(c) for c in zip(*held, strict=True)])

    sorted_rows = dealt.select("shard", "side", "fp").repartition("shard").sortWithinPartitions("shard", "side")
    return sorted_rows.mapInArrow(run, "a bigint, b bigint")


def group_of_fingerprint(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fp, root`` for the fingerprints that have a link; others are their own group."""
    return components(links(fingerprints, radius)).select(F.col("id").alias("fp"), "root")


def near_copies(docs: DataFrame, words: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every document."""
    spark = docs.sparkSession
    path = shared_scratch(spark, "simhash")
    with_fingerprints(docs, ["doc_id"], words).write.parquet(path)
    rows = spark.read.parquet(path)
    known = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = group_of_fingerprint(known.select("fp"), radius)
    known = known.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = known.join(least, "root").select("fp", "component_id")
    return rows.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, words: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each group: the one with the smallest ``doc_id``."""
    spark = docs.sparkSession
    path = shared_scratch(spark, "simhash")
    # A hash of the whole row tells rows apart where an id is repeated.
    docs = docs.select(F.struct("*").alias("doc"), F.xxhash64(*docs.columns).alias("row"))
    with_fingerprints(docs.select("doc.doc_id", "row", "doc.text"), ["doc_id", "row"], words).write.parquet(path)
    rows = spark.read.parquet(path)
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"))
    known = rows.groupBy("fp").agg(F.min(key).alias("best"))
    roots = group_of_fingerprint(known.select("fp"), radius)
    best = (
        known.join(roots, "fp", "left")
        .groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(F.min("best").alias("best"))
        .select(F.col("best.row").alias("_row"), F.col("best.doc_id").alias("_id"))
    )
    found = docs.join(best, (F.col("row") == F.col("_row")) & F.col("doc.doc_id").eqNullSafe(F.col("_id")))
    # Equal rows are one group of this aggregate, which needs no shuffle after the join.
    return found.groupBy("row", "_id").agg(F.any_value("doc").alias("doc")).select("doc.*")
