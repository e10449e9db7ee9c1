"""Suffix-array dedup: bytes of strings that begin more than once anywhere in the corpus.

A suffix here is a text from some byte on; its leading tokens are its first and last
bytes of ``match``, overlapping. Two suffixes with equal ones share ``match`` bytes. Suffixes are range-partitioned
by their leading tokens with sampled splitters, sorted in each bucket by multikey
quicksort, and compared with their neighbours; the ends of the buckets are compared
across boundaries, so one string with a third of all places may spread over many.

Most suffixes never need to be sorted (``suffix_spans``):

1. Every string of ``match`` bytes has an anchor that its copies have too. Anchors
   without a second one anywhere rule out all their strings.
2. Segments of at least ``match`` bytes between anchors, or the ends of a text, that
   occur again are removed whole. Both are counted by fingerprint over all texts.
3. What is left are strings around the edges of repeated passages that segments do not
   cover. They are sorted as above, along with those at the same places around the same
   anchors in every other text.

Equal texts are worked on once; a text is known by its hash and size. Bloom filters of
a bounded size keep texts and fingerprints without a partner out of the shuffles.
Fingerprints have 64 bits, leading tokens 64 each.

Cases: a null text is an empty one, and texts shorter than a match keep all bytes.
Rows that are repeated are copies of each other, so a text of at least ``match`` bytes
that is there twice goes whole. A null id is an id like others. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import shared_scratch
from . import bloom
from . import textbytes as tb
from .suffix_spans import Spans, token_bytes, union_spans

MATCH = 400
BUCKET_ROWS = 1 << 19
KEY = ["text_hash", "text_bytes"]
_KEY_TYPE = "text_hash bigint, text_bytes int"


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", text.alias("text"), F.xxhash64(text).alias("text_hash"), F.octet_length(text).alias("text_bytes")
    )


def marks(texts: DataFrame, match: int, known: bloom.BloomFilter | None = None) -> DataFrame:
    """``mark, kind, low, high, at, text_hash, text_bytes``: every anchor and segment of each text,
    or those that ``known`` may hold."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.text_arrays(batch.column("text"))
            for first, _, part, ends in tb.pieces(data, offsets):
                if len(part) < match:
                    continue
                rows, found, *place = Spans(part, ends, match).marks()
                found = found.view(np.int64)
                if shared.value is not None:
                    keep = shared.value.might_hold(found)
                    rows, found, place = rows[keep], found[keep], [p[keep] for p in place]
                at = pa.array(rows + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found), *(pa.array(p.astype(np.int32)) for p in place),
                        batch.column("text_hash").take(at), batch.column("text_bytes").take(at),
                    ],
                    ["mark", "kind", "low", "high", "at", *KEY],
                )

    long = texts.where(F.col("text_bytes") >= match).select("text", *KEY)
    return long.mapInArrow(run, f"mark bigint, kind int, low int, high int, at int, {_KEY_TYPE}")


_ANCHOR = ["mark", "low", "high", "at", "open_low", "open_high"]


def sure_spans(places: DataFrame, match: int) -> DataFrame:
    """From the repeated marks ``places`` of each text: the spans that are sure to go, and its
    anchors with the range of their starts that have bytes outside of them (-1: none)."""
    spans = [pa.int32(), pa.int32(), pa.int64(), *[pa.int32()] * 5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("places")
            mark, kind, low, high, at = (v.to_numpy(zero_copy_only=False) for v in found.values.flatten())
            ends = found.offsets.to_numpy().astype(np.int64)
            sizes = batch.column("text_bytes").to_numpy()
            out: list[list[np.ndarray]] = [[] for _ in spans]
            for n, size in enumerate(sizes):
                own = slice(ends[n], ends[n + 1])
                segment = kind[own] == 1
                opens, closes, outside = union_spans(low[own][segment], high[own][segment], int(size))
                anchor = [v[own][~segment] for v in (mark, low, high, at)]
                first, last = anchor[1].astype(np.int64), anchor[2].astype(np.int64)
                # The starts of an anchor whose strings reach a byte outside are found by
                # counting: the next such byte after a start, the last one before an end.
                places_out = np.flatnonzero(np.diff(outside))
                after = np.append(places_out, size + match)[np.searchsorted(places_out, first)]
                before = np.append(-match, places_out)[np.searchsorted(places_out, last + match)]
                open_low, open_high = np.maximum(first, after - match + 1), np.minimum(last, before)
                is_open = (after < last + match) & (before >= first)
                anchor += [np.where(is_open, open_low, -1), np.where(is_open, open_high, -1)]
                for column, part in zip(out, (opens, closes, *anchor), strict=True):
                    column.append(part)
            lists = [
                pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, column)]), pa.int32()),
                    pa.array(np.concatenate([np.zeros(0, np.int64), *column]), kind),
                )
                for column, kind in zip(out, spans, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_hash"), batch.column("text_bytes"), *lists], [*KEY, "opens", "closes", *_ANCHOR]
            )

    grouped = places.groupBy(*KEY).agg(F.collect_set(F.struct("mark", "kind", "low", "high", "at")).alias("places"))
    lists = ", ".join(f"{c} array<{'bigint' if c == 'mark' else 'int'}>" for c in ["opens", "closes", *_ANCHOR])
    return grouped.mapInArrow(run, f"{_KEY_TYPE}, {lists}")


def asked_ranges(sure: DataFrame) -> DataFrame:
    """Per text the ranges of starts to sort: those as far before their anchor as an open
    start of that anchor is in any text. ``open_low, open_high``: which are open here."""
    anchors = sure.select(*KEY, F.explode(F.arrays_zip(*_ANCHOR)).alias("x")).select(*KEY, "x.*")
    asked = (
        anchors.where("open_low >= 0")
        .groupBy("mark")
        .agg(F.min(F.col("at") - F.col("open_high")).alias("near"), F.max(F.col("at") - F.col("open_low")).alias("far"))
    )
    # As a table of its own, so that Spark can split a mark with many anchors in the join.
    spark, path = sure.sparkSession, shared_scratch(sure.sparkSession, "suffix_asked")
    asked.write.parquet(path)
    asked = spark.read.parquet(path)
    low = F.greatest("low", F.col("at") - F.col("far")).alias("low")
    high = F.least("high", F.col("at") - F.col("near")).alias("high")
    return (
        anchors.join(asked, "mark")
        .select(*KEY, low, high, "open_low", "open_high")
        .where("low <= high")
        .groupBy(*KEY)
        .agg(F.collect_list(F.struct("low", "high", "open_low", "open_high")).alias("ranges"))
    )


def leading_tokens(texts: DataFrame, match: int) -> DataFrame:
    """From rows ``text, ranges``: each suffix with its two tokens, and whether it is open.

    One that is not open only serves to show that another is a repeat, so of equal ones in
    a piece one is enough.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = token_bytes(match)
        for batch in batches:
            data, offsets = tb.text_arrays(batch.column("text"))
            ranges = batch.column("ranges")
            low, high, open_low, open_high = (
                v.to_numpy(zero_copy_only=False).astype(np.int64) for v in ranges.values.flatten()
            )
            ends = ranges.offsets.to_numpy().astype(np.int64)
            for first, until, part, row_ends in tb.pieces(data, offsets):
                own = slice(ends[first], ends[until])
                rows = np.repeat(np.arange(until - first), np.diff(ends[first : until + 1]))
                n = high[own] - low[own] + 1
                start = np.repeat(low[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
                row = np.repeat(rows, n)
                is_open = (start >= np.repeat(open_low[own], n)) & (start <= np.repeat(open_high[own], n))
                grams = tb.SpanHash(part).windows(token)
                at = start + row_ends[row]
                lead, last = grams[at], grams[at + match - token]
                closed = np.flatnonzero(~is_open)
                order = np.lexsort((last[closed], lead[closed]))
                f, s = lead[closed][order], last[closed][order]
                new = np.ones(len(order), bool)
                new[1:] = (f[1:] != f[:-1]) | (s[1:] != s[:-1])
                keep = np.concatenate([np.flatnonzero(is_open), closed[order[new]]])
                keep.sort()
                rows_kept = pa.array(row[keep] + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("text_hash").take(rows_kept), batch.column("text_bytes").take(rows_kept),
                        pa.array(start[keep].astype(np.int32)), pa.array(lead[keep].view(np.int64)),
                        pa.array(last[keep].view(np.int64)), pa.array(is_open[keep]),
                    ],
                    [*KEY, "start", "first", "second", "open"],
                )

    return texts.mapInArrow(run, f"{_KEY_TYPE}, start int, first bigint, second bigint, open boolean")


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """Order by the first key; only what is equal in it is sorted on by the next."""
    order = np.argsort(keys[0])
    if len(keys) == 1 or len(order) < 2:
        return order
    lead = keys[0][order]
    same = lead[1:] == lead[:-1]
    tied = np.flatnonzero(np.append(same, False) | np.insert(same, 0, False))
    if len(tied):
        part = order[tied]
        run = np.cumsum(np.insert(~same, 0, True))[tied]
        inner = multikey_order([k[part] for k in keys[1:]])
        order[tied] = part[inner[np.argsort(run[inner], kind="stable")]]
    return order


def repeated_suffixes(suffixes: DataFrame, n_rows: int) -> DataFrame:
    """``text_hash, text_bytes, start`` of the open suffixes that share both tokens with another."""
    spark = suffixes.sparkSession
    path = shared_scratch(spark, "suffix_buckets")
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // BUCKET_ROWS))
    schema = pa.schema(
        [("text_hash", "int64"), ("text_bytes", "int32"), ("start", "int32"), ("first", "int64"),
         ("second", "int64"), ("open", "bool"), ("bucket", "int32"), ("edge", "int32")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        first, second = (table.column(c).to_numpy() for c in ("first", "second"))
        order = multikey_order([first, second])
        f, s = first[order], second[order]
        same = (f[1:] == f[:-1]) & (s[1:] == s[:-1])
        many = np.append(same, False) | np.insert(same, 0, False)
        # The ends of the bucket go along for the comparison with its neighbours.
        is_open = table.column("open").to_numpy()[order]
        pick = np.union1d(np.flatnonzero(many & is_open), [0, len(order) - 1])
        edge = (~many).astype(np.int32)[pick]
        at = pa.array(order[pick])
        bucket = np.where(np.isin(pick, [0, len(order) - 1]), TaskContext.get().partitionId(), -1)
        columns = [table.column(c).combine_chunks().take(at) for c in schema.names[:6]]
        out = pa.Table.from_arrays([*columns, pa.array(bucket.astype(np.int32)), pa.array(edge)], schema=schema)
        yield from out.to_batches()

    (
        suffixes.repartitionByRange(n_buckets, "first", "second", *KEY, "start")
        .mapInArrow(run, f"{_KEY_TYPE}, start int, first bigint, second bigint, open boolean, bucket int, edge int")
        .write.parquet(path)
    )
    found = spark.read.parquet(path)
    # At most two rows a bucket: a comparison of neighbours over all of them.
    order = W.orderBy("bucket", "first", "second")
    ends = found.where("bucket >= 0")
    same = F.lit(False)
    for near in (F.lag, F.lead):
        equal = (near("first").over(order) == F.col("first")) & (near("second").over(order) == F.col("second"))
        same = same | F.coalesce(equal, F.lit(False))
    across = ends.withColumn("same", same).where("open and same and edge = 1").select(*KEY, "start")
    return found.where("open and edge = 0").select(*KEY, "start").union(across)


def removed(docs: DataFrame, match: int = MATCH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every document."""
    spark = docs.sparkSession
    base = shared_scratch(spark, "suffix_dedup")
    texts = _texts(docs)

    # Equal texts have equal marks; only one text with a mark twice, or two, make it a repeat.
    counted = marks(texts, match).groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counted.select("mark").write.parquet(f"{base}/marks")
    repeated = spark.read.parquet(f"{base}/marks")
    places = marks(texts, match, bloom.build(repeated)).join(repeated, "mark")
    sure_spans(places, match).write.parquet(f"{base}/sure")
    sure = spark.read.parquet(f"{base}/sure")
    asked_ranges(sure).write.parquet(f"{base}/ranges")
    ranges = spark.read.parquet(f"{base}/ranges")
    some = bloom.build(ranges.select("text_hash")).column(F.col("text_hash"), texts)
    once = texts.where(some).groupBy(*KEY).agg(F.any_value("text").alias("text")).join(ranges, KEY)
    starts = F.aggregate("ranges", F.lit(0).cast("bigint"), lambda n, r: n + r["high"] - r["low"] + 1)
    n_rows = ranges.agg(F.sum(starts)).first()[0] or 0
    # Tokens are computed once for the sample of splitters and once for the shuffle.
    suffixes = leading_tokens(once, match)
    again = repeated_suffixes(suffixes, n_rows).groupBy(*KEY).agg(F.collect_list("start").alias("starts"))
    none = F.array().cast("array<int>")
    spans = (
        sure.select(*KEY, "opens", "closes")
        .join(again, KEY, "left")
        .where("size(opens) > 0 or starts is not null")
        .withColumn("starts", F.coalesce("starts", none))
    )
    spans.write.parquet(f"{base}/spans")
    spans = spark.read.parquet(f"{base}/spans")
    cut = bloom.build(spans.select("text_hash")).column(F.col("text_hash"), texts)
    rows = texts.withColumn("cut", cut)
    whole = rows.where(~F.col("cut"))
    found = rows.where("cut").join(spans, KEY, "left")

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, opens, closes, starts in zip(
                *(batch.column(c) for c in ("text", "opens", "closes", "starts")), strict=True
            ):
                body = np.frombuffer(text.as_buffer(), np.uint8)
                step = np.zeros(len(body) + 1, np.int64)
                if opens.is_valid:
                    for column, sign, add in ((opens, 1, 0), (closes, -1, 0), (starts, 1, 0), (starts, -1, match)):
                        np.add.at(step, column.values.to_numpy() + add, sign)
                gone = np.cumsum(step[:-1]) > 0
                n_spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + bool(len(gone) and gone[0])
                out.append((len(body), int(gone.sum()), n_spans, hashlib.sha256(body[~gone].tobytes()).hexdigest()))
            columns = [pa.array(c) for c in zip(*out, strict=True)] if out else [pa.array([])] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return found.select("doc_id", "text", "opens", "closes", "starts").mapInArrow(cut_out, schema).unionByName(
        whole.select(
            "doc_id",
            F.col("text_bytes").cast("bigint").alias("n_bytes"),
            F.lit(0).cast("bigint").alias("n_removed"),
            F.lit(0).cast("bigint").alias("n_spans"),
            F.sha2("text", 256).alias("kept_sha256"),
        )
    )
