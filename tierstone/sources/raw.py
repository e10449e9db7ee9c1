"""RAW files: JSON lines as this package lands them, and files holding one JSON array."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package

_BLANK = " \t\r"
_END = "end of the array  "
_COMPRESSED = r"\.(gz|bz2|zst|zstd|lz4|snappy|deflate|lzo|xz)$"


# --- lines --------------------------------------------------------------------


def encode_line(payload: Column) -> Column:
    """One line of text for any payload, from which :func:`decode_line` has it back.

    A record stands as it is. A null is the line ``null``. What a line cannot hold or
    what would read as something else (line breaks, blanks alone, no text, a JSON
    string, the text ``null``, a byte-order mark in front) stands as a JSON string.
    """
    plain = (
        ~payload.rlike('[\n\r]|^[﻿"]')
        & (F.btrim(payload, F.lit(_BLANK)) != "")
        & (payload != "null")
    )
    quoted = F.to_json(F.array(payload))
    quoted = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    return F.when(payload.isNull(), "null").when(plain, payload).otherwise(quoted)


def decode_line(line: Column) -> Column:
    text = F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<string>")[0]
    return F.when(line == "null", None).when(line.startswith('"'), text).otherwise(line)


def read_raw_lines(spark: SparkSession, path: str, *, encoded: bool = True) -> DataFrame:
    """One payload per line, as ``write_raw`` was given it. Plain files split across tasks,
    compressed ones, as ``write_raw`` makes them, are spread over tasks whole.

    Blank lines hold no record; ``write_raw`` leaves none. ``encoded=False`` takes the
    lines of other writers as they stand.
    """
    lines = spark.read.text(path, lineSep="\n").where(F.btrim("value", F.lit(_BLANK)) != "")
    value = F.col("value")
    return lines.select((decode_line(value) if encoded else value).alias("payload"))


# --- arrays -------------------------------------------------------------------


def _marked(body: Column) -> Column:
    """A JSON array from its text without brackets, with an end mark as last element.

    The parser stops at the end of an array and accepts what follows, so a text with
    more than one array never shows the mark.
    """
    return F.concat(F.lit("["), body, F.lit(f', "{_END}"]'))


def _unmarked(parsed: Column) -> Column:
    return F.when(F.element_at(parsed, -1) == _END, F.slice(parsed, 1, F.size(parsed) - 1)).otherwise(
        F.raise_error(F.lit("text after the end of a JSON array, or none"))
    )


def read_raw_arrays(spark: SparkSession, path: str, *, positions: bool = False) -> DataFrame:
    """Files that each hold one JSON array -> one ``payload`` row per element.

    Rows come in no order; ``positions`` adds ``file`` and ``position``, by which they
    sort into the order of the file. A file that is not one whole array, or has text
    after it, fails the read (Spark shows no file without bytes; a gate has to find
    those missing). Records may be parted by any white space, or none.

    Files of any size are read in splits and cut after each closing brace. A cut parts
    two records where it lies outside of strings and at the depth of the array. A first
    scan takes from each split what it does to both, one row a split; sums of those over
    the splits of a file tell where each begins. A second scan then cuts out records.
    Only pieces of records that lie in several splits are shuffled, and only the splits
    that hold such pieces are cut a second time. What is broadcast is a row for each
    split that begins or ends unlike most, at most one for each task of the scan. An
    array without any object is one piece, and one task.
    """
    ship_package(spark)
    pieces = spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.concat("value", F.lit("}")).alias("value"),
        F.col("_metadata.file_size").alias("file_size"),
    )
    splits = _split_starts(pieces)
    odd = splits.where(~(F.col("plain") & F.col("whole_ends") & ~F.col("last")))
    state = [F.col(f"s.{n}") for n in ("depth", "quoted", "clean", "last")]
    plain = [F.lit(1), F.lit(0), F.lit(True), F.lit(False)]
    at_split = (F.col("p.file") == F.col("s.file")) & (F.col("p.block") == F.col("s.block"))
    source = pieces.alias("p").join(F.broadcast(odd.alias("s")), at_split, "left")
    whole = source.select(
        "p.file", "p.block", "p.value",
        *(F.coalesce(c, d).alias(d_name) for c, d, d_name in zip(state, plain, _STATE, strict=True)),
    ).mapInArrow(_whole_records, _RECORD)
    whole = whole.select("file", "block", "place", "last", "value")

    cut = F.broadcast(odd.where(~F.col("whole_ends")).alias("s"))
    edges = (
        pieces.alias("p")
        .join(cut, at_split)
        .select("p.file", "p.block", "p.value", *state)
        .mapInArrow(_edge_pieces, _RECORD)
        .alias("p")
        .join(splits.where(~F.col("whole_ends")).alias("s"), at_split)
    )
    parts = F.array_sort(F.collect_list(F.struct("p.block", "p.place", "p.value", "p.last")))
    joined = (
        edges.groupBy("p.file", (F.col("s.record") + F.col("p.place")).alias("record"))
        .agg(parts.alias("parts"))
        .select(
            "file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["place"].alias("place"),
            F.element_at("parts", -1)["last"].alias("last"),
            F.array_join("parts.value", "").alias("value"),
        )
    )
    records = whole.unionByName(joined)

    # A record begins with the comma before it and ends with its brace. The first begins
    # with the bracket; the last text of a file has the other, and a brace put there above.
    # Each step is a projection of its own, so that no text is parsed twice.
    space = F.lit(" \t\r\n")
    first, last, text = (F.col("block") == 0) & (F.col("place") == 0), F.col("last"), F.col("text")
    kept = ["file", "block", "place", "last"]
    records = records.select(*kept, F.btrim("value", space).alias("text"))
    ended = F.when(last, F.btrim(F.left(text, F.length(text) - 1), space)).otherwise(text)
    records = records.select(*kept, ended.alias("text"))
    body = F.substring(text, F.lit(2), F.length(text) - F.when(last, 2).otherwise(1))
    sound = text.startswith(F.when(first, "[").otherwise(",")) & (~last | text.endswith("]"))
    nothing = last & F.when(first, sound & (F.btrim(body, space) == "")).otherwise(text == "]")
    failed = F.raise_error(F.concat(F.lit("not one whole JSON array: "), F.col("file")))
    records = records.select(
        *kept, F.when(nothing, f'["{_END}"]').when(sound, _marked(body)).otherwise(failed).alias("text")
    )
    parsed = F.from_json("text", "array<string>", {"mode": "FAILFAST"})
    records = records.select(*kept, parsed.alias("parsed"))
    elements = _unmarked(F.col("parsed"))
    if not positions:
        return records.select(F.explode(elements).alias("payload"))
    return records.select("file", "block", "place", F.posexplode(elements).alias("element", "payload")).select(
        "payload", "file", F.struct("block", "place", "element").alias("position")
    )


_STATE = ("depth", "quoted", "clean", "last")
_RECORD = "file string, block bigint, place bigint, last boolean, value string"
_PROFILE = (
    "file string, block bigint, file_size bigint, quotes int, net array<bigint>, ends array<bigint>, "
    "cuts array<map<bigint,bigint>>, bytes bigint, pieces bigint"
)


def _split_starts(pieces: DataFrame) -> DataFrame:
    """One row a split: the depth it begins at, whether in a string, and the records before it."""
    rows = pieces.mapInArrow(_profile, _PROFILE)
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)

    def prefix(name: str) -> Column:
        return F.coalesce(F.sum(name).over(before), F.lit(0))

    rows = rows.withColumn("quoted", (prefix("quotes") % 2).cast("int"))
    rows = rows.withColumn("net", F.col("net")[F.col("quoted")])
    rows = rows.withColumn("depth", prefix("net").cast("int"))
    cuts = F.col("cuts")[F.col("quoted")][F.lit(1).cast("bigint") - F.col("depth")]
    rows = rows.withColumn("breaks", F.coalesce(cuts, F.lit(0)))
    rows = rows.withColumn("record", prefix("breaks"))
    rows = rows.withColumn("last", F.lead("block").over(order).isNull())
    # Two arrays in one file can meet a break of depth 1, so the text is checked as well.
    rows = rows.withColumn("plain", (F.col("depth") == 1) & (F.col("quoted") == 0))
    rows = rows.withColumn("clean", F.col("plain") | (F.col("block") == 0))
    # The reader drops a last brace unseen: the file is then a byte longer than its pieces.
    braced = (F.col("total") + F.col("count")).isin(
        F.col("file_size"), F.col("file_size") - 3
    ) & ~F.col("file").rlike(_COMPRESSED)
    rows = rows.withColumn("total", prefix("bytes") + F.col("bytes"))
    rows = rows.withColumn("count", prefix("pieces") + F.col("pieces"))
    closed = (F.col("depth") + F.col("ends")[F.col("quoted")] == 0) & (
        (F.col("quoted") + F.col("quotes")) % 2 == 0
    )
    failed = F.raise_error(F.concat(F.lit("not one whole JSON array: "), F.col("file")))
    rows = rows.withColumn("depth", F.when(F.col("last") & (~closed | braced), failed.cast("int")).otherwise(F.col("depth")))
    following = F.coalesce(F.lead("clean").over(order), F.lit(True))
    return rows.withColumn("whole_ends", F.col("clean") & following).select(
        "file", "block", "depth", "quoted", "record", "clean", "plain", "last", "whole_ends"
    )


_QUOTE, _OPEN, _CLOSE, _ESCAPE = 1, 2, 3, 4
_KIND = np.zeros(256, np.uint8)
for _letters, _kind in ((b'"', _QUOTE), (b"[{", _OPEN), (b"]}", _CLOSE), (b"\\", _ESCAPE)):
    _KIND[list(_letters)] = _kind
_STEP = np.array([0, 0, 1, -1, 0], np.int64)


def _marks(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quotes so far and step of depth at each mark, and the marks that end a piece."""
    kinds = _KIND[data]
    at = np.flatnonzero(kinds)
    kinds = kinds[at]
    escapes = at[kinds == _ESCAPE]
    if len(escapes):
        # Of a run of backslashes every second one is escaped itself.
        n = np.arange(len(escapes))
        run = np.maximum.accumulate(np.where(np.diff(escapes, prepend=-2) != 1, n, 0))
        hidden = escapes[(n - run) % 2 == 0] + 1
        found = np.minimum(np.searchsorted(at, hidden), len(at) - 1)
        found = found[(at[found] == hidden) & (kinds[found] == _QUOTE)]
        kinds[found] = 0
    return np.cumsum(kinds == _QUOTE), _STEP[kinds], np.searchsorted(at, ends - 1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, np.ndarray, np.ndarray]]:
    """``(split, first row, bytes, ends of the pieces in them)`` for each split in a batch."""
    n = batch.num_rows
    if not n:
        return
    file, block = batch.column("file"), batch.column("block")
    changes = np.zeros(n, bool)
    if n > 1:
        same = pc.and_(pc.equal(file[1:], file[:-1]), pc.equal(block[1:], block[:-1]))
        changes[1:] = ~same.to_numpy(zero_copy_only=False)
    starts = [0, *np.flatnonzero(changes).tolist(), n]
    value = batch.column("value").cast(pa.large_string())
    _, offsets, data = value.buffers()
    offsets = np.frombuffer(offsets, np.int64)[value.offset : value.offset + n + 1]
    data = np.frombuffer(data, np.uint8)
    for low, high in zip(starts, starts[1:], strict=False):
        a, b = offsets[low], offsets[high]
        yield (file[low].as_py(), block[low].as_py()), low, data[a:b], offsets[low + 1 : high + 1] - a


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split does, for a start outside of strings and for one inside."""
    names = [part.split()[0] for part in _PROFILE.replace("map<bigint,bigint>", "map").split(", ")]
    kind = pa.schema(
        zip(
            names,
            [
                pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                pa.list_(pa.map_(pa.int64(), pa.int64())), pa.int64(), pa.int64(),
            ],
            strict=True,
        )
    )
    split, row = None, None

    def done() -> pa.RecordBatch:
        values = dict(zip(names, (*split, *row), strict=True))
        values["cuts"] = [list(c.items()) for c in values["cuts"]]
        return pa.RecordBatch.from_pylist([values], kind)

    for batch in batches:
        for key, low, data, ends in _runs(batch):
            if key != split:
                if split:
                    yield done()
                split = key
                row = [batch.column("file_size")[low].as_py(), 0, [0, 0], [0, 0], [Counter(), Counter()], 0, 0]
            quotes, steps, cuts = _marks(data, ends)
            quotes = quotes + row[1]
            row[1] = int(quotes[-1]) % 2
            for inside in (0, 1):
                outside = quotes % 2 == inside
                depth = np.cumsum(np.where(outside, steps, 0)) + row[2][inside]
                row[2][inside] = int(depth[-1])
                row[3][inside] = int(depth[-1]) + int(outside[-1])  # without the last brace
                levels, n = np.unique(depth[cuts][outside[cuts]], return_counts=True)
                row[4][inside].update(dict(zip(levels.tolist(), n.tolist(), strict=True)))
            row[5] += len(data) - len(ends)
            row[6] += len(ends)
    if split:
        yield done()


def _records(
    batches: Iterator[pa.RecordBatch], whole: bool
) -> Iterator[pa.RecordBatch]:
    """The records that lie whole in a split, or else the pieces of the others."""
    split, last, clean = None, False, True
    quoted = depth = place = 0
    pending: list[bytes] = []

    def rows(values: pa.Array, first: int, ends_file: bool) -> pa.RecordBatch:
        n = len(values)
        columns = [
            pa.array([split[0]] * n, pa.string()), pa.array([split[1]] * n, pa.int64()),
            pa.array(np.arange(first, first + n)), pa.array([ends_file] * n, pa.bool_()), values,
        ]
        return pa.RecordBatch.from_arrays(columns, ["file", "block", "place", "last", "value"])

    def rest() -> Iterator[pa.RecordBatch]:
        """What stands after the last break of a split."""
        complete = last and (clean or place > 0)
        if pending and complete == whole:
            yield rows(pa.array([b"".join(pending)]).cast(pa.string()), place, last)

    for batch in batches:
        for key, low, data, ends in _runs(batch):
            if key != split:
                if split:
                    yield from rest()
                split, pending, place = key, [], 0
                depth, quoted, clean, last = (batch.column(name)[low].as_py() for name in _STATE)
            quotes, steps, cuts = _marks(data, ends)
            quotes = quotes + quoted
            quoted = int(quotes[-1]) % 2
            outside = quotes % 2 == 0
            levels = np.cumsum(np.where(outside, steps, 0)) + depth
            depth = int(levels[-1])
            breaks = ends[outside[cuts] & (levels[cuts] == 1)]
            if len(breaks):
                head = b"".join([*pending, data[: breaks[0]].tobytes()])
                pending = []
                if (clean or place > 0) == whole:
                    yield rows(pa.array([head]).cast(pa.string()), place, False)
                if whole and len(breaks) > 1:
                    start = breaks[0]
                    offsets = pa.py_buffer((breaks - start).astype(np.int32).tobytes())
                    body = pa.py_buffer(data[start : breaks[-1]].tobytes())
                    yield rows(
                        pa.StringArray.from_buffers(len(breaks) - 1, offsets, body), place + 1, False
                    )
                place += len(breaks)
            tail = data[breaks[-1] if len(breaks) else 0 :]
            if len(tail):
                pending.append(tail.tobytes())
    if split:
        yield from rest()


def _whole_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _records(batches, True)


def _edge_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _records(batches, False)
