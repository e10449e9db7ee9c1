"""Statistics of whole texts, and labelled rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb

#: Characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5

STATISTICS = (
    "n_chars n_words word_chars n_symbols n_digits n_upper n_stops n_lines n_dup_lines "
    "n_repeat_words n_distinct n_short n_long n_urls n_wide n_ended"
).split()


def _flag(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_IS_SYMBOL = _flag(SYMBOLS)
_IS_DIGIT = _flag(b"0123456789")
_IS_UPPER = _flag(bytes(range(65, 91)))
_IS_STOP = _flag(b".,;:!?")
_IS_URL = _flag(b"/@_=")
_IS_END = _flag(b'.!?"')


def _repeats(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item, whether its key is in its row more than once, and whether it was before."""
    order = np.lexsort((keys, rows))
    r, k = rows[order], keys[order]
    same = (r[1:] == r[:-1]) & (k[1:] == k[:-1])
    many, later = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
    many[order[1:]] |= same
    many[order[:-1]] |= same
    later[order[1:]] = same
    return many, later


def _piece_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    out = np.zeros((n, len(STATISTICS)), np.int64)
    at = {name: i for i, name in enumerate(STATISTICS)}
    if not len(data):
        return out

    def put(name: str, values: np.ndarray) -> None:
        out[:, at[name]] = values

    def count(rows: np.ndarray) -> np.ndarray:
        return np.bincount(rows, minlength=n)

    starts, ends, rows = tb.word_spans(data, offsets)
    first_bytes = (data & 0xC0) != 0x80
    put("n_chars", tb.per_row(first_bytes, offsets))
    put("n_words", count(rows))
    put("word_chars", tb.per_row(first_bytes & ~tb.SEPARATOR[data], offsets))
    for name, table in (
        ("n_symbols", _IS_SYMBOL), ("n_digits", _IS_DIGIT), ("n_upper", _IS_UPPER),
        ("n_stops", _IS_STOP), ("n_urls", _IS_URL),
    ):
        put(name, tb.per_row(table[data], offsets))
    put("n_wide", tb.per_row(data >= 0xC0, offsets))
    put("n_short", count(rows[ends - starts <= 3]))
    put("n_long", count(rows[ends - starts > 12]))

    hashes = tb.SpanHash(data)
    words = hashes.spans(starts, ends)
    put("n_distinct", out[:, at["n_words"]] - count(rows[_repeats(rows, words)[1]]))

    # Windows of words: those that are in one row only, by a hash of their words.
    m = len(words) - WINDOW + 1
    if m > 0:
        inside = rows[:m] == rows[WINDOW - 1 :]
        window = np.zeros(m, np.uint64)
        for j in range(WINDOW):
            window = tb.mix(window + words[j : j + m])
        starts_at = np.flatnonzero(inside)
        many, _ = _repeats(rows[:m][starts_at], window[starts_at])
        covered = np.zeros(len(words) + 1, np.int64)
        repeated = starts_at[many]
        np.add.at(covered, repeated, 1)
        np.add.at(covered, repeated + WINDOW, -1)
        put("n_repeat_words", count(rows[np.cumsum(covered[:-1]) > 0]))

    # Lines with a word: from each row's start or line break to the next.
    breaks = np.flatnonzero(data == 10)
    line_starts = np.union1d(offsets[:-1], breaks + 1)
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.append(line_starts[1:], len(data))
    closed = data[line_ends - 1] == 10
    line_rows = np.searchsorted(offsets, line_starts, "right") - 1
    has_word = np.searchsorted(starts, line_starts) < np.searchsorted(starts, line_ends)
    line_starts, line_ends, closed, line_rows = (
        x[has_word] for x in (line_starts, line_ends, closed, line_rows)
    )
    line_ends = line_ends - closed
    put("n_lines", count(line_rows))
    put("n_dup_lines", count(line_rows[_repeats(line_rows, hashes.spans(line_starts, line_ends))[1]]))
    put("n_ended", count(line_rows[_IS_END[data[line_ends - 1]]]))
    return out


def statistics(column: pa.Array) -> np.ndarray:
    """A row of ``STATISTICS`` for each text of a column; a null text counts as empty."""
    data, offsets = tb.text_arrays(column)
    out = [np.zeros((0, len(STATISTICS)), np.int64)]
    out += [_piece_statistics(part, ends) for _, _, part, ends in tb.pieces(data, offsets)]
    return np.concatenate(out)


def ratios(stats: np.ndarray) -> np.ndarray:
    """Statistics as features that do not depend on a text's length, but for its logarithm."""
    s = {name: stats[:, i].astype(float) for i, name in enumerate(STATISTICS)}
    words, chars, lines = (np.maximum(s[n], 1) for n in ("n_words", "n_chars", "n_lines"))
    word_chars = np.maximum(s["word_chars"], 1)
    columns = [
        np.log1p(s["n_words"]), s["word_chars"] / words, s["n_symbols"] / words,
        s["n_digits"] / word_chars, s["n_upper"] / word_chars, s["n_stops"] / words,
        np.log1p(s["n_words"] / lines), s["n_dup_lines"] / lines, s["n_repeat_words"] / words,
        s["n_distinct"] / np.sqrt(words), s["n_short"] / words, s["n_long"] / words,
        s["n_urls"] / words, s["n_wide"] / word_chars, s["n_ended"] / lines, chars / words,
    ]
    return np.stack(columns, 1)


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of the rows and an array ``stats``, in the order of ``STATISTICS``."""
    columns = list(dict.fromkeys([*keep, "text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = statistics(batch.column("text"))
            offsets = pa.array(np.arange(len(table) + 1, dtype=np.int32) * len(STATISTICS))
            values = pa.ListArray.from_arrays(offsets, pa.array(table.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), values], [*keep, "stats"]
            )

    rows = docs.select(*columns)
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return rows.mapInArrow(run, ", ".join([*fields, "stats array<bigint>"]))


def label_rows(labels: DataFrame, column: str) -> DataFrame:
    """One row per labelled document: the largest of its labels that are not null."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(column).cast("int").alias("label"))
    )
