"""A Bloom filter of bounded size over 64-bit values, to keep rows without a partner out of a shuffle.

It never hides a value that was put in. It has sixteen bits for each value up to
``MAX_BYTES`` in all, which bounds what is broadcast; beyond that it lets more rows
through, and the join behind it decides as always.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textbytes import mix

MAX_BYTES = 1 << 24
CHUNK_BYTES = 1 << 14
PROBES = 3


def _place(values: np.ndarray, chunks: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The chunk of each value, and its bits there."""
    h = mix(values.view(np.uint64))
    chunk = (h >> np.uint64(40)).astype(np.int64) % chunks
    bits = []
    for _ in range(PROBES):
        h = mix(h + np.uint64(0x9E3779B97F4A7C15))
        bits.append((h % np.uint64(8 * CHUNK_BYTES)).astype(np.int64))
    return chunk, bits


@dataclass
class BloomFilter:
    chunks: int
    bits: np.ndarray

    def might_hold(self, values: np.ndarray) -> np.ndarray:
        chunk, bits = _place(values, self.chunks)
        found = np.ones(len(values), bool)
        for b in bits:
            found &= (self.bits[chunk * CHUNK_BYTES + (b >> 3)] >> (b & 7).astype(np.uint8)) & 1 == 1
        return found

    def column(self, values: Column, df: DataFrame) -> Column:
        """A boolean column; broadcasts the filter."""
        known = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("boolean")
        def might_hold(x: pd.Series) -> pd.Series:
            return pd.Series(known.value.might_hold(x.to_numpy(np.int64)))

        return might_hold(values)


def build(values: DataFrame) -> BloomFilter:
    """The filter of a data frame with one column of 64-bit numbers without nulls."""
    (name,) = values.columns
    size = min(max(2 * values.count(), CHUNK_BYTES), MAX_BYTES)
    chunks = -(-size // CHUNK_BYTES)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(_place(x, chunks)[0]), batch.column(0)], ["chunk", "x"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            x = batch.column("x").to_numpy(zero_copy_only=False)
            chunk, bits = _place(x, chunks)
            for c in np.unique(chunk):
                own = held.setdefault(int(c), np.zeros(CHUNK_BYTES, np.uint8))
                for b in bits:
                    at = b[chunk == c]
                    np.bitwise_or.at(own, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        rows = [{"chunk": c, "body": body.tobytes()} for c, body in held.items()]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("chunk", "int64"), ("body", "binary")]))

    placed = values.select(F.col(name).alias("x")).mapInArrow(place, "chunk bigint, x bigint")
    out = BloomFilter(chunks, np.zeros(chunks * CHUNK_BYTES, np.uint8))
    for row in placed.repartition("chunk").mapInArrow(fill, "chunk bigint, body binary").collect():
        at = row["chunk"] * CHUNK_BYTES
        out.bits[at : at + CHUNK_BYTES] = np.frombuffer(row["body"], np.uint8)
    return out
