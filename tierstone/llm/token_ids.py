"""Token ids of whole texts in compressed binary files.

Texts are encoded by a public tokenizer; ids are counted over all documents and coded
by one canonical Huffman code. Files hold ranges of document ids in ascending order,
nulls first, and each stands on its own:

* ``TKH1``, then little-endian 64-bit numbers: documents, ids before the first one of
  this file, ids in it, and bytes of the packed code lengths that follow;
* for each document its id with a null mark, its number of ids and of blocks, and the
  blocks with their sizes (see ``huffman``).

A byte-level tokenizer splits a text at white space before anything else, so pieces that
begin at a space are encoded on their own and remembered, about ``REMEMBERED`` to twice
that many in each worker; how much is remembered does not change a result. Texts that hold
one of the tokenizer's added tokens as a literal get its id there, as from the tokenizer
itself (``add_special_tokens=False``).

Cases: a null text is an empty one and has the end id only. Rows that are repeated, or
share an id, are documents of their own, ordered by their content. An empty table gives
no files and an empty result. Other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_scratch
from .files import create, open_file
from .huffman import BLOCK, Codec, code_lengths

END_ID = 2
REMEMBERED = 400_000
FILE_IDS = 1 << 20
MAX_FILES = 20_000
MAGIC = b"TKH1"

_loaded: dict[str, PieceEncoder] = {}
#: White space next to a space: the places where a split at each space would be wrong.
_WIDE = re.compile(r"[^\S ] | [^\S ]")
#: Fixed value: the pattern by which byte-level vocabularies of this kind part words.
_WORDS = regex.compile(r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_EDGES = re.compile(r"(?<!\s)(?= )|(?= \S)")


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it is
    printable Latin-1, else the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + n for n, b in enumerate(others)}


class _Memory(dict):
    """What a function gave for recent arguments: those used since the last but one clearing."""

    def __init__(self, learn: Callable[[str], bytes]):
        super().__init__()
        self._learn = learn
        self._older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= REMEMBERED:
            self._older = dict(self)
            self.clear()
        found = self._older.get(key)
        self[key] = found = self._learn(key) if found is None else found
        return found


class PieceEncoder:
    """Encodes texts by their pieces and remembers those it has met, as packed ids.

    A piece met for the first time is split into words by the tokenizer's own pattern,
    and words not met before go through its model. Only for byte-level vocabularies with
    that pattern; others encode whole texts.
    """

    def __init__(self, path: str, added_tokens: bool = False):
        """``added_tokens``: whether literals of added tokens in a text get the ids of these."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = not added_tokens
        added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._added = re.compile("|".join(map(re.escape, added))) if added_tokens and added else None
        parts = json.loads(self._tokenizer.to_str())
        splits = parts["pre_tokenizer"] or {}
        self._by_pieces = (
            splits.get("type") == "ByteLevel" and splits["use_regex"] and not splits["add_prefix_space"]
            and not parts["normalizer"] and parts["model"]["type"] == "BPE"
        )
        letters, tokenize = _byte_letters(), self._tokenizer.model.tokenize

        def encode_word(word: str) -> bytes:
            tokens = tokenize(word.encode().decode("latin-1").translate(letters))
            return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

        words = _Memory(encode_word)

        def encode_piece(piece: str) -> bytes:
            return b"".join([words[w] for w in _WORDS.findall(piece)])

        self._pieces = _Memory(encode_piece)
        #: Pieces that begin with a space, by what follows it.
        self._spaced = _Memory(lambda rest: encode_piece(" " + rest))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        if not self._by_pieces:
            found = [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found])
        bodies = []
        piece, spaced = self._pieces.__getitem__, self._spaced.__getitem__
        for text in texts:
            if self._added is not None and self._added.search(text):
                ids = self._tokenizer.encode(text, add_special_tokens=False).ids
                bodies.append(struct.pack(f"<{len(ids)}I", *ids))
            elif "  " in text or _WIDE.search(text):
                bodies.append(b"".join([piece(p) for p in _EDGES.split(text) if p]))
            else:
                first, *rest = text.split(" ")
                bodies.append(piece(first) + b"".join(map(spaced, rest)))
        sizes = np.array([len(b) // 4 for b in bodies], np.int64)
        return np.frombuffer(b"".join(bodies), "<u4"), sizes


def _encoder(path: str) -> PieceEncoder:
    if path not in _loaded:
        _loaded[path] = PieceEncoder(path, added_tokens=True)
    return _loaded[path]


def _texts(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """Slices of a text column of about ``limit`` characters, or one text, with their first row."""
    low, size, part = 0, 0, []
    for n, text in enumerate(column.to_pylist()):
        part.append(text or "")
        size += len(part[-1])
        if size >= limit:
            yield low, part
            low, size, part = n + 1, 0, []
    if part:
        yield low, part


def encode(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id, n, ids``: the ids of each text as packed 32-bit numbers, or 16-bit where all fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            for low, texts in _texts(batch.column("text")):
                ids, sizes = encoder.encode(texts)
                ends = np.cumsum(sizes)
                ids = np.insert(ids, ends, end_id).astype(np.uint32)
                sizes, ends = sizes + 1, ends + np.arange(1, len(sizes) + 1)
                wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
                packed = ids.astype("<u4" if wide else "<u2")
                rows = [packed[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, len(texts)), pa.array(sizes), pa.array(rows, pa.binary())],
                    ["doc_id", "n", "ids"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n bigint, ids binary")


def _unpack(body: bytes, n: int) -> np.ndarray:
    return np.frombuffer(body, "<u4" if len(body) == 4 * n else "<u2")


def count_ids(encoded: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents; as many numbers as the vocabulary has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            sizes, bodies = batch.column("n").to_numpy(), batch.column("ids").to_pylist()
            for low in range(0, len(sizes), 256):
                now = slice(low, low + 256)
                found = np.bincount(np.concatenate([_unpack(b, n) for b, n in zip(bodies[now], sizes[now], strict=True)]))
                if len(found) > len(total):
                    total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
                total[: len(found)] += found
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "c"])

    rows = encoded.select("n", "ids").mapInArrow(run, "id bigint, c bigint")
    found = rows.groupBy("id").agg(F.sum("c").alias("c")).collect()
    counts = np.zeros(max((r["id"] for r in found), default=0) + 1, np.int64)
    for r in found:
        counts[r["id"]] = r["c"]
    return counts


def write_files(encoded: DataFrame, folder: str) -> DataFrame:
    """Write the files of ``encoded`` below a folder; the manifest ``path, file, docs, ids``."""
    spark = encoded.sparkSession
    lengths = code_lengths(count_ids(encoded))
    total = encoded.agg(F.sum("n"), F.count("doc_id")).first()
    n_files = int(min(max((total[0] or 0) // FILE_IDS, 1), MAX_FILES))
    cuts = []
    if n_files > 1 and total[1]:
        shares = [i / n_files for i in range(1, n_files)]
        cuts = encoded.agg(F.percentile_approx("doc_id", shares, 10 * n_files)).first()[0]
    edges = np.unique(np.array(cuts, np.int64))
    code = spark.sparkContext.broadcast((lengths, edges))

    def file_of(ids: pa.Array) -> np.ndarray:
        """0 for null and the smallest ids; a cut belongs to the file before it."""
        nulls = ids.is_null().to_numpy(zero_copy_only=False)
        values = ids.fill_null(0).to_numpy(zero_copy_only=False)
        return np.where(nulls, 0, np.searchsorted(code.value[1], values, "left"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = pa.array(file_of(batch.column("doc_id").cast(pa.int64())))
            yield pa.RecordBatch.from_arrays([files, batch.column("n")], ["file", "n"])

    sums = encoded.select("doc_id", "n").mapInArrow(number, "file bigint, n bigint")
    sizes = dict(sums.groupBy("file").agg(F.sum("n")).collect())
    starts, at = {}, 0
    for file in sorted(sizes):
        starts[file] = at
        at += sizes[file]
    begin = spark.sparkContext.broadcast(starts)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(code.value[0])
        for batch in batches:
            sizes = batch.column("n").to_numpy()
            bodies = batch.column("ids").to_pylist()
            files = file_of(batch.column("doc_id").cast(pa.int64()))
            low = 0
            while low < len(sizes):
                high = low + max(1, int(np.searchsorted(np.cumsum(sizes[low : low + 512]), 1 << 17, "right")))
                ids = np.concatenate([_unpack(b, n) for b, n in zip(bodies[low:high], sizes[low:high], strict=True)])
                whole, rest = np.divmod(sizes[low:high], BLOCK)
                cut = np.concatenate([[BLOCK] * w + [r] * int(r > 0) for w, r in zip(whole, rest, strict=True)])
                blocks = codec.encode(ids.astype(np.int64), cut.astype(np.int64))
                rows, take = [], 0
                for n in whole + (rest > 0):
                    own = blocks[take : take + n]
                    rows.append(b"".join(struct.pack("<I", len(b)) + b for b in own))
                    take += n
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(files[low:high]), batch.column("doc_id").slice(low, high - low),
                        batch.column("n").slice(low, high - low), pa.array(rows, pa.binary()),
                    ],
                    ["file", "doc_id", "n", "body"],
                )
                low = high

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = zlib.compress(code.value[0].astype(np.uint8).tobytes())
        out = None
        done: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None or row["file"] != done[-1]["file"]:
                    if out is not None:
                        out.close()
                    path, out = create(folder, ".tkh")
                    done.append({"path": path, "file": row["file"], "docs": 0, "ids": 0})
                    out.write(MAGIC + struct.pack("<QQ", begin.value[row["file"]], len(packed)) + packed)
                null = row["doc_id"] is None
                out.write(struct.pack("<?qQQ", null, row["doc_id"] or 0, row["n"], len(row["body"])))
                out.write(row["body"])
                done[-1]["docs"] += 1
                done[-1]["ids"] += row["n"]
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_pylist(done, schema=manifest)

    manifest = pa.schema([("path", "string"), ("file", "int64"), ("docs", "int64"), ("ids", "int64")])
    kind = encoded.schema["doc_id"].dataType.simpleString()
    blocks = encoded.mapInArrow(compress, f"file bigint, doc_id {kind}, n bigint, body binary")
    return (
        blocks.repartition("file")
        .sortWithinPartitions("file", F.col("doc_id").asc_nulls_first(), "n", "body")
        .mapInArrow(write, "path string, file bigint, docs bigint, ids bigint")
    )


@lru_cache(maxsize=2)
def _codec(packed: bytes) -> Codec:
    return Codec(np.frombuffer(zlib.decompress(packed), np.uint8))


def read_file(path: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """``(doc_id, start, ids)`` of each document of a file, in the order they were written."""
    with open_file(path) as stream:
        if stream.read(4) != MAGIC:
            raise ValueError(f"{path} is no token file")
        start, size = struct.unpack("<QQ", stream.read(16))
        codec = _codec(stream.read(size))
        head = struct.Struct("<?qQQ")
        more = True
        while more:
            # Some hundred thousand ids at a time decode side by side.
            held: list[tuple[int | None, int]] = []
            blocks: list[bytes] = []
            n_ids = 0
            while n_ids < 1 << 19:
                raw = stream.read(head.size)
                if not raw:
                    more = False
                    break
                null, doc_id, n, size = head.unpack(raw)
                body, at, count = stream.read(size), 0, 0
                while at < size:
                    (length,) = struct.unpack_from("<I", body, at)
                    blocks.append(body[at + 4 : at + 4 + length])
                    at, count = at + 4 + length, count + 1
                held.append((None if null else doc_id, count))
                n_ids += n
            decoded, take = codec.decode(blocks), 0
            for doc_id, count in held:
                ids = np.concatenate([np.zeros(0, np.uint32), *decoded[take : take + count]])
                yield doc_id, start, ids
                start, take = start + len(ids), take + count


def read_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document in the files of a manifest."""
    schema = pa.schema([("doc_id", "int64"), ("start", "int64"), ("n_tokens", "int64"), ("ids_crc32", "int64")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = [
                    (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for doc_id, start, ids in read_file(path)
                ]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    # One row is one file: enough of them for every task.
    files = manifest.select("path").repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4)
    return files.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def store(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Encode, count, write the files, read them back."""
    spark = docs.sparkSession
    base = shared_scratch(spark, "token_ids")
    encode(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(f"{base}/encoded")
    encoded = spark.read.parquet(f"{base}/encoded")
    write_files(encoded, f"{base}/files").write.parquet(f"{base}/manifest")
    return read_files(spark.read.parquet(f"{base}/manifest"))
