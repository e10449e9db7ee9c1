"""Alignment of two tokenizers' tokens over the bytes of whole documents.

Vocabulary A is a byte-level one of the ``tokenizers`` library and reads a space and the
text; B is a ``sentencepiece`` model and adds that space itself. Neither joins anything
across a place where a space follows what is no white space, so the words between such
places are encoded on their own, each distinct one once, and about ``REMEMBERED`` of them
are remembered in a worker. That changes no result; where B's pieces could span such a
place, loading fails.

Bytes at which tokens of both end cut a document into groups; overlapping tokens are links
(see ``fragments``). A text of more than ``RANGE`` bytes is cut into byte ranges of that
size, whatever lies there, which tasks align on their own, each from the nearest such place
before it to the nearest after it. Their fragments are composed in rounds of ``FAN`` until
one is left of each document; the text of the groups is hashed in one pass over the ranges
in order, of which one is held at a time. A range without such a place joins the next.

A table keeps the pairs of each document. From it comes, added up in tasks first, in how
many documents each pair of ids is linked; that table is broadcast in parts of at most
``PAIRS`` pairs, cut between A ids, and what the parts give a document is added up.

Cases: a text that is null or empty, or of which the joined bytes of either vocabulary's
tokens are not a space and the text, has no tokens: zeros, and an empty ``groups_sha256``.
Rows that are repeated or share an id are documents of their own, each counted; a null id
stays null. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_scratch
from . import textbytes as tb
from .fragments import Fragment, Tokens, align, compose, count_pairs, fragment, spans
from .token_ids import _byte_letters

RANGE = 1 << 16
FAN = 8
PAIRS = 1 << 22
REMEMBERED = 300_000
LONG_WORD = 256

_SPACE = 32
_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[32, 9, 10, 11, 12, 13]] = True
# The other characters of Unicode's White_Space, and U+180E, in UTF-8.
_WIDE_SPACE = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe1\xa0\x8e"] + [
    chr(c).encode() for c in (*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
]

_loaded: dict[tuple[str, str], Vocabularies] = {}


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where words begin in rows that each begin with a space: there, and at every space
    after something that is no white space."""
    at = np.flatnonzero(data == _SPACE)
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    before = data[np.maximum(at - 1, 0)]
    good = ~_ASCII_SPACE[before]
    for shape in _WIDE_SPACE:
        alike = before == shape[-1]
        for back, byte in enumerate(reversed(shape[:-1]), 2):
            alike &= data[np.maximum(at - back, 0)] == byte
        good &= ~alike
    return at[good | first[at]]


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and words met before."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(a_path)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {letter: byte for byte, letter in _byte_letters().items()}
        names = {i: name for name, i in self._a.get_vocab(with_added_tokens=False).items()}
        a_bytes = [
            bytes(byte_of[ord(c)] for c in names[i]) if all(ord(c) in byte_of for c in names.get(i, "\0")) else b""
            for i in range(max(names) + 1)
        ]
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"pieces of {b_path} go on after a space, so words have no tokens of their own")
        b_bytes = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self._a_tokens, self._b_tokens = a_bytes, b_bytes
        self.a_ends, self.b_ends = self._ends(a_bytes), self._ends(b_bytes)
        # What B has for a space that ends a text; an empty text gets no space from it.
        self._b_space = self._b.encode("x ")[len(self._b.encode("x")) :]
        self._words: dict[bytes, bytes | None] = {}
        self._older: dict[bytes, bytes | None] = {}

    @staticmethod
    def _ends(tokens: list[bytes]) -> np.ndarray:
        ends = np.zeros(len(tokens) + 1, np.int64)
        np.cumsum([len(t) for t in tokens], out=ends[1:])
        return ends

    def _learn(self, words: list[bytes]) -> list[bytes | None]:
        """For each word how many ids A has for it, these and B's, packed as 32-bit numbers;
        None where the bytes of either are not a space and the word."""
        texts = [w.decode(errors="replace") for w in words]
        a = [e.ids for e in self._a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        b = [ids if t else self._b_space for t, ids in zip(texts, self._b.encode(texts, num_threads=1), strict=True)]
        found: list[bytes | None] = []
        of_a, of_b = self._a_tokens.__getitem__, self._b_tokens.__getitem__
        for word, x, y in zip(words, a, b, strict=True):
            same = b"".join(map(of_a, x)) == b" " + word == b"".join(map(of_b, y))
            found.append(array("I", [len(x), *x, *y]).tobytes() if same else None)
        return found

    def _known(self, words: list[bytes]) -> list[bytes | None]:
        if len(self._words) > REMEMBERED:
            self._older, self._words = self._words, {}
        memory, older = self._words, self._older
        new = []
        for w in words:
            if w not in memory:
                if w in older:
                    memory[w] = older[w]
                else:
                    new.append(w)
        learned = dict(zip(new, self._learn(new), strict=True)) if new else {}
        memory.update(learned)
        out = [memory[w] for w in words]
        for w in new:
            if len(w) > LONG_WORD:
                del memory[w]
        return out

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[Tokens, np.ndarray]:
        """Tokens of rows that each begin with a space, with ends in their joined bytes, and
        which rows are sound; others give no tokens."""
        starts = word_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        row = np.searchsorted(offsets, starts, "right") - 1
        one, two = (tb.SpanHash(data, salt).spans(starts, ends) for salt in (0, 1))
        keys, first, which = np.unique(one, return_index=True, return_inverse=True)
        if not np.array_equal(two, two[first][which]):  # two words of one hash
            _, first, which = np.unique(np.stack([one, two], 1), axis=0, return_index=True, return_inverse=True)
        raw = data.tobytes()
        found = self._known([raw[s + 1 : e] for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
        broken = np.array([f is None for f in found], bool)
        sound = np.ones(len(offsets) - 1, bool)
        sound[row[broken[which]]] = False
        use = sound[row]

        ids = np.frombuffer(b"".join([f or b"" for f in found]), np.uint32).astype(np.int64)
        all_sizes = np.array([len(f) // 4 if f else 0 for f in found], np.int64)
        begins = np.cumsum(all_sizes) - all_sizes
        a_sizes = np.zeros(len(found), np.int64)
        a_sizes[~broken] = ids[begins[~broken]]
        b_sizes = np.maximum(all_sizes - 1 - a_sizes, 0)

        def stream(first: np.ndarray, sizes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            of = which[use]
            taken = ids[spans(first[of], sizes[of])]
            # Ends in the joined bytes of all rows: from the start of each word on.
            lengths = table[taken + 1] - table[taken]
            sums = np.cumsum(lengths)
            n = sizes[of]
            last = np.cumsum(n)
            word_total = sums[last - 1] if len(last) else last
            before = np.concatenate([[0], word_total[:-1]]) if len(last) else last
            return taken, sums + np.repeat(starts[use] - before, n)

        a, a_ends = stream(begins + 1, a_sizes, self.a_ends)
        b, b_ends = stream(begins + 1 + a_sizes, b_sizes, self.b_ends)
        return Tokens(a, a_ends, b, b_ends), sound


def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    """Both, loaded once in each worker."""
    key = a_path, b_path
    if key not in _loaded:
        _loaded[key] = Vocabularies(*key)
    return _loaded[key]


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with a space put before each."""
    n = len(offsets) - 1
    out = np.full(len(data) + n, _SPACE, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = data
    return out, offsets + np.arange(n + 1)


def _pack_pairs(keys: np.ndarray, times: np.ndarray) -> bytes:
    """A ids, B ids and links of the pairs of a document, column by column."""
    return np.concatenate([keys >> 32, keys & 0xFFFFFFFF, times]).astype("<u4").tobytes()


def _unpack_pairs(bodies: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, links and row of the pairs of many documents."""
    parts = [np.frombuffer(b, "<u4").reshape(3, -1) for b in bodies.to_pylist()]
    rows = np.repeat(np.arange(len(parts)), [p.shape[1] for p in parts])
    all_ = np.concatenate(parts, 1).astype(np.int64) if parts else np.zeros((3, 0), np.int64)
    return all_[0] << 32 | all_[1], all_[2], rows


_COUNTS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs binary"
_NAMES = [c.split()[0] for c in _COUNTS.split(", ")]


def _align_rows(data: np.ndarray, offsets: np.ndarray, both: Vocabularies) -> list[pa.Array]:
    """The columns of ``_COUNTS`` for rows of a bounded size, whole documents each."""
    n = len(offsets) - 1
    filled = np.diff(offsets) > 0
    full, ends = spaced(data, np.concatenate([[0], offsets[1:][filled]]))
    at = np.flatnonzero(filled)
    tokens, sound = both.tokens(full, ends) if len(at) else (None, None)
    counts = np.zeros((4, n), np.int64)
    digests, pairs = np.full(n, "", object), np.full(n, b"", object)
    if tokens:
        aligned = align(tokens)

        def per_row(values: np.ndarray) -> np.ndarray:
            return np.diff(np.searchsorted(values, ends, "right"))

        link_rows = np.repeat(np.arange(len(at)), per_row(aligned.link_ends))
        for k, values in enumerate((tokens.a_ends, tokens.b_ends, aligned.common, aligned.link_ends)):
            counts[k, at] = per_row(values)
        # The text of each row, its groups' texts without the last semicolon.
        text_ends = aligned.text_ends[np.cumsum(counts[2, at]) - 1]
        keys, code = np.unique(aligned.links, return_inverse=True)
        found, times = np.unique(link_rows * len(keys) + code, return_counts=True)
        bounds = np.searchsorted(found, np.arange(len(at) + 1) * len(keys))
        start = 0
        for i, row in enumerate(at.tolist()):
            if not sound[i]:
                continue
            digests[row] = hashlib.sha256(aligned.text[start : text_ends[i] - 1]).hexdigest()
            start = text_ends[i]
            low, high = bounds[i], bounds[i + 1]
            pairs[row] = _pack_pairs(keys[found[low:high] % len(keys)], times[low:high])
    return [*(pa.array(c) for c in counts), pa.array(digests, pa.string()), pa.array(pairs, pa.binary())]


def align_documents(docs: DataFrame, a_path: str, b_path: str, range_bytes: int = RANGE) -> DataFrame:
    """``doc_id``, the columns of ``_COUNTS`` and a number ``row`` for every row, from a table
    in the shared folder. ``pairs`` holds the linked id pairs of a document, see ``pairs_of``."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(a_path, b_path)
        for batch in batches:
            data, offsets = tb.text_arrays(batch.column("text"))
            for low, high, part, ends in tb.pieces(data, offsets):
                columns = _align_rows(part, ends, both)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), *columns], ["doc_id", *_NAMES]
                )

    short = docs.where(size <= range_bytes).mapInArrow(whole, f"doc_id {kind}, {_COUNTS}")
    long = _align_long(docs.where(size > range_bytes), kind, a_path, b_path, range_bytes)
    path = shared_scratch(spark, "alignment")
    rows = short.unionByName(long).withColumn("row", F.monotonically_increasing_id())
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


# --- very long documents --------------------------------------------------------


def ranges_of(full: np.ndarray, size: int) -> list[tuple[int, int, int, int]]:
    """``(low, high, from, to)``: byte ranges, and the words that have a token ending in them."""
    starts = word_starts(full, np.array([0, len(full)]))
    starts = np.append(starts, len(full))
    bounds = [0]
    for high in range(size, len(full), size):
        # Only where a word has begun since the last bound; else the range goes on.
        if np.searchsorted(starts, high, "right") > np.searchsorted(starts, bounds[-1], "right"):
            bounds.append(high)
    bounds.append(len(full))
    out = []
    for low, high in zip(bounds, bounds[1:], strict=False):
        first = starts[np.searchsorted(starts, low, "right") - 1]
        out.append((low, high, int(first), int(starts[np.searchsorted(starts, high, "left")])))
    return out


def _align_long(docs: DataFrame, kind: str, a_path: str, b_path: str, range_bytes: int) -> DataFrame:
    spark = docs.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "number", "place", "parts", "low", "high", "begin", "body"]
        for batch in batches:
            for i in range(batch.num_rows):
                full = np.frombuffer(b" " + batch.column("text")[i].as_buffer().to_pybytes(), np.uint8)
                found = ranges_of(full, range_bytes)
                number = batch.column("number")[i].as_py()
                for place, (low, high, begin, end) in enumerate(found):
                    row = [[number], [place], [len(found)], [low], [high], [begin], [full[begin:end].tobytes()]]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(i, 1), *(pa.array(v) for v in row)], names
                    )

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(a_path, b_path)
        for batch in batches:
            bodies, texts = [], []
            for body, low, high, begin in zip(
                *(batch.column(c).to_pylist() for c in ("body", "low", "high", "begin")), strict=True
            ):
                found, text = _leaf(both, np.frombuffer(body, np.uint8), low - begin, high - begin, begin)
                bodies.append(found.pack())
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "number", "place", "parts")), pa.array(bodies, pa.binary()), pa.array(texts, pa.binary())],
                ["doc_id", "number", "place", "parts", "fragment", "text"],
            )

    numbered = docs.withColumn("number", F.monotonically_increasing_id())
    ids = f"doc_id {kind}, number bigint, place bigint, parts bigint"
    pieces = numbered.mapInArrow(cut, f"{ids}, low bigint, high bigint, begin bigint, body binary")
    path = shared_scratch(spark, "alignment_ranges")
    # The ranges of a document go to all tasks alike.
    pieces.repartition("number", "place").mapInArrow(leaves, f"{ids}, fragment binary, text binary").write.option(
        "compression", "zstd"
    ).parquet(path)
    leaf_rows = spark.read.parquet(path)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Digests of documents from their ranges, which come in order."""
        number, digest, open_, held = None, None, None, b""

        def feed(text: bytes) -> None:
            nonlocal held
            if text:  # the last semicolon waits for what follows
                digest.update(held + text[:-1])
                held = text[-1:]

        for batch in batches:
            done: list[tuple[int, str]] = []
            for i, body, text in zip(*(batch.column(c).to_pylist() for c in ("number", "fragment", "text")), strict=True):
                if i != number:
                    if number is not None:
                        done.append((number, digest.hexdigest()))
                    number, digest, open_, held = i, hashlib.sha256(), Fragment(), b""
                leaf = Fragment.unpack(body)
                leaf.keys = leaf.times = np.zeros(0, np.int64)
                open_, between = compose(open_, leaf)
                open_.keys = open_.times = np.zeros(0, np.int64)
                feed(between)
                feed(text)
            yield pa.RecordBatch.from_pydict({"number": [d[0] for d in done], "digest": [d[1] for d in done]}, _DIGEST)
        if number is not None:
            yield pa.RecordBatch.from_pydict({"number": [number], "digest": [digest.hexdigest()]}, _DIGEST)

    digests = (
        leaf_rows.select("number", "place", "fragment", "text")
        .repartition("number")
        .sortWithinPartitions("number", "place")
        .mapInArrow(hashed, "number bigint, digest string")
    )

    def folded(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        total = Fragment.unpack(rows["fragment"].iloc[0])
        for body in rows["fragment"].iloc[1:]:
            total, _ = compose(total, Fragment.unpack(body))
        return pd.DataFrame(
            {"number": rows["number"].iloc[:1], "place": rows["place"].iloc[:1] // FAN, "fragment": [total.pack()]}
        )

    most = leaf_rows.agg(F.max("parts")).first()[0] or 0
    tree = leaf_rows.select("number", "place", "fragment")
    while most > 1:
        tree = tree.groupBy("number", F.floor(F.col("place") / FAN).alias("above")).applyInPandas(
            folded, "number bigint, place bigint, fragment binary"
        )
        most = -(-most // FAN)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for body, digest in zip(*(batch.column(c).to_pylist() for c in ("fragment", "digest")), strict=True):
                # The first byte and the last are common ends: what is still open closes.
                total, _ = compose(Fragment(), Fragment.unpack(body))
                if total.valid:
                    rows.append((total.n_a, total.n_b, total.n_groups, int(total.times.sum()), digest, _pack_pairs(total.keys, total.times)))
                else:
                    rows.append((0, 0, 0, 0, "", b""))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["doc_id", *_NAMES]
            )

    owners = leaf_rows.where("place = 0").select("number", "doc_id")
    whole = tree.join(digests, "number").join(owners, "number")
    return whole.select("doc_id", "fragment", "digest").mapInArrow(finished, f"doc_id {kind}, {_COUNTS}")


_DIGEST = pa.schema([("number", pa.int64()), ("digest", pa.string())])


def _leaf(both: Vocabularies, window: np.ndarray, low: int, high: int, begin: int) -> tuple[Fragment, bytes]:
    """The fragment of the bytes ``low`` to ``high`` of a window of whole words, and its text."""
    tokens, sound = both.tokens(window, np.array([0, len(window)]))
    if not sound[0]:
        return Fragment(valid=False), b""

    def inside(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        here = slice(np.searchsorted(ends, low, "right"), np.searchsorted(ends, high, "right"))
        return ids[here], ends[here] + begin

    return fragment(Tokens(*inside(tokens.a, tokens.a_ends), *inside(tokens.b, tokens.b_ends)))


# --- pairs over the corpus ------------------------------------------------------


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, documents``: in how many documents a pair of ids is linked."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(n)], ["a", "b", "n"]
            )

        for batch in batches:
            found, _, _ = _unpack_pairs(batch.column("pairs"))
            keys, n = count_pairs(np.concatenate([keys, found]), np.concatenate([n, np.ones(len(found), np.int64)]))
            if len(keys) > PAIRS:
                yield out()
                keys, n = keys[:0], n[:0]
        yield out()

    sums = aligned.select("pairs").mapInArrow(count, "a bigint, b bigint, n bigint")
    return sums.groupBy("a", "b").agg(F.sum("n").alias("documents"))


def _with_counts(aligned: DataFrame, keep: list[str], keys: np.ndarray, n: np.ndarray) -> DataFrame:
    """``n_best`` and ``count_sum`` of the links whose pairs are among ``keys``, in order."""
    a = keys >> 32
    starts = np.flatnonzero(np.diff(a, prepend=-1))
    best = n == np.repeat(np.maximum.reduceat(n, starts), np.diff(np.append(starts, len(n)))) if len(n) else n > 0
    shared = aligned.sparkSession.sparkContext.broadcast((keys, n, best))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = shared.value
        for batch in batches:
            found, times, rows = _unpack_pairs(batch.column("pairs"))
            at = np.minimum(np.searchsorted(keys, found), max(len(keys) - 1, 0))
            here = keys[at] == found if len(keys) else np.zeros(len(found), bool)
            at, times, rows = at[here], times[here], rows[here]
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], rows, times * best[at])
            np.add.at(sums[1], rows, times * n[at])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(sums[0]), pa.array(sums[1])],
                [*keep, "n_best", "count_sum"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in aligned.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "n_best bigint, count_sum bigint"])
    return aligned.select(*keep, "pairs").mapInArrow(score, schema)


def report(
    docs: DataFrame, a_path: str, b_path: str, *, range_bytes: int = RANGE, pairs_at_once: int = PAIRS
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row."""
    spark = docs.sparkSession
    aligned = align_documents(docs, a_path, b_path, range_bytes)
    path = shared_scratch(spark, "alignment_pairs")
    pair_counts(aligned).write.parquet(path)
    counts = spark.read.parquet(path)
    # A ids in ranges of at most so many pairs; one id has no more than B has tokens.
    sizes = counts.groupBy("a").agg(F.count(F.lit(1)).alias("n")).collect()
    bounds, held = [0], 0
    for a, n in sorted(map(tuple, sizes)):
        if held and held + n > pairs_at_once:
            bounds.append(a)
            held = 0
        held += n
    keep = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    parts = []
    for i, low in enumerate(bounds):
        part = counts.where(F.col("a") >= low)
        if i + 1 < len(bounds):
            part = part.where(F.col("a") < bounds[i + 1])
        found = part.toPandas()
        keys = found["a"].to_numpy(np.int64) << 32 | found["b"].to_numpy(np.int64)
        order = np.argsort(keys)
        n = found["documents"].to_numpy(np.int64)[order]
        parts.append(_with_counts(aligned, keep if len(bounds) == 1 else ["row"], keys[order], n))
    if len(parts) == 1:
        return parts[0].drop("row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    sums = parts[0]
    for part in parts[1:]:
        sums = sums.unionByName(part)
    sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return aligned.select(*keep).join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
