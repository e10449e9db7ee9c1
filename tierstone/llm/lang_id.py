"""Language identification by hierarchical discrimination.

A text's language *family* is predicted first, then linear support vector machines, one
for each pair of the family's languages, vote for the language. Families are groups of
the learned languages whose byte n-grams are most alike: average linkage of the cosines
of the languages' mean vectors, to the square root of their number, or they are given.

Features are the byte n-grams (1 to 4) of the words of a text, hashed to ``SLOTS``: runs
of bytes that are ASCII letters or above 127, in lower case (A-Z) and parted by single
spaces. Machines have a squared hinge loss and no bias, so that the sign of a sum over all
n-grams of a text decides, whatever its length; whole texts are read, in blocks.

Fitting reads a bounded sample: of each language the ``PER_LANGUAGE`` distinct texts of the
least hashes. Its vectors are shuffled to one task for each machine; the machine that tells
a family from the others sees at most ``FAMILY_ROWS`` of them in all. So a language that
holds most rows, or one text that does, weighs no more than its sample. The number of
languages is taken to be some hundreds at most: the model, 256 KB for each machine, is
broadcast, and it grows with the pairs within families.

Cases: a text that is null or has no letter is ``und`` with score 0, also in training,
where it is left out, as are rows without a language. If nothing can be learned, every
text is ``und``; a single learned language is given to all texts with a letter, score 1.
Languages are told apart as they are spelled. Ties go to the first by code point.
Repeated rows are rows of their own in the result; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_scratch
from . import textbytes as tb
from .quality_classifier import fold

BITS = 15
SLOTS = 1 << BITS
ORDERS = (1, 2, 3, 4)
PER_LANGUAGE = 256
FAMILY_ROWS = 2048
PENALTY = 10.0
PASSES = 30
UNKNOWN = "und"
BROADCAST_ROWS = 1 << 20

_BLOCK = 1 << 19
_SPACE = 32
_KEPT = np.full(256, _SPACE, np.uint8)
_KEPT[65:91] = np.arange(97, 123)
_KEPT[97:123] = np.arange(97, 123)
_KEPT[128:] = np.arange(128, 256)


# --- features -----------------------------------------------------------------


def words_only(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters in lower case with a space around each word; every row begins with one."""
    n = len(offsets) - 1
    rows = np.repeat(np.arange(n), np.diff(offsets) + 2)
    padded = np.full(len(data) + 2 * n, _SPACE, np.uint8)
    starts = offsets[:-1] + 2 * np.arange(n)
    padded[np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, np.diff(offsets))] = _KEPT[data]
    keep = np.ones(len(padded), bool)
    keep[1:] = (padded[1:] != _SPACE) | (padded[:-1] != _SPACE)
    keep[starts] = True
    # A space that ends one row and the one that begins the next are both kept.
    sizes = np.bincount(rows[keep], minlength=n)
    ends = np.zeros(n + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    return padded[keep], ends


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slots of all n-grams and the row of each, in blocks of bounded size."""
    for low in range(0, len(data), _BLOCK):
        high = min(low + _BLOCK, len(data))
        part = data[low : min(high + max(ORDERS) - 1, len(data))].astype(np.uint32)
        rows = np.searchsorted(offsets, np.arange(low, high), "right") - 1
        left = offsets[rows + 1] - np.arange(low, high)
        key = np.zeros(high - low, np.uint32)
        for n in ORDERS:
            m = min(high - low, len(part) - n + 1)
            if m <= 0:
                break
            key = key[:m] | part[n - 1 : n - 1 + m] << np.uint32(8 * (n - 1))
            mixed = (key ^ (key >> np.uint32(15))) * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B % (1 << 32))
            mixed = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35)
            whole = left[:m] >= n
            yield (mixed >> np.uint32(32 - BITS))[whole], rows[:m][whole]


def letters(column: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which rows have a letter: ASCII ones by their bytes, others by the text."""
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    found = tb.per_row(ascii_letter, offsets) > 0
    for row in np.flatnonzero(~found & (tb.per_row(data >= 128, offsets) > 0)):
        found[row] = any(map(str.isalpha, column[int(row)].as_py()))
    return found


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``lang, place, text`` -> sparse unit vectors of those with a letter."""
    for batch in batches:
        column = batch.column("text")
        data, offsets = tb.text_arrays(column)
        usable = letters(column, data, offsets)
        bodies = []
        for row in np.flatnonzero(usable):
            words, ends = words_only(data[offsets[row] : offsets[row + 1]], np.array([0, offsets[row + 1] - offsets[row]]))
            counts = np.zeros(SLOTS)
            for slots, _ in grams(words, ends):
                counts += np.bincount(slots, minlength=SLOTS)
            at = np.flatnonzero(counts)
            values = (counts[at] / np.linalg.norm(counts)).astype(np.float32)
            bodies.append(at.astype(np.uint16).tobytes() + values.tobytes())
        kept = pa.array(usable)
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang").filter(kept), batch.column("place").filter(kept), pa.array(bodies, pa.binary())],
            ["lang", "place", "vector"],
        )


def _unpack(vector: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(vector) // 6
    return np.frombuffer(vector[: 2 * n], np.uint16), np.frombuffer(vector[2 * n :], np.float32)


# --- fitting ------------------------------------------------------------------


def machine(vectors: list[bytes], signs: np.ndarray) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss: dual coordinate descent.

    The rows are few, so the descent runs on their products. Classes weigh alike.
    """
    n = len(vectors)
    parts = [_unpack(v) for v in vectors]
    rows = np.repeat(np.arange(n), [len(at) for at, _ in parts])
    slots = np.concatenate([at for at, _ in parts]).astype(np.int64)
    values = np.concatenate([v for _, v in parts])
    order = np.argsort(slots, kind="stable")
    rows, slots, values = rows[order], slots[order], values[order]
    products, step = np.zeros((n, n), np.float32), 4096
    for low in range(0, SLOTS, step):
        a, b = np.searchsorted(slots, [low, low + step])
        dense = np.zeros((n, step), np.float32)
        dense[rows[a:b], slots[a:b] - low] = values[a:b]
        products += dense @ dense.T
    share = np.where(signs > 0, max((signs > 0).sum(), 1), max((signs < 0).sum(), 1))
    diagonal = share / (2 * PENALTY) * 2 / n
    alpha, margins = np.zeros(n), np.zeros(n)
    rng = np.random.default_rng(3)
    for _ in range(PASSES):
        moved = 0.0
        for i in rng.permutation(n):
            slope = signs[i] * margins[i] - 1 + diagonal[i] * alpha[i]
            new = max(alpha[i] - slope / (products[i, i] + diagonal[i]), 0.0)
            change = new - alpha[i]
            if change:
                margins += change * signs[i] * products[i]
                alpha[i] = new
                moved = max(moved, abs(change))
        if moved < 1e-3:
            break
    weights = np.zeros(SLOTS)
    np.add.at(weights, slots, values * (alpha * signs)[rows])
    return (weights / max(np.abs(margins).mean(), 1e-9)).astype(np.float32)


def families_of(centroids: Mapping[str, np.ndarray]) -> list[list[str]]:
    """Average linkage of languages by the cosines of their mean vectors."""
    groups = [[name] for name in sorted(centroids)]
    wanted = math.ceil(math.sqrt(len(groups)))
    unit = {name: v / max(np.linalg.norm(v), 1e-9) for name, v in centroids.items()}
    # What all languages share, as the space around words, says nothing about their kinship.
    middle = sum(unit.values()) / max(len(unit), 1)
    unit = {name: v - middle for name, v in unit.items()}
    unit = {name: v / max(np.linalg.norm(v), 1e-9) for name, v in unit.items()}
    while len(groups) > wanted:
        best = max(
            ((i, j) for i in range(len(groups)) for j in range(i + 1, len(groups))),
            key=lambda p: (np.mean([[unit[a] @ unit[b] for b in groups[p[1]]] for a in groups[p[0]]]), -p[0], -p[1]),
        )
        groups[best[0]] = sorted(groups[best[0]] + groups.pop(best[1]))
    return groups


@dataclass
class Model:
    """Families in order; a machine for each, and one for each pair within a family."""

    families: list[list[str]]
    family_weights: np.ndarray  # a column for each family
    pair_weights: list[np.ndarray]  # for each family a column for each pair, the earlier language positive

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        names, scores = np.full(len(column), UNKNOWN, object), np.zeros(len(column))
        data, offsets = tb.text_arrays(column)
        if not self.families or not len(column):
            return list(names), scores
        known = letters(column, data, offsets)
        for low, high, part, ends in tb.pieces(data, offsets):
            words, ends = words_only(part, ends)
            sums, n = self._sums(words, ends, self.family_weights)
            family = np.argmax(sums, 1)
            sure = _softmax(3 * sums / np.maximum(n, 1)[:, None])[np.arange(len(n)), family]
            for f, members in enumerate(self.families):
                mine = np.flatnonzero((family == f) & known[low:high])
                if not len(mine):
                    continue
                language, share = self._vote(f, words, ends, mine)
                names[low + mine] = np.array(members, object)[language]
                scores[low + mine] = np.clip(sure[mine] * share, 0, 1)
        return list(names), scores

    def _vote(self, f: int, words: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        members = len(self.families[f])
        if members == 1:
            return np.zeros(len(rows), np.int64), np.ones(len(rows))
        chosen = np.zeros(len(ends) - 1, bool)
        chosen[rows] = True
        sizes = np.diff(ends)
        part = words[np.repeat(chosen, sizes)]
        bounds = np.concatenate([[0], np.cumsum(sizes[rows])])
        sums, n = self._sums(part, bounds, self.pair_weights[f])
        votes, belief = np.zeros((len(rows), members)), np.zeros((len(rows), members))
        pairs = [(a, b) for a in range(members) for b in range(a + 1, members)]
        for k, (a, b) in enumerate(pairs):
            p = 1 / (1 + np.exp(-3 * sums[:, k] / np.maximum(n, 1)))
            votes[:, a] += sums[:, k] >= 0
            votes[:, b] += sums[:, k] < 0
            belief[:, a] += p
            belief[:, b] += 1 - p
        # Votes decide; where they tie, how sure the machines were.
        best = np.argmax(votes + belief / (2 * members), 1)
        return best, belief[np.arange(len(rows)), best] / (members - 1)

    @staticmethod
    def _sums(words: np.ndarray, ends: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights of all n-grams of each row, and the length that makes them comparable.

        The length of a row's vector is near its n-grams' number over a constant, so sums
        are divided by the number of bytes and scaled by the mean of the machine's margins.
        """
        out = np.zeros((len(ends) - 1, weights.shape[1]))
        for slots, rows in grams(words, ends):
            for k in range(weights.shape[1]):
                out[:, k] += np.bincount(rows, weights[slots, k], minlength=len(out))
        return out, np.diff(ends) * 0.2


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(train: DataFrame, families: list[list[str]] | None = None, per_language: int = PER_LANGUAGE) -> Model:
    """Model from rows ``text, lang``; see the module for the sample it reads.

    ``families`` replaces the learned ones; languages in none are left out.
    """
    spark = train.sparkSession
    rows = train.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("lang").cast("string"), "text", F.xxhash64("text").alias("key"))
    # The distinct come first, so that one text in many copies is one row of the sample.
    least = Window.partitionBy("lang").orderBy("key")
    chosen = (
        rows.where(F.col("text").rlike(r"[a-zA-Z]|[^\x00-\x7F]"))
        .select("lang", "key")
        .distinct()
        .withColumn("place", F.row_number().over(least))
        .where(F.col("place") <= per_language)
    )
    path = shared_scratch(spark, "lang_sample")
    chosen.write.parquet(f"{path}/keys")
    chosen = spark.read.parquet(f"{path}/keys")
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    # Copies of a text meet before the shuffle: one row a task is left of each.
    sample = rows.join(chosen, ["lang", "key"]).groupBy("lang", "key", "place").agg(F.max("text").alias("text"))
    sample.select("lang", "place", "text").mapInArrow(_vectors, "lang string, place int, vector binary").write.parquet(
        f"{path}/vectors"
    )
    vectors = spark.read.parquet(f"{path}/vectors")

    def centroid(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SLOTS)
        for vector in rows["vector"]:
            at, values = _unpack(vector)
            total[at] += values
        return pd.DataFrame({"lang": rows["lang"].iloc[:1], "body": [total.astype(np.float32).tobytes()]})

    means = vectors.groupBy("lang").applyInPandas(centroid, "lang string, body binary").collect()
    centroids = {r["lang"]: np.frombuffer(r["body"], np.float32) for r in means}
    if families is None:
        families = families_of(centroids)
    else:
        families = [known for group in families if (known := sorted(set(group) & centroids.keys()))]
    if not families:
        return Model([], np.zeros((SLOTS, 0), np.float32), [])
    roles = []  # (machine, language, sign, rows of it to take)
    members = sum(map(len, families))
    each = max(1, FAMILY_ROWS // members)
    for f, family in enumerate(families):
        if len(families) > 1:
            roles += [(f, name, 1 if g == f else -1, each) for g, group in enumerate(families) for name in group]
    number = len(families)
    pairs: list[list[int]] = []
    for family in families:
        pairs.append([])
        for a in range(len(family)):
            for b in range(a + 1, len(family)):
                roles += [(number, family[a], 1, per_language), (number, family[b], -1, per_language)]
                pairs[-1].append(number)
                number += 1
    weights: dict[int, np.ndarray] = {}
    if roles:
        table = spark.createDataFrame(roles, "machine int, lang string, sign int, bound int")

        def train_one(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["lang", "place"])
            found = machine(list(rows["vector"]), rows["sign"].to_numpy(float))
            return pd.DataFrame({"machine": rows["machine"].iloc[:1].to_numpy(), "body": [found.tobytes()]})

        tasks = vectors.join(F.broadcast(table), "lang").where(F.col("place") <= F.col("bound"))
        tasks = tasks.select("machine", "lang", "place", "sign", "vector").groupBy("machine")
        for r in tasks.applyInPandas(train_one, "machine int, body binary").collect():
            weights[r["machine"]] = np.frombuffer(r["body"], np.float32)
    none = np.zeros(SLOTS, np.float32)
    return Model(
        families,
        np.stack([weights.get(f, none) for f in range(len(families))], 1),
        [np.stack([weights[k] for k in ks], 1) if ks else np.zeros((SLOTS, 0), np.float32) for ks in pairs],
    )


def predict(docs: DataFrame, model: Model, keep: list[Column]) -> DataFrame:
    """The columns ``keep`` of every row with ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("text").cast("string").alias("__text"), *keep)
    kept = [f for f in rows.schema.fields if f.name != "__text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.predict(batch.column("__text"))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(names, pa.string()), pa.array(scores)],
                [*(f.name for f in kept), "lang_pred", "score"],
            )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "lang_pred string", "score double"])
    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame, held_out_of: int = 5, held_out: int = 0) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; rows whose crc32 of the id modulo
    ``held_out_of`` is ``held_out`` never train. A null id counts as the empty text."""
    out = fold() % held_out_of == held_out
    model = fit(docs.where(~out).select("text", "lang"))
    return predict(docs, model, [F.col("doc_id"), out.alias("held_out")])
