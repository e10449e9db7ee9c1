"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Each text becomes a few ratios of its statistics, scaled to unit variance. Random
cosines of them span, in the limit, the functions of a Gaussian kernel; a ridge
regression on the cosines is then a kernel regression whose normal equations are sums
over rows. Each task sums its own rows, a second level of tasks sums those, and the
driver adds at most ``MERGE`` matrices of a fixed size. Rows held back from the
regression (a fifth of the training rows) map its output to a probability by isotonic
regression over ``BINS`` counts.

Labels, language, source and document id never enter a score. Cases: a null text is
scored as an empty one; rows that are repeated get equal scores; documents without a
label, and labels without a document or with a null, take no part in training; a
document with several labels counts with the largest. Without training rows of both
labels every score is the share of ones, or 0.5 without any. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_scratch
from .labelled import STATISTICS, label_rows, ratios, with_statistics

FEATURES = 256
WIDTH = 3.0
RIDGE = 1e-3
BINS = 400
MERGE = 16


def fold(of: str = "doc_id"):
    """crc32 of an id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(of).cast("string"), F.lit("")).cast("binary"))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def cosines(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.waves + self.phases)
        return np.hstack([waves, z, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.cosines(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0, 1)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nearest non-decreasing sequence: neighbours that fall are pooled."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights, strict=True):
        blocks.append([float(v), float(w), 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v1, w1, n1 = blocks.pop()
            v0, w0, n0 = blocks.pop()
            blocks.append([(v0 * w0 + v1 * w1) / (w0 + w1), w0 + w1, n0 + n1])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("stats").flatten().to_numpy(zero_copy_only=False)
    return ratios(flat.reshape(-1, len(STATISTICS)))


def _summed(rows: DataFrame, terms) -> np.ndarray | None:
    """Sum of ``terms(batch)``, one array of a fixed size, over all rows."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = terms(batch)
                total = found if total is None else total + found
        if total is not None:
            body = np.ascontiguousarray(total, dtype=np.float64).tobytes()
            yield pa.RecordBatch.from_pydict({"body": [body]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for body in batch.column("body").to_pylist():
                found = np.frombuffer(body)
                total = found.copy() if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_pydict({"body": [total.tobytes()]})

    sums = rows.mapInArrow(part, "body binary").repartition(MERGE).mapInArrow(merge, "body binary")
    found = [np.frombuffer(r["body"]) for r in sums.collect()]
    return np.sum(found, axis=0) if found else None


def fit(train: DataFrame) -> Model | None:
    """Model from rows ``stats, label, hold`` (``hold``: for calibration only)."""
    d = len(STATISTICS)
    count = _summed(
        train, lambda b: np.concatenate([[b.num_rows], (x := _matrix(b)).sum(0), (x * x).sum(0)])
    )
    if count is None:
        return None
    n, sums, squares = count[0], count[1 : d + 1], count[d + 1 :]
    mean = sums / n
    scale = np.sqrt(np.maximum(squares / n - mean**2, 1e-6))
    rng = np.random.default_rng(5)
    model = Model(
        mean, scale, rng.normal(0, 1 / WIDTH, (d, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + d + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]),
    )

    def equations(batch: pa.RecordBatch) -> np.ndarray:
        z = model.cosines(_matrix(batch))
        y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y, [len(y), y.sum()]])

    found = _summed(train.where(~F.col("hold")), equations)
    if found is None:
        return None
    k = FEATURES + d + 1
    gram, right = found[: k * k].reshape(k, k), found[k * k : k * k + k]
    model.weights = np.linalg.solve(gram + RIDGE * found[-2] * np.eye(k) / k, right)

    edges = np.linspace(-0.25, 1.25, BINS + 1)

    def bins(batch: pa.RecordBatch) -> np.ndarray:
        at = np.clip(np.searchsorted(edges, model.raw(_matrix(batch)), "right") - 1, 0, BINS - 1)
        y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, minlength=BINS)])

    held = _summed(train.where(F.col("hold")), bins)
    share = found[-1] / found[-2]
    if held is None:
        model.levels = np.array([share, share])
        return model
    n, ones = held[:BINS], held[BINS:]
    used = n > 0
    middle = (edges[:-1] + edges[1:])[used] / 2
    # One row of the overall share in each bin keeps scores off 0 and 1.
    level = isotonic((ones[used] + share) / (n[used] + 1), n[used] + 1)
    # A slope within pooled bins keeps the order of the regression.
    model.knots, model.levels = middle, 0.999 * level + 0.001 * np.clip(middle, 0, 1)
    return model


def classify(docs: DataFrame, labels: DataFrame, held_out_of: int = 3, held_out: int = 1) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document.

    Rows whose crc32 of the id modulo ``held_out_of`` is ``held_out`` never train. The
    texts are read once: their statistics, some hundred bytes a row, go to a table.
    """
    spark = docs.sparkSession
    path = shared_scratch(spark, "quality_statistics")
    with_statistics(docs, ["doc_id"]).write.parquet(path)
    stats = spark.read.parquet(path).withColumn("held_out", fold() % held_out_of == held_out)
    train = (
        stats.where(~F.col("held_out"))
        .join(label_rows(labels, "quality"), "doc_id")
        .select("stats", "label", (F.xxhash64("doc_id", F.lit(3)) % 5 == 0).alias("hold"))
    )
    model = spark.sparkContext.broadcast(fit(train))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch)
            score = model.value.score(x) if model.value else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"), pa.array(score),
                    pa.array((score >= 0.5).astype(np.int32)),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, score double, predicted int"
    return stats.select("doc_id", "held_out", "stats").mapInArrow(run, schema)
