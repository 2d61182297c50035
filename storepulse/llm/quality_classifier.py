"""Quality classifier: regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from storepulse.llm.common import learning_fold, map_rows, slices, written

# Byte classes that are counted.
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"
SYMBOLS = b"#*$%&|<>{}[]_=~^\\/@"
LOUD = b"!?"
PAUSES = b".,;:"

FEATURES = 13
THRESHOLD = 0.5
# Shrinkage: part of the pooled covariance, and part of its diagonal, in each class's.
POOLED = 0.1
DIAGONAL = 0.05
# A ridge in units of a standard deviation, for statistics that never vary in a class.
RIDGE = 0.05


def share(part: float, whole: float) -> float:
    """Smoothed log of a share, so that short texts stay near the middle."""
    return float(np.log((part + 0.5) / (whole + 10.0)))


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one whole text; all finite, also for b''."""
    words = text.split()
    n, size = len(words), len(text)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in text.split(b"\n") if line.strip()]
    without = lambda chars: size - len(text.translate(None, chars))
    seen = sum(map(len, words))
    return [
        float(np.log1p(n)),
        float(np.log((seen + 5.0) / (n + 1.0))),
        share(without(UPPER), size),
        share(without(DIGITS), size),
        share(without(SYMBOLS), size),
        share(without(LOUD), size),
        share(without(PAUSES), n),
        share(n - len(counts), n),
        max(n - 1 - pairs, 0) / (n + 50.0),
        share(max(counts.values(), default=0), n),
        (len(lines) - len(set(lines))) / (len(lines) + 20.0),
        float(np.log((n + 1.0) / (len(lines) + 1.0))),
        share(text.count(b"|"), n),
    ]


def statistics_of(texts: list[bytes | None]) -> np.ndarray:
    return np.array([statistics(t or b"") for t in texts]).reshape(-1, FEATURES)


@dataclass(frozen=True)
class Discriminant:
    """Class means, inverse Cholesky factors of the covariances, and log priors."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    inverse_factors: np.ndarray
    log_norms: np.ndarray

    @staticmethod
    def fit(n: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Discriminant:
        """From each class's count, sum and sum of outer products of statistics.

        A class without rows takes the pooled mean and covariance; no rows at all give
        a score of 0.5 everywhere.
        """
        total = max(n.sum(), 1.0)
        centre = sums.sum(0) / total
        spread = products.sum(0) / total - np.outer(centre, centre)
        scale = np.sqrt(np.maximum(np.diag(spread), 1e-6))
        pooled_means = [sums[k] / n[k] if n[k] else centre for k in (0, 1)]
        covariances = [
            (products[k] / n[k] - np.outer(pooled_means[k], pooled_means[k])
             if n[k] > 1 else spread) / np.outer(scale, scale)
            for k in (0, 1)
        ]
        pooled = sum(n[k] * covariances[k] for k in (0, 1)) / total if n.sum() else np.eye(len(centre))
        means, factors, norms = [], [], []
        for k in (0, 1):
            mixed = (1 - POOLED) * covariances[k] + POOLED * pooled
            mixed = (1 - DIAGONAL) * mixed + DIAGONAL * np.diag(np.diag(mixed))
            factor = np.linalg.cholesky(mixed + RIDGE ** 2 * np.eye(len(centre)))
            means.append((pooled_means[k] - centre) / scale)
            factors.append(np.linalg.inv(factor))
            norms.append(np.log((n[k] + 1) / (total + 2)) - np.log(np.diag(factor)).sum())
        return Discriminant(centre, scale, np.array(means), np.array(factors), np.array(norms))

    def scores(self, statistics: np.ndarray) -> np.ndarray:
        """Probability of class 1, from the difference of the log densities."""
        if not len(statistics):
            return np.zeros(0)
        x = (statistics - self.centre) / self.scale
        density = [
            self.log_norms[k] - 0.5 * (((x - self.means[k]) @ self.inverse_factors[k].T) ** 2).sum(1)
            for k in (0, 1)
        ]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def described(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the ``statistics`` of every whole text, computed once and written.

    What is joined and scored later are these few numbers, never the texts.
    """
    def of(batch: pa.RecordBatch) -> list:
        return [batch.column(0), statistics_of(batch.column(1).to_pylist()).tolist()]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(map_rows(docs.select("doc_id", F.col("text").cast("binary").alias("text")),
                            f"doc_id {kind}, statistics array<double>", of), "statistics")


def train(described: DataFrame, labels: DataFrame) -> Discriminant:
    """Learn from every labelled document of the learning fold.

    Each task sums its own documents; what is shuffled is one row of sums per task and
    class, so neither a hot class nor the corpus size matters. Labels that are NULL or
    neither 0 nor 1 are ignored; a document with several labels counts once for each.
    """
    known = labels.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("y")
                          ).filter(F.col("y").isin(0, 1) & learning_fold(F.col("label_id")))
    marked = described.join(known, F.col("doc_id") == F.col("label_id")).select("statistics", "y")

    def sums(batch: pa.RecordBatch) -> list[list]:
        x = np.array(batch.column(0).to_pylist()).reshape(-1, FEATURES)
        x = np.hstack([np.ones((len(x), 1)), x])
        y = np.array(batch.column(1).to_pylist())
        return [[0, 1], [(x[y == k].T @ x[y == k]).ravel().tolist() for k in (0, 1)]]

    parts = map_rows(marked, "y int, moments array<double>", sums)
    by_place = parts.select("y", F.posexplode("moments").alias("place", "value")).groupBy(
        "y", "place").agg(F.sum("value").alias("value"))
    moments = np.zeros((2, (FEATURES + 1) ** 2))
    for row in by_place.collect():  # two classes by (FEATURES + 1) squared
        moments[row.y, row.place] = row.value
    moments = moments.reshape(2, FEATURES + 1, FEATURES + 1)
    return Discriminant.fit(moments[:, 0, 0], moments[:, 0, 1:], moments[:, 1:, 1:])


def score(described: DataFrame, model: Discriminant) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every described document.

    NULL and empty texts are scored like any other by their statistics, as the empty
    text; repeated rows are scored alike; NULL doc_ids fall in the fold of the empty id.
    """
    shared = described.sparkSession.sparkContext.broadcast(model)

    def of(batch: pa.RecordBatch) -> list:
        x = np.array(batch.column(2).to_pylist()).reshape(-1, FEATURES)
        return [batch.column(0), batch.column(1), shared.value.scores(x).tolist()]

    rows = described.select(
        "doc_id", (~learning_fold(F.col("doc_id"))).alias("held_out"), "statistics")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_rows(rows, f"doc_id {kind}, held_out boolean, score double", of).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, model: Discriminant) -> DataFrame:
    """The documents of class 1, with their columns as they are; one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array([statistics((t.as_py() or "").encode()) for t in batch.column(at)])
            keep = shared.value.scores(x.reshape(-1, FEATURES)) >= THRESHOLD
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
