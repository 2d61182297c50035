"""Toxicity: averaged subword embeddings under a linear softmax, trained in numpy."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from storepulse.llm.common import learning_fold, map_rows

BUCKETS = 1 << 18
# Bytes of an n-gram.
GRAMS = (3, 4, 5, 6, 7)
DIMENSIONS = 4
EPOCHS = 5
RATE = 0.05
# Averages of a few offending words among many are small; their logits are not.
GAIN = 40.0
# A subword of fewer training documents stays neutral.
LEAST_DOCUMENTS = 5
# So does one whose rates in the two classes differ by fewer standard errors than this;
# else chance subwords of few toxic texts are learned by heart.
LEAST_Z = 3.0
# Texts shorter than this are averaged as if they had that many words.
LEAST_WORDS = 30
# The part of a text that one word counts for at most, so that a word said over and
# over does not decide alone.
MOST_SHARE = 0.04
# Documents of a class that the classifier is fitted on at most: the first by md5 of doc_id.
SAMPLE = 2000
THRESHOLD = 0.7
# Words a worker remembers before it forgets them all.
REMEMBERED = 400_000

# ASCII letters and digits stand for themselves, as do the bytes of other scripts; the
# rest of ASCII parts words.
PARTED = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
# Multiplier of the rolling hash.
HASH = np.uint32(0x9E3779B1)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(PARTED).split()


def shares(words: list[bytes]) -> list[tuple[bytes, float]]:
    """Each distinct word of a text and the part of the average it has."""
    n = max(len(words), LEAST_WORDS)
    return [(w, min(c / n, MOST_SHARE)) for w, c in Counter(words).items()]


def subwords(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' subwords, and the number of the word each belongs to.

    A word's subwords are the n-grams of its bytes between ``<`` and ``>``, and the whole
    between them. Every n-gram of the list is hashed in one sweep over its bytes.
    """
    text = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    room = np.repeat(ends, sizes) - np.arange(len(text))
    whole = np.array([crc32(w) % BUCKETS for w in words], np.int64)
    buckets, owners = [whole], [np.arange(len(words))]
    rolling = np.zeros(len(text), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        # The hash of n bytes from each place on, from that of n - 1 bytes.
        if n > len(text):
            break
        last = len(text) - n + 1
        rolling = rolling[:last] * HASH + text[n - 1:] + np.uint32(1)
        if n in GRAMS:
            inside = room[:last] >= n
            mixed = rolling[inside] ^ (rolling[inside] >> np.uint32(15))
            buckets.append(((mixed * HASH) >> np.uint32(14)).astype(np.int64) % BUCKETS)
            owners.append(owner[:last][inside])
    return np.concatenate(buckets), np.concatenate(owners)


def bag(text: str | None, telling: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text, of ``telling`` alone, and the weight of each in its average."""
    part = shares(words_of(text))
    if not part:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    buckets, owners = subwords([w for w, _ in part])
    weight = (np.array([s for _, s in part]) / np.bincount(owners, minlength=len(part)))[owners]
    if telling is not None:
        kept = telling[buckets]
        buckets, weight = buckets[kept], weight[kept]
    distinct, where = np.unique(buckets, return_inverse=True)
    return (distinct.astype(np.int32),
            np.bincount(where, weight, len(distinct)).astype(np.float32))


def z_of(documents: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Standard errors between the rates of two classes, of ``documents`` among ``sizes``."""
    pooled = documents.sum(0) / sizes.sum()
    error = np.sqrt(pooled * (1 - pooled) * (1 / sizes[0] + 1 / sizes[1]))
    apart = np.abs(documents[1] / sizes[1] - documents[0] / sizes[0])
    return np.divide(apart, error, out=np.zeros_like(apart), where=error > 0)


@dataclass(frozen=True)
class Subwords:
    """A trained classifier, folded into one logit per bucket and a bias."""

    logits: np.ndarray
    bias: float

    @staticmethod
    def fit(texts: Sequence[str | None], labels: Sequence[int], seed: int = 1) -> Subwords:
        """Adagrad over documents, embeddings and softmax layer together.

        The first dimension starts at the log odds of a subword's documents, the others at
        zero, so subwords of few training documents, or of much the same rate in both
        classes, stay neutral. Both classes weigh the
        same, however many documents each has. Without documents of both classes every
        score is 0.5.
        """
        y = np.array(labels, np.int64)
        if len(set(y.tolist())) < 2:
            return Subwords(np.zeros(BUCKETS, np.float32), 0.0)
        weigh = len(y) / (2 * np.bincount(y, minlength=2))
        documents = np.zeros((2, BUCKETS), np.int64)
        for text, k in zip(texts, y):
            documents[k, bag(text)[0]] += 1
        sizes = np.bincount(y, minlength=2)
        telling = (documents.sum(0) >= LEAST_DOCUMENTS) & (z_of(documents, sizes) >= LEAST_Z)
        read = [bag(text, telling) for text in texts]
        rates = (documents + 1) / (sizes[:, None] + 2)
        log_odds = np.where(telling, np.log(rates[1] / rates[0]), 0)

        random = np.random.default_rng(seed)
        vectors = np.zeros((BUCKETS, DIMENSIONS), np.float32)
        vectors[:, 0] = log_odds / 2
        layer = random.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32)
        layer[0] = (-1, 1)
        bias = np.zeros(2, np.float32)
        squares = np.full(BUCKETS, 1e-8, np.float32)
        layer_squares, bias_squares = np.full(layer.shape, 1e-4, np.float32), 1e-4
        for _ in range(EPOCHS):
            for i in random.permutation(len(y)):
                at, part = read[i]
                own = vectors[at]
                mean = GAIN * (part @ own)
                logit = mean @ layer + bias
                p = np.exp(logit - logit.max())
                p /= p.sum()
                p[y[i]] -= 1
                p *= weigh[y[i]]
                towards = layer @ p
                gradient = GAIN * part
                seen = squares[at] + gradient ** 2 * (towards @ towards)
                squares[at] = seen
                vectors[at] = own - np.outer(RATE * gradient / np.sqrt(seen), towards)
                change = np.outer(mean, p)
                layer_squares += change ** 2
                layer -= RATE / np.sqrt(layer_squares) * change
                bias_squares += p @ p
                bias -= RATE / np.sqrt(bias_squares) * p
        difference = layer[:, 1] - layer[:, 0]
        return Subwords((GAIN * (vectors @ difference)).astype(np.float32),
                        float(bias[1] - bias[0]))


class Scorer:
    """A worker's scorer; remembers the logit of each word it has met."""

    def __init__(self, model: Subwords):
        self.model = model
        self.known: dict[bytes, float] = {}

    def learn(self, words: list[bytes]) -> None:
        if words:
            buckets, owners = subwords(words)
            sums = np.bincount(owners, self.model.logits[buckets], len(words))
            self.known.update(zip(words, (sums / np.bincount(owners)).tolist()))

    def scores(self, texts: Sequence[str | None]) -> list[float]:
        """Probability of class 1 of each whole text."""
        found, known = [], self.known
        for text in texts:
            if len(known) > REMEMBERED:
                known.clear()
            part = shares(words_of(text))
            self.learn([w for w, _ in part if w not in known])
            logit = self.model.bias + sum(known[w] * s for w, s in part)
            found.append(1 / (1 + math.exp(-min(max(logit, -500.0), 500.0))))
        return found


def train(docs: DataFrame, labels: DataFrame) -> Subwords:
    """Learn from labelled documents of the learning fold, at most ``SAMPLE`` of each class.

    The sample is fitted in the driver; its size does not grow with the corpus. Labels
    that are NULL or neither 0 nor 1 are ignored.
    """
    known = (
        labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("y"))
        .filter(F.col("y").isin(0, 1) & learning_fold(F.col("label_id")))
    )
    first = [F.md5(F.col("label_id").cast("string").cast("binary")), F.col("label_id")]
    sample = reduce(DataFrame.union, (
        known.filter(F.col("y") == k).orderBy(*first).limit(SAMPLE) for k in (0, 1)))
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
        .select("doc_id", "text", "y").collect()
    )
    rows.sort(key=lambda r: (r.doc_id, r.y, r.text or ""))
    return Subwords.fit([r.text for r in rows], [r.y for r in rows])


def score(docs: DataFrame, model: Subwords) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Reads ``doc_id, text``; other columns are ignored, whatever their names. Texts without
    a word, NULL among them, score as the bias alone; repeated rows score alike; NULL
    doc_ids fall in the fold of the empty id.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    known: list[Scorer] = []

    def of(batch: pa.RecordBatch) -> list:
        if not known:
            known.append(Scorer(shared.value))
        return [batch.column(0), batch.column(1), known[0].scores(batch.column(2).to_pylist())]

    rows = docs.select("doc_id", (~learning_fold(F.col("doc_id"))).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_rows(rows, f"doc_id {kind}, held_out boolean, score double", of).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
