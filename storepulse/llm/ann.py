"""Approximate nearest neighbours by balanced posting lists and a graph of centroids."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from storepulse.llm.common import written

# Vectors that the centroids are fitted on at most: the first by md5 of vec_id.
SAMPLE = 20_000
# Vectors of a posting list, on average over the sample; lists never hold more than
# twice the share of the sample that this is.
LISTS_PER_ROOT = 1.0
MOST_LISTS = 4_096
ROUNDS = 12
# A vector is also put on lists whose centroid is at most this much farther than the
# nearest, up to that many lists.
BOUNDARY, REPLICAS = 1.10, 3
# A query looks at lists that promise at least this part of the best list's inner product,
# but at no fewer than this part of all, and this many. What a list promises is the inner
# product with its centroid and one deviation of its vectors from there.
PROMISE, LEAST_PART, LEAST_LISTS = 0.5, 0.45, 8
# Neighbours of a centroid in the graph, and nodes a search keeps open.
DEGREE, BEAM = 24, 1.5
# Rows of one list that a task compares with queries at a time.
BLOCK = 2_048


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)[None], 0)


def balanced(x: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Centroids of at least ``k`` lists, none with over twice its share of ``x``.

    K-means, then every list that is too long is halved at the median along its widest
    direction, as often as it takes.
    """
    random = np.random.default_rng(seed)
    centres = x[random.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        nearest = squared_distances(x, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        counts = np.bincount(nearest, minlength=k)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    nearest = squared_distances(x, centres).argmin(1)
    most = max(2 * len(x) // k, 1)
    lists = [np.flatnonzero(nearest == i) for i in range(k)]
    done = []
    while lists:
        own = lists.pop()
        if len(own) <= most:
            if len(own):
                done.append(x[own].mean(0))
            continue
        part = x[own] - x[own].mean(0)
        direction = part[np.argmax((part * part).sum(1))]
        order = np.argsort(part @ direction, kind="stable")
        lists += [own[order[:len(own) // 2]], own[order[len(own) // 2:]]]
    return np.array(done)


@dataclass(frozen=True)
class Lists:
    """Centroids, and the graph in which they are searched."""

    centres: np.ndarray
    graph: np.ndarray
    entries: np.ndarray

    @staticmethod
    def fit(sample: np.ndarray, rows: int) -> Lists:
        """About ``sqrt(rows)`` lists, so lists and the rows of each grow alike."""
        k = int(min(max(LISTS_PER_ROOT * math.sqrt(rows), 1), MOST_LISTS, max(len(sample), 1)))
        centres = balanced(sample, k) if len(sample) else np.zeros((0, 0))
        n = len(centres)
        degree = min(DEGREE, max(n - 1, 0))
        graph = np.zeros((n, degree), np.int64)
        for i in range(0, n, 1024):
            d = squared_distances(centres[i:i + 1024], centres)
            d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
            graph[i:i + 1024] = np.argsort(d, axis=1, kind="stable")[:, :degree]
        # Long edges keep the graph connected; several entries start from far apart.
        random = np.random.default_rng(2)
        if degree > 4:
            graph[:, -4:] = random.integers(0, n, (n, 4))
        entries = random.permutation(n)[:min(16, n)]
        return Lists(centres, graph, entries)

    @property
    def norms(self) -> np.ndarray:
        return (self.centres * self.centres).sum(1)

    def search(
        self, x: np.ndarray, wanted: int, norms: np.ndarray,
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ``wanted`` nearest centroids found for each row, and their squared distances.

        ``norms`` are the centroids' squared norms, or what stands for them.

        Best-first search in the graph for all rows at once: each step opens the nearest
        unopened nodes of every row, until the nearest nodes of a row are all open.
        """
        n = len(self.centres)
        wanted = min(wanted, n)
        beam = min(n, max(int(BEAM * wanted), 16))
        rows = np.arange(len(x))[:, None]
        distance = np.full((len(x), n), np.inf)
        opened = np.zeros((len(x), n), bool)
        own = (x * x).sum(1)[:, None]

        def reach(nodes: np.ndarray) -> None:
            distance[rows, nodes] = (
                own - 2 * np.einsum("ij,ikj->ik", x, self.centres[nodes]) + norms[nodes])

        reach(np.tile(self.entries, (len(x), 1)))
        while True:
            near = np.argpartition(distance, beam - 1, axis=1)[:, :beam]
            known = np.isfinite(distance[rows, near]) & ~opened[rows, near]
            if not known.any():
                break
            order = np.argsort(np.where(known, distance[rows, near], np.inf), axis=1)[:, :8]
            chosen = near[rows, order]
            fresh = known[rows, order]
            opened[rows, chosen] |= fresh
            # A row with nothing left to open looks at its entries again.
            nodes = self.graph[np.where(fresh, chosen, self.entries[0])].reshape(len(x), -1)
            reach(nodes) if nodes.shape[1] else None
        found = np.argsort(distance, axis=1, kind="stable")[:, :wanted]
        return found, distance[rows, found]

    def near(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and list for each list that a stored vector is put on."""
        parts = [np.zeros((2, 0), np.int64)]
        for i in range(0, len(x), 256):
            found, squared = self.search(x[i:i + 256], REPLICAS, self.norms)
            distance = np.sqrt(np.maximum(squared, 0))
            keep = distance <= BOUNDARY * distance[:, :1]
            keep[:, :1] = True
            row, place = np.nonzero(keep & np.isfinite(distance))
            parts.append(np.array([row + i, found[row, place]]))
        return tuple(np.concatenate(parts, axis=1))

    def promising(self, x: np.ndarray, largest: float) -> tuple[np.ndarray, np.ndarray]:
        """Row and list for each list that a query looks at; ``x`` from ``asking``.

        All stored vectors are as long as ``largest``, so the lists nearest to a query by
        the mean square of its vectors' distances are those of the largest mean inner
        product. A centroid falls short of ``largest`` by the variance of its list, whose
        deviation in one direction is added; long vectors of a mixed list are found by it.
        """
        deviation = np.sqrt(
            np.maximum(largest ** 2 - self.norms, 0) / max(self.centres.shape[1] - 1, 1))
        norms = largest ** 2 - 2 * largest * deviation
        least = max(LEAST_LISTS, math.ceil(LEAST_PART * len(self.centres)))
        parts = [np.zeros((2, 0), np.int64)]
        for i in range(0, len(x), 256):
            found, squared = self.search(x[i:i + 256], len(self.centres), norms)
            promise = 2 * largest ** 2 - squared
            keep = promise >= PROMISE * promise[:, :1]
            keep[:, :least] = True
            row, place = np.nonzero(keep & np.isfinite(squared))
            parts.append(np.array([row + i, found[row, place]]))
        return tuple(np.concatenate(parts, axis=1))


def usable(vectors: DataFrame) -> DataFrame:
    """Vectors that take part: not NULL, zero, or with a NULL or non-finite component."""
    x = F.col("vector")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    zero = F.forall(x, lambda v: v == 0)
    return vectors.filter(x.isNotNull() & ~F.coalesce(bad, F.lit(True))
                          & ~F.coalesce(zero, F.lit(True)))


def spherical(rows: pd.Series, largest: float) -> np.ndarray:
    """Stored vectors with one more component that brings each to the largest norm.

    Among such the nearest to a query of ``asking`` has the largest inner product.
    """
    x = np.array(rows.tolist(), np.float64)
    rest = np.maximum(largest ** 2 - (x * x).sum(1), 0)
    return np.hstack([x, np.sqrt(rest)[:, None]])


def asking(rows: pd.Series, largest: float) -> np.ndarray:
    """Queries brought to the largest norm, with 0 as the component more."""
    x = np.array(rows.tolist(), np.float64)
    x /= np.abs(x).max(1)[:, None]
    x *= largest / np.sqrt((x * x).sum(1))[:, None]
    return np.hstack([x, np.zeros((len(x), 1))])


def search(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's nearest by inner product.

    Reads ``vec_id`` and ``embedding`` of one length; other columns are ignored, whatever
    their names. Queries are the rows whose ``vec_id`` is divisible by ``every``, their
    candidates all other rows. Vectors that are NULL, empty, zero or hold
    a NULL or non-finite component take no part, nor do rows without ``vec_id``. Every row is
    a vector of its own: rows that repeat a ``vec_id`` are candidates of each other, and each
    such query has its results. Ties go to the smaller ``vec_id``. With ``k`` candidates or
    fewer all are returned; no rows give no rows.

    Centroids are fitted on a bounded sample in the driver and sent to all tasks, at most
    ``MOST_LISTS`` of them. Every row is put on its lists; lists and queries meet by list
    and slot, so a list of any length, as of one vector repeated, is many blocks. Each
    block keeps its ``k`` best per query, and only those are shuffled.
    """
    read = usable(vectors.filter(F.col("vec_id").isNotNull()).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vector")))
    read = written(read.withColumn("row", F.monotonically_increasing_id()), "vectors")
    facts = read.agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v)).alias("largest")).first()
    largest = math.sqrt(facts.largest or 0.0)
    sample = read.orderBy(F.md5(F.col("vec_id").cast("string").cast("binary")), "vec_id").limit(
        SAMPLE).toPandas()
    lists = Lists.fit(
        spherical(sample.vector, largest) if len(sample) else np.zeros((0, 1)), facts["rows"])
    shared = read.sparkSession.sparkContext.broadcast(lists)

    def placed(queries: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                if not len(rows):
                    continue
                at, where = (
                    shared.value.promising(asking(rows.vector, largest), largest) if queries
                    else shared.value.near(spherical(rows.vector, largest)))
                yield pd.DataFrame({"row": rows.row.to_numpy()[at],
                                    "vec_id": rows.vec_id.to_numpy()[at],
                                    "list": where.astype(np.int32),
                                    "vector": rows.vector.to_numpy()[at]})
        return run

    schema = "row long, vec_id long, list int, vector array<double>"
    posted = written(
        read.mapInPandas(placed(queries=False), schema), "postings")
    lengths = posted.groupBy("list").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("slots"))
    asked = read.filter(F.col("vec_id") % every == 0).mapInPandas(
        placed(queries=True), schema).join(
            lengths, "list").withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    posted = posted.join(lengths, "list").withColumn(
        "slot", F.pmod(F.xxhash64("vec_id", "vector"), F.col("slots")).cast("int"))

    def best(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"asking": [], "query_id": [], "row": [], "vec_id": [], "score": []})]
        x, ids, own = np.array(rows.vector.tolist()), rows.vec_id.to_numpy(), rows.row.to_numpy()
        for i in range(0, len(queries) if len(rows) else 0, 256):
            part = queries.iloc[i:i + 256]
            names, asking = part.vec_id.to_numpy(), part.row.to_numpy()
            scores = np.array(part.vector.tolist()) @ x.T
            scores[asking[:, None] == own[None]] = -np.inf
            at_least = -np.partition(-scores, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
            row, place = np.nonzero((scores >= at_least[:, None]) & np.isfinite(scores))
            # More than k only if some tie with the last; the smaller vec_ids stay.
            order = np.lexsort((own[place], ids[place], -scores[row, place], row))
            row, place = row[order], place[order]
            nth = np.arange(len(row)) - np.searchsorted(row, row)
            row, place = row[nth < k], place[nth < k]
            found.append(pd.DataFrame({"asking": asking[row], "query_id": names[row],
                                       "row": own[place], "vec_id": ids[place],
                                       "score": scores[row, place]}))
        return pd.concat(found[1:] or found)

    sides = [side.select("list", "slot", "row", "vec_id", "vector").groupBy("list", "slot")
             for side in (asked, posted)]
    near = sides[0].cogroup(sides[1]).applyInPandas(
        best, "asking long, query_id long, row long, vec_id long, score double")
    # A row that is on several lists is found on each.
    once = near.groupBy("asking", "query_id", "row", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(
        W.partitionBy("asking").orderBy(F.col("score").desc(), F.col("vec_id"), F.col("row")))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
