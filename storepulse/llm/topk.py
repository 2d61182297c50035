"""Exact top-k by inner product: sorted lists read in order, with bounds, to no further
than the results need."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from storepulse.llm.common import written

# Rows of a block of candidates, queries of a block of queries, and blocks of candidates
# that one task reads with the queries it holds.
ROWS, QUERIES, STRIP = 4_096, 1_024, 16
# Parts of a list, from either end, that are read one after the other.
DEPTHS = (1 / 16, 1 / 8, 1 / 4, 3 / 8, 1 / 2)
# Integers that doubles hold exactly.
EXACT = 2.0 ** 53
LONG = 2 ** 63 - 1

BLOCK = "size int, block long, n int, ids binary, lists binary, vectors binary"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` of rows that take part."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.select("vec_id", "embedding").filter(
        F.col("vec_id").isNotNull() & (F.size("embedding") > 0)
        & ~F.coalesce(bad, F.lit(True))
    ).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("vector"))


def blocks(vectors: DataFrame, scale: int) -> DataFrame:
    """Blocks of up to ``ROWS`` vectors of one length, with a sorted list per dimension.

    A list holds the rows of its block by descending component; rows and components are
    packed. Every task packs what it reads, so nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}
        counts: dict[int, int] = {}

        def packed(size: int) -> pa.RecordBatch:
            nonlocal made
            ids = np.concatenate([i for i, _ in held[size]])
            x = np.nan_to_num(np.floor(scale * np.concatenate([v for _, v in held.pop(size)])))
            del counts[size]
            made += 1
            lists = np.argsort(-x, axis=0, kind="stable").T.astype(np.uint16)
            return pa.RecordBatch.from_pylist([{
                "size": size, "block": (part << 32) + made - 1, "n": len(ids),
                "ids": ids.astype("<i8").tobytes(), "lists": lists.tobytes(),
                "vectors": x.astype("<f8").tobytes()}], schema)

        schema = pa.schema([("size", pa.int32()), ("block", pa.int64()), ("n", pa.int32()),
                            ("ids", pa.binary()), ("lists", pa.binary()), ("vectors", pa.binary())])
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            vectors = batch.column(1)
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                # Wide vectors make blocks of fewer rows.
                rows = max(1, min(ROWS, ROWS * 256 // size))
                while len(at):
                    take = at[:rows - counts.get(size, 0)]
                    at = at[len(take):]
                    held.setdefault(size, []).append(
                        (ids[take], flat[starts[take][:, None] + np.arange(size)]))
                    counts[size] = counts.get(size, 0) + len(take)
                    if counts[size] >= rows:
                        yield packed(size)
                # Vectors of very many lengths: the fullest block is closed early.
                while sum(n * s for s, n in counts.items()) > 4 * ROWS * 256:
                    yield packed(max(counts, key=lambda s: s * counts[s]))
        for size in list(held):
            yield packed(size)

    return vectors.mapInArrow(run, BLOCK)


@dataclass
class Best:
    """Each query's best so far: exact scores, ids and places, best first."""

    k: int
    scores: list[list[tuple[int, int]]]

    def floor(self) -> np.ndarray:
        """What a score must reach to change the results."""
        return np.array([float(s[self.k - 1][0]) * -1 if len(s) >= self.k else -np.inf
                         for s in self.scores])

    def add(self, query: int, scores: list[int], ids: list[int]) -> None:
        own = self.scores[query]
        own.extend((-s, i) for s, i in zip(scores, ids))
        own.sort()
        del own[self.k:]


def read_lists(
    queries: np.ndarray, x: np.ndarray, lists: np.ndarray, k: int, floor: np.ndarray,
    own: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Query and row of the pairs that may be among the ``k`` best of their query.

    Every list is read from both ends, as a query's component is positive or negative. A
    component that is not read yet lies between the last read from either end, which
    bounds every score from above and below. Reading stops when each query has few rows
    left whose upper bound reaches its ``k``-th lower bound or ``floor``; what is left is
    resolved by the caller. ``own`` is each query's place among the rows, or -1.
    """
    n, size = x.shape
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    columns = np.arange(size)
    alive = np.arange(len(queries))
    rows_out, places_out = [], []
    known = np.zeros((n, size), bool)
    done = 0
    for depth in DEPTHS:
        to = n if depth == DEPTHS[-1] else min(n, int(np.ceil(n * depth)))
        front = lists[:, done:to], lists[:, max(n - to, 0):n - done]
        for read in front:
            known[read, columns[:, None]] = True
        done = to
        if 2 * done >= n:
            high = low = x
        else:
            last_high = x[lists[:, done - 1], columns]
            last_low = x[lists[:, n - done], columns]
            high, low = np.where(known, x, last_high), np.where(known, x, last_low)
        upper = up[alive] @ high.T + down[alive] @ low.T
        lower = upper if high is low else up[alive] @ low.T + down[alive] @ high.T
        mine = own[alive]
        has = np.flatnonzero(mine >= 0)
        upper[has, mine[has]] = -np.inf
        if lower is not upper:
            lower[has, mine[has]] = -np.inf
        least = floor[alive]
        if n > k:
            least = np.maximum(least, -np.partition(-lower, k - 1, axis=1)[:, k - 1])
        keep = upper >= np.maximum(least, -1e300)[:, None]
        few = keep.sum(1) <= max(4 * k, n // 64) if 2 * done < n else np.ones(len(alive), bool)
        row, place = np.nonzero(keep[few])
        rows_out.append(alive[few][row])
        places_out.append(place)
        alive = alive[~few]
        if not len(alive):
            break
    return np.concatenate(rows_out), np.concatenate(places_out)


def resolved(q: np.ndarray, x: np.ndarray) -> list[int]:
    """Exact inner products of pairs of rows, whatever their size, as longs hold them."""
    if (np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1]) < EXACT:
        return np.einsum("ij,ij->i", q, x).astype(np.int64).tolist()
    exact = [sum(int(a) * int(b) for a, b in zip(u, v)) for u, v in zip(q.tolist(), x.tolist())]
    return [max(-LONG - 1, min(LONG, s)) for s in exact]


def of_strip(queries: pd.DataFrame, strip: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best of one strip of candidate blocks for each query of a block."""
    out = {"block": [], "place": [], "query_id": [], "vec_id": [], "score": []}
    if not len(queries) or not len(strip):
        return pd.DataFrame(out)
    size, ids = int(queries["size"].iloc[0]), queries.vec_id.to_numpy()
    q = np.stack([np.frombuffer(v, "<f8") for v in queries.vector])
    best = Best(k, [[] for _ in range(len(q))])
    for row in strip.sort_values("block").itertuples():
        x = np.frombuffer(row.vectors, "<f8").reshape(row.n, size)
        names = np.frombuffer(row.ids, "<i8")
        lists = np.frombuffer(row.lists, np.uint16).reshape(size, row.n)
        own = np.where(queries.block.to_numpy() == row.block, queries.place.to_numpy(), -1)
        if np.abs(q).max() * np.abs(x).max() * size < EXACT:
            at, place = read_lists(q, x, lists, k, best.floor(), own)
        else:
            # Doubles do not bound such scores: all pairs are resolved.
            at, place = np.nonzero(np.arange(row.n)[None] != own[:, None])
        for i in range(0, len(at), 1 << 16):
            a, p = at[i:i + (1 << 16)], place[i:i + (1 << 16)]
            scores = np.array(resolved(q[a], x[p]), object)
            order = np.argsort(a, kind="stable")
            cuts = np.flatnonzero(np.diff(a[order])) + 1
            for chunk in np.split(order, cuts) if len(order) else ():
                best.add(int(a[chunk[0]]), scores[chunk].tolist(), names[p[chunk]].tolist())
    for query, found in zip(queries.itertuples(), best.scores):
        for score, vec_id in found:
            out["block"].append(query.block)
            out["place"].append(query.place)
            out["query_id"].append(query.vec_id)
            out["vec_id"].append(vec_id)
            out["score"].append(-score)
    return pd.DataFrame(out)


def search(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best by whole inner products.

    Reads ``vec_id`` and ``embedding``; other columns are ignored, whatever their names.
    Components become ``floor(scale * x)``. Queries are the rows whose ``vec_id`` is
    divisible by ``every``; candidates are all rows but the query's own, of the same
    length. Ties go to the smaller ``vec_id``. With fewer candidates than ``k`` all are
    returned. Rows without ``vec_id``, NULL and empty vectors and those with a NULL or
    non-finite component take no part; a row that repeats a ``vec_id`` is a row of its own,
    and so is its query. Scores that no long holds are held to its ends. No rows give none.

    No random access: candidates are blocks with a sorted list per dimension. A task reads
    the lists of a strip of blocks, block by block, for a block of queries, and carries what
    the best of earlier blocks demand over to later ones. The best of each strip and query
    are merged at the end.
    """
    table = written(blocks(usable(vectors), scale), "blocks")

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for row in rows.itertuples():
                names = np.frombuffer(row.ids, "<i8")
                x = np.frombuffer(row.vectors, "<f8").reshape(row.n, row.size)
                at = np.flatnonzero(names % every == 0)
                yield pd.DataFrame({
                    "size": row.size, "block": row.block, "place": at, "vec_id": names[at],
                    "vector": [x[i].tobytes() for i in at]})

    queries = written(table.select("size", "block", "n", "ids", "vectors").mapInPandas(
        asked, "size int, block long, place int, vec_id long, vector binary"), "queries")
    numbered = W.partitionBy("size").orderBy("block")
    # Places of blocks in the order of all: one row a block, and a window over those.
    counts = queries.groupBy("size", "block").agg(F.count(F.lit(1)).alias("asked"))
    places = table.groupBy("size", "block").agg(F.first("n").alias("rows")).join(
        counts, ["size", "block"], "left").select(
            "size", "block", (F.row_number().over(numbered) - 1).alias("number"),
            F.coalesce(F.sum("asked").over(numbered.rowsBetween(W.unboundedPreceding, -1)),
                       F.lit(0)).alias("before"))
    places = written(places, "places")
    within = F.row_number().over(W.partitionBy("size", "block").orderBy("place")) - 1
    queries = queries.withColumn("within", within).join(places, ["size", "block"]).select(
        "size", "block", "place", "vec_id", "vector",
        F.floor((F.col("before") + F.col("within")) / QUERIES).alias("asking"))
    strips = places.groupBy("size").agg(
        F.max(F.floor(F.col("number") / STRIP)).alias("last_strip"))
    askers = queries.join(strips, "size").withColumn(
        "strip", F.explode(F.sequence(F.lit(0).cast("long"), "last_strip"))).drop("last_strip")
    asking = queries.groupBy("size").agg(F.max("asking").alias("last_asking"))
    read = table.join(places.select("size", "block", "number"), ["size", "block"]).join(
        asking, "size").withColumn(
            "asking", F.explode(F.sequence(F.lit(0).cast("long"), "last_asking"))).select(
            "size", "asking", F.floor(F.col("number") / STRIP).alias("strip"), "block", "n",
            "ids", "lists", "vectors")
    near = askers.groupBy("size", "asking", "strip").cogroup(
        read.groupBy("size", "asking", "strip")
    ).applyInPandas(
        lambda asked, strip: of_strip(asked, strip, k),
        "block long, place int, query_id long, vec_id long, score long")
    rank = F.row_number().over(
        W.partitionBy("block", "place").orderBy(F.col("score").desc(), F.col("vec_id")))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
