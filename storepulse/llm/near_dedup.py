"""Near-duplicate classes by SetSketch registers, likelihood and exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from storepulse.llm.common import WORD, map_rows, slices, written

# Base of the register scale: neighbouring values differ by 0.1 per cent, so equal
# registers are about as likely as equal minima.
BASE = 1.001
# Registers are truncated to this range; 2 bytes each.
MOST = 65_534
RATE = 20.0
# The chance that banding misses a pair at the threshold is below this.
MISSED = 1e-5
# Standard deviations below the threshold at which the likelihood estimate drops a pair.
DOUBT = 5.0
# Members of a bucket that one task compares with each other at a time.
BLOCK = 512
# Words whose hash a worker remembers.
REMEMBERED = 400_000
# Shingles whose registers are computed in one sweep.
SWEEP = 512

MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """``words`` a shingle, linked from ``percent`` of the union in common."""

    words: int = 5
    percent: int = 80
    band: int = field(init=False)
    bands: int = field(init=False)

    def __post_init__(self) -> None:
        threshold = self.percent / 100
        rows = max(1, round(math.log(0.42) / math.log(threshold))) if threshold < 1 else 8
        hit = min(threshold ** rows, 1 - 1e-9)
        object.__setattr__(self, "band", rows)
        object.__setattr__(self, "bands", math.ceil(math.log(MISSED) / math.log(1 - hit)))

    @property
    def registers(self) -> int:
        return self.band * self.bands


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


@lru_cache
def multipliers(n: int) -> np.ndarray:
    """An odd multiplier for each register."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * MIX) | np.uint64(1)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return value


def shingles(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a whole text's shingles.

    Words are what white space parts, A-Z in lower case. Fewer words than a shingle has
    are one shingle; no words give the empty set.
    """
    if len(hashes) > REMEMBERED:
        hashes.clear()
    parts = (text or "").encode().lower().split()
    h = np.fromiter(map(hashes.__getitem__, parts), np.uint64, len(parts))
    if not len(h):
        return h
    n = max(len(h) - words + 1, 1)
    rolled = np.zeros(n, np.uint64)
    for i in range(min(words, len(h))):
        rolled = mixed(rolled + h[i:i + n] + np.uint64(i + 1))
    return np.unique(rolled)


def sketch(values: np.ndarray, registers: int) -> np.ndarray:
    """SetSketch registers of a nonempty set; the maximum merges two sketches.

    Each register is the smallest of exponential variables, one per element, on a scale
    of powers of ``BASE``: ``1 - log(smallest)``, truncated to 0 .. MOST + 1.
    """
    least = np.full(registers, np.iinfo(np.uint64).max, np.uint64)
    by = multipliers(registers)
    for i in range(0, len(values), SWEEP):
        np.minimum(least, (values[i:i + SWEEP, None] * by).min(0), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0 ** 64
    exponential = -np.log1p(-uniform) / RATE
    level = np.floor(1 - np.log(np.maximum(exponential, 1e-300)) / math.log(BASE))
    return np.clip(level, 0, MOST + 1).astype(np.uint16)


def band_hashes(registers: np.ndarray, settings: Settings) -> np.ndarray:
    """A 64-bit hash of each band of each row of registers."""
    h = np.tile(np.arange(1, settings.bands + 1, dtype=np.uint64), (len(registers), 1))
    parts = registers.reshape(len(registers), settings.bands, settings.band)
    for i in range(settings.band):
        h = mixed(h + parts[:, :, i].astype(np.uint64) * MIX)
    return h.view(np.int64)


GRID = np.linspace(0.005, 0.995, 100)


def likely_similarity(
    above: np.ndarray, below: np.ndarray, equal: np.ndarray, n: np.ndarray, m: np.ndarray,
) -> np.ndarray:
    """Maximum-likelihood similarity of pairs of sets of ``n`` and ``m`` elements.

    From the numbers of registers of the first that are above, below and equal to the
    second's. A register is above if the smallest element is the first set's own, by more
    than the scale resolves.
    """
    u, v = (n / (n + m))[:, None], (m / (n + m))[:, None]
    q = np.minimum(GRID[None, :], np.minimum(u / v, v / u) - 1e-9)
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)
    more, less = np.clip(p(u - v * q), 1e-12, 1), np.clip(p(v - u * q), 1e-12, 1)
    same = np.clip(1 - more - less, 1e-12, 1)
    score = (above[:, None] * np.log(more) + below[:, None] * np.log(less)
             + equal[:, None] * np.log(same))
    return q[np.arange(len(q)), score.argmax(1)]


def promising(
    a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, settings: Settings,
) -> np.ndarray:
    """Which pairs of sketches may reach the threshold; a pair of rows each."""
    threshold = settings.percent / 100
    fits = 100 * np.minimum(n, m) >= settings.percent * np.maximum(n, m)
    least = threshold - DOUBT * math.sqrt(threshold * (1 - threshold) / settings.registers)
    found = np.zeros(len(a), bool)
    at = np.flatnonzero(fits)
    if len(at):
        x, y = a[at], b[at]
        estimate = likely_similarity(
            (x > y).sum(1), (x < y).sum(1), (x == y).sum(1),
            n[at].astype(float), m[at].astype(float))
        found[at] = estimate >= least
    return found


def print_of(found: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return blake2b(found.tobytes(), digest_size=16).digest()


def sets_of(docs: DataFrame, words: int) -> DataFrame:
    """Each document's set: its ``print`` and its hashes, packed as ``shingles``."""
    hashes = WordHashes()

    def of(batch: pa.RecordBatch) -> list:
        sets = [shingles(t.as_py(), words, hashes) for t in batch.column(0)]
        return [[print_of(s) for s in sets], [s.tobytes() for s in sets]]

    return map_rows(docs.select("text"), "print binary, shingles binary", of)


def mark_of(text: Column) -> Column:
    """What tells texts apart, to the letter."""
    return F.md5(text.cast("binary"))


def sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    """``doc_id``, the ``mark`` of the text, ``n_shingles``, the ``print`` of the set, and its
    ``registers``."""
    hashes = WordHashes()

    def of(batch: pa.RecordBatch) -> list:
        out: list[list] = [[], [], []]
        for text in batch.column(1):
            found = shingles(text.as_py(), settings.words, hashes)
            out[0].append(len(found))
            out[1].append(print_of(found))
            out[2].append(sketch(found, settings.registers).tobytes() if len(found) else b"")
        return [batch.column(0), batch.column(2), *out]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(
        docs.select("doc_id", "text", mark_of(F.col("text")).alias("mark")),
        f"doc_id {kind}, mark string, n_shingles long, print binary, registers binary", of)


def matrix(packed: pd.Series, registers: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.uint16).reshape(len(packed), registers)


def likely(pairs: DataFrame, settings: Settings) -> DataFrame:
    """The pairs ``a, b`` whose sketches ``ra, rb`` may reach the threshold."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            good = promising(matrix(rows.ra, settings.registers),
                             matrix(rows.rb, settings.registers),
                             rows.na.to_numpy(), rows.nb.to_numpy(), settings)
            yield rows.loc[good, ["a", "b"]]

    return pairs.select("a", "b", "na", "nb", "ra", "rb").mapInPandas(
        run, "a binary, b binary")


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Elements that two sorted sets have in common."""
    place = np.minimum(np.searchsorted(x, y), len(x) - 1)
    return int((x[place] == y).sum())


def linked(x: np.ndarray, y: np.ndarray, settings: Settings) -> bool:
    common = overlap(x, y)
    return 100 * common >= settings.percent * (len(x) + len(y) - common)


def verified(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs ``a, b`` that the full sets confirm.

    ``sets`` has ``print, shingles``. Spark splits the pairs of a set that many name.
    """
    left = sets.select(F.col("print").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("print").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                keep.append(linked(np.frombuffer(x.as_py(), np.uint64),
                                   np.frombuffer(y.as_py(), np.uint64), settings))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "sa", "sb").mapInArrow(
        run, "a binary, b binary")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``id, root``: the smallest id each node reaches over the edges ``a, b``.

    Rounds of hooking and pointer jumping: every node takes the smallest root among its
    neighbours and itself, then its root's root. Each round is written, so a lost
    executor costs one round; rounds end when no edge joins two roots.
    """
    roots = written(nodes.select("id", F.col("id").alias("root")), "roots")
    live = edges.select("a", "b")
    while True:
        at_a = roots.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        at_b = roots.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        # Edges between roots; those within one root are done.
        live = written(
            live.join(at_a, "a").join(at_b, "b").filter("ra <> rb").select(
                F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            "live-edges",
        )
        if live.isEmpty():
            return roots
        hooks = live.groupBy(F.col("b").alias("from")).agg(F.min("a").alias("to"))
        # A chain of hooks only ever goes down; follow it to its end.
        hooks = written(hooks, "hooks")
        while True:
            ahead = hooks.select(F.col("from").alias("to"), F.col("to").alias("on"))
            jumped = written(
                hooks.join(ahead, "to", "left").select(
                    "from", F.coalesce("on", "to").alias("to"), F.col("on").isNotNull().alias("moved")),
                "hooks",
            )
            hooks = jumped.select("from", "to")
            if jumped.filter("moved").isEmpty():
                break
        moved = hooks.select(F.col("from").alias("root"), "to")
        roots = written(
            roots.join(moved, "root", "left").select("id", F.coalesce("to", "root").alias("root")),
            "roots",
        )


def leftover_links(members: DataFrame, settings: Settings) -> DataFrame:
    """Links ``a, b`` that join the components of a bucket; as many as they need.

    ``members`` has ``bucket, id, root, n, registers, shingles``. The members of a
    bucket's largest component need no comparison with each other, the rest with
    everyone: both are dealt over blocks by hash, and each block of the rest meets every
    block. A pair is compared in the first band it shares only: by its sketches, then by
    its full sets, unless links of the block already join it. Pairs are never rows.
    """
    counts = members.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = counts.groupBy("bucket").agg(
        F.max_by("root", F.struct("size", "root")).alias("main"),
        F.max("size").alias("main_size"), F.sum("size").alias("all_size"))
    blocks = lambda size: F.ceil(size / BLOCK).cast("int")
    dealt = members.join(
        largest.select("bucket", "main",
                       blocks(F.col("all_size") - F.col("main_size")).alias("rest_blocks"),
                       blocks(F.col("main_size")).alias("main_blocks")), "bucket"
    ).withColumn("in_main", F.col("root") == F.col("main")).withColumn(
        "block",
        F.when(F.col("in_main"),
               F.col("rest_blocks") + F.pmod(F.xxhash64("id"), F.col("main_blocks")))
        .otherwise(F.pmod(F.xxhash64("id"), F.col("rest_blocks"))).cast("int"),
    )
    meets = F.sequence(F.lit(0), F.when(F.col("in_main"), F.col("rest_blocks"))
                       .otherwise(F.col("rest_blocks") + F.col("main_blocks")) - 1)
    dealt = dealt.withColumn("other", F.explode(meets)).select(
        "bucket", "id", "root", "n", "registers", "shingles", "block",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        low, high, bucket = rows.low.iloc[0], rows.high.iloc[0], rows.bucket.iloc[0]
        rows = rows.sort_values("block", kind="stable")
        x, n, ids = matrix(rows.registers, settings.registers), rows.n.to_numpy(), rows.id.to_numpy()
        sets = [np.frombuffer(packed, np.uint64) for packed in rows.shingles]
        roots = np.unique(rows.root.to_numpy(), return_inverse=True)[1]
        in_band = band_hashes(x, settings) == bucket
        band = in_band.argmax(1)[0]
        earlier = x[:, :band * settings.band].reshape(len(x), band, settings.band)
        first_right = 0 if low == high else int((rows.block == low).sum())
        found = []
        for i in range(len(rows) if low == high else first_right):
            at = np.arange(max(i + 1, first_right), len(rows))
            at = at[roots[at] != roots[i]]
            at = at[~(earlier[at] == earlier[i]).all(2).any(1)]
            at = at[promising(np.broadcast_to(x[i], (len(at), settings.registers)), x[at],
                              np.full(len(at), n[i]), n[at], settings)]
            for j in at:
                if roots[i] != roots[j] and linked(sets[i], sets[j], settings):
                    roots[roots == roots[j]] = roots[i]
                    found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        return pd.DataFrame(found, columns=["a", "b"], dtype=object)

    # Else Spark takes the deal by bucket, which the joins have made, as good enough, and all
    # blocks of a bucket are one task's.
    return dealt.repartition("bucket", "low", "high").groupBy("bucket", "low", "high").applyInPandas(
        compare, "a binary, b binary").distinct()


def classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Reads integer ``doc_id`` and ``text``; other columns are ignored, whatever their
    names. Documents whose shingle sets reach the threshold are linked; a component is
    what links reach, named by its smallest doc_id, which is kept. Sets are compared as
    sets of 64-bit hashes.

    NULL, empty and white texts have the empty set and are linked with nothing: each is
    its own component. Repeated rows are copies of each other. NULL doc_ids link nothing;
    they get a NULL component and are kept. No rows give no rows.

    Equal sets are one class before anything else, by partial aggregation, so copies
    never meet in a task. Classes are banded; within a bucket all are paired with one of
    them, drawn anew for each band, verified and joined. Buckets that still hold several components are
    compared whole, except inside their largest component: no link between components is
    left out, and links inside one add nothing.
    """
    read, by_print = judged(docs, settings)
    component = F.when(F.col("n_shingles") > 0, F.col("lowest")).otherwise(F.col("doc_id"))
    return read.select("doc_id", "n_shingles", "print").join(by_print, "print", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def judged(docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """The sketches of all rows, and for the ``print`` of each set that is not empty the
    component's ``lowest`` doc_id and the print ``lowest_print`` of a set that has it."""
    read = written(sketches(docs, settings), "sketches")
    full = read.filter("n_shingles > 0 and doc_id is not null")
    sets = written(
        full.groupBy(F.col("print").alias("id")).agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"),
            F.first("registers").alias("registers")),
        "distinct-sets",
    )

    def banded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            hashes = band_hashes(matrix(rows.registers, settings.registers), settings)
            yield pd.DataFrame({"id": np.repeat(rows.id.to_numpy(), settings.bands),
                                "bucket": hashes.ravel()})

    bands = written(
        sets.select("id", "registers").mapInPandas(banded, "id binary, bucket long"), "bands")
    centres = written(
        bands.groupBy("bucket").agg(
            F.min_by("id", F.xxhash64("id", "bucket")).alias("centre"),
            F.count(F.lit(1)).alias("members")).filter("members > 1"), "buckets")
    stars = bands.join(centres, "bucket").filter("id <> centre").select(
        F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()

    def side(name: str) -> DataFrame:
        return sets.select(F.col("id").alias(name), F.col("n").alias("n" + name),
                           F.col("registers").alias("r" + name))

    candidates = written(
        likely(stars.join(side("a"), "a").join(side("b"), "b"), settings), "candidates")

    # The sets of all that share a bucket, from their texts again. Merged at every size:
    # the texts move once, whether few or many are wanted.
    shared = bands.join(centres, "bucket").select("id").distinct()
    wanted = sets.join(shared, "id").select("doc_id").hint("merge")
    texts = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    full_sets = written(sets_of(texts, settings.words).dropDuplicates(["print"]), "sets")
    links = written(verified(candidates, full_sets, settings), "links")
    roots = components(sets, links)
    split = (
        bands.join(centres.filter("members > 2").select("bucket"), "bucket").join(roots, "id")
        .groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .filter("low <> high").select("bucket")
    )
    members = bands.join(split, "bucket").join(roots, "id").join(
        sets.select("id", "n", "registers"), "id").join(
            full_sets.withColumnRenamed("print", "id"), "id")
    more = written(leftover_links(members, settings), "leftovers")
    if not more.isEmpty():
        roots = components(sets, links.union(more))

    named = sets.join(roots, "id")
    lowest = named.groupBy("root").agg(F.min(F.struct("doc_id", "id")).alias("lowest"))
    return read, named.join(lowest, "root").select(
        F.col("id").alias("print"), F.col("lowest.doc_id").alias("lowest"),
        F.col("lowest.id").alias("lowest_print"))


def deduplicated(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row of each class: the rows of ``docs`` that stay, with their columns.

    It is decided by row, not by doc_id: rows of one doc_id with different texts are documents
    of their own, and each stays unless it is a near copy of a row with a smaller doc_id, or
    of another row of its own. Rows without doc_id, and texts without words, are linked with
    nothing and all stay.
    """
    read, by_print = judged(docs, settings)
    full = read.filter("n_shingles > 0 and doc_id is not null")
    # Of the texts that have the lowest doc_id and its set, the one of the least mark.
    keepers = full.join(by_print.filter("print = lowest_print"), "print").filter(
        "doc_id = lowest").groupBy("print").agg(F.min(F.struct("doc_id", "mark")).alias("keeper"))
    keepers = keepers.select(F.col("keeper.doc_id").alias("held_id"),
                             F.col("keeper.mark").alias("mark")).hint("merge")
    free = F.col("doc_id").isNull() | ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    held = docs.filter(~free).select(
        F.col("doc_id").alias("held_id"), mark_of(F.col("text")).alias("mark"),
        F.struct(*[docs[c] for c in docs.columns]).alias("held"))
    # Rows that are the same in doc_id and text leave each task as one.
    one = held.join(keepers, ["held_id", "mark"], "left_semi").groupBy("held_id", "mark").agg(
        F.min_by("held", F.xxhash64("held")).alias("held"))
    return one.select("held.*").unionByName(docs.filter(free))
