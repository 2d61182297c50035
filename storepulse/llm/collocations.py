"""Phrases that recur more than their parts explain, by vertically partitioned suffix trees."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from storepulse.llm.common import give_back, slices, written

# Words of a phrase at most, occurrences of a phrase at least, phrases a language gets.
DEPTH, LEAST, FIRST = 5, 100, 2_000
# Words and piece ends after which a block of texts is closed.
BLOCK = 1 << 19
# Suffixes of a group of prefixes, which a task holds at 24 bytes each. With over MOST_GROUPS
# times as many suffixes, groups grow in proportion, up to LARGEST. A group's subtrees are
# built a few at a time, of about BUILT suffixes.
GROUP, MOST_GROUPS, LARGEST, BUILT = 1 << 20, 1 << 10, 1 << 23, 1 << 18
# Shares that light prefixes are dealt to by hash; a group is a run of shares.
SHARES = 1 << 16
# Bits that tell which words may be frequent, and bits of one bitmap.
BITS, BITMAP = 1 << 26, 1 << 15
# Word pairs that a worker counts at a time, and a share of them by hash, which a task sums.
PAIRS, PAIR_SHARE = 1 << 21, 1 << 21
# Bytes of a text that are split at a time.
SLICE = 1 << 20
# Rows of a batch for a Python worker, of texts and of blocks. Spark holds a batch outside
# its heap, and the worker holds it once more.
TEXTS, BLOCKS = 1 << 10, 1

# Fixed value: what ends a piece. 0xff, which UTF-8 never has, stands for it.
ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"\xff" * 10)
GAP = re.compile(rb"[ \t\xff]")


class Numbers(dict):
    """Numbers words from 1 as they come; the end of a piece is 0."""

    def __init__(self) -> None:
        super().__init__({b"\xff": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def tokens(text: str, numbers: Numbers) -> Iterator[np.ndarray]:
    """Numbers of a whole text's words and piece ends, a slice at a time."""
    data = text.encode().lower().translate(ENDS)
    start = 0
    while start < len(data):
        gap = GAP.search(data, start + SLICE)
        end = gap.start() if gap else len(data)
        found = data[start:end].replace(b"\xff", b" \xff ").split()
        yield np.fromiter(map(numbers.__getitem__, found), np.int32, len(found))
        start = end


def place_of(lang: str, phrase: bytes) -> int:
    """63 bits that a phrase of a language hashes to."""
    return xxhash.xxh3_64_intdigest(lang.encode() + b"\n" + phrase) >> 1


def blocks(docs: DataFrame) -> DataFrame:
    """Texts as blocks of numbered words: a language, its words, and their sequence.

    ``words`` are joined by newlines, which no word has; ``tokens`` are their numbers from 1,
    and 0 where a piece or a text ends. A block is closed after a text, so no phrase crosses
    its border.
    """
    schema = pa.schema([("lang", pa.string()), ("words", pa.binary()), ("tokens", pa.binary())])
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"),
                       F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[Numbers, list[np.ndarray]]] = {}
        sizes: dict[str, int] = {}

        def packed(lang: str) -> pa.RecordBatch:
            numbers, parts = held.pop(lang)
            del sizes[lang]
            return pa.RecordBatch.from_pylist([{
                "lang": lang, "words": b"\n".join(list(numbers)[1:]),
                "tokens": np.concatenate(parts).astype("<i4").tobytes()}], schema)

        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                numbers, parts = held.setdefault(lang, (Numbers(), []))
                own = [*tokens(text.as_py(), numbers), np.zeros(1, np.int32)]
                parts += own
                sizes[lang] = sizes.get(lang, 0) + sum(map(len, own))
                if sizes[lang] >= BLOCK:
                    yield packed(lang)
                # Many small languages: the largest block is closed early.
                while sum(sizes.values()) > 2 * BLOCK:
                    yield packed(max(sizes, key=sizes.get))
        for lang in list(held):
            yield packed(lang)

    return rows.mapInArrow(run, "lang string, words binary, tokens binary")


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """All rows of a task's batches, one at a time: each is large."""
    give_back()
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: column[i].as_py()
                   for name, column in zip(batch.schema.names, batch.columns)}
    give_back()


def unpacked(row: dict) -> tuple[list[bytes], np.ndarray]:
    """A block's words by number, with nothing at 0, and its sequence."""
    return [b"", *row["words"].split(b"\n")], np.frombuffer(row["tokens"], "<i4")


COUNTED = "lang string, phrase string, n long"


def counts(lang: str, phrases: list[bytes], n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([lang] * len(phrases), pa.string()),
        pa.array([p.decode() for p in phrases], pa.string()),
        pa.array(n.astype(np.int64)),
    ], ["lang", "phrase", "n"])


def summed(partial: DataFrame) -> DataFrame:
    return partial.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def placed(counted: DataFrame) -> DataFrame:
    """``lang, phrase, n, place``: with the hash of each phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [place_of(lang, phrase.encode()) for lang, phrase in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield batch.append_column("place", pa.array(places, pa.int64()))

    return counted.mapInArrow(run, f"{COUNTED}, place long")


def word_counts(read: DataFrame) -> DataFrame:
    """``lang, phrase, n`` of every word: the prefixes of length one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            words, sequence = unpacked(row)
            found = np.bincount(sequence, minlength=len(words))
            for i in range(1, len(words), 1 << 16):
                yield counts(row["lang"], words[i:i + (1 << 16)], found[i:i + (1 << 16)])

    return summed(read.mapInArrow(run, COUNTED))


def is_set(bitmap: np.ndarray, place: np.ndarray) -> np.ndarray:
    bit = place % BITS
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)


def bitmap_of(places: DataFrame) -> np.ndarray:
    """BITS bits, of which those of these rows' ``place`` are set."""
    bit = F.col("place") % BITS
    out = np.zeros(BITS // 8, np.uint8)
    for row in places.groupBy(F.floor(bit / BITMAP).alias("bitmap")).agg(
            F.bitmap_construct_agg((bit % BITMAP).cast("long")).alias("bits")).toLocalIterator():
        own = np.frombuffer(row.bits, np.uint8)
        out[row.bitmap * (BITMAP // 8):][:len(own)] = own
    return out


def frequent_words(
    frequent: np.ndarray, lang: str, words: list[bytes], sequence: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """The places of a block's words, and its sequence with 0 for those that are not frequent."""
    places = np.array([place_of(lang, w) for w in words], np.int64)
    often = is_set(frequent, places)
    often[0] = False
    return places, np.where(often[sequence], sequence, np.int32(0))


def pair_places(places: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """63 bits that pairs of words hash to, from the places of the words."""
    mixed = places.astype(np.uint64)[first] * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed += places.astype(np.uint64)[second]
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x94D049BB133111EB)
    return ((mixed ^ mixed >> np.uint64(31)) >> np.uint64(1)).astype(np.int64)


def planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 by their bytes, the first ones first: the last ones are mostly 0."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unplaned(data: bytes) -> np.ndarray:
    return np.frombuffer(np.frombuffer(data, np.uint8).reshape(4, -1).T.tobytes(), "<u4")


def frequent_pairs(read: DataFrame, frequent: np.ndarray, least: int, everything: int) -> np.ndarray:
    """A bitmap of the word pairs that occur ``least`` times, and few others.

    Workers count pairs of frequent words by hash, ``PAIRS`` places at a time, and send the
    sorted hashes as differences. A task sums those of a share; there are as many shares as
    ``everything``, the places of frequent words, asks for. Pairs whose hashes meet
    may pass without need; none that is frequent is missed.
    """
    shared = read.sparkSession.sparkContext.broadcast(frequent)
    shares = max(1, everything // PAIR_SHARE)

    def counted(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        places = np.concatenate(held)
        key = (places >> 32) % shares << 32 | places & 0xFFFFFFFF
        key.sort()
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        n = np.diff(first, append=len(key))
        key = key[first]
        own = key >> 32
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(key)]])
        for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            steps = np.diff(key[begin:end] & 0xFFFFFFFF, prepend=0)
            data = planes(steps) + planes(n[begin:end])
            yield pa.RecordBatch.from_pylist([{
                "share": int(own[begin]), "n": end - begin,
                "pairs": pa.compress(data, "zstd", asbytes=True)}])

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for row in rows_of(batches):
            words, sequence = unpacked(row)
            places, kept = frequent_words(shared.value, row["lang"], words, sequence)
            at = np.flatnonzero((kept[:-1] > 0) & (kept[1:] > 0))
            if len(at):
                held.append(pair_places(places, kept[at], kept[at + 1]))
            if sum(map(len, held)) >= PAIRS:
                yield from counted(held)
                held = []
        if held:
            yield from counted(held)

    def often(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        key, n = (np.concatenate(column) for column in zip(*parts))
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        total = np.add.reduceat(n[order].astype(np.int64), first)
        found = key[first[total >= least]].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found)], ["place"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, held = None, []
        for row in rows_of(batches):
            if held and share != row["share"]:
                yield often(held)
                held = []
            data = pa.decompress(row["pairs"], 8 * row["n"], "zstd", asbytes=True)
            steps, n = unplaned(data[:4 * row["n"]]), unplaned(data[4 * row["n"]:])
            held.append((np.cumsum(steps, dtype=np.int64).astype(np.uint32), n))
            share = row["share"]
        if held:
            yield often(held)

    rows = read.mapInArrow(sent, "share long, n long, pairs binary").repartition(
        "share").sortWithinPartitions("share")
    return bitmap_of(written(rows.mapInArrow(sums, "place long"), "frequent-pairs", BLOCKS))


@dataclass
class Partition:
    """Which words and pairs may be frequent, which prefixes are heavy, and the groups of the others.

    Bounded: ``frequent`` and ``pairs`` by BITS, ``group`` by SHARES, ``heavy`` by the number
    of suffixes over the size of a group, for each depth.
    """

    frequent: np.ndarray
    pairs: np.ndarray
    heavy: list[dict[str, list[bytes]]]
    group: np.ndarray

    def parted(self, places: np.ndarray, kept: np.ndarray) -> np.ndarray:
        """The sequence without words that are in no frequent pair, and with a 0 between
        neighbours that are none: no frequent phrase crosses it."""
        joined = np.zeros(len(kept) + 1, bool)
        at = np.flatnonzero((kept[:-1] > 0) & (kept[1:] > 0))
        joined[at + 1] = is_set(self.pairs, pair_places(places, kept[at], kept[at + 1]))
        before, after = joined[:-1], joined[1:]
        at = np.flatnonzero(before | after)
        last = ~after[at]
        out = np.zeros(len(at) + int(last.sum()), np.int32)
        out[np.arange(len(at)) + np.cumsum(last) - last] = kept[at]
        return out

    def suffixes(self, lang: str, words: list[bytes], sequence: np.ndarray, depth: int):
        """The parts of the sequence that frequent phrases can lie in, and by depth, for each
        place of these the number of the heavy prefix that starts there, or -1."""
        places, kept = frequent_words(self.frequent, lang, words, sequence)
        kept = self.parted(places, kept)
        size = len(kept)
        kept = np.concatenate([kept, np.zeros(depth, np.int32)])
        number = {w: i for i, w in enumerate(words)}
        names, found = {(): 0}, [np.zeros(size, np.int64)]
        for k, of_lang in enumerate(self.heavy, 1):
            keys, ahead = [], {}
            for phrase in of_lang.get(lang, ()):
                ids = tuple(number.get(w, 0) for w in phrase.split(b" "))
                if all(ids) and ids[:-1] in names:
                    ahead[ids] = len(keys)
                    keys.append(names[ids[:-1]] * len(words) + ids[-1])
            order = np.argsort(np.array(keys, np.int64))
            ranked = np.array(keys, np.int64)[order]
            own = found[-1] * len(words) + kept[k - 1:k - 1 + size]
            at = np.minimum(np.searchsorted(ranked, own), max(len(keys) - 1, 0))
            hit = (found[-1] >= 0) & (kept[k - 1:k - 1 + size] > 0)
            hit &= ranked[at] == own if len(keys) else False
            found.append(np.where(hit, order[at] if len(keys) else -1, -1))
            names = ahead
        return places, kept, found[1:]


def extensions(read: DataFrame, partition: Partition, depth: int) -> DataFrame:
    """``lang, phrase, n, place`` of all that follow a heavy prefix of ``depth - 1`` words."""
    shared = read.sparkSession.sparkContext.broadcast(partition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            words, sequence = unpacked(row)
            _, kept, heavy = shared.value.suffixes(row["lang"], words, sequence, DEPTH)
            at = np.flatnonzero((heavy[-1] >= 0) & (kept[depth - 1:depth - 1 + len(heavy[-1])] > 0))
            key = heavy[-1][at] * len(words) + kept[at + depth - 1]
            _, first, n = np.unique(key, return_index=True, return_counts=True)
            for i in range(0, len(first), 1 << 16):
                starts = at[first[i:i + (1 << 16)]]
                phrases = [b" ".join([words[w] for w in kept[s:s + depth].tolist()])
                           for s in starts.tolist()]
                yield counts(row["lang"], phrases, n[i:i + (1 << 16)])

    return summed(read.mapInArrow(run, COUNTED))


def partitioned(
    read: DataFrame, words: DataFrame, least: int, group: int,
) -> tuple[Partition, list[DataFrame]]:
    """Vertical partitioning: the groups, and the counts of all heavy prefixes.

    A prefix over the size of a group is extended by a word, until it is light or as long as
    a phrase may be; light prefixes are packed into groups by their counts.
    """
    often = words.filter(F.col("n") >= least)
    frequent = bitmap_of(often)
    everything = often.agg(F.sum("n")).first()[0] or 0
    pairs = frequent_pairs(read, frequent, least, everything)
    size = min(max(group, everything // MOST_GROUPS), max(group, LARGEST))
    share = (F.col("place") % SHARES).cast("int").alias("share")
    weights = np.zeros(SHARES, np.int64)
    partition = Partition(frequent, pairs, [], np.zeros(SHARES, np.int64))
    level, known = often, []
    for depth in range(1, DEPTH + 1):
        if depth > 1:
            level = placed(written(
                extensions(read, partition, depth), f"prefixes-{depth}", BLOCKS))
        if depth == DEPTH:
            known.append(level.filter(F.col("n") >= least).withColumn("words", F.lit(depth)))
            break
        for row in level.filter(F.col("n") <= size).groupBy(share).agg(
                F.sum("n").alias("n")).toLocalIterator():
            weights[row.share] += row.n
        heavy: dict[str, list[bytes]] = {}
        over = level.filter(F.col("n") > size)
        for row in over.select("lang", "phrase").toLocalIterator():
            heavy.setdefault(row.lang, []).append(row.phrase.encode())
        partition.heavy.append(heavy)
        if not heavy:
            break
        if depth > 1:
            known.append(over.filter(F.col("n") >= least).withColumn("words", F.lit(depth)))
    filled, number = 0, 0
    for i, weight in enumerate(weights.tolist()):
        if filled and filled + weight > size:
            filled, number = 0, number + 1
        filled += weight
        partition.group[i] = number
    return partition, [rows.select("lang", "phrase", "n", "words") for rows in known]


def routed(read: DataFrame, partition: Partition) -> DataFrame:
    """The suffixes of each block, cut off after ``DEPTH`` words, by group of their prefix.

    A row is all that a block has for a group: ``words``, and ``suffixes`` as columns: the
    numbers, from 1, of a suffix's words, 0 after its end, and the length of its light
    prefix. They are sorted by their first two words and packed.
    """
    shared = read.sparkSession.sparkContext.broadcast(partition)
    schema = pa.schema([("group", pa.int64()), ("lang", pa.string()), ("words", pa.binary()),
                        ("wide", pa.bool_()), ("n", pa.int32()), ("suffixes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            words, sequence = unpacked(row)
            lang, group = row["lang"], shared.value.group
            places, kept, heavy = shared.value.suffixes(lang, words, sequence, DEPTH)
            size = len(kept) - DEPTH
            columns = [kept[:size]]
            for k in range(1, DEPTH):
                columns.append(np.where(columns[-1] > 0, kept[k:k + size], np.int32(0)))
            route = np.where(columns[1] > 0, group[places % SHARES][columns[0]], -1)
            light = np.ones(size, np.int32)
            for k, own in enumerate(heavy, 1):
                # What a heavy prefix starts goes by one word more; if there is none,
                # or no room for one, its phrases are counted already.
                at = np.flatnonzero(own >= 0)
                route[at] = -1
                if k + 1 >= DEPTH:
                    continue
                at = at[columns[k][at] > 0]
                key = own[at] * len(words) + columns[k][at]
                _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
                phrases = [b" ".join([words[w] for w in kept[s:s + k + 1].tolist()])
                           for s in at[first].tolist()]
                of = np.array([place_of(lang, p) % SHARES for p in phrases], np.int64)
                route[at] = group[of[inverse]] if len(of) else route[at]
                light[at] = k + 1
            at = np.flatnonzero(route >= 0)
            at = at[np.lexsort((columns[1][at], route[at] * len(words) + columns[0][at]))]
            rows = np.stack([c[at] for c in columns] + [light[at]])
            route = route[at]
            del columns, light, heavy, at
            cuts = np.flatnonzero(np.diff(route)) + 1
            used = np.zeros(len(words), np.int64)
            for number, part in zip(route[np.concatenate([[0], cuts])] if len(route) else (),
                                    np.split(rows, cuts, axis=1)):
                present = np.zeros(len(words), bool)
                present[part[:DEPTH]] = True
                present[0] = False
                own = np.flatnonzero(present)
                used[own] = np.arange(1, len(own) + 1)
                part = np.vstack([used[part[:DEPTH]], part[DEPTH:]])
                wide = len(own) >= 1 << 16
                data = part.astype("<u4" if wide else "<u2").tobytes()
                yield pa.RecordBatch.from_pylist([{
                    "group": number, "lang": lang, "wide": wide, "n": part.shape[1],
                    "words": b"\n".join([words[i] for i in own.tolist()]),
                    "suffixes": pa.compress(data, "zstd", asbytes=True)}], schema)

    return read.mapInArrow(
        run, "group long, lang string, words binary, wide boolean, n int, suffixes binary")


def unrouted(parts: list[dict]) -> tuple[list[bytes], np.ndarray]:
    """The words and suffixes of a group, a row each. Uses up ``parts``."""
    numbers: dict[bytes, int] = {}
    rows, end = np.empty((sum(part["n"] for part in parts), DEPTH + 1), np.int32), 0
    while parts:
        part = parts.pop()
        size, kind = part["n"], "<u4" if part["wide"] else "<u2"
        words = part["words"].split(b"\n")
        of = np.array([0, *(numbers.setdefault(w, len(numbers) + 1) for w in words)], np.int32)
        data = pa.decompress(
            part["suffixes"], size * (DEPTH + 1) * int(kind[-1]), "zstd", asbytes=True)
        own = np.frombuffer(data, kind).reshape(DEPTH + 1, size).T
        rows[end:end + size, :DEPTH] = of[own[:, :DEPTH]]
        rows[end:end + size, DEPTH] = own[:, DEPTH]
        end += size
    return [b"", *numbers], rows


def subtree(
    names: list[bytes], rows: np.ndarray, least: int,
) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """By length, the phrases of these suffixes that occur ``least`` times, and how often.

    Level by level: the nodes of a level are the pairs of a node above and a word, and what
    lies below a node that is too rare is cut off. Every suffix is a leaf of its own, so a
    node's total is the number of suffixes below it.
    """
    node = rows[:, 0].astype(np.int64)
    for k in range(1, DEPTH):
        live = rows[:, k] > 0
        rows, node = rows[live], node[live]
        key = node * len(names) + rows[:, k]
        _, first, inverse, n = np.unique(
            key, return_index=True, return_inverse=True, return_counts=True)
        # Nodes above the light prefix are spread over groups, and counted elsewhere.
        counted = rows[first, DEPTH] <= k + 1
        often = np.flatnonzero(counted & (n >= least))
        yield k + 1, [b" ".join([names[w] for w in rows[i, :k + 1].tolist()])
                      for i in first[often].tolist()], n[often]
        live = (~counted | (n >= least))[inverse]
        rows, node = rows[live], inverse[live].astype(np.int64)


def phrase_counts(suffixes: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, n, words`` of all frequent phrases of light prefixes.

    A task reads group after group, and holds one. Suffixes that begin with the same two
    words belong to one subtree; subtrees are built as many at a time as BUILT allows.
    """
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64()),
                        ("words", pa.int32())])
    rows = suffixes.repartition("group").sortWithinPartitions("group", "lang")

    def found(parts: list[dict]) -> Iterator[pa.RecordBatch]:
        lang = parts[0]["lang"]
        names, rows = unrouted(parts)
        turns = len(rows) // BUILT + 1
        turn = (rows[:, 0] * np.int32(31) + rows[:, 1]) % np.int32(turns)
        for i in range(turns):
            for k, phrases, n in subtree(names, rows[turn == i], least):
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(phrases), pa.string()),
                    pa.array([p.decode() for p in phrases], pa.string()),
                    pa.array(n.astype(np.int64)), pa.array([k] * len(phrases), pa.int32()),
                ], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for row in rows_of(batches):
            if held and (held[0]["group"], held[0]["lang"]) != (row["group"], row["lang"]):
                yield from found(held)
            held.append(row)
        if held:
            yield from found(held)

    return rows.mapInArrow(run, "lang string, phrase string, n long, words int")


def first_words(phrase: Column, k: Column) -> Column:
    return F.concat_ws(" ", F.slice(F.split(phrase, " "), F.lit(1), k))


def scored(phrases: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score`` of phrases, cut where they score least.

    ``phrases`` has ``lang, phrase, words, a``; ``words`` has ``lang, phrase, n``. Both parts
    of a frequent phrase are frequent. Products are decimals of 38 digits.
    """
    parts = words.select("lang", "phrase", "n").unionByName(
        phrases.select("lang", "phrase", F.col("a").alias("n")))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("left", first_words(F.col("phrase"), F.col("k")))
    cuts = cuts.withColumn("right", F.expr("substring(phrase, length(left) + 2)"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")),
                     ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")),
                     ["lang", "right"]).join(totals, "lang")
    cuts = cuts.withColumn("score", F.expr(
        "(1000 * cast(a as decimal(17, 0)) * cast(n as decimal(17, 0)))"
        " div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"))
    return cuts.groupBy("lang", "phrase", "words", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
            "lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")


def maximal(phrases: DataFrame) -> DataFrame:
    """Phrases without those that a longer one holds each time they occur.

    A longer phrase never occurs more often, and if one of any length occurs as often, so
    does the one that has a word more: it is enough to look at those.
    """
    longer = phrases.filter(F.col("words") > 2)
    inner = [first_words(F.col("phrase"), F.col("words") - 1),
             F.expr("substring(phrase, length(substring_index(phrase, ' ', 1)) + 2)")]
    held = longer.select("lang", F.explode(F.array(*inner)).alias("phrase"), "a").distinct()
    return phrases.join(held, ["lang", "phrase", "a"], "left_anti")


def mine(
    docs: DataFrame, least: int = LEAST, first: int = FIRST, group: int = GROUP,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``first`` phrases.

    Reads ``text, lang``; other columns are ignored, whatever their names. NULL texts are
    empty, NULL languages ``und``. A-Z are lower-cased; pieces end at ``.,;:!?`` and line
    ends, words at spaces and tabs. Phrases of 2 to 5 words that occur ``least`` times within
    pieces score ``1000 a n / (l r)`` at their worst cut, rounded down; one that a longer
    frequent phrase holds each time is left out. Ties go to the more frequent, then to the
    phrase. Repeated rows count each time. No rows, or no frequent phrase, give no rows.

    Texts are split once, into blocks of numbered words, and parted between words that are
    no frequent pair. Word prefixes are grouped by how often they occur, prefixes of more than
    a group are extended first, and every group's suffixes, cut off after five words, go to
    one task, which builds their tree.
    """
    read = written(blocks(docs), "blocks", TEXTS)
    counted = written(word_counts(read), "words", BLOCKS)
    words = written(placed(counted.filter(F.col("n") >= least)), "frequent-words")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    partition, known = partitioned(read, words, least, group)
    found = reduce(DataFrame.unionByName, known, phrase_counts(routed(read, partition), least))
    phrases = written(found.withColumnRenamed("n", "a"), "phrases", BLOCKS)
    kept = maximal(scored(phrases, words, totals))
    order = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(
        F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
