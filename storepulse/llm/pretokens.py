"""Encoding whole texts by their distinct pretokens, found and looked up in blocks."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

from storepulse.llm.repair import stretches

# Fixed value: the pattern of byte-level BPE that `split_plain` splits by.
PLAIN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# What may follow the apostrophe of a contraction.
SHORT, LONG = ("s", "t", "m", "d"), ("re", "ve", "ll")
OTHER, LETTER, NUMBER, SPACE = range(4)
# Pretokens a worker remembers of late; as many that it met earlier are kept besides.
REMEMBERED = 400_000
# Characters that are encoded together at least: pretokens repeat within a block.
TOGETHER = 1 << 22

Encode = Callable[[Sequence[bytes]], Iterable[Sequence[int]]]


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """Of each code point: letter, number, white space or other, as `regex` has them."""
    kind = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, range(0x110000)))
    for what, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for found in regex.finditer(pattern, every):
            kind[found.start():found.end()] = what
    return kind


def bounded(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the joined texts, where pretokens of `PLAIN` start, and texts do.

    A pretoken is a run of one kind, with a single space before it if there is one. White
    space gives its last character away unless the text ends with it. An apostrophe that
    starts a run takes the letters of a contraction.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    n = len(points)
    ends = np.cumsum([len(t) for t in texts])
    firsts = np.concatenate([[0], ends[:-1]])
    if not n:
        return points, np.zeros(0, bool), firsts
    kind = kinds()[points]
    new_text = np.zeros(n + 1, bool)
    new_text[firsts] = True
    start = new_text[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    white = kind == SPACE
    tail = np.flatnonzero(white[:-1] & ~white[1:] & ~new_text[1:n])
    start[tail] = True
    start[tail[points[tail] == ord(" ")] + 1] = False

    quote = np.flatnonzero(start & (points == ord("'")))
    if len(quote):
        left = ends[np.searchsorted(ends, quote, side="right")] - quote - 1
        padded = np.concatenate([points, np.zeros(2, "<u4")])
        one, two = padded[quote + 1], padded[quote + 2]
        short = (left >= 1) & np.isin(one, [ord(c) for c in SHORT])
        long = (left >= 2) & np.logical_or.reduce(
            [(one == ord(c[0])) & (two == ord(c[1])) for c in LONG])
        start[quote[short | long] + 1] = False
        after = np.concatenate([quote[short] + 2, quote[long] + 3])
        start[after[after < n]] = True
    return points, start, firsts


def split_plain(texts: Sequence[str]) -> tuple[pa.Array, np.ndarray]:
    """Pretokens of all texts by `PLAIN`, as UTF-8, and the first one of each text."""
    points, start, firsts = bounded(texts)
    data = "".join(texts).encode()
    starts = np.flatnonzero(start)
    at = starts
    if len(data) != len(points):
        width = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
        at = (np.cumsum(width, dtype=np.int64) - width)[starts]
    offsets = np.append(at, len(data)).astype(np.int64)
    pieces = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return pieces, np.searchsorted(starts, firsts)


def plain_list(pieces: pa.Array) -> list[bytes]:
    """What `to_pylist` gives for pieces without NULLs, cut from their one buffer."""
    if not len(pieces):
        return []
    _, offsets, data = pieces.buffers()
    at = np.frombuffer(offsets, np.int64)[pieces.offset:pieces.offset + len(pieces) + 1].tolist()
    whole = data.to_pybytes() if data else b""
    return [whole[a:b] for a, b in zip(at, at[1:])]


class Chunks:
    """Ids of texts, from those of their distinct pretokens.

    ``pattern`` splits into pretokens, ``encode`` gives the ids of each of a list of
    pretokens in UTF-8. Memory goes by ``remembered`` and ``characters``: a block of
    ``characters``, or a longer text, is split at once.
    """

    def __init__(
        self, pattern, encode: Encode, remembered: int = REMEMBERED,
        characters: int = TOGETHER,
    ):
        self.pattern, self.encode = pattern, encode
        self.remembered, self.characters = remembered, characters
        self.split = split_plain if pattern.pattern == PLAIN else self.split_by_pattern
        self.late: dict[bytes, bytes] = {}
        self.early: dict[bytes, bytes] = {}

    def split_by_pattern(self, texts: Sequence[str]) -> tuple[pa.Array, np.ndarray]:
        parts = [self.pattern.findall(text) for text in texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        return (pa.array([p.encode() for own in parts for p in own], pa.large_binary()),
                np.cumsum(sizes) - sizes)

    def read(self, pretokens: list[bytes]) -> list[bytes]:
        """Ids of distinct pretokens, as little-endian unsigned 32-bit integers."""
        if len(self.late) > self.remembered:
            self.late, self.early = {}, self.late
        late, early = self.late, self.early
        found = list(map(late.get, pretokens))
        missing = []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            p = pretokens[i]
            if p in early:
                found[i] = late[p] = early[p]
            else:
                missing.append(i)
        # One pretoken's ids at a time: lists of all would set off the garbage collector.
        ids, ends = array("I"), [0]
        for own in self.encode([pretokens[i] for i in missing]) if missing else ():
            ids.extend(own)
            ends.append(ids.itemsize * len(ids))
        data = np.array(ids, "<u4").tobytes()
        for i, begin, end in zip(missing, ends[:-1], ends[1:], strict=True):
            found[i] = late[pretokens[i]] = data[begin:end]
        return found

    def data(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= self.characters:
                yield from self.together(held)
                held, size = [], 0
        if held:
            yield from self.together(held)

    def together(self, texts: list[str]) -> Iterator[bytes]:
        pieces, firsts = self.split(texts)
        coded = pieces.dictionary_encode()
        ids = self.read(plain_list(coded.dictionary))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        place = coded.indices.to_numpy()
        own = sizes[place]
        out = np.frombuffer(b"".join(ids), "<u4")[
            stretches((np.cumsum(sizes) - sizes)[place], own)]
        at = np.concatenate([[0], np.cumsum(own)])[np.append(firsts, len(place))].tolist()
        for begin, end in zip(at, at[1:]):
            yield out[begin:end].tobytes()
