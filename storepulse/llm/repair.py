"""Re-Pair grammar compression of token ids, with random access by document."""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np

# Fixed value: what a shard starts with.
MAGIC = b"RPG1"
HEADER = struct.Struct("<4sIIII")
# Occurrences a pair needs; rounds go on while one has them.
LEAST = 8
# A round replaces the pairs that occur at least this share as often as the most frequent.
SHARE = 0.1
# Slots that pairs are counted in before they are told apart, as a power of two.
SLOT_BITS = 18


def stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places ``start, start + 1, ...`` of each stretch, one stretch after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def perhaps_frequent(symbols: np.ndarray, shut: np.ndarray) -> np.ndarray:
    """Places not ``shut`` of pairs whose slot, by a hash, counts ``LEAST`` or more: all that do, few others.

    Few places are not worth a sieve.
    """
    at = np.flatnonzero(~shut[:-1])
    if len(at) < 1 << SLOT_BITS - 4:
        return at
    slot = symbols[:-1] * np.uint32(0x9E3779B1)
    slot ^= symbols[1:] * np.uint32(0x85EBCA6B)
    slot >>= np.uint32(32 - SLOT_BITS)
    slot = slot[at].astype(np.intp)
    often = np.bincount(slot, minlength=1 << SLOT_BITS) >= LEAST
    return at[often.take(slot)]


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each key, the same for equal keys only, and the key of each number.

    Keys go to slots by a hash; a slot belongs to one of the keys that meet there, and the
    other keys, which are few, are numbered by sorting. Slots without a key keep any key.
    """
    bits = max(8, int(len(keys)).bit_length())
    slot = (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)
    owner = np.zeros(1 << bits, np.uint64)
    owner[slot] = keys
    guests = np.flatnonzero(owner[slot] != keys)
    others, number = np.unique(keys[guests], return_inverse=True)
    slot[guests] = (1 << bits) + number
    return slot, np.concatenate([owner, others])


def frequent_places(
    symbols: np.ndarray, shut: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places not ``shut`` of pairs that occur ``LEAST`` times or more, the number of the pair
    at each, and by number the pairs (as keys of 64 bits) and how often they occur.

    Pairs and their places are sorted as one integer where they fit in 64 bits.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(~shut[:-1])
    if len(at) < LEAST:
        return none
    wide, far = int(symbols.max()).bit_length(), len(symbols).bit_length()
    if 2 * wide + far > 64:
        at = perhaps_frequent(symbols, shut)
        number, key_of = numbered(symbols[at].astype(np.uint64) << np.uint64(32) | symbols[at + 1])
        counts = np.bincount(number, minlength=len(key_of))
        often = counts >= LEAST
        kept = often[number]
        return at[kept], (np.cumsum(often) - 1)[number[kept]], key_of[often], counts[often]
    packed = symbols[at].astype(np.uint64)
    packed <<= np.uint64(wide)
    packed |= symbols[at + 1]
    packed <<= np.uint64(far)
    packed |= at.view(np.uint64)
    packed.sort()
    pair = packed >> np.uint64(far)
    ends = np.append(np.flatnonzero(pair[1:] != pair[:-1]) + 1, len(pair))
    counts = np.diff(ends, prepend=0)
    often = np.flatnonzero(counts >= LEAST)
    ends, counts = ends[often], counts[often]
    pair = pair[ends - 1]
    key_of = pair >> np.uint64(wide) << np.uint64(32) | pair & np.uint64((1 << wide) - 1)
    places = packed[stretches(ends - counts, counts)] & np.uint64((1 << far) - 1)
    places <<= np.uint64(32)
    places |= np.repeat(np.arange(len(often), dtype=np.uint64), counts)
    places.sort()
    number = places & np.uint64(0xFFFFFFFF)
    places >>= np.uint64(32)
    return places.view(np.int64), number.view(np.int64), key_of, counts


def replace_pairs(
    symbols: np.ndarray, last: np.ndarray, shut: np.ndarray, first_new: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One round: the most frequent pairs become nonterminals ``first_new, ...``.

    ``last`` marks the last symbol of each document; no pair crosses it. Where occurrences
    of different pairs overlap, the more frequent pair has it; where those of one pair do
    (a run of one symbol), every other one is replaced. A pair that others leave less than
    half of ``LEAST`` waits; the most frequent never does. ``shut`` marks the last symbols and
    those that begin a pair of too few occurrences: all pairs with a symbol come up in the
    round that makes it, so none gains any later. Gives symbols, both marks and the pairs,
    none if no pair occurs ``LEAST`` times.
    """
    at, number, key_of, counts = frequent_places(symbols, shut)
    if not len(at):
        return symbols, last, shut, np.zeros((0, 2), np.uint32)
    chosen = np.flatnonzero(counts >= counts.max() * SHARE)
    chosen = chosen[np.lexsort((key_of[chosen], -counts[chosen]))]
    rank_of = np.full(len(key_of), -1, np.int32)
    rank_of[chosen] = np.arange(len(chosen))
    shut = np.ones(len(symbols), bool)
    shut[at] = False
    rank = rank_of[number]
    hit = np.flatnonzero(rank >= 0)
    at, rank = at[hit], rank[hit]

    # Runs of overlapping occurrences of one pair; of touching runs the lower rank stays.
    near = np.diff(at) == 1
    begins = np.concatenate([[True], ~(near & (rank[1:] == rank[:-1]))])
    begin = np.flatnonzero(begins)
    run = np.cumsum(begins) - 1
    lower = rank[begin][1:] < rank[begin][:-1]
    touching = near[begin[1:] - 1]
    stays = np.ones(len(begin), bool)
    stays[1:] &= ~touching | lower
    stays[:-1] &= ~(touching & lower)
    taken = stays[run] & ((np.arange(len(at)) - begin[run]) & 1 == 0)
    at, rank = at[taken], rank[taken]
    enough = np.bincount(rank, minlength=len(chosen)) >= LEAST // 2
    kept = enough[rank]
    at, rank = at[kept], rank[kept]

    symbols, last = symbols.copy(), last.copy()
    symbols[at] = first_new + (np.cumsum(enough) - 1)[rank]
    last[at] = last[at + 1]
    shut[at] = False
    shut[at[at > 0] - 1] = False
    shut |= last
    left = np.ones(len(symbols), bool)
    left[at + 1] = False
    pairs = key_of[chosen[enough]]
    pairs = np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
    return symbols[left], last[left], shut[left], pairs


def compress(documents: Sequence[np.ndarray]) -> bytes:
    """A shard: grammar rules, their expansion lengths, and each document's symbols.

    Documents may be empty. Layout: header (magic, first nonterminal, rules, documents,
    symbols), rules as pairs, expansion lengths, first symbol of each document and the
    end, symbols; all little-endian unsigned 32-bit.
    """
    sizes = np.array([len(d) for d in documents], np.int64)
    symbols = np.concatenate([np.asarray(d, np.uint32) for d in documents] or
                             [np.zeros(0, np.uint32)])
    base = int(symbols.max()) + 1 if len(symbols) else 0
    last = np.zeros(len(symbols), bool)
    last[np.cumsum(sizes)[sizes > 0] - 1] = True
    shut = last
    rules, lengths = np.zeros((0, 2), np.uint32), np.zeros(0, np.uint32)
    while len(symbols) >= 2:
        symbols, last, shut, pairs = replace_pairs(symbols, last, shut, base + len(rules))
        if not len(pairs):
            break
        rules, lengths = np.concatenate([rules, pairs]), np.concatenate(
            [lengths, expansion_lengths(pairs, lengths, base)])
    ends = np.zeros(len(documents) + 1, np.uint32)
    filled = np.flatnonzero(sizes > 0)
    ends[filled + 1] = np.flatnonzero(last) + 1
    ends = np.maximum.accumulate(ends)
    return b"".join([
        HEADER.pack(MAGIC, base, len(rules), len(documents), len(symbols)),
        *(x.astype("<u4").tobytes() for x in (rules, lengths, ends, symbols)),
    ])


def expansion_lengths(pairs: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """Ids that each pair expands to, from the ``lengths`` of the earlier rules it may name."""
    new = pairs >= base
    sizes = np.ones(pairs.shape, np.uint32)
    sizes[new] = lengths[pairs[new] - base]
    return sizes.sum(axis=1, dtype=np.uint32)


class Shard:
    """A compressed shard; decodes any document by itself."""

    def __init__(self, data: bytes):
        magic, self.base, n_rules, n_documents, n_symbols = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        numbers = np.frombuffer(data, "<u4", offset=HEADER.size)
        parts = np.cumsum([2 * n_rules, n_rules, n_documents + 1, n_symbols])
        rules, self.lengths, self.ends, self.symbols, _ = np.split(numbers, parts)
        self.rules = rules.reshape(-1, 2)

    def sizes(self) -> np.ndarray:
        """Ids of each document, from the expansion lengths alone."""
        one = np.ones(len(self.symbols) + 1, np.int64)
        one[0] = 0
        new = self.symbols >= self.base
        one[1:][new] = self.lengths[self.symbols[new] - self.base]
        return np.diff(np.cumsum(one)[self.ends])

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of a stretch of symbols, from those of each rule it names."""
        new = symbols >= self.base
        named = symbols[new] - self.base
        is_named = np.zeros(len(self.rules), bool)
        is_named[named] = True
        sizes = np.where(is_named, self.lengths, 0).astype(np.int64)
        ids = self.expanded(np.flatnonzero(is_named).astype(np.uint32) + np.uint32(self.base))
        # The symbols themselves, of which ids stand for one id, and what the rules expand to.
        source = np.concatenate([symbols, ids])
        starts, size = np.arange(len(symbols)), np.ones(len(symbols), np.int64)
        starts[new] = (len(symbols) + np.cumsum(sizes) - sizes)[named]
        size[new] = sizes[named]
        return source[stretches(starts, size)]

    def expanded(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of symbols, a level of the grammar at a time."""
        while len(symbols) and (new := symbols >= self.base).any():
            size = np.where(new, 2, 1)
            at = np.cumsum(size) - size
            out = np.empty(int(size.sum()), np.uint32)
            out[at[~new]] = symbols[~new]
            pairs = self.rules[symbols[new] - self.base]
            out[at[new]], out[at[new] + 1] = pairs[:, 0], pairs[:, 1]
            symbols = out
        return symbols

    def document(self, i: int) -> np.ndarray:
        return self.expand(self.symbols[self.ends[i]:self.ends[i + 1]])

    def documents(self) -> list[np.ndarray]:
        return np.split(self.expand(self.symbols), np.cumsum(self.sizes())[:-1])
