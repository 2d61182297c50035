"""Byte-level BPE through a sentencepiece model made from the vocabulary."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from storepulse.llm.common import map_rows
from storepulse.llm.pretokens import Chunks

# Field numbers and kinds of sentencepiece's model message.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, KIND = 1, 2, 3
UNKNOWN = 2
MODEL_TYPE, BPE, VOCABULARY_SIZE = 3, 2, 4
NAME, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE_SPACES = 1, 3, 4, 5
VARINT, BYTES, FLOAT = 0, 2, 5
# Pretokens a worker remembers, and characters it splits at a time.
REMEMBERED, TOGETHER = 100_000, 1 << 19


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def field(number: int, value: int | bytes | float) -> bytes:
    """One field of a protocol buffer message."""
    if isinstance(value, bytes):
        return varint(number << 3 | BYTES) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | FLOAT) + np.float32(value).tobytes()
    return varint(number << 3 | VARINT) + varint(value)


def letters(data: bytes) -> str:
    """Each byte as the letter of that number; sentencepiece takes no letter 0."""
    return data.decode("latin-1").replace("\0", "\u0100")


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a tiktoken file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def model_of(ranks: dict[bytes, int]) -> bytes:
    """A serialised BPE model whose piece i is the token of rank i, scored -i.

    Merging the pair of highest score first is then merging by rank. The normalisation is
    the identity: no prefix, no removed or escaped spaces. An unknown piece, which
    sentencepiece demands, follows the tokens. Ranks must be 0, 1, 2, ...
    """
    by_rank = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks are not 0, 1, 2, ...")
    pieces = b"".join(
        field(PIECES, field(PIECE, letters(token).encode()) + field(SCORE, -float(rank)))
        for rank, token in enumerate(by_rank)
    )
    unknown = field(PIECES, field(PIECE, b"<unk>") + field(SCORE, 0.0) + field(KIND, UNKNOWN))
    trainer = field(TRAINER, field(MODEL_TYPE, BPE) + field(VOCABULARY_SIZE, len(ranks) + 1))
    normalizer = field(NORMALIZER, field(NAME, b"identity") + field(DUMMY_PREFIX, 0)
                       + field(EXTRA_SPACES, 0) + field(ESCAPE_SPACES, 0))
    return pieces + unknown + trainer + normalizer


class Codec:
    """Encodes and decodes whole texts; lives in a worker and remembers chunks of text."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model_of(ranks))
        self.tokens = sorted(ranks, key=ranks.__getitem__)
        self.decimals = [str(i) for i in range(len(ranks))]
        self.chunks = Chunks(regex.compile(pattern), self.encode_pretokens, REMEMBERED, TOGETHER)

    def encode_pretokens(self, data: Sequence[bytes]) -> list[list[int]]:
        """Ids of each; a pretoken that is itself a token is that token."""
        found = [[self.ranks[d]] if d in self.ranks else None for d in data]
        rest = [i for i, ids in enumerate(found) if ids is None]
        if rest:
            encoded = self.processor.encode([letters(data[i]) for i in rest], num_threads=1)
            for i, ids in zip(rest, encoded):
                found[i] = ids
        return found

    def encode(self, texts: Iterable[str]) -> Iterator[list[int]]:
        """Ids of whole texts."""
        return (np.frombuffer(data, "<u4").tolist() for data in self.chunks.data(texts))

    def decode(self, ids: Iterable[int]) -> bytes:
        """The inverse mapping: bytes of each token, joined."""
        return b"".join(map(self.tokens.__getitem__, ids))

    def digest(self, ids: list[int]) -> str:
        """SHA-256 of the ids as decimals joined by commas."""
        return sha256(",".join(map(self.decimals.__getitem__, ids)).encode()).hexdigest()


def codec_of(path: str, pattern: str) -> Callable[[], Codec]:
    """A worker's codec, made once from the vocabulary read in the driver."""
    ranks = read_ranks(path)
    made: list[Codec] = []

    def get() -> Codec:
        if not made:
            made.append(Codec(ranks, pattern))
        return made[0]

    return get


def encode(docs: DataFrame, path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and (on request) ``ids``.

    Reads ``doc_id, text``; other columns are ignored, whatever their names. ``path`` is a
    tiktoken vocabulary the driver can read, ``pattern`` what splits a text into
    pretokens. ``decoded_sha256`` is of the bytes that the ids decode to. NULL and empty
    texts have no ids; repeated rows are encoded alike. One pass, no shuffle.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    codec = codec_of(path, pattern)

    def of(batch: pa.RecordBatch) -> list:
        own = codec()
        out: list[list] = [[], [], [], []]
        for ids in own.encode(text.as_py() or "" for text in batch.column(1)):
            out[0].append(len(ids))
            out[1].append(own.digest(ids))
            out[2].append(sha256(own.decode(ids)).hexdigest())
            if with_ids:
                out[3].append(np.array(ids, np.int32))
        return [batch.column(0), *out[:3 + with_ids]]

    return map_rows(
        docs.select("doc_id", "text"),
        f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
        + (", ids array<int>" if with_ids else ""), of,
    )
