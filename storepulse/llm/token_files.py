"""Token ids of a corpus as grammar-compressed shards, written and read by Spark."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from tokenizers import Tokenizer

from storepulse.llm.pretokens import Chunks
from storepulse.llm.repair import Shard, compress

END = 0
# Ids that close a shard; a document is never parted, so a longer one is a shard alone.
SHARD_IDS = 1 << 18

# Fixed value: the letters that byte-level models write bytes with.
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
LETTERS = {b: chr(b) for b in PLAIN} | {
    b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*PLAIN}))}

# A character that stands for no byte.
APART = "\u1000"


class Encoder:
    """Whole texts to ids by a byte-level BPE file of the tokenizers library."""

    def __init__(self, model: str, pattern: str):
        self.tokenizer = Tokenizer.from_str(model)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.chunks = Chunks(regex.compile(pattern), self.encode_pretokens)

    def encode_pretokens(self, pretokens: Sequence[bytes]) -> Iterator[list[int]]:
        tokenize = self.model.tokenize
        spelt = APART.join([p.decode("latin-1") for p in pretokens]).translate(LETTERS)
        return ([t.id for t in tokenize(p)] for p in spelt.split(APART))

    def data(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids as little-endian unsigned 32-bit integers.

        A text that spells an added token is the library's to split.
        """
        texts = list(texts)
        whole = {i for i, text in enumerate(texts) if any(a in text for a in self.added)}
        chunked = self.chunks.data(text for i, text in enumerate(texts) if i not in whole)
        for i, text in enumerate(texts):
            if i in whole:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                yield np.array(ids, "<u4").tobytes()
            else:
                yield next(chunked)


@lru_cache(maxsize=1)
def encoder_of(model: str, pattern: str) -> Encoder:
    """A worker's encoder, which stays from task to task with what it remembers."""
    return Encoder(model, pattern)


def write_shards(docs: DataFrame, model: str, pattern: str, path: str, end: int = END) -> None:
    """Write all documents in ascending order of doc_id as compressed shards.

    Reads ``doc_id, text``. ``model`` is the text of a tokenizers file. NULL doc_ids come
    first, rows of one doc_id are ordered by a hash of their text; NULL texts are empty
    and have the end id alone. Spark deals ranges of doc_id to tasks, and each task closes
    a shard after ``SHARD_IDS`` ids, so a task holds one shard and one batch. A shard is a
    row: its place (``part, shard``), the doc_ids, the ids of all, and the ``data``.
    """
    order = [F.col("doc_id"), F.col("tie")]
    rows = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    )
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                        ("n_ids", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model, pattern)
        part, shard = TaskContext.get().partitionId(), 0
        doc_ids: list = []
        held: list[np.ndarray] = []
        size = 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{
                "part": part, "shard": shard, "doc_ids": doc_ids, "n_ids": size,
                "data": compress(held)}], schema)

        tail = np.array([end], "<u4")
        for batch in batches:
            names = batch.column(0).to_pylist()
            for doc_id, data in zip(names, encoder.data(batch.column(1).to_pylist())):
                doc_ids.append(doc_id)
                held.append(np.concatenate([np.frombuffer(data, "<u4"), tail]))
                size += len(held[-1])
                if size >= SHARD_IDS:
                    yield closed()
                    doc_ids, held, size, shard = [], [], 0, shard + 1
        if held:
            yield closed()

    rows.mapInArrow(run, "part int, shard int, doc_ids array<long>, n_ids long, data binary"
                    ).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "part int, shard int, doc_ids array<long>, n_ids long, data binary").parquet(path)


def decoded(shards: DataFrame, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and (on request) ``ids`` of every document.

    ``start`` counts the ids of all documents before it. Only ids per shard are summed
    across the corpus: first those of each part, then those of the shards in a part.
    """
    names = ["doc_id long", "part int", "shard int", "before long", "n_tokens long",
             "ids_crc32 long"] + ["ids array<int>"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                documents = Shard(row["data"]).documents()
                sizes = np.array([len(d) for d in documents], np.int64)
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(np.full(len(sizes), row["part"], np.int32)),
                    pa.array(np.full(len(sizes), row["shard"], np.int32)),
                    pa.array(np.cumsum(sizes) - sizes), pa.array(sizes),
                    pa.array([crc32(np.ascontiguousarray(d, "<u4")) for d in documents], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([d.tolist() for d in documents], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [n.split()[0] for n in names])

    rows = shards.select("part", "shard", "doc_ids", "data").mapInArrow(run, ", ".join(names))
    sizes = shards.select("part", "shard", "n_ids")
    earlier = W.rowsBetween(W.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("all")).select(
        "part", F.coalesce(F.sum("all").over(earlier.orderBy("part")), F.lit(0)).alias("part_start"))
    places = sizes.join(parts, "part").select(
        "part", "shard",
        (F.col("part_start") + F.coalesce(
            F.sum("n_ids").over(earlier.partitionBy("part").orderBy("shard")), F.lit(0))
         ).alias("shard_start"))
    return rows.join(places, ["part", "shard"]).select(
        "doc_id", (F.col("shard_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32",
        *["ids"] * with_ids)
