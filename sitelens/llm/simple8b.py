"""Simple-8b files of token ids.

A chunk holds the ids of whole documents, in 64-bit words. Four bits of a word select how many ids it
packs and in how many bits each. Ids too large for any width escape: their word points into a table
of plain 64-bit values. Every 128 ids start a new word and the chunk lists where, so that a reader
can decode all blocks at once or go to one. A chunk's layout, all little-endian:

    magic "S8B1", ids in a block, documents, ids, blocks, words, escapes    7 x uint32
    number of each document, with a flag for null ones                       int64, uint8
    ids of each document                                                     int64
    first word of each block                                                 uint32
    words, escaped ids                                                       uint64

Chunks are the rows of Parquet files (through Spark, as only Spark can write to any shared store and
commit a task's output once), which range partitioning by document id puts in ascending order.

Defined results: a null text is an empty one, so it holds just the end id; rows without an id come
first; rows with equal ids follow each other in the order of their texts' hashes, each with ids of
its own; an empty table gives an empty result.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitelens.llm.token_ids import batches, encoder, tokenizer_path
from sitelens.session import scratch_path

END_ID = 2
BLOCK = 128
#: Characters of text whose ids share a chunk; a longer document has one to itself.
CHUNK_CHARS = 3_000_000
MAGIC = int.from_bytes(b"S8B1", "little")

# Ids in a word and bits of each, by selector from 1. Selector 0 is an escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
WIDTHS = np.array([60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60])
_LAST = 14  # one id of 60 bits; 15 is not written
_U = np.uint64


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, first word of each block, and escaped values of ``ids`` (unsigned 64-bit).

    All blocks advance together: a step writes one word of each block that has ids left, with the
    selector that packs most of them.
    """
    blocks = -(-len(ids) // BLOCK)
    grid = np.zeros((blocks, BLOCK), "uint64")
    grid.ravel()[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.T)
    left = np.full(blocks, BLOCK)
    if blocks:
        left[-1] = len(ids) - BLOCK * (blocks - 1)
    in_block = np.arange(BLOCK)[:, None] < left
    runs = {}  # by selector, ids from here on that fit; only where a block has enough of them
    for selector in range(1, _LAST + 1):
        fits = in_block & (grid < _U(1 << int(WIDTHS[selector])))
        if fits.sum(axis=0, dtype="uint8").max(initial=0) < COUNTS[selector]:
            continue
        own = runs[selector] = np.zeros((BLOCK + 1, blocks), "uint8")
        for i in range(BLOCK - 1, -1, -1):
            np.multiply(own[i + 1] + 1, fits[i], out=own[i], casting="unsafe")
    at, wrote, escapes = np.zeros(blocks, "int64"), [], []
    open_ = np.flatnonzero(left > 0)
    n_escapes = 0
    while len(open_):
        here = at[open_]
        selector = np.zeros(len(open_), "int64")
        for s in reversed(runs):
            selector[runs[s][here, open_] >= COUNTS[s]] = s
        word = selector.astype("uint64")
        for s in np.unique(selector):
            own = np.flatnonzero(selector == s)
            if s == 0:
                escapes.append(grid[here[own], open_[own]])
                word[own] |= np.arange(n_escapes, n_escapes + len(own)).astype("uint64") << _U(4)
                n_escapes += len(own)
                continue
            for j in range(COUNTS[s]):
                shift = _U(4 + WIDTHS[s] * j)
                word[own] |= grid[here[own] + j, open_[own]] << shift
        wrote.append((open_, word))
        at[open_] += COUNTS[selector]
        open_ = open_[at[open_] < left[open_]]
    owner = np.concatenate([x for x, _ in wrote] or [np.zeros(0, "int64")])
    words = np.concatenate([x for _, x in wrote] or [np.zeros(0, "uint64")])
    order = np.argsort(owner, kind="stable")
    first = np.searchsorted(owner[order], np.arange(blocks)).astype("uint32")
    return words[order], first, np.concatenate(escapes or [np.zeros(0, "uint64")])


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids of consecutive words."""
    selector = (words & _U(15)).astype("int64")
    count = COUNTS[selector]
    at = np.cumsum(count) - count
    ids = np.zeros(int(count.sum()), "uint64")
    for s in np.unique(selector):
        own = np.flatnonzero(selector == s)
        if s == 0:
            ids[at[own]] = escapes[(words[own] >> _U(4)).astype("int64")]
            continue
        mask = _U((1 << int(WIDTHS[s])) - 1)
        for j in range(COUNTS[s]):
            ids[at[own] + j] = (words[own] >> _U(4 + WIDTHS[s] * j)) & mask
    return ids


def write_chunk(numbers: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    words, first, escapes = pack(ids.astype("uint64"))
    head = [MAGIC, BLOCK, len(numbers), len(ids), len(first), len(words), len(escapes)]
    return b"".join(
        [
            np.array(head, "<u4").tobytes(),
            np.array([x or 0 for x in numbers], "<i8").tobytes(),
            np.array([x is None for x in numbers], "u1").tobytes(),
            np.array(lengths, "<i8").tobytes(),
            first.astype("<u4").tobytes(),
            words.astype("<u8").tobytes(),
            escapes.astype("<u8").tobytes(),
        ]
    )


class Chunk:
    """A chunk's documents and words."""

    def __init__(self, data: bytes):
        magic, self.block, docs, self.n_ids, blocks, words, escapes = np.frombuffer(data, "<u4", 7)
        if magic != MAGIC:
            raise ValueError("not a Simple-8b chunk")
        at = 28

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, int(n), at)
            at += out.nbytes
            return out

        numbers, absent = take("<i8", docs), take("u1", docs)
        self.numbers = [None if a else int(x) for x, a in zip(numbers, absent, strict=True)]
        self.lengths = take("<i8", docs)
        self.first, self.words, self.escapes = take("<u4", blocks), take("<u8", words), take("<u8", escapes)

    def ids(self) -> np.ndarray:
        return unpack(self.words, self.escapes)

    def block_ids(self, block: int) -> np.ndarray:
        """The ids of one block, without reading the others."""
        end = self.first[block + 1] if block + 1 < len(self.first) else len(self.words)
        return unpack(self.words[self.first[block] : end], self.escapes)


def write_ids(docs: DataFrame, path: str, tokenizer: str) -> None:
    """The ids of all texts, an end id after each, as chunks in ascending order of ``doc_id``."""
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
        F.xxhash64(docs["text"]).alias("tie"),
    )
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    end = END_ID.to_bytes(4, "little")
    schema = pa.schema(
        [("part", pa.int32()), ("chunk", pa.int32()), ("n_ids", pa.int64()), ("data", pa.binary())]
    )

    def chunks(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own, chunk = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for part in parts:
            numbers, at = part.column(0).to_pylist(), 0
            for texts in batches(part.column(1).to_pylist(), CHUNK_CHARS):
                found = [x + end for x in known.ids(texts)]
                ids = np.frombuffer(b"".join(found), "<u4")
                data = write_chunk(
                    numbers[at : at + len(texts)], [len(x) // 4 for x in found], ids
                )
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], f.type) for x, f in zip((own, chunk, len(ids), data), schema)],
                    schema=schema,
                )
                chunk += 1

    written = rows.drop("tie").mapInArrow(chunks, "part int, chunk int, n_ids long, data binary")
    written.write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files, decoded from them."""
    chunks = spark.read.parquet(path)
    # parts number as many as Spark partitions; chunks of one part are few as well
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.select(
        "part", "chunk", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("chunk_start")
    )
    starts = starts.join(F.broadcast(parts), "part").select(
        "part", "chunk", (F.col("part_start") + F.col("chunk_start")).alias("chunk_start")
    )
    schema = pa.schema([(x, pa.int64()) for x in ("part", "chunk", "doc_id", "at", "n_tokens", "ids_crc32")])

    def decode(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            for part, number, data in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                chunk = Chunk(data)
                ids, ends = chunk.ids().astype("<u4"), np.cumsum(chunk.lengths)
                at = ends - chunk.lengths
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at, ends, strict=True)]
                n = len(crc)
                columns = [[part] * n, [number] * n, chunk.numbers, at, chunk.lengths, crc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in columns], schema=schema
                )

    rows = chunks.select("part", "chunk", "data").mapInArrow(
        decode, "part long, chunk long, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    return rows.join(starts, ["part", "chunk"]).select(
        "doc_id", (F.col("chunk_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, path: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Write ``docs`` to ``path`` (a scratch folder if None) and read the files back."""
    path = path or scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, path, tokenizer or tokenizer_path("word_bpe_49k.json"))
    return read_ids(docs.sparkSession, path)
