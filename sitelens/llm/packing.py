"""Bound-certified repacking of token sequences.

Documents longer than a sequence are cut; whole pieces fill a sequence each. The others are dealt
into partitions that each run best-fit decreasing. Dual-feasible functions bound from below how many
bins any packing of a partition's documents needs. A partition that meets its bound is certified
and stays. Any other keeps as many of its fullest bins as waste less than one bin together, which is
the best for what they hold, and gives the rest to the exchange: they are dealt anew, over as many
partitions as they fill, and packed again.

Defined results: a null text is an empty one, so it holds just the end id; rows with equal or no ids
are packed each by itself; an empty table gives an empty result; other columns are left out.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import spread, stored
from sitelens.llm.token_ids import batches, encoder, tokenizer_path

CAPACITY = 1024
END_ID = 2
#: Documents that a partition packs together.
PARTITION_ITEMS = 65_536
#: Packings at most; the last one keeps all its bins.
ROUNDS = 4
_PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"
_PACKED = "item long, sequence_id long, offset long, fill int, released boolean"


def cut(doc_id, ids: bytes, capacity: int) -> Iterator[tuple]:
    """Pieces of one document; the first one is the shorter."""
    n = len(ids) // 4
    ends = range(n % capacity or capacity, n + capacity, capacity) if n > capacity else [n]
    start = 0
    for piece, end in enumerate(ends):
        yield doc_id, piece, start, end - start, zlib.crc32(ids[4 * start : 4 * end])
        start = end


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's pieces."""
    schema = pa.schema(
        [("doc_id", "int64"), ("piece", "int32"), ("start", "int64"), ("length", "int32")]
        + [("ids_crc32", "int64")]
    )
    end = END_ID.to_bytes(4, "little")

    def pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        for part in parts:
            numbers, at = part.column(0).to_pylist(), 0
            for texts in batches([x or "" for x in part.column(1).to_pylist()]):
                rows = []
                for ids in known.ids(texts):
                    rows += cut(numbers[at], ids + end, capacity)
                    at += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema)],
                    schema=schema,
                )

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(pieces, _PIECES)


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, longest first into the fullest bin that has room."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.zeros(len(sizes), "int64"), np.zeros(len(sizes), "int64")
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    some, opened = 0, 0  # bit r of some: a bin has room r
    for i in order:
        size = int(sizes[i])
        fitting = some >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = with_room[room].pop()
            if not with_room[room]:
                some ^= 1 << room
        else:
            own, room = opened, capacity
            opened += 1
        bins[i], offsets[i] = own, capacity - room
        left = room - size
        if left:
            with_room[left].append(own)
            some |= 1 << left
    return bins, offsets


def bins_at_least(sizes: np.ndarray, capacity: int) -> int:
    """The largest bound that two families of dual-feasible functions give."""
    count = np.bincount(sizes, minlength=capacity + 1).astype("int64")
    size = np.arange(capacity + 1)
    best = int(-(-(count * size).sum() // capacity))
    for k in range(1, capacity // 2 + 1):
        f = np.where(size > capacity - k, capacity, np.where(size >= k, size, 0))
        best = max(best, int(-(-(count * f).sum() // capacity)))
    for k in range(1, 33):  # rounds sizes to whole k-ths, scaled by k * capacity
        whole = (k + 1) * size % capacity == 0
        f = np.where(whole, k * size, (k + 1) * size // capacity * capacity)
        best = max(best, int(-(-(count * f).sum() // (k * capacity))))
    return best


def _pack(capacity: int, turn: int, last: bool):
    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        sizes = part["length"].to_numpy(dtype="int64")
        bins, offsets = best_fit_decreasing(sizes, capacity)
        fills = np.bincount(bins, weights=sizes).astype("int64")
        released = np.zeros(len(fills), bool)
        if not last and len(fills) > bins_at_least(sizes, capacity):
            fullest = np.argsort(-fills, kind="stable")
            waste = np.cumsum(capacity - fills[fullest])
            released[fullest[waste >= capacity]] = True
        return pd.DataFrame(
            {
                "item": part["item"],
                # the round, the partition and the bin name a sequence
                "sequence_id": (turn + 1 << 58) + (int(key[0]) << 24) + bins,
                "offset": offsets,
                "fill": fills[bins].astype("int32"),
                "released": released[bins],
            }
        )

    return pack


def repack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``item, sequence_id, offset, fill`` for ``items`` of ``item long, length int``.

    Lengths are 1 to ``capacity``. A round holds ``PARTITION_ITEMS`` items a partition, so no task
    grows with the input; each round gets what the round before released.
    """
    done, pool = [], items.select("item", "length")
    for turn in range(ROUNDS):
        waiting = pool.count()
        parts = max(1, -(-waiting // PARTITION_ITEMS))
        last = turn == ROUNDS - 1
        packed = stored(
            pool.groupBy(spread(F.col("item") * 31 + turn, parts).alias("part")).applyInPandas(
                _pack(capacity, turn, last or (turn > 0 and parts == 1)), _PACKED
            ),
            f"packed-{turn}",
        )
        done.append(packed.where(~F.col("released")))
        if last or (turn > 0 and parts == 1):
            break
        free = packed.where("released").select("item")
        if free.isEmpty():
            break
        pool = stored(items.join(free, "item", "left_semi").select("item", "length"), f"pool-{turn}")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("released")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    ``path`` is a tokenizer file that every machine has.
    """
    path = path or tokenizer_path("byte_bpe_50k.json")
    pieces = stored(
        token_pieces(docs, path, capacity).withColumn("item", F.monotonically_increasing_id()),
        "pieces",
    )
    packed = repack(pieces.where(F.col("length") < capacity), capacity)
    placed = pieces.where(F.col("length") < capacity).join(packed, "item")
    whole = pieces.where(F.col("length") == capacity).select(
        "*", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    columns = ["doc_id", "piece", "start", F.col("length").cast("long"), "ids_crc32"]
    columns += ["sequence_id", "offset"]
    return placed.select(*columns).unionByName(whole.select(*columns))
