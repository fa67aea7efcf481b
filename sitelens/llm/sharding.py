"""Sampled splitters: shards of equal bytes from a size-weighted sample of keys.

Records are ordered by a key whose high bits are a hash of the text and whose low bits are a hash
of the id: equal texts stand side by side, and yet a group of copies of any size can be cut. A
size-weighted sample of keys gives range boundaries; ranges that turn out overfull, by bytes or by
records, are sampled again and subdivided until none is. A record's weight is its size plus the mean
size, so that a great many empty texts get boundaries too. Within a range, records are numbered in order, and running byte totals of
ranges and records say which shard each record falls into.

Only copies of one text under one id, or under ids of one 24-bit hash, can overfill a range.

Defined results: a null text counts one byte and crc32 0, as does an empty one; rows with equal
ids, or without an id, are placed each by itself; an empty table gives an empty result; other
columns of the input are left out.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitelens.llm.common import stored

#: Records that one range should hold, and draws of the sample for each range.
RANGE_ROWS = 1_000_000
DRAWS = 64
#: Ranges for each shard at least.
RANGES_PER_SHARD = 16


def records(docs: DataFrame) -> DataFrame:
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    place = F.shiftleft(F.shiftright(F.xxhash64(text), 24), 24)
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        place.bitwiseOR(F.xxhash64(docs["doc_id"]).bitwiseAND(F.lit(0xFFFFFF))).alias("place"),
    )


def _in_range(bounds: np.ndarray):
    @F.pandas_udf("int")
    def number(place: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, place.to_numpy(), side="right").astype("int32"))

    return number(F.col("place"))


def _draw(kept: DataFrame, weight: Column, every: float, seed: int) -> np.ndarray:
    """Keys drawn with a chance of ``weight`` / ``every``; ``every`` bounds how many come back."""
    ticket = F.pmod(F.xxhash64(F.lit(seed), "place", "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = kept.where(ticket * every < weight).select("place").toPandas()
    return np.sort(drawn["place"].to_numpy(dtype="int64"))


def split_points(kept: DataFrame, shards: int) -> np.ndarray:
    """Range boundaries: quantiles of a weighted sample, then of samples in overfull ranges.

    A range is overfull above twice its share of the bytes or above twice ``RANGE_ROWS`` records.
    The driver holds the sample: some ``DRAWS`` keys a range, and ranges number the records over
    ``RANGE_ROWS``. Each overfull range is also cut at the middle of its keys, so subdividing ends.
    """
    rows, total = kept.agg(F.count("*"), F.sum("size")).first()
    if not rows:
        return np.array([], "int64")
    ranges = max(shards * RANGES_PER_SHARD, -(-rows // RANGE_ROWS))
    weight = F.col("size") + total / rows
    every = 2 * total / (ranges * DRAWS)
    bounds = np.unique(_draw(kept, weight, every, 0)[DRAWS // 2 :: DRAWS])
    too_long = (F.col("size") > 2.0 * total / ranges) | (F.col("rows") > 2 * RANGE_ROWS)
    turn = 0
    while True:
        turn += 1
        held = (
            kept.groupBy(_in_range(bounds).alias("range"))
            .agg(
                F.sum("size").alias("size"),
                F.count("*").alias("rows"),
                F.min("place").alias("low"),
                F.max("place").alias("high"),
            )
            .where(too_long & (F.col("low") < F.col("high")))
            .toPandas()
        )
        if not len(held):
            return bounds
        over = kept.where(_in_range(bounds).isin([int(x) for x in held["range"]]))
        drawn = _draw(over, weight, every / 2, turn)
        low, high = (held[x].to_numpy(dtype="int64") for x in ("low", "high"))
        middle = (low >> 1) + (high >> 1) + (low & high & 1) + 1
        bounds = np.unique(np.concatenate([bounds, drawn[DRAWS // 2 :: DRAWS], middle]))


def sampled_splitters(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row of ``docs``.

    Shard sizes differ by one record at most; slots count from 0 in each shard.
    """
    kept = stored(records(docs), "shard-records")
    ranged = stored(kept.withColumn("range", _in_range(split_points(kept, shards))), "shard-ranges")
    held = (
        ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    ).toPandas()
    held = held.sort_values("range")
    before = held.assign(
        bytes_before=held["bytes"].cumsum() - held["bytes"],
        rows_before=held["rows"].cumsum() - held["rows"],
    )[["range", "bytes_before", "rows_before"]]
    total = int(held["bytes"].sum())
    offsets = docs.sparkSession.createDataFrame(
        before if len(before) else [], "range int, bytes_before long, rows_before long"
    )
    order = Window.partitionBy("range").orderBy("place", "doc_id", "text_crc32", "size")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        ranged.withColumn("number", F.row_number().over(order).cast("long"))
        .withColumn("upto", F.sum("size").over(running))
        .join(F.broadcast(offsets), "range")
        .withColumn("middle", F.col("bytes_before") + F.col("upto") - F.col("size") / 2)
        .withColumn(
            "shard",
            F.least(F.floor(F.col("middle") * shards / max(total, 1)), F.lit(shards - 1)).cast(
                "int"
            ),
        )
        .withColumn("number", F.col("rows_before") + F.col("number") - 1)
    )
    placed = stored(placed, "shard-places")
    firsts = placed.groupBy("shard").agg(F.min("number").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("number") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
