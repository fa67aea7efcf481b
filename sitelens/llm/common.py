"""Small helpers that the operators of this folder share."""

import ctypes
import gc
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.session import scratch_path

_HELD: list[tuple[Any, Any]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, written once as Parquet in the shared folder and read from there.

    Later readers do not repeat its work, and a lost executor costs no more than a read.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def held_out(doc_id):
    """Rows that no label may be learned from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def spread(number, of: int):
    """A long column dealt over 0 to ``of`` - 1."""
    return F.pmod(F.xxhash64(number), F.lit(of)).cast("int")


def held(owner, make: Callable[[], Any]):
    """What this Python worker remembers for ``owner``, a name or an object, made where it is none.

    A worker serves one operator after the other, so what it remembered for another is let go first.
    """
    last = _HELD[0][0] if _HELD else None
    if last is not owner and not (isinstance(owner, str) and isinstance(last, str) and last == owner):
        _HELD.clear()
        _give_back()
        _HELD.append((owner, make()))
    return _HELD[0][1]


def _give_back() -> None:
    """Memory that is free inside this process goes back to the system, where it can be asked to."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)
