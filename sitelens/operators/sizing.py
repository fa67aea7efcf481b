"""Measured sizes: what may be broadcast, and which literal ranges bound a sample.

A sample's file size says little about the size of the rows derived from it, so the planner's own
estimate is not trusted here. One small aggregation per sample measures rows, bytes, extents and the
levels of its lengths.
"""

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# A side is broadcast only when it was measured to be at most this large, unless the session sets
# ``spark.sitelens.broadcastBytes``.
BROADCAST_BYTES = 64 << 20
# Ranges pushed into the scan of the sites, at most, and the share of the positions up to the
# sample's last ones that they must leave out; else one range of positions is pushed.
MAX_RANGES = 64
LEAST_EXCLUDED = 0.4
# Chromosomes named in a pushed filter, at most.
MAX_CHROMOSOMES = 16
# Blocks in which a sample's cover is measured, about.
COVER_BLOCKS = 16_384
# In-memory row and field overhead of a hashed relation.
_ROW_OVERHEAD = 64


def row_size(columns: int) -> int:
    """Estimated in-memory size of a row of numbers."""
    return _ROW_OVERHEAD + 8 * columns


def row_bytes(df: DataFrame) -> Column:
    """Estimated in-memory size of one row."""
    size = F.lit(row_size(len(df.columns)))
    for f in df.schema.fields:
        if isinstance(f.dataType, StringType):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
    return size.cast("bigint")


def level_of(length: Column) -> Column:
    """Even exponent of the bin width for a length: over half of it and at most twice."""
    bits = F.length(F.bin(length)) - 1
    return (bits + bits % 2).cast("int")


def bins_between(start: Column, stop: Column, bits) -> tuple[Column, Column]:
    """First and last bin of width ``2 ** bits`` that an interval touches."""
    bits = bits if isinstance(bits, Column) else F.lit(bits)
    return tuple(F.call_function("shiftright", x.cast("bigint"), bits) for x in (start, stop))


@dataclass(frozen=True)
class Profile:
    """Measured sums of a sample: rows, positions, bytes (as they are, and copied to the bins of
    their levels), extents and last positions over its chromosomes, and the levels in use."""

    bound: int
    rows: int = 0
    span: int = 0
    size: int = 0
    binned: int = 0
    chromosomes: int = 0
    extent: int = 0
    reach: int = 0
    low: int | None = None
    high: int | None = None
    levels: tuple[int, ...] = ()

    def small(self, copied: bool = False) -> bool:
        """Whether the rows fit a broadcast, copied to the bins they touch if ``copied``."""
        return (self.binned if copied else self.size) <= self.bound

    def cover_bits(self) -> int:
        """Exponent of a block width at which the sample's cover has a bounded number of blocks,
        and its intervals a few each."""
        bits = 0
        while self.extent >> bits > COVER_BLOCKS or self.span >> bits > 4 * self.rows + COVER_BLOCKS:
            bits += 1
        return bits


def extents(df: DataFrame, start: str, stop: str) -> DataFrame:
    """Lowest start and highest stop per chromosome."""
    return df.groupBy("chromosome").agg(
        F.min(start).alias("start_pos"), F.max(stop).alias("stop_pos")
    )


def broadcast_bound(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sitelens.broadcastBytes", str(BROADCAST_BYTES)))


def profile(df: DataFrame, start: str, stop: str, bits: int | None = None) -> Profile:
    """Measure a sample in one job; ``bits`` stands for every interval's level, if given."""
    begin, end = F.col(start), F.col(stop)
    level = level_of(end - begin + 1) if bits is None else F.lit(bits)
    first, last = bins_between(begin, end, level)
    size = row_bytes(df)
    known = df.where("chromosome is not null").where(begin.isNotNull() & end.isNotNull())
    each = known.groupBy("chromosome").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(end - begin + 1).alias("span"),
        F.sum(size).alias("size"),
        F.sum((size + 16) * (last - first + 1)).alias("binned"),
        F.min(begin).alias("lo"),
        F.max(end).alias("hi"),
        F.collect_set(level).alias("levels"),
    )
    sums = ("rows", "span", "size", "binned")
    total = each.agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums),
        F.count("*").alias("chromosomes"),
        F.coalesce(F.sum(F.col("hi") - F.col("lo") + 1), F.lit(0)).alias("extent"),
        F.coalesce(F.sum(F.greatest("hi", F.lit(0)) + 1), F.lit(0)).alias("reach"),
        F.min("lo").alias("low"),
        F.max("hi").alias("high"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("levels")))).alias("levels"),
    ).first()
    found = total.asDict() | {"levels": tuple(total.levels)}
    return Profile(broadcast_bound(df.sparkSession), **found)


def merged_ranges(covered: list[tuple[int, int, int]], most: int) -> list[tuple[int, int, int]]:
    """At most ``most`` ranges ``(chromosome, low, high)`` that hold all covered ones, with the
    widest gaps between them; more only where there are more chromosomes."""
    covered = sorted(covered)
    gaps = [
        (b[1] - a[2], n)
        for n, (a, b) in enumerate(zip(covered, covered[1:]), 1)
        if a[0] == b[0] and b[1] - a[2] > 1
    ]
    breaks = [n for n, (a, b) in enumerate(zip(covered, covered[1:]), 1) if a[0] != b[0]]
    wide = sorted(gaps, reverse=True)[: max(0, most - 1 - len(breaks))]
    cuts = sorted([0, len(covered), *breaks, *(n for _, n in wide)])
    parts = [covered[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]
    return [(x[0][0], x[0][1], max(r[2] for r in x)) for x in parts]


def cover(df: DataFrame, measured: Profile, start: str, stop: str) -> list[tuple[int, int, int]]:
    """What a sample covers of each block that it touches, as ``(chromosome, low, high)``; at most
    about ``COVER_BLOCKS`` and one for each chromosome."""
    bits = measured.cover_bits()
    first, last = bins_between(F.col(start), F.col(stop), bits)
    blocks = df.where("chromosome is not null").select(
        "chromosome", F.col(start).alias("a"), F.col(stop).alias("b"), F.explode(F.sequence(first, last)).alias("block")
    )
    edge = F.shiftleft("block", bits)
    found = blocks.groupBy("chromosome", "block").agg(
        F.min(F.greatest("a", edge)).alias("low"),
        F.max(F.least("b", edge + ((1 << bits) - 1))).alias("high"),
    )
    return [(r.chromosome, r.low, r.high) for r in found.collect()]


def bounds(df: DataFrame, measured: Profile, start: str, stop: str) -> Column:
    """Literal filter on ``chromosome`` and ``mutation_pos`` that every match must pass.

    It reaches the Parquet scan; sites are stored sorted, so row groups outside are skipped. Merged
    ranges of what the sample covers are pushed only where they leave out ``LEAST_EXCLUDED`` of the
    positions up to each chromosome's last; a filter of many ranges costs every other row more than
    it saves.
    """
    position, chromosome = F.col("mutation_pos"), F.col("chromosome")
    if not measured.rows:
        return F.lit(False)
    condition = position.between(measured.low, measured.high)
    if measured.chromosomes > MAX_RANGES:
        return condition
    ranges = merged_ranges(cover(df, measured, start, stop), MAX_RANGES)
    covered = sum(high - low + 1 for _, low, high in ranges)
    if covered <= (1 - LEAST_EXCLUDED) * measured.reach:
        return within(ranges, chromosome, position)
    codes = sorted({c for c, _, _ in ranges})
    return condition & chromosome.isin(codes) if len(codes) <= MAX_CHROMOSOMES else condition


def within(ranges, chromosome: Column, position: Column) -> Column:
    """Whether a place is in one of the ranges; those of a chromosome test its code once."""
    condition = None
    for code in sorted({c for c, _, _ in ranges}):
        own = [position.between(low, high) for c, low, high in sorted(ranges) if c == code]
        held = (chromosome == code) & reduce(or_, own)
        condition = held if condition is None else condition | held
    return condition


def is_small(df: DataFrame) -> bool:
    """Whether ``df`` was measured to be within the broadcast bound."""
    size = df.agg(F.sum(row_bytes(df))).first()[0]
    return (size or 0) <= broadcast_bound(df.sparkSession)


def sized_join_side(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast a measured-small side; otherwise ask for a shuffled join.

    The shuffled join is a sort-merge join, which adaptive execution splits on skewed keys.
    """
    return F.broadcast(df) if small else df.hint("merge")
