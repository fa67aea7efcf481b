"""Joins of sites with samples."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.operators.sizing import (
    Profile,
    bins_between,
    bounds,
    broadcast_bound,
    is_small,
    level_of,
    profile,
    row_size,
    sized_join_side,
)

# Numbers of one block of an exploded range.
_BLOCK_BITS = 16
# Cells by which sites are thinned before a large sample is joined: the least width, the widths
# that are measured above it, and the cells of one word of a bitmap.
_CELL_BITS = 8
_COARSER = (0, 3, 6, 9, 12, 15, 18, 20)
_WORD_BITS = 6
# Levels up to this are taken as one in a join: its bins of 16 positions hold few more pairs than
# finer ones, and every level less saves a copy of all sites.
_LEAST_LEVEL = 4


def bin_of(position: Column, bin_bits: int) -> Column:
    return F.shiftright(position, bin_bits)


def closed_intervals(intervals: DataFrame, half_open: bool = False) -> DataFrame:
    """Intervals that can match: known chromosome, not empty, both ends included."""
    stop = F.col("stop") - 1 if half_open else F.col("stop")
    return intervals.withColumn("stop", stop).where(
        F.col("chromosome").isNotNull() & (F.col("start") <= F.col("stop"))
    )


def explode_range(df: DataFrame, name: str, first: Column, last: Column) -> DataFrame:
    """A row for each whole number from ``first`` to ``last``, which must not be below it.

    Blocks come first and then the numbers of each, so that no row holds a long list.
    """
    low, high, block = f"_{name}_low", f"_{name}_high", f"_{name}_block"
    blocks = df.withColumns({low: first.cast("bigint"), high: last.cast("bigint")}).withColumn(
        block, F.explode(F.sequence(F.shiftright(low, _BLOCK_BITS), F.shiftright(high, _BLOCK_BITS)))
    )
    start = F.shiftleft(block, _BLOCK_BITS)
    own = F.sequence(F.greatest(low, start), F.least(high, start + ((1 << _BLOCK_BITS) - 1)))
    return blocks.withColumn(name, F.explode(own)).drop(low, high, block)


def explode_intervals(intervals: DataFrame) -> DataFrame:
    """One row per position of each interval, both ends included."""
    kept = [c for c in intervals.columns if c not in ("start", "stop")]
    usable = closed_intervals(intervals)
    rows = explode_range(usable, "mutation_pos", F.col("start"), F.col("stop"))
    return rows.select(*kept, "mutation_pos")


def cell_words(sample: DataFrame, measured: Profile) -> tuple[DataFrame, int] | None:
    """The sample's cells as bitmaps ``chromosome, _word, _bits``, and the cells' width.

    ``sample`` holds ``chromosome, start, stop``. The finest width is taken whose words were measured
    to fit a broadcast; a word has 64 cells, so even a sample that covers a genome needs few. None
    if not even one word a chromosome fits.
    """
    finest = _CELL_BITS
    while measured.span >> (finest + _WORD_BITS) > 4 * measured.rows + (1 << 20):
        finest += 1
    first, last = bins_between(F.col("start"), F.col("stop"), finest + _WORD_BITS)
    words = explode_range(sample.select("chromosome", "start", "stop"), "_word", first, last)
    counts = words.agg(
        *(
            F.count_distinct("chromosome", F.shiftright("_word", n)).alias(f"n{n}") for n in _COARSER
        )
    ).first()
    bound = broadcast_bound(sample.sparkSession)
    fits = [n for n in _COARSER if counts[f"n{n}"] * row_size(3) <= bound]
    if not fits:
        return None
    bits = finest + fits[0]
    first, last = bins_between(F.col("start"), F.col("stop"), bits + _WORD_BITS)
    words = explode_range(sample.select("chromosome", "start", "stop"), "_word", first, last)
    zero = F.shiftleft("_word", _WORD_BITS)
    low = F.greatest(bin_of(F.col("start"), bits) - zero, F.lit(0))
    high = F.least(bin_of(F.col("stop"), bits) - zero, F.lit(63))
    # ones from bit ``low`` to bit ``high``
    ones = F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), (63 - high + low).cast("int"))
    mask = F.call_function("shiftleft", ones, low.cast("int"))
    return words.groupBy("chromosome", "_word").agg(F.bit_or(mask).alias("_bits")), bits


def thinned(sites: DataFrame, sample: DataFrame, measured: Profile) -> DataFrame:
    """Sites in a cell that the sample touches, before any of them moves."""
    found = cell_words(sample, measured)
    if found is None:
        return sites
    words, bits = found
    cell = bin_of(F.col("mutation_pos"), bits)
    marked = sites.withColumns({"_cell": cell, "_word": F.shiftright(cell, _WORD_BITS)})
    words = F.broadcast(words.withColumnsRenamed({"chromosome": "_chromosome", "_word": "_held"}))
    bit = F.call_function("getbit", F.col("_bits"), F.col("_cell").bitwiseAND(63).cast("int"))
    met = (F.col("chromosome") == F.col("_chromosome")) & (F.col("_word") == F.col("_held")) & (bit == 1)
    return marked.join(words, met, "left_semi").select(*sites.columns)


def leveled(intervals: DataFrame, bin_bits: int | None = None, least: int = 0) -> DataFrame:
    """Intervals copied to the bins ``_level, _bin`` that they touch at the level of their length,
    which counts as ``least`` if it is lower.

    A bin is over half as wide as the interval and at most twice as wide, so an interval has three
    copies at most, and not many more sites in its bins than in itself.
    """
    if bin_bits is None:
        level = F.greatest(level_of(F.col("stop") - F.col("start") + 1), F.lit(least))
    else:
        level = F.lit(bin_bits)
    rows = intervals.withColumn("_level", level)
    first, last = bins_between(F.col("start"), F.col("stop"), F.col("_level"))
    return explode_range(rows, "_bin", first, last)


def probes(sites: DataFrame, levels: tuple[int, ...]) -> DataFrame:
    """Sites with the bin they lie in, once for each level."""
    if len(levels) == 1:
        return sites.withColumns(
            {"_level": F.lit(levels[0]), "_bin": bin_of(F.col("mutation_pos"), levels[0])}
        )
    each = [
        F.struct(F.lit(n).alias("_level"), bin_of(F.col("mutation_pos"), n).alias("_bin")) for n in levels
    ]
    return sites.select("*", F.inline(F.array(*each)))


def overlap_join(
    sites: DataFrame,
    intervals: DataFrame,
    half_open: bool = False,
    bin_bits: int | None = None,
) -> DataFrame:
    """Every (site, interval) pair where the site lies in the interval.

    Intervals are copied to bins at the level of their own length, and sites look into one bin of
    each level in use: an equi-join on chromosome, level and bin, with the exact containment as
    residual. A site is in one bin of a level and an interval at most once in each, so no pair comes
    twice, and long intervals among short ones make no wide bins. ``bin_bits`` sets one level for
    all. Output: the columns of ``sites`` plus the interval's other columns.
    """
    usable = closed_intervals(intervals, half_open)
    measured = profile(usable, "start", "stop", bin_bits)
    sites = sites.where(bounds(usable, measured, "start", "stop"))
    small = measured.small(copied=True)
    if not small:
        sites = thinned(sites, usable, measured)
    levels, least = measured.levels or (0,), 0
    if bin_bits is None:
        least = max((x for x in levels if x <= _LEAST_LEVEL), default=0)
        levels = tuple(x for x in levels if x >= least)
    binned = leveled(usable, bin_bits, least)
    joined = probes(sites, levels).join(
        sized_join_side(binned, small), ["chromosome", "_level", "_bin"]
    )
    others = [c for c in intervals.columns if c not in ("chromosome", "start", "stop")]
    return joined.where(F.col("mutation_pos").between(F.col("start"), F.col("stop"))).select(
        *sites.columns, *others
    )


def position_join(sites: DataFrame, positions: DataFrame) -> DataFrame:
    """Inner join on chromosome and position; duplicates on either side multiply."""
    measured = profile(positions, "mutation_pos", "mutation_pos")
    sites = sites.where(bounds(positions, measured, "mutation_pos", "mutation_pos"))
    if not measured.small():
        place = F.col("mutation_pos")
        points = positions.select("chromosome", place.alias("start"), place.alias("stop"))
        sites = thinned(sites, points.where("chromosome is not null and start is not null"), measured)
    return sites.join(
        sized_join_side(positions, measured.small()), ["chromosome", "mutation_pos"]
    )


def with_motif(sites: DataFrame, motifs: DataFrame, small: bool = False) -> DataFrame:
    """Add the motif columns that queries report. Sites without a motif row are dropped.

    The motif side is measured, unless the caller already knows that it is ``small``.
    """
    info = motifs.select(
        F.col("row_id").alias("pwmid"),
        "motif_id",
        F.col("name").alias("tf_info_name"),
        "score_threshold",
    )
    return sites.join(sized_join_side(info, small or is_small(info)), "pwmid")
