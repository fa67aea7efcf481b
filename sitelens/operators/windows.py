"""Row generators of the scan, spelled out as rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.sequence import ALPHABET, encode_bases, reverse_complement
from sitelens.operators.window_scores import FLANK

# Bases per tile. A task works on whole tiles, so this bounds a row whatever a fragment's length.
TILE = 1 << 14


def tiles_of(fragments: DataFrame, tile: int = TILE, partitions: int | None = None) -> DataFrame:
    """Overlapping pieces of the fragments, spread evenly over the tasks.

    A piece holds ``tile`` reportable positions and a flank on both sides, so each position has
    all its context in one piece. Positions are bytes. What follows works hard on every base, so
    the one shuffle of the sequence pays for itself: it spreads a long fragment over all tasks.
    """
    spark = fragments.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = [c for c in fragments.columns if c != "seq"]
    bases = fragments.withColumn("seq", F.col("seq").cast("binary"))
    centre = F.octet_length("seq") - 2 * FLANK
    last = F.floor((centre - 1) / F.lit(tile)).cast("int")
    # The outer form, with its own test for rows, keeps the planner from evaluating the sequence
    # once more in a filter below the generator.
    pieces = F.explode_outer(F.when(centre > 0, F.sequence(F.lit(0), last)))
    return (
        bases.withColumn("n", pieces)
        .where(F.col("n").isNotNull())
        .withColumn("offset", F.col("n") * F.lit(tile))
        .select(
            *kept,
            "offset",
            F.substring("seq", F.col("offset") + 1, F.lit(tile + 2 * FLANK)).alias("tile"),
        )
        .repartition(partitions, "chunk_id", "offset")
    )


def positions(tiles: DataFrame) -> DataFrame:
    """Every reportable 1-based place ``p`` in its tile: all but the flanks."""
    return tiles.withColumn(
        "p", F.explode(F.sequence(F.lit(FLANK + 1), F.octet_length("tile") - FLANK))
    )


def windows(tiles: DataFrame, k: int) -> DataFrame:
    """The ``k`` windows of length ``k`` that cover each reportable position.

    ``p`` and ``s`` are 1-based offsets in the fragment. Tiles are bytes: a substring of text
    would walk from its start every time.
    """
    p, s, offset = F.col("p"), F.col("s"), F.col("offset")
    covering = positions(tiles).withColumn("s", F.explode_outer(F.sequence(p - (k - 1), p)))
    return covering.select(
        "chunk_id",
        (offset + p).alias("p"),
        (offset + s).alias("s"),
        F.upper(F.substring("tile", s, F.lit(k)).cast("string")).alias("window"),
    )


def weighted_windows(tiles: DataFrame, k: int) -> DataFrame:
    """``window, weight``: each window of length ``k``, with the number of reportable positions
    that it covers. A row for each start stands for the rows that :func:`windows` spells out.
    """
    s, end = F.col("s"), F.octet_length("tile") - FLANK
    starts = F.explode(F.sequence(F.lit(FLANK + 2 - k), end))
    return tiles.withColumn("s", starts).select(
        F.upper(F.substring("tile", s, F.lit(k)).cast("string")).alias("window"),
        (F.least(s + (k - 1), end) - F.greatest(s, F.lit(FLANK + 1)) + 1).alias("weight"),
    )


def base_codes(fragments: DataFrame, piece: int = TILE) -> DataFrame:
    """``chunk_id, offset, codes``: base codes of whole fragments, ``piece`` bases a row at most."""
    last = F.floor((F.length("seq") - 1) / F.lit(piece)).cast("int")
    pieces = F.explode_outer(F.when(F.length("seq") > 0, F.sequence(F.lit(0), last)))
    at = F.col("n") * F.lit(piece)
    return (
        fragments.select("chunk_id", F.col("seq").cast("binary").alias("seq"), pieces.alias("n"))
        .where(F.col("n").isNotNull())
        .select(
            "chunk_id",
            at.alias("offset"),
            encode_bases(F.substring("seq", at + 1, F.lit(piece)).cast("string")).alias("codes"),
        )
    )


def substitutions(windows: DataFrame) -> DataFrame:
    """Each base put in place of each letter of a window, read on both strands.

    Windows with a letter outside ACGT are left out: their score is fixed.
    """
    window, n, base = F.col("window"), F.col("n"), F.col("base")
    known = windows.where(window.rlike(f"^[{ALPHABET}]+$"))
    return (
        known.withColumn("n", F.explode(F.sequence(F.lit(1), F.length("window"))))
        .withColumn("base", F.explode(F.array(*(F.lit(b) for b in ALPHABET))))
        .select(
            *windows.columns,
            (n - 1).alias("place"),
            "base",
            F.overlay("window", "base", "n", F.lit(1)).alias("forward"),
        )
        .withColumn("reverse", reverse_complement(F.col("forward")))
    )
