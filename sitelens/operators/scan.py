"""Motif scan: best wild-type and substituted scores at every position of DNA fragments."""

from itertools import batched

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from sitelens.functions.pwm import EVEN_BACKGROUND, log_odds, smooth
from sitelens.functions.sites import event_code
from sitelens.operators import window_scores
from sitelens.operators.windows import TILE, tiles_of
from sitelens.schemas import HITS, LOWER_BASES, STRAND_SCORES

# Executors get the window scorer with the task, not as an installed module.
cloudpickle.register_pickle_by_value(window_scores)

# Motifs per pass over the fragments: at most 30 x 4 doubles each, so a broadcast holds some 4 MB.
MOTIFS_PER_PASS = 4096
# Fixed value: longest matrix that the flank of a fragment allows for.
MAX_LENGTH = 30

_CANDIDATES = StructType(
    [
        StructField("chromosome", LongType()),
        StructField("mutation_pos", LongType()),
        StructField("chunk_id", LongType()),
        StructField("pwmid", LongType()),
        StructField("threshold", DoubleType()),
        StructField("base", IntegerType()),
        *(StructField(c, DoubleType()) for c in STRAND_SCORES),
    ]
)


def pack_motifs(pwms: DataFrame, background=EVEN_BACKGROUND, smoothing: bool = True) -> DataFrame:
    """One row per motif: ``llr`` row by row in A, C, G, T order, with the counts to check it.

    Motifs in order that cannot reach their threshold on any sequence are dropped; 0 is always
    within reach, since a window with an unknown base scores 0. Others stay, to be refused.
    """
    cells = smooth(pwms) if smoothing else pwms
    odds = cells.withColumn("llr", log_odds(F.col("p"), F.col("b"), background))
    rows = odds.groupBy("pwmid", "threshold", "i").agg(
        F.array(*(F.max(F.when(F.col("b") == b, F.col("llr"))) for b in (1, 2, 3, 4))).alias("row"),
        F.max("llr").alias("top"),
        F.count(F.lit(1)).alias("n"),
    )
    # A matrix that is too long is cut one row after the limit, so that a group stays small and
    # the check still sees that it is too long.
    kept = F.when(F.col("i").between(0, MAX_LENGTH), F.struct("i", "row"))
    packed = rows.groupBy("pwmid", "threshold").agg(
        F.array_sort(F.collect_list(kept)).alias("rows"),
        F.count(F.lit(1)).alias("k"),
        F.max("i").alias("last"),
        F.sum("n").alias("n"),
        F.sum("top").alias("top"),
    )
    best = F.greatest("top", F.lit(0.0))
    motifs = packed.select(
        F.col("pwmid").cast("bigint"),
        F.col("threshold").cast("double"),
        "k",
        "last",
        "n",
        (best >= F.col("threshold") - window_scores.SLACK).alias("reachable"),
        F.flatten(F.col("rows.row")).alias("llr"),
    )
    in_order = (
        (F.col("n") == 4 * F.col("k"))
        & (F.size("llr") == 4 * F.col("k"))
        & (F.col("last") + 1 == F.col("k"))
        & (F.col("k") <= MAX_LENGTH)
        & ~F.exists("llr", lambda x: x.isNull())
    )
    return motifs.where(F.coalesce("reachable", F.lit(True)) | ~in_order).drop("reachable")


def _checked(motif) -> tuple[int, float, list[float]]:
    if motif.k > MAX_LENGTH:
        raise ValueError(f"motif {motif.pwmid} has {motif.k} rows, more than {MAX_LENGTH}")
    if not motif.n == len(motif.llr) == 4 * motif.k or motif.last + 1 != motif.k or None in motif.llr:
        raise ValueError(f"motif {motif.pwmid} does not have four cells in each row")
    if motif.threshold is None or motif.threshold != motif.threshold:
        raise ValueError(f"motif {motif.pwmid} has no threshold")
    return motif.pwmid, motif.threshold, motif.llr


def best_scores(tiles: DataFrame, motifs: DataFrame) -> DataFrame:
    """Scores of all positions that can be hits, each tile against each motif.

    No pairs are formed: a task holds a bounded block of motifs and emits candidates only. More
    motifs than one block take more passes over the tiles.
    """
    found = tiles.sparkSession.createDataFrame([], _CANDIDATES)
    packed = map(_checked, motifs.toLocalIterator())
    for number, block in enumerate(batched(packed, MOTIFS_PER_PASS)):
        shared = tiles.sparkSession.sparkContext.broadcast(block)
        scanned = tiles.mapInArrow(
            window_scores.scan_batches(shared, _CANDIDATES.names), _CANDIDATES
        )
        found = found.union(scanned) if number else scanned
    return found


def keep_hits(candidates: DataFrame) -> DataFrame:
    """Apply the thresholds.

    A base other than the fragment's own gains when a strand reaches the threshold; the wild type
    passes only above it. A position is a hit when a base gains or the wild type passes. Scores of
    a base are kept when it gains or the wild type passes, else they are NULL, as they always are
    for the fragment's own base.
    """
    threshold = F.col("threshold")
    passes = F.greatest("wt_fwd", "wt_rev") > threshold
    other = {b: F.col("base") != n for n, b in enumerate(LOWER_BASES, start=1)}
    gains = {
        b: other[b] & (F.greatest(f"{b}_fwd", f"{b}_rev") >= threshold) for b in LOWER_BASES
    }
    hits = candidates.withColumn("event", event_code(gains)).where((F.col("event") > 0) | passes)
    kept = [
        F.when(gains[b] | (other[b] & passes), F.col(f"{b}_{d}")).alias(f"{b}_{d}")
        for b in LOWER_BASES
        for d in ("fwd", "rev")
    ]
    return hits.select(
        "chromosome", "mutation_pos", "chunk_id", "pwmid", "event", "wt_fwd", "wt_rev", *kept
    )


def scan_motifs(
    fragments: DataFrame,
    pwms: DataFrame,
    background=EVEN_BACKGROUND,
    smoothing: bool = True,
    tile: int = TILE,
    partitions: int | None = None,
) -> DataFrame:
    """Scan ``fragments(chunk_id, chromosome, start, seq)`` with ``pwms(pwmid, threshold, i, b, p)``.

    Returns hits in the shape of ``schemas.HITS``. The position of the first base is ``start + 1``.
    """
    return scan_tiles(tiles_of(fragments, tile, partitions), pwms, background, smoothing)


def scan_tiles(
    tiles: DataFrame, pwms: DataFrame, background=EVEN_BACKGROUND, smoothing: bool = True
) -> DataFrame:
    """As :func:`scan_motifs`, for fragments that are cut into tiles already."""
    hits = keep_hits(best_scores(tiles, pack_motifs(pwms, background, smoothing)))
    return hits.select(*HITS.names)
