"""Building, compacting and checking the stored tables."""

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.sites import event_flags, strand_max
from sitelens.schemas import LOWER_BASES, MOTIFS_DIR, SITES, SITES_DIR
from sitelens.session import scratch_path
from sitelens.sinks.tables import (
    FILE_BYTES,
    TARGET_BYTES,
    Written,
    directories,
    write_motifs,
    write_sites,
    write_sites_by_position,
)
from sitelens.sources.hits import read_hits
from sitelens.sources.motif_info import read_motif_info
from sitelens.sources.tables import read_sites


def sites_from_hits(hits: DataFrame) -> DataFrame:
    """Site rows: decoded event, better strand of each score."""
    rows = hits.select(
        "chromosome",
        "mutation_pos",
        F.col("chunk_id").alias("chromosome_chunk"),
        "pwmid",
        *(flag.alias(c) for c, flag in event_flags(F.col("event")).items()),
        strand_max(F.col("wt_fwd"), F.col("wt_rev")).alias("wt_max_score"),
        *(
            strand_max(F.col(f"{b}_fwd"), F.col(f"{b}_rev")).alias(f"{b}_mutation_max_score")
            for b in LOWER_BASES
        ),
    )
    return rows.select(*SITES.names)


def build_tables(
    spark: SparkSession, motif_csv: str, hits: str, directory: str, by_position: bool = False
) -> Written:
    """Write both tables of a table directory from the metadata file and the scanner's output.

    Sites are laid out by motif, or ``by_position``. The result has the figures that the write of
    the sites measured, so no further scan is needed to check it.
    """
    write_motifs(read_motif_info(spark, motif_csv), posixpath.join(directory, MOTIFS_DIR))
    write = write_sites_by_position if by_position else write_sites
    return write(sites_from_hits(read_hits(spark, hits)), posixpath.join(directory, SITES_DIR))


def compact_sites(
    spark: SparkSession, source: str, target: str, target_bytes: int = TARGET_BYTES
) -> Written:
    """Rewrite a site table of many small files as few large ones per motif."""
    return write_sites(read_sites(spark, source), target, target_bytes=target_bytes)


def scattered_motifs(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``pwmid, files, bytes`` of the motifs with more files than their bytes ask for, in a table
    with a directory for each motif.
    """
    found = scattered_directories(spark, path, file_bytes)
    return found.where(F.col("kind") == "pwmid").select(F.col("number").alias("pwmid"), "files", "bytes")


def scattered_directories(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``kind, number, files, bytes`` of the directories with more files than their bytes ask for."""
    # a motif just above a target may have one file more than its bytes fill
    return directories(spark, path).where(F.col("files") > F.ceil(F.col("bytes") / file_bytes) + 1)


def compact_scattered(
    spark: SparkSession,
    path: str,
    target_bytes: int = TARGET_BYTES,
    file_bytes: int = FILE_BYTES,
) -> Written | None:
    """Compact in place the motifs that need it, and leave the files of the others alone.

    Motifs that share a directory are compacted together. Their rows are copied to the scratch
    folder first, so that a failure while directories are replaced loses nothing. Returns what was
    rewritten, None if nothing had to be.
    """
    found = scattered_directories(spark, path, file_bytes).where("kind != ''").collect()
    if not found:
        return None
    kind, wanted = found[0].kind, [r.number for r in found]
    chosen = F.col(kind).isin([x for x in wanted if x is not None])
    if None in wanted:
        chosen = chosen | F.col(kind).isNull()
    copy = scratch_path(spark, "scattered")
    stored = spark.read.schema(SITES).parquet(path).where(chosen)
    # files of the table's own sizes: tasks times motifs of them would be a second scatter
    stored.select(*SITES.names).write.parquet(copy)
    return write_sites(read_sites(spark, copy), path, target_bytes=target_bytes, only_given=True)


def table_counts(sites: DataFrame, motifs: DataFrame) -> DataFrame:
    """Row counts of both tables, one row each."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows"
    )
    return count(motifs, "tf_info").unionAll(count(sites, "tfbs"))


def score_total(sites: DataFrame) -> DataFrame:
    """Sum of the wild-type scores."""
    return sites.agg(F.sum("wt_max_score").alias("total_score"))


def on_chromosome(sites: DataFrame, code: int) -> DataFrame:
    """Sites of one chromosome; the filter reaches the scan."""
    return sites.where(F.col("chromosome") == code)
