"""Site queries against intervals, variants and motif selections."""

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.sites import allele_score
from sitelens.operators.overlap import (
    explode_intervals,
    overlap_join,
    position_join,
    with_motif,
)
from sitelens.operators.selection import selected_motifs
from sitelens.schemas import LOWER_BASES, MUTATION_SCORES, USE_COLUMNS
from sitelens.session import written_once
from sitelens.sources.samples import (
    read_interval_samples,
    read_intervals,
    read_selection,
    read_variant_samples,
    read_variants,
)

_SITE_COLUMNS = ["chromosome", "mutation_pos", *USE_COLUMNS, "wt_max_score", *MUTATION_SCORES]


def _motif_columns():
    return ["motif_id", F.col("tf_info_name").alias("name"), "score_threshold"]


def intersect_intervals(
    sites: DataFrame,
    motifs: DataFrame,
    intervals: DataFrame,
    half_open: bool = False,
    bin_bits: int | None = None,
) -> DataFrame:
    """Sites inside the intervals with their motif, once per interval that holds the site."""
    found = overlap_join(
        sites.select(*_SITE_COLUMNS, "pwmid"), intervals, half_open=half_open, bin_bits=bin_bits
    )
    own = [c for c in intervals.columns if c not in ("chromosome", "start", "stop")]
    return with_motif(found, motifs).select(*_SITE_COLUMNS, *_motif_columns(), *own)


def intersect_positions(sites: DataFrame, motifs: DataFrame, intervals: DataFrame) -> DataFrame:
    """Same rows as :func:`intersect_intervals`, through one row per interval position."""
    found = position_join(
        sites.select(*_SITE_COLUMNS, "pwmid"), explode_intervals(intervals)
    )
    return with_motif(found, motifs).select(*_SITE_COLUMNS, *_motif_columns(), "bed_name")


def intersect_minimal(sites: DataFrame, intervals: DataFrame) -> DataFrame:
    """Chromosome, motif number and wild-type score of the sites inside the intervals."""
    found = overlap_join(
        sites.select("chromosome", "mutation_pos", "pwmid", "wt_max_score"), intervals
    )
    return found.select("chromosome", "pwmid", "wt_max_score")


def annotate_variants(
    sites: DataFrame, motifs: DataFrame, variants: DataFrame, only_gains: bool = False
) -> DataFrame:
    """Sites at the variants' positions with the score of the variant allele.

    The allele takes no part in the match: an allele of several letters gives a NULL score.
    ``only_gains`` keeps pairs whose site is marked as gained by that allele.
    """
    marks = {f"use_{b}": F.col(f"alt_{b}") for b in LOWER_BASES}
    sample = variants.select(
        "chromosome",
        "mutation_pos",
        "reference",
        "alt",
        "name",
        "vcf_name",
        *(F.col(f"use_{b}").alias(f"alt_{b}") for b in LOWER_BASES),
        *_sample_column(variants),
    )
    scores = {b: F.col(f"{b}_mutation_max_score") for b in LOWER_BASES}
    wanted = ["chromosome", "mutation_pos", "pwmid", "wt_max_score", *MUTATION_SCORES]
    if only_gains:
        wanted += USE_COLUMNS
    found = position_join(sites.select(*wanted), sample)
    if only_gains:
        gained = F.lit(False)
        for b in LOWER_BASES:
            gained = gained | (F.col(f"alt_{b}") & F.col(f"use_{b}"))
        found = found.where(gained)
    return with_motif(found, motifs).select(
        "chromosome",
        "mutation_pos",
        "reference",
        "alt",
        "name",
        "wt_max_score",
        allele_score(marks, scores).alias("mutation_max_score"),
        "motif_id",
        "tf_info_name",
        "score_threshold",
        "vcf_name",
        *_sample_column(variants),
    )


def _sample_column(sample: DataFrame) -> list[str]:
    return [c for c in sample.columns if c == "sample"]


def select_motifs(
    sites: DataFrame, motifs: DataFrame, ids: DataFrame, names: DataFrame
) -> DataFrame:
    """All sites of the motifs whose number and name are both selected."""
    chosen = selected_motifs(motifs, ids, names)
    found = with_motif(sites.select(*_SITE_COLUMNS, "pwmid"), chosen)
    return found.select(*_SITE_COLUMNS, *_motif_columns())


def intersect_samples(
    spark: SparkSession,
    sites: DataFrame,
    motifs: DataFrame,
    samples: list[str],
    bed_col: int = 0,
    n_cols: int | None = None,
    half_open: bool = False,
    only_gains: bool = False,
) -> dict[str, DataFrame]:
    """Many sample files in one pass over the sites for each kind of file.

    By extension (``.bed``, ``.vcf``) the rows that :func:`intersect` gives for each file, with the
    file's path as ``sample``; written ``partitionBy("sample")`` they are a result a file.
    """
    kinds: dict[str, list[str]] = {}
    for path in samples:
        kinds.setdefault(posixpath.splitext(path)[1].lower(), []).append(path)
    if unknown := kinds.keys() - {".bed", ".vcf"}:
        raise ValueError(f"sample file extensions that have no common pass: {sorted(unknown)}")
    found = {}
    if ".bed" in kinds:
        # a join measures its sample in several passes, so the lines are parsed for all of them
        intervals = written_once(
            read_interval_samples(spark, kinds[".bed"], bed_col, n_cols), "intervals"
        )
        found[".bed"] = intersect_intervals(sites, motifs, intervals, half_open=half_open)
    if ".vcf" in kinds:
        variants = written_once(read_variant_samples(spark, kinds[".vcf"]), "variants")
        found[".vcf"] = annotate_variants(sites, motifs, variants, only_gains=only_gains)
    return found


def intersect(
    spark: SparkSession,
    sites: DataFrame,
    motifs: DataFrame,
    sample: str,
    bed_col: int = 0,
    n_cols: int | None = None,
    half_open: bool = False,
    only_gains: bool = False,
) -> DataFrame:
    """Run the query that the sample's file extension stands for.

    ``bed_col``, ``n_cols`` and ``half_open`` are for intervals, ``only_gains`` is for variants.

    The parsed sample is also registered as a view, named as users' own SQL expects: ``bed``,
    ``vcf``, or ``pwmid`` and ``tf_name``.
    """
    extension = posixpath.splitext(sample)[1].lower()
    if extension == ".bed":
        intervals = written_once(read_intervals(spark, sample, bed_col, n_cols), "intervals")
        explode_intervals(intervals).createOrReplaceTempView("bed")
        return intersect_intervals(sites, motifs, intervals, half_open=half_open)
    if extension == ".vcf":
        variants = written_once(read_variants(spark, sample), "variants")
        variants.createOrReplaceTempView("vcf")
        return annotate_variants(sites, motifs, variants, only_gains=only_gains)
    if extension == ".ez":
        ids, names = read_selection(spark, sample)
        ids.createOrReplaceTempView("pwmid")
        names.createOrReplaceTempView("tf_name")
        return select_motifs(sites, motifs, ids, names)
    raise ValueError(f"unknown sample file extension: {extension!r}")
