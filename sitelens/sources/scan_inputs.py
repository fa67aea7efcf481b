"""Inputs of the scanner: DNA fragments, motif thresholds and weight matrices."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.chromosome import chromosome_code
from sitelens.functions.text import complete, field, is_blank, number, strip
from sitelens.operators.row_id import with_row_id


def read_fragments(spark: SparkSession, path: str) -> DataFrame:
    """Fragments from a tab file with a header line; fields 1, 2 and 8 are used.

    ``chunk_id`` is the 1-based number of the line, ``start`` the offset that positions add to.
    """
    # a separator that no line holds: the reader drops headers and blank lines, and the fields are
    # cut here, where an empty sequence and an absent one differ
    lines = spark.read.csv(
        path, schema="value string", sep="\x01", header=True, quote="", enforceSchema=True
    )
    f, value = F.col("f"), F.col("value")
    rows = with_row_id(lines, "chunk_id").select(
        "chunk_id", F.split(value, "\t").alias("f")
    )
    rows = rows.withColumn("f", complete(f, "fragment", 8))
    return rows.select(
        "chunk_id",
        chromosome_code(field(f, 0)).alias("chromosome"),
        strip(field(f, 1)).cast("bigint").alias("start"),
        strip(field(f, 7)).alias("seq"),
    )


def read_thresholds(spark: SparkSession, path: str) -> DataFrame:
    """Motif list without header: matrix file and score threshold. The line number is the motif.

    Blank lines are not counted; a line without two fields or with no number as threshold fails.
    """
    lines = spark.read.csv(path, schema="value string", sep="\x01", quote="")
    f, value = F.col("f"), F.col("value")
    rows = with_row_id(lines.where(~is_blank(value)), "pwmid").select(
        "pwmid", F.split(value, "\t").alias("f")
    )
    rows = rows.withColumn("f", complete(f, "threshold", 2))
    return rows.select(
        "pwmid", field(f, 0).alias("motif_file"), number(field(f, 1), "threshold").alias("threshold")
    )


def read_pwms(spark: SparkSession, path: str, name: Column | None = None) -> DataFrame:
    """Matrix cells ``(motif_file, i, b, p)`` from a directory with one tab file per motif.

    The first line of a file and the first field of a line are skipped. A matrix has at most 30
    rows, so a file is read whole. ``name`` says how a motif's file is called, if not by its name.
    """
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    named = files.select(
        (F.col("_metadata.file_name") if name is None else name).alias("motif_file"),
        F.posexplode(F.split("value", "\r?\n")).alias("i", "line"),
    )
    f = F.split("line", "\t")
    rows = named.where((F.col("i") > 0) & (strip(F.col("line")) != ""))
    return rows.select(
        "motif_file",
        (F.col("i") - 1).alias("i"),
        F.posexplode(F.array(*(strip(field(f, n)).cast("double") for n in (1, 2, 3, 4)))).alias(
            "b", "p"
        ),
    ).withColumn("b", F.col("b") + 1)


def number_pwms(cells: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Matrix cells of the listed motifs, with the motif number and threshold of the list.

    A listed motif without a single cell fails; matrices that are not listed are left out.
    """
    said = F.concat(F.lit("no matrix in file "), F.col("motif_file"))
    i = F.when(F.col("i").isNotNull(), F.col("i")).otherwise(F.raise_error(said).cast("int"))
    return thresholds.join(cells, "motif_file", "left").select(
        "pwmid", "threshold", i.alias("i"), "b", "p"
    )


def with_motif_numbers(thresholds: DataFrame, motifs: DataFrame) -> DataFrame:
    """Thresholds under the numbers of the motif table, which sites refer to.

    The two lists go together by matrix file, whatever their orders. A listed file that the table
    lacks, or has twice, fails.
    """
    known = motifs.groupBy(F.col("file").alias("motif_file")).agg(
        F.min("row_id").alias("_number"), F.count(F.lit(1)).alias("_times")
    )
    said = F.concat(F.lit("not one motif has the file "), F.col("motif_file"))
    number_ = F.when(F.col("_times") == 1, F.col("_number")).otherwise(F.raise_error(said))
    return thresholds.join(known, "motif_file", "left").select(
        number_.cast("bigint").alias("pwmid"), "motif_file", "threshold"
    )
