"""Motif metadata: comma-separated, unquoted, 13 fields."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.text import complete, field, is_blank, strip
from sitelens.operators.row_id import with_row_id
from sitelens.schemas import MOTIF_TEXT_COLUMNS

# Fixed value: how a header line begins.
HEADER_START = "Motif_ID"


def is_data_line(line):
    """False for header lines and blank lines."""
    return ~line.startswith(HEADER_START) & ~is_blank(line)


def parse_motif_info(lines: DataFrame) -> DataFrame:
    """Typed columns of each line; further columns of ``lines`` are kept.

    A line of under 13 fields fails.
    """
    f, value = F.col("_fields"), F.col("value")
    kept = [c for c in lines.columns if c != "value"]
    rows = lines.where(is_data_line(value)).withColumn("_fields", F.split(value, ","))
    rows = rows.withColumn("_fields", complete(f, "motif", 13))
    return rows.select(
        *(field(f, n).alias(c) for n, c in enumerate(MOTIF_TEXT_COLUMNS)),
        strip(field(f, 10)).cast("bigint").alias("pmid"),
        field(f, 11).alias("file"),
        strip(field(f, 12)).cast("double").alias("score_threshold"),
        *kept,
    )


def read_motif_info(spark: SparkSession, path: str) -> DataFrame:
    """The motif dimension; ``row_id`` counts the data lines from 1 in file order."""
    lines = spark.read.text(path)
    return parse_motif_info(with_row_id(lines.where(is_data_line(F.col("value")))))
