"""Text form of hits."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitelens.functions.chromosome import chromosome_label
from sitelens.schemas import STRAND_SCORES


def score_text(score: Column) -> Column:
    """Three decimals; ``NaN`` where there is no score."""
    return F.when(score.isNull(), F.lit("NaN")).otherwise(F.format_string("%.3f", score))


def hit_line() -> Column:
    """The 16 space-separated fields of a hit; the end position is one past the position."""
    return F.concat_ws(
        " ",
        chromosome_label(F.col("chromosome")),
        F.col("mutation_pos"),
        F.col("mutation_pos") + 1,
        F.col("chunk_id"),
        F.col("pwmid"),
        F.col("event"),
        *(score_text(F.col(c)) for c in STRAND_SCORES),
    )
