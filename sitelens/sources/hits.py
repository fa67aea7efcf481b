"""Scanner output as text: 16 space-separated fields."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.chromosome import chromosome_code
from sitelens.functions.text import complete, field, fields, is_blank
from sitelens.schemas import STRAND_SCORES


def parse_hits(lines: DataFrame) -> DataFrame:
    """Hits in the scanner's own shape. The end position is dropped; ``NaN`` stands for no score.

    Blank lines are dropped; a line without 16 fields fails.
    """
    f, value = F.col("f"), F.col("value")
    rows = lines.where(~is_blank(value)).select(fields(value).alias("f"))
    rows = rows.select(complete(f, "hit", 16, 16).alias("f"))
    score = lambda n: F.nanvl(field(f, n).cast("double"), F.lit(None).cast("double"))
    return rows.select(
        chromosome_code(field(f, 0), strip_prefix=False).alias("chromosome"),
        field(f, 1).cast("bigint").alias("mutation_pos"),
        field(f, 3).cast("bigint").alias("chunk_id"),
        field(f, 4).cast("bigint").alias("pwmid"),
        field(f, 5).cast("bigint").alias("event"),
        *(score(6 + n).alias(c) for n, c in enumerate(STRAND_SCORES)),
    )


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    return parse_hits(spark.read.text(path))
