"""Weight-matrix arithmetic on long-form cells ``(pwmid, i, b, p)``, ``b`` in 1..4."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Pseudo-count per cell, and the even background over the four bases.
PSEUDO_COUNT = 0.001
EVEN_BACKGROUND = (0.25, 0.25, 0.25, 0.25)


def smooth(cells: DataFrame) -> DataFrame:
    """Add the pseudo-count to every cell of a motif that holds a zero; leave other motifs alone.

    Both windows lie inside one motif, and the first already puts a motif into one partition, so
    there is a single exchange.
    """
    motif = Window.partitionBy("pwmid")
    row = Window.partitionBy("pwmid", "i")
    marked = cells.withColumn("_zero", F.max(F.col("p") == 0).over(motif))
    summed = marked.withColumn("_sum", F.sum("p").over(row))
    smoothed = (F.col("p") + PSEUDO_COUNT) / (F.col("_sum") + 4 * PSEUDO_COUNT)
    return summed.withColumn("p", F.when(F.col("_zero"), smoothed).otherwise(F.col("p"))).drop(
        "_zero", "_sum"
    )


def log_odds(p: Column, b: Column, background=EVEN_BACKGROUND) -> Column:
    """``ln(p / background)``; minus infinity for 0, where SQL ``ln`` would give NULL."""
    expected = F.element_at(F.array(*(F.lit(float(x)) for x in background)), b.cast("int"))
    return F.when(p > 0, F.ln(p / expected)).otherwise(F.lit(float("-inf")))
