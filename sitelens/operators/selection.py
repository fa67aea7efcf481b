"""Restriction of the motif dimension."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def selected_motifs(motifs: DataFrame, ids: DataFrame, names: DataFrame) -> DataFrame:
    """Motifs whose number is in one set and whose name is in the other (sets are not paired).

    Numbers count from 1. Saying so costs nothing and tells the planner that the motifs are a
    selection: a join of stored sites with them then prunes the ``pwmid=`` directories at run time.
    """
    motifs = motifs.where(F.col("row_id") >= 1)
    return motifs.join(ids.withColumnRenamed("pwmid", "row_id"), "row_id", "left_semi").join(
        names.withColumnRenamed("tf_name", "name"), "name", "left_semi"
    )
