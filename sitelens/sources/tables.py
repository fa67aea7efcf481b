"""The stored tables."""

import posixpath

from pyspark.sql import DataFrame, SparkSession

from sitelens.schemas import MOTIFS, MOTIFS_DIR, MOTIFS_VIEW, SITES, SITES_DIR, SITES_VIEW


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """Sites, columns in schema order (the partition column ``pwmid`` is stored last)."""
    return spark.read.schema(SITES).parquet(path).select(*SITES.names)


def read_motifs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MOTIFS).parquet(path)


def load_tables(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """Both tables of a table directory, also registered as views ``tfbs`` and ``tf_info``."""
    sites = read_sites(spark, posixpath.join(directory, SITES_DIR))
    motifs = read_motifs(spark, posixpath.join(directory, MOTIFS_DIR))
    sites.createOrReplaceTempView(SITES_VIEW)
    motifs.createOrReplaceTempView(MOTIFS_VIEW)
    return sites, motifs
