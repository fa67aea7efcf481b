"""Connected components of a link table, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import stored


def _lowest(edges: DataFrame) -> DataFrame:
    """Of each ``u`` the smallest ``v``, as ``low``."""
    return edges.groupBy("u").agg(F.min("v").alias("low"))


def _far_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both).withColumn("low", F.least("u", "low"))
    linked = both.where(F.col("v") > F.col("u")).join(low, "u")
    return linked.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _near_star(edges: DataFrame) -> DataFrame:
    linked = edges.join(_lowest(edges), "u")
    down = linked.where(F.col("v") != F.col("low")).select(
        F.col("v").alias("u"), F.col("low").alias("v")
    )
    return down.unionByName(linked.select("u", F.col("low").alias("v"))).distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of every node of ``links`` (``u, v`` of longs); label is the smallest node.

    A node holds no list of its neighbours, so a centre of any degree is no heavier than its rows.
    Rounds grow with the logarithm of the longest chain. Without links the result is empty.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stored(edges.where("u != v").distinct(), "links")
    state = _state(edges)
    while True:
        edges = stored(_near_star(_far_star(edges)), "stars")
        new = _state(edges)
        if new == state:
            break
        state = new
    label = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return label.unionByName(roots)
