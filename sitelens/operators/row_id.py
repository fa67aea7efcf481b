"""Dense row numbers in file order."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitelens.operators.sizing import is_small, sized_join_side
from sitelens.session import scratch_path


def with_row_id(scan: DataFrame, name: str = "row_id") -> DataFrame:
    """Number the rows of a file scan 1, 2, ... by file path, then by place in the file.

    ``scan`` must be a file read with at most filters on top. A plain read of files that know their
    rows' places (Parquet) needs no copy: a row's number is its place in the file plus the rows of
    earlier files, and a pass over the places alone counts those. Other rows are written once to the
    session's scratch folder, each with its file, split and place in the split, so that nothing
    depends on a second scan being split like the first; a row's number is its place plus the rows
    of earlier splits.
    """
    placed = _with_places(scan)
    if placed is not None:
        keys, last = ["_file"], F.col("_place") + 1
        sizes = placed.groupBy("_file").agg(F.max(last).alias("_rows")).withColumn("_first", F.lit(0))
    else:
        keys = ["_file", "_block"]
        path = scratch_path(scan.sparkSession, "row-places")
        scan.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_place"),
        ).write.parquet(path)
        placed = scan.sparkSession.read.parquet(path)
        sizes = placed.groupBy(*keys).agg(
            F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
        )
    shifts = _shifts(sizes, keys)
    joined = placed.join(sized_join_side(shifts, is_small(shifts)), keys)
    return joined.withColumn(name, F.col("_place") + F.col("_shift")).select(*scan.columns, name)


def dense_numbers(rows: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """Number stored rows 1, 2, ... by ``keys``, then by ``order``, which is unique among equal keys.

    Rows of equal keys are numbered in one task, so keys are to hold a bounded number of rows.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order)).cast("long")
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_first", F.lit(1))
    shifts = _shifts(sizes, keys)
    joined = rows.withColumn("_place", place).join(sized_join_side(shifts, is_small(shifts)), keys)
    number = (F.col("_place") + F.col("_shift")).alias(name)
    return joined.select(*(c for c in rows.columns if c != name), number)


def _with_places(scan: DataFrame) -> DataFrame | None:
    """The rows with their file and place in it, if the files have them and no filter is on top."""
    if scan._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation":
        return None
    try:
        return scan.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.row_index").alias("_place"),
        )
    except AnalysisException:
        return None


def _shifts(sizes: DataFrame, keys: list[str]) -> DataFrame:
    """What to add to the places of each file or split, given its first place and rows.

    Files are range-partitioned for that: their running sums are taken within a range and over the
    ranges, so no task gets all of them.
    """
    spark = sizes.sparkSession
    path = scratch_path(spark, "split-sizes")
    sizes.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    sizes = spark.read.parquet(path)
    upto = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_range").orderBy(*keys).rowsBetween(*upto)
    before = Window.orderBy("_range").rowsBetween(*upto)
    ranges = sizes.groupBy("_range").agg(F.sum("_rows").alias("_all"))
    ranges = ranges.select("_range", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_base"))
    return (
        sizes.withColumn("_inside", F.coalesce(F.sum("_rows").over(inside), F.lit(0)))
        .join(F.broadcast(ranges), "_range")
        .select(*keys, (F.col("_base") + F.col("_inside") - F.col("_first") + 1).alias("_shift"))
    )
