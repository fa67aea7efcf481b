"""Sample files: intervals, variants and motif selections."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.chromosome import chromosome_code
from sitelens.functions.sites import allele_flags
from sitelens.functions.text import complete, field, fields, is_blank, strip


_FILE = "_metadata.file_path"


def _first_widths(lines: DataFrame) -> DataFrame:
    """``sample, width``: the field count of each file's first line.

    Only the first split of a file is looked at, and there only its first line.
    """
    first = lines.where("_metadata.file_block_start = 0").select(
        F.col(_FILE).alias("sample"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    # only a file's first line is cut into fields
    lines = first.groupBy("sample").agg(F.min_by("value", "place").alias("value"))
    return lines.select("sample", F.size(fields(F.col("value"))).alias("width"))


def _first_line_width(lines: DataFrame) -> int | None:
    """Field count of the first line in file order."""
    first = _first_widths(lines).orderBy("sample").first()
    return first.width if first else None


def parse_intervals(lines: DataFrame, n_cols: int, bed_col: int = 0) -> DataFrame:
    """Intervals ``(chromosome, start, stop, bed_name)``, both ends included.

    Lines whose field count is not ``n_cols`` are dropped. The name is the fourth of exactly four
    fields, else field ``bed_col`` (0 to 2, anything else means 0).
    """
    rows = lines.select(fields(F.col("value")).alias("f")).where(F.size("f") == n_cols)
    return rows.select(*_interval_columns(bed_col))


def _interval_columns(bed_col: int) -> list:
    if bed_col not in (0, 1, 2):
        bed_col = 0
    f = F.col("f")
    return [
        chromosome_code(field(f, 0)).alias("chromosome"),
        field(f, 1).cast("bigint").alias("start"),
        field(f, 2).cast("bigint").alias("stop"),
        F.when(F.size(f) == 4, field(f, 3)).otherwise(field(f, bed_col)).alias("bed_name"),
    ]


def read_intervals(
    spark: SparkSession, path: str, bed_col: int = 0, n_cols: int | None = None
) -> DataFrame:
    """Interval file; without ``n_cols`` the first line sets the field count."""
    lines = spark.read.text(path)
    if n_cols is None:
        n_cols = _first_line_width(lines) or 3
    return parse_intervals(lines, n_cols, bed_col)


def read_interval_samples(
    spark: SparkSession, paths: list[str], bed_col: int = 0, n_cols: int | None = None
) -> DataFrame:
    """Intervals of many files at once, each with its file as ``sample``.

    Without ``n_cols`` each file's own first line sets its field count.
    """
    lines = spark.read.text(paths)
    rows = lines.select(F.col(_FILE).alias("sample"), fields(F.col("value")).alias("f"))
    if n_cols is None:
        # a row a file
        rows = rows.join(F.broadcast(_first_widths(lines)), "sample")
    else:
        rows = rows.withColumn("width", F.lit(n_cols))
    return rows.where(F.size("f") == F.col("width")).select(*_interval_columns(bed_col), "sample")


def read_variant_samples(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Variants of many files at once, each with its file as ``sample``."""
    return parse_variants(spark.read.text(paths).withColumn("sample", F.col(_FILE)), "sample")


def parse_variants(lines: DataFrame, *others: str) -> DataFrame:
    """Variants from tab-separated lines; ``#`` lines and blank lines are dropped.

    A line of under 5 fields fails. ``others`` are columns of ``lines`` to keep.
    """
    value, f = F.col("value"), F.col("f")
    rows = lines.where(~value.startswith("#") & ~is_blank(value))
    rows = rows.select(F.split(value, "\t").alias("f"), *others)
    rows = rows.withColumn("f", complete(f, "variant", 5))
    alt = strip(field(f, 4))
    return rows.select(
        chromosome_code(field(f, 0)).alias("chromosome"),
        strip(field(f, 1)).cast("bigint").alias("mutation_pos"),
        field(f, 2).alias("name"),
        field(f, 3).alias("reference"),
        alt.alias("alt"),
        *(flag.alias(c) for c, flag in allele_flags(alt).items()),
        field(f, 2).alias("vcf_name"),
        *others,
    )


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    return parse_variants(spark.read.text(path))


def parse_selection(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Motif numbers and factor names, two sets that are not paired.

    A line counts when it has one or two comma-separated fields and the first is all digits.
    """
    f = F.col("f")
    good = lines.select(F.split(F.col("value"), ",").alias("f")).where(
        F.size(f).isin(1, 2) & field(f, 0).rlike(r"^\s*[0-9]+\s*$")
    )
    ids = good.select(strip(field(f, 0)).cast("bigint").alias("pwmid"))
    names = good.select(strip(field(f, 1)).alias("tf_name")).where(F.col("tf_name") != "")
    return ids, names


def read_selection(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_selection(spark.read.text(path))
