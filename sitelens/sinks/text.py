"""Writers of text results."""

from pyspark.sql import DataFrame

from sitelens.functions.format import hit_line


def write_csv(
    df: DataFrame,
    path: str,
    partitions: int | None = None,
    mode: str = "error",
    by: list[str] | None = None,
) -> None:
    """Write a directory of CSV part files, each with a header; below a directory for each value of
    the columns ``by``, if given."""
    if partitions:
        df = df.repartition(partitions)
    writer = df.write.mode(mode).option("header", True)
    (writer.partitionBy(*by) if by else writer).csv(path)


def write_hits(hits: DataFrame, path: str, mode: str = "error") -> None:
    """Write hits as text, one line each."""
    hits.select(hit_line().alias("value")).write.mode(mode).text(path)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows."""
    return df.limit(n)
