"""Chromosome labels and their numeric codes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sex chromosomes have negative codes.
X_CODE = -1
Y_CODE = -2


def chromosome_code(label: Column, strip_prefix: bool = True) -> Column:
    """Digits to their number, X and Y to their codes, everything else and 0 to NULL.

    Sample files often say ``chr8``; with ``strip_prefix`` both spellings give the same code.
    """
    prefix = "(?:[cC][hH][rR])?" if strip_prefix else ""
    name = F.regexp_extract(label, rf"^\s*{prefix}(X|Y|[0-9]*[1-9][0-9]*)\s*$", 1)
    return (
        F.when(name == "X", F.lit(X_CODE).cast("bigint"))
        .when(name == "Y", F.lit(Y_CODE).cast("bigint"))
        .otherwise(name.try_cast("bigint"))
    )


def chromosome_label(code: Column) -> Column:
    """The label that :func:`chromosome_code` turns back into ``code``."""
    return (
        F.when(code == X_CODE, F.lit("X"))
        .when(code == Y_CODE, F.lit("Y"))
        .otherwise(F.coalesce(code.cast("string"), F.lit("0")))
    )


def chromosome_from_file_name(path: Column) -> Column:
    """``.../chr10_005.bed`` gives ``10``."""
    base = F.regexp_extract(path, "([^/]*)$", 1)
    return F.regexp_extract(base, "chr([^_.]+)", 1)
