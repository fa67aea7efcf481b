"""Expressions over DNA text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four bases in code order 1..4, and their complements.
ALPHABET = "ACGT"
COMPLEMENT = "TGCA"


def code_text(seq: Column) -> Column:
    """Each letter as its digit: A, C, G, T are 1 to 4 in either case, all else 0."""
    digits = F.translate(F.upper(seq), ALPHABET, "1234")
    return F.regexp_replace(digits, "[^1234]", "0")


def encode_bases(seq: Column) -> Column:
    """Base codes as ``array<int>``."""
    return F.when(F.length(seq) > 0, F.split(code_text(seq), "").cast("array<int>")).otherwise(
        F.array().cast("array<int>")
    )


def reverse_complement(seq: Column) -> Column:
    """The other strand, read backwards; letters outside ACGT stay as they are."""
    return F.reverse(
        F.translate(seq, ALPHABET + ALPHABET.lower(), COMPLEMENT + COMPLEMENT.lower())
    )
