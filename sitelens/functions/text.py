"""Splitting of raw text lines."""

from pyspark.sql import Column
from pyspark.sql import functions as F


_WHITESPACE = " \t\r\n\f\v"


def strip(col: Column) -> Column:
    """Trim any whitespace, tabs included (plain SQL ``trim`` removes spaces only)."""
    return F.trim(col, F.lit(_WHITESPACE))


def fields(line: Column) -> Column:
    """Whitespace-separated fields; an empty or blank line has a single empty field."""
    return F.split(strip(line), r"\s+")


def field(array: Column, index: int) -> Column:
    """Zero-based field, NULL when the line is too short."""
    return F.get(array, F.lit(index))


def is_blank(line: Column) -> Column:
    """Whether a line holds nothing but white space."""
    return strip(line) == ""


def complete(array: Column, what: str, least: int, most: int | None = None) -> Column:
    """The fields of a line; reading any of them fails if their number is out of bounds.

    ``array`` is to be a column of its own, so that a line is cut once.
    """
    count = F.size(array)
    good = count >= least if most is None else count.between(least, most)
    said = F.concat(
        F.lit(f"{what} line of "), count, F.lit(" fields: "), F.substring(F.concat_ws(" ", array), 1, 200)
    )
    return F.when(good, array).otherwise(F.raise_error(said))


def number(text: Column, what: str) -> Column:
    """A double; fails on anything that is none, NaN included."""
    value = strip(text).try_cast("double")
    said = F.concat(F.lit(f"{what} is no number: "), F.coalesce(text, F.lit("nothing")))
    return F.when(value.isNotNull() & ~F.isnan(value), value).otherwise(F.raise_error(said))
