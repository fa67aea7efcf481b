"""Expressions over hits, sites and alleles."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitelens.schemas import LOWER_BASES

# A gain by A, C, G or T adds this to the decimal event code.
EVENT_DIGITS = {"a": 1, "c": 10, "g": 100, "t": 1000}


def event_code(gains: dict[str, Column]) -> Column:
    """Decimal event code from one boolean per base."""
    code = F.lit(0)
    for base, digit in EVENT_DIGITS.items():
        code = code + F.when(gains[base], digit).otherwise(0)
    return code.cast("bigint")


def event_flags(event: Column) -> dict[str, Column]:
    """``use_w`` is set when no base gains; the other flags are the digits of the code.

    A code with other digits than 0 and 1, or of more than four, fails.
    """
    said = F.concat(F.lit("no event code: "), event)
    code = F.when(event.cast("string").rlike("^0*[01]{1,4}$"), event.cast("bigint")).when(
        event.isNotNull(), F.raise_error(said).cast("bigint")
    )
    flags = {"use_w": code == 0}
    for base, digit in EVENT_DIGITS.items():
        flags[f"use_{base}"] = code % (10 * digit) >= digit
    return flags


def strand_max(forward: Column, reverse: Column) -> Column:
    """Better of the two strands; NULL only when both are."""
    return F.greatest(forward, reverse)


def allele_flags(alt: Column) -> dict[str, Column]:
    """One boolean per base; an allele of several letters sets none."""
    letter = F.upper(alt)
    return {f"use_{b}": letter == b.upper() for b in LOWER_BASES}


def allele_score(flags: dict[str, Column], scores: dict[str, Column]) -> Column:
    """Mutated score of the allele that is set, NULL when none is."""
    picked = F.lit(None).cast("double")
    for b in reversed(LOWER_BASES):
        picked = F.when(flags[f"use_{b}"], scores[b]).otherwise(picked)
    return picked
