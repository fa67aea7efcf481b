import pytest
from pyspark.sql import functions as F

from sitelens.functions.chromosome import (
    chromosome_code,
    chromosome_from_file_name,
    chromosome_label,
)
from sitelens.functions.pwm import log_odds, smooth
from sitelens.functions.sequence import code_text, encode_bases, reverse_complement
from sitelens.functions.sites import (
    allele_flags,
    allele_score,
    event_code,
    event_flags,
    strand_max,
)

CODES = {
    "8": 8, "chr8": 8, "CHR22": 22, " 7\t": 7, "X": -1, "chrY": -2, "0": None, "00": None,
    "010": 10, "M": None, "chrM": None, "x": None, "": None, "1.5": None, "9" * 30: None,
}


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def results(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_chromosome_codes(spark):
    df = column(spark, CODES)
    assert results(df, chromosome_code(F.col("v"))) == list(CODES.values())
    plain = results(column(spark, ["8", "chr8", "X"]), chromosome_code(F.col("v"), False))
    assert plain == [8, None, -1]


def test_chromosome_labels_come_back(spark):
    df = column(spark, [1, 22, -1, -2, None], "bigint")
    assert results(df, chromosome_label(F.col("v"))) == ["1", "22", "X", "Y", "0"]
    back = chromosome_code(chromosome_label(F.col("v")), strip_prefix=False)
    assert results(df, back) == [1, 22, -1, -2, None]


def test_chromosome_from_file_name(spark):
    df = column(spark, ["chr10_005.bed", "/a/chr1_x/chrX_01.bed", "hdfs://h/chr7.bed"])
    assert results(df, chromosome_from_file_name(F.col("v"))) == ["10", "X", "7"]


@pytest.mark.parametrize(
    "event, flags",
    [
        ("100", (False, False, False, True, False)),
        ("1101", (False, True, False, True, True)),
        ("0", (True, False, False, False, False)),
        ("0010", (False, False, True, False, False)),
    ],
)
def test_event_flags(spark, event, flags):
    row = column(spark, [event]).select(*event_flags(F.col("v")).values()).first()
    assert tuple(row) == flags


def test_event_code_is_the_inverse(spark):
    gains = {b: F.col("v").bitwiseAND(1 << n) > 0 for n, b in enumerate("acgt")}
    codes = results(column(spark, range(16), "int"), event_code(gains))
    assert codes == [int(f"{n:b}") for n in range(16)]


def test_strand_max_skips_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, -3.0), (None, None)], "f double, r double")
    assert results(df, strand_max(F.col("f"), F.col("r"))) == [2.0, -3.0, None]


def test_allele_scores(spark):
    df = column(spark, ["a", "C", "g", "T", "A,C", "AC", "."])
    scores = {b: F.lit(float(n)) for n, b in enumerate("acgt")}
    got = results(df, allele_score(allele_flags(F.col("v")), scores))
    assert got == [0.0, 1.0, 2.0, 3.0, None, None, None]


def test_base_codes(spark):
    df = column(spark, ["ACGTNacgt-", ""])
    assert results(df, encode_bases(F.col("v"))) == [[1, 2, 3, 4, 0, 1, 2, 3, 4, 0], []]
    assert results(df, code_text(F.col("v"))) == ["1234012340", ""]


def test_reverse_complement(spark):
    df = column(spark, ["AACGTn", "acgN"])
    assert results(df, reverse_complement(F.col("v"))) == ["nACGTT", "Ncgt"]


def test_smoothing_is_per_motif(spark):
    cells = spark.createDataFrame(
        [(1, 0, 1, 0.0), (1, 0, 2, 1.0), (1, 0, 3, 0.5), (1, 0, 4, 0.5), (1, 1, 1, 0.25),
         (2, 0, 1, 0.4), (2, 0, 2, 0.6)],
        "pwmid int, i int, b int, p double",
    )
    got = {(r.pwmid, r.i, r.b): r.p for r in smooth(cells).collect()}
    assert got[1, 0, 1] == pytest.approx(0.001 / 2.004)
    assert got[1, 1, 1] == pytest.approx(0.251 / 0.254)
    assert (got[2, 0, 1], got[2, 0, 2]) == (0.4, 0.6)


def test_log_odds_of_zero(spark):
    df = column(spark, [0.25, 0.0], "double")
    assert results(df, log_odds(F.col("v"), F.lit(2))) == [0.0, float("-inf")]
    skewed = log_odds(F.col("v"), F.lit(2), (0.4, 0.125, 0.4, 0.075))
    assert results(df, skewed)[0] == pytest.approx(0.6931471805599453)
