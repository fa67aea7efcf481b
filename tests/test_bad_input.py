"""Imperfect input fails or is skipped as stated; it is never lost in silence."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sitelens.functions.sites import event_flags
from sitelens.operators.scan import scan_motifs
from sitelens.sources.hits import parse_hits
from sitelens.sources.motif_info import read_motif_info
from sitelens.sources.samples import parse_variants
from sitelens.sources.scan_inputs import (
    number_pwms,
    read_fragments,
    read_thresholds,
    with_motif_numbers,
)

HIT = "1 5 6 1 1 0 1 1 NaN NaN 1 1 1 1 1 1"
MOTIF = "{},n,s,D,f,d,t,i,t,a,1,{}.txt,2.5"


def saved(tmp_path, text):
    path = tmp_path / "in.txt"
    path.write_text(text)
    return str(path)


def lines(spark, *texts):
    return spark.createDataFrame([(x,) for x in texts], "value string")


def fails(df):
    with pytest.raises(PySparkException):
        df.collect()


def test_threshold_that_is_no_number(spark, tmp_path):
    fails(read_thresholds(spark, saved(tmp_path, "a.txt\tabc\n")))


def test_threshold_that_is_nan(spark, tmp_path):
    fails(read_thresholds(spark, saved(tmp_path, "a.txt\tNaN\n")))


def test_threshold_that_is_absent(spark, tmp_path):
    fails(read_thresholds(spark, saved(tmp_path, "a.txt\n")))


def test_blank_threshold_lines_take_no_number(spark, tmp_path):
    rows = read_thresholds(spark, saved(tmp_path, "a.txt\t1\n\n \nb.txt\t2\n")).collect()
    assert sorted(tuple(r) for r in rows) == [(1, "a.txt", 1.0), (2, "b.txt", 2.0)]


def test_listed_motif_without_matrix(spark):
    cells = spark.createDataFrame([("a.txt", 0, 1, 0.5)], "motif_file string, i int, b int, p double")
    listed = "pwmid long, motif_file string, threshold double"
    one = spark.createDataFrame([(1, "a.txt", 1.0)], listed)
    assert number_pwms(cells, one).count() == 1
    fails(number_pwms(cells, spark.createDataFrame([(1, "a.txt", 1.0), (2, "b.txt", 1.0)], listed)))


def matrix(spark, rows, missing=()):
    cells = [(1, 99.0, i, b, 0.25) for i in range(rows) for b in (1, 2, 3, 4) if (i, b) not in missing]
    return spark.createDataFrame(cells, "pwmid long, threshold double, i int, b int, p double")


def test_unreachable_matrix_is_checked_first(spark):
    fragments = spark.createDataFrame(
        [(1, 1, 0, "ACGT" * 30)], "chunk_id long, chromosome long, start long, seq string"
    )
    assert scan_motifs(fragments, matrix(spark, 30)).count() == 0
    for bad in (
        matrix(spark, 31),
        matrix(spark, 3, missing=[(1, 2)]),
        matrix(spark, 3, missing=[(1, b) for b in (1, 2, 3, 4)]),
        matrix(spark, 3).withColumn("threshold", F.lit(None).cast("double")),
    ):
        with pytest.raises(ValueError):
            scan_motifs(fragments, bad)


def test_motif_lines(spark, tmp_path):
    text = f"Motif_ID,x\n{MOTIF.format('M1', 'a')}\n\n{MOTIF.format('M2', 'b')}\n"
    rows = read_motif_info(spark, saved(tmp_path, text)).collect()
    assert sorted((r.motif_id, r.row_id) for r in rows) == [("M1", 1), ("M2", 2)]
    fails(read_motif_info(spark, saved(tmp_path, f"{MOTIF.format('M1', 'a')}\nM2,n,s\n")))


def test_hit_lines(spark):
    assert parse_hits(lines(spark, HIT, "", "  ")).count() == 1
    fails(parse_hits(lines(spark, " ".join(HIT.split()[:8]))))
    fails(parse_hits(lines(spark, HIT + " 1")))


def test_variant_lines(spark):
    assert parse_variants(lines(spark, "1\t5\tv\tA\tC", "", "#x")).count() == 1
    fails(parse_variants(lines(spark, "1\t5\tv")))


def test_fragment_lines(spark, tmp_path):
    head = "h\n"
    good = "chr1\t5\t.\t.\t.\t.\t.\tACGT\nchr1\t9\t.\t.\t.\t.\t.\t\n"
    rows = read_fragments(spark, saved(tmp_path, head + good)).collect()
    assert sorted((r.chunk_id, r.seq) for r in rows) == [(1, "ACGT"), (2, "")]
    fails(read_fragments(spark, saved(tmp_path, head + good + "chr1\t9\t.\n")))


@pytest.mark.parametrize("event", ["2", "900", "11111", "-1"])
def test_event_digits(spark, event):
    fails(lines(spark, event).select(*(f.alias(c) for c, f in event_flags(F.col("value")).items())))


def test_thresholds_take_the_numbers_of_the_motif_table(spark):
    listed = spark.createDataFrame(
        [(1, "b.txt", 2.0), (2, "a.txt", 1.0)], "pwmid long, motif_file string, threshold double"
    )
    motifs = spark.createDataFrame([("a.txt", 1), ("b.txt", 2)], "file string, row_id long")
    rows = with_motif_numbers(listed, motifs).collect()
    assert sorted(tuple(r) for r in rows) == [(1, "a.txt", 1.0), (2, "b.txt", 2.0)]
    fails(with_motif_numbers(listed, motifs.where("row_id = 1")))
    fails(with_motif_numbers(listed, motifs.union(motifs)))
