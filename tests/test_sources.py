import pytest
from pyspark.sql import functions as F

from sitelens.operators.row_id import with_row_id
from sitelens.sources.hits import parse_hits
from sitelens.sources.motif_info import read_motif_info
from sitelens.sources.samples import (
    parse_intervals,
    parse_selection,
    parse_variants,
    read_intervals,
)
from sitelens.sources.scan_inputs import number_pwms, read_fragments, read_pwms, read_thresholds


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_intervals_with_names(spark):
    got = parse_intervals(lines(spark, "chr1\t5 9 peak", "X 3 3 p2", "1 2 3", "", "a b"), 4)
    assert rows(got) == [(1, 5, 9, "peak"), (-1, 3, 3, "p2")]


@pytest.mark.parametrize("bed_col, name", [(0, "chr1"), (1, "5"), (2, "9"), (3, "chr1"), (-1, "chr1")])
def test_interval_name_column(spark, bed_col, name):
    got = parse_intervals(lines(spark, "chr1 5 9"), 3, bed_col)
    assert rows(got) == [(1, 5, 9, name)]


def test_first_line_sets_the_width(spark, tmp_path):
    path = tmp_path / "sample.bed"
    path.write_text("chr1 5 9\n2 7 8 named\nY 1 2\n")
    assert rows(read_intervals(spark, str(path))) == [(1, 5, 9, "chr1"), (-2, 1, 2, "Y")]
    (tmp_path / "empty.bed").write_text("")
    assert rows(read_intervals(spark, str(tmp_path / "empty.bed"))) == []


def test_variants(spark):
    got = parse_variants(
        lines(
            spark,
            "##header",
            "",
            "8\t145086052\t.\tC\tT",
            "chrX\t 7 \trs1\tC\ta \tmore\tfields",
            "9\t74979169\t.\tC\tA,G",
        )
    )
    assert rows(got) == [
        (8, 145086052, ".", "C", "T", False, False, False, True, "."),
        (-1, 7, "rs1", "C", "a", True, False, False, False, "rs1"),
        (9, 74979169, ".", "C", "A,G", False, False, False, False, "."),
    ]


def test_selection(spark):
    ids, names = parse_selection(
        lines(spark, "pwmid, tf_name", "1,TFAP2B", " 3 , TFAP2D ", "5", "6,", "7,a,b", "x,y", "")
    )
    assert rows(ids) == [(1,), (3,), (5,), (6,)]
    assert rows(names) == [("TFAP2B",), ("TFAP2D",)]


def test_hits(spark):
    text = "X 1031 1032 4 7 110 3.089 -2.749 NaN nan 1.0 2.0 -0.5 -0.25 0.0 -99999.000"
    assert rows(parse_hits(lines(spark, text, "chr8" + text[1:]))) == [
        (-1, 1031, 4, 7, 110, 3.089, -2.749, None, None, 1.0, 2.0, -0.5, -0.25, 0.0, -99999.0),
        (None, 1031, 4, 7, 110, 3.089, -2.749, None, None, 1.0, 2.0, -0.5, -0.25, 0.0, -99999.0),
    ]


def motif_line(n):
    return f"M{n},TF{n},sp,D,fam,dbd,PBM,id,type,author,{n * 3},M{n}.txt,{n}.5"


def test_motif_info_is_numbered_without_headers(spark, tmp_path):
    path = tmp_path / "info.csv"
    path.write_text("Motif_ID,Name\n" + "".join(motif_line(n) + "\n" for n in (4, 9, 2)))
    got = read_motif_info(spark, str(path))
    assert sorted(rows(got.select("row_id", "motif_id", "pmid", "file", "score_threshold"))) == [
        (1, "M4", 12, "M4.txt", 4.5),
        (2, "M9", 27, "M9.txt", 9.5),
        (3, "M2", 6, "M2.txt", 2.5),
    ]


def test_row_ids_over_many_splits_and_files(spark, tmp_path):
    expected = {}
    for name, size in (("b.txt", 3000), ("a.txt", 1), ("d.txt", 700), ("c.txt", 0)):
        (tmp_path / name).write_text("".join(f"{name}:{n}\n" for n in range(size)))
    for name, size in (("a.txt", 1), ("b.txt", 3000), ("d.txt", 700)):
        for n in range(size):
            if n % 3:
                expected[f"{name}:{n}"] = len(expected) + 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        scan = spark.read.text(str(tmp_path))
        assert scan.rdd.getNumPartitions() > 5
        kept = scan.where(F.split_part("value", F.lit(":"), F.lit(2)).cast("int") % 3 != 0)
        for threshold in ("10485760", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            got = dict(rows(with_row_id(kept).select("value", "row_id")))
            assert got == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scan_inputs(spark, tmp_path):
    fragments = tmp_path / "fragments.tsv"
    fragments.write_text(
        "chrom\tstart\ta\tb\tc\td\te\tseq\n"
        "chr8\t1000\t.\t.\t\t.\t.\tACGT\n"
        "chrX\t5\t.\t.\t.\t.\t.\tacgn\textra\n"
    )
    assert sorted(rows(read_fragments(spark, str(fragments)))) == [
        (1, 8, 1000, "ACGT"),
        (2, -1, 5, "acgn"),
    ]
    (tmp_path / "pwms").mkdir()
    for name in ("M2.txt", "M1.txt", "unused.txt"):
        (tmp_path / "pwms" / name).write_text("Pos\tA\tC\tG\tT\n1\t0.1\t0.2\t0.3\t0.4\n")
    thresholds = tmp_path / "thresholds.tsv"
    thresholds.write_text("M2.txt\t2.5\nM1.txt\t-1\n")
    listed = read_thresholds(spark, str(thresholds))
    assert sorted(rows(listed)) == [(1, "M2.txt", 2.5), (2, "M1.txt", -1.0)]
    cells = number_pwms(read_pwms(spark, str(tmp_path / "pwms")), listed)
    assert sorted(rows(cells)) == [
        (number, threshold, 0, b, b / 10)
        for number, threshold in ((1, 2.5), (2, -1.0))
        for b in (1, 2, 3, 4)
    ]
