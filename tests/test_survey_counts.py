"""Row counts that the survey established independently, on the tables that it derived."""

import os

import pytest
from pyspark.sql import functions as F

from sitelens.functions.sites import allele_flags
from sitelens.operators.scan import scan_motifs
from sitelens.plans.intersect import (
    annotate_variants,
    intersect_intervals,
    intersect_minimal,
    select_motifs,
)
from sitelens.plans.tables import on_chromosome

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")

CODE = "case {0} % 24 when 22 then -1 when 23 then -2 else {0} % 24 + 1 end as chromosome"
BITS = "(l_orderkey + l_linenumber)"


def table(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet")


@pytest.fixture(scope="module")
def tables(spark):
    sites = table(spark, "lineitem").selectExpr(
        CODE.format("l_suppkey"),
        "l_orderkey as mutation_pos",
        "l_suppkey + 1 as chromosome_chunk",
        "l_partkey % 50 + 1 as pwmid",
        f"{BITS} % 16 = 0 as use_w",
        *(f"({BITS} & {1 << n}) > 0 as use_{b}" for n, b in enumerate("acgt")),
        "l_quantity as wt_max_score",
        *(
            f"l_quantity {x} as {b}_mutation_max_score"
            for b, x in zip("acgt", ("+ l_tax", "- l_tax", "+ l_discount", "- l_discount"))
        ),
    )
    motifs = table(spark, "part").where("p_partkey < 50").selectExpr(
        "p_partkey + 1 as row_id",
        "concat('M', p_partkey) as motif_id",
        "p_brand as name",
        "cast(p_size as double) as score_threshold",
    )
    return sites, motifs


def test_interval_counts(spark, tables):
    intervals = table(spark, "orders").where("o_orderkey % 50 = 0").selectExpr(
        CODE.format("o_custkey"),
        "o_orderkey as start",
        "o_orderkey + o_custkey % 20 as stop",
        "o_orderpriority as bed_name",
    )
    found = intersect_intervals(*tables, intervals)
    assert found.count() == 541
    assert found.select("chromosome", "mutation_pos").distinct().count() <= 496
    assert intersect_minimal(tables[0], intervals).count() == 541


def test_variant_count(spark, tables):
    alt = (
        "case when event_id % 10 = 0 then 'A,C'"
        " else substr('acgt', cast((event_id + 1) % 4 + 1 as int), 1) end as alt"
    )
    variants = table(spark, "events").selectExpr(
        CODE.format("user_id"),
        "event_id as mutation_pos",
        "concat('v', event_id) as name",
        "substr('ACGT', cast(event_id % 4 + 1 as int), 1) as reference",
        alt,
    )
    variants = variants.withColumns({**allele_flags(F.col("alt")), "vcf_name": F.col("name")})
    assert annotate_variants(*tables, variants).count() == 1680


def test_selection_and_chromosome_counts(spark, tables):
    sites, motifs = tables
    ids = motifs.where("row_id % 3 = 1").selectExpr("row_id as pwmid")
    names = spark.createDataFrame([("Brand#1",), ("Brand#2",)], "tf_name string")
    assert select_motifs(sites, motifs, ids, names).count() == 3592
    assert on_chromosome(sites, -2).count() == 2417


@pytest.mark.parametrize("threshold, count", [(3.0, 497), (4.0, 0)])
def test_scan_counts(spark, threshold, count):
    fragments = table(spark, "documents").selectExpr(
        "doc_id + 1 as chunk_id",
        "doc_id % 22 + 1 as chromosome",
        "doc_id * 1000 as start",
        "translate(substr(regexp_replace(lower(text), '[^a-z]', ''), 1, 200),"
        " 'abcdefghijklmnopqrstuvwxyz', 'acgtacgtacgtacgtacgtacgtan') as seq",
    ).where("length(seq) >= 64 and chunk_id <= 10")
    raw = [
        (m, i, b, (m * 7 + i * 3 + b * b * 5) % 10) for m in range(3) for i in range(6) for b in (1, 2, 3, 4)
    ]
    total = {(m, i): sum(v for m2, i2, _, v in raw if (m2, i2) == (m, i)) for m, i, _, _ in raw}
    cells = spark.createDataFrame(
        [(m + 1, threshold, i, b, v / total[m, i]) for m, i, b, v in raw],
        "pwmid bigint, threshold double, i int, b int, p double",
    )
    assert scan_motifs(fragments, cells).count() == count
