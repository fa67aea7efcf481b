"""Joins against brute force: overlaps, hot keys, and the path without a broadcast."""

import random

import pytest
from pyspark.sql import functions as F

from sitelens.operators import sizing
from sitelens.operators.overlap import (
    cell_words,
    explode_intervals,
    leveled,
    overlap_join,
    position_join,
    probes,
)
from sitelens.operators.sizing import merged_ranges
from sitelens.plans.intersect import annotate_variants, intersect_intervals, select_motifs
from sitelens.schemas import SITES

INTERVAL = "chromosome bigint, start bigint, stop bigint, bed_name string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(params=["broadcast", "shuffle"])
def side(request, monkeypatch):
    if request.param == "shuffle":
        monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    return request.param


def positions(spark, values):
    return spark.createDataFrame(values, "chromosome bigint, mutation_pos bigint, tag int")


def random_case(seed, chromosomes=3, hot=0.35):
    """Sites and intervals where one spot holds a third of each side."""
    rng = random.Random(seed)
    sites, intervals = [], []
    for n in range(400):
        spot = (1, 5000) if rng.random() < hot else (rng.randint(1, chromosomes), rng.randint(0, 9999))
        sites.append((*spot, n))
    sites += [(None, 5000, 400), (1, None, 401)]
    for n in range(120):
        if rng.random() < hot:
            c, start, length = 1, 5000 - rng.randint(0, 3), rng.randint(0, 9)
        else:
            c, start = rng.randint(1, chromosomes), rng.randint(0, 9999)
            length = rng.choice([-1, 0, 1, 7, 100, 6000])
        intervals.append((c, start, start + length, f"i{n}"))
    intervals += [(None, 0, 10_000, "nowhere"), (1, 5000, 5000, "twin"), (1, 5000, 5000, "twin")]
    return sites, intervals


def brute(sites, intervals):
    return sorted(
        (c, p, tag, name)
        for c, p, tag in sites
        for ic, start, stop, name in intervals
        if None not in (c, p, ic) and c == ic and start <= p <= stop
    )


@pytest.mark.parametrize("bits", [None, 0, 4, 20])
@pytest.mark.parametrize("chromosomes", [3, 24])
def test_overlap_join(spark, side, bits, chromosomes):
    sites, intervals = random_case(chromosomes, chromosomes)
    joined = overlap_join(
        positions(spark, sites), spark.createDataFrame(intervals, INTERVAL), bin_bits=bits
    )
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert ("broadcast" in plan) == (side == "broadcast")
    assert rows(joined) == brute(sites, intervals)


def test_exploded_form_gives_the_same(spark):
    sites, intervals = random_case(5)
    exploded = explode_intervals(spark.createDataFrame(intervals, INTERVAL))
    assert rows(position_join(positions(spark, sites), exploded)) == brute(sites, intervals)


def test_half_open_intervals(spark):
    sites = positions(spark, [(1, p, p) for p in range(10)])
    intervals = spark.createDataFrame([(1, 3, 5, "a"), (1, 7, 7, "b")], INTERVAL)
    assert [r[1] for r in rows(overlap_join(sites, intervals, half_open=True))] == [3, 4]
    assert [r[1] for r in rows(overlap_join(sites, intervals))] == [3, 4, 5, 7]


def test_empty_sample(spark):
    sites = positions(spark, [(1, 5, 0)])
    assert rows(overlap_join(sites, spark.createDataFrame([], INTERVAL))) == []


def test_mixed_lengths_copy_and_test_little(spark, side):
    """Lengths from 1 to 1e8: few copies of each interval, few pairs tested for each match."""
    rng = random.Random(11)
    intervals = []
    for n in range(300):
        length = int(10 ** (8 * n / 299))
        start = rng.randint(0, 10**8)
        intervals.append((1, start, start + length - 1, f"i{n}"))
    sample = spark.createDataFrame(intervals, INTERVAL)
    copies = leveled(sample).groupBy("bed_name").count().agg(F.max("count")).first()[0]
    assert copies <= 3
    near = [p for _, a, b, _ in intervals for p in (a, b, (a + b) // 2, a + 1)]
    sites = [(1, p, n) for n, p in enumerate([*near, *(rng.randint(0, 2 * 10**8) for _ in range(2000))])]
    places = positions(spark, sites)
    levels = sizing.profile(sample, "start", "stop").levels
    assert levels == tuple(range(0, 28, 2))
    tested = probes(places, levels).join(leveled(sample), ["chromosome", "_level", "_bin"]).count()
    expected = brute(sites, intervals)
    assert tested <= 4 * len(expected)
    assert rows(overlap_join(places, sample)) == expected


def test_merged_ranges_keep_the_widest_gaps():
    covered = [(1, 0, 9), (1, 10, 15), (1, 100, 110), (1, 5000, 5001), (2, 7, 8), (1, 120, 130)]
    assert merged_ranges(covered, 3) == [(1, 0, 130), (1, 5000, 5001), (2, 7, 8)]
    assert merged_ranges(covered, 4) == [(1, 0, 15), (1, 100, 130), (1, 5000, 5001), (2, 7, 8)]
    assert merged_ranges(covered, 1) == [(1, 0, 5001), (2, 7, 8)]
    assert merged_ranges([], 5) == []


def test_bounds_are_pushed_where_they_leave_out_much(spark):
    dense = spark.createDataFrame([(c, 10 * n, 10 * n + 12, "x") for c in (1, 2) for n in range(50)], INTERVAL)
    measured = sizing.profile(dense, "start", "stop")
    said = str(sizing.bounds(dense, measured, "start", "stop"))
    assert " OR " not in said.upper() and "IN" in said.upper()
    sparse = spark.createDataFrame([(1, 10, 20, "x"), (1, 90_000, 90_020, "y")], INTERVAL)
    measured = sizing.profile(sparse, "start", "stop")
    sites = positions(spark, [(1, p, 0) for p in (5, 15, 30_000, 90_010, 100_000)])
    kept = sites.where(sizing.bounds(sparse, measured, "start", "stop"))
    assert sorted(r.mutation_pos for r in kept.collect()) == [15, 90_010]


def test_cells_of_any_sample_fit(spark):
    """A sample that covers much, and one of many points, both thin the sites under a small bound."""
    for lengths, bound in (([10**7] * 40, "200000"), ([0] * 3000, "50000"), ([0, 10**8] * 20, "20000")):
        rng = random.Random(4)
        starts = [rng.randint(0, 10**8) for _ in lengths]
        sample = spark.createDataFrame(
            [(1 + n % 3, a, a + w, "x") for n, (a, w) in enumerate(zip(starts, lengths))], INTERVAL
        )
        spark.conf.set("spark.sitelens.broadcastBytes", bound)
        try:
            words, bits = cell_words(sample, sizing.profile(sample, "start", "stop"))
        finally:
            spark.conf.unset("spark.sitelens.broadcastBytes")
        held = {(r.chromosome, 64 * r._word + n) for r in words.collect() for n in range(64) if r._bits >> n & 1}
        expected = {
            (1 + n % 3, cell) for n, (a, w) in enumerate(zip(starts, lengths)) for cell in range(a >> bits, (a + w >> bits) + 1)
        }
        assert held == expected


def test_few_extents_reach_the_scan(spark, tmp_path):
    positions(spark, [(c, p, 0) for c in (1, 2) for p in range(50)]).write.parquet(
        str(tmp_path / "sites")
    )
    sites = spark.read.parquet(str(tmp_path / "sites"))
    joined = overlap_join(sites, spark.createDataFrame([(2, 10, 12, "a")], INTERVAL))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "EqualTo(chromosome,2), GreaterThanOrEqual(mutati" in pushed
    assert len(rows(joined)) == 3


def site_rows(spark, values):
    """``(chromosome, position, pwmid, use flags as text, scores)``"""
    full = [
        (c, p, 1, m, *(u in flags for u in "wacgt"), *scores) for c, p, m, flags, scores in values
    ]
    return spark.createDataFrame(full, SITES)


def motif_rows(spark, *values):
    return spark.createDataFrame(
        values, "row_id bigint, motif_id string, name string, score_threshold double"
    )


def test_interval_query_columns(spark, side):
    sites = site_rows(
        spark, [(8, 10, 1, "w", (5.0, 1.0, 2.0, 3.0, None)), (8, 11, 9, "a", (1.0,) * 5)]
    )
    motifs = motif_rows(spark, (1, "M1", "TF1", 4.5))
    intervals = spark.createDataFrame([(8, 10, 11, "p"), (8, 9, 10, "q")], INTERVAL)
    result = intersect_intervals(sites, motifs, intervals)
    assert result.columns == (
        "chromosome mutation_pos use_w use_a use_c use_g use_t wt_max_score a_mutation_max_score"
        " c_mutation_max_score g_mutation_max_score t_mutation_max_score motif_id name"
        " score_threshold bed_name"
    ).split()
    fixed = (8, 10, True, False, False, False, False, 5.0, 1.0, 2.0, 3.0, None, "M1", "TF1", 4.5)
    assert rows(result) == [(*fixed, "p"), (*fixed, "q")]


def test_variant_query(spark, side):
    sites = site_rows(
        spark,
        [(8, 10, 1, "ct", (5.0, 1.0, 2.0, 3.0, 4.0)), (8, 10, 2, "a", (6.0, 7.0, 8.0, 9.0, 0.5))],
    )
    motifs = motif_rows(spark, (1, "M1", "TF1", 4.5), (2, "M2", "TF2", 1.5))
    variants = spark.createDataFrame(
        [(8, 10, "v1", "G", "c", False, True, False, False, "v1"),
         (8, 10, "v2", "G", "AC", False, False, False, False, "v2"),
         (9, 10, "v3", "G", "A", True, False, False, False, "v3")],
        "chromosome bigint, mutation_pos bigint, name string, reference string, alt string,"
        " use_a boolean, use_c boolean, use_g boolean, use_t boolean, vcf_name string",
    )
    result = annotate_variants(sites, motifs, variants)
    key = lambda r: (r[4], r[7])
    assert sorted((tuple(r) for r in result.collect()), key=key) == [
        (8, 10, "G", "c", "v1", 5.0, 2.0, "M1", "TF1", 4.5, "v1"),
        (8, 10, "G", "c", "v1", 6.0, 8.0, "M2", "TF2", 1.5, "v1"),
        (8, 10, "G", "AC", "v2", 5.0, None, "M1", "TF1", 4.5, "v2"),
        (8, 10, "G", "AC", "v2", 6.0, None, "M2", "TF2", 1.5, "v2"),
    ]
    gains = annotate_variants(sites, motifs, variants, only_gains=True)
    assert [(r.name, r.motif_id) for r in gains.collect()] == [("v1", "M1")]


def test_selection_query(spark):
    scores = (1.0, 2.0, 3.0, 4.0, 5.0)
    sites = site_rows(spark, [(1, p, 1 + p % 4, "w", scores) for p in range(12)])
    motifs = motif_rows(spark, *((n, f"M{n}", f"TF{n % 2}", 0.5) for n in (1, 2, 3, 4)))
    ids = spark.createDataFrame([(1,), (2,), (2,), (3,), (77,)], "pwmid bigint")
    names = spark.createDataFrame([("TF1",), ("TF1",), ("none",)], "tf_name string")
    expected = sorted((p, f"M{1 + p % 4}") for p in range(12) if 1 + p % 4 in (1, 3))
    for bound in ("1000000", "0"):
        spark.conf.set("spark.sitelens.broadcastBytes", bound)
        result = select_motifs(sites, motifs, ids, names)
        assert sorted((r.mutation_pos, r.motif_id) for r in result.collect()) == expected
    spark.conf.unset("spark.sitelens.broadcastBytes")
    nothing = select_motifs(sites, motifs, ids, names.where(F.lit(False)))
    assert nothing.count() == 0


def test_selection_prunes_directories(spark, tmp_path):
    scores = (1.0, 2.0, 3.0, 4.0, 5.0)
    sites = site_rows(spark, [(1, p, 1 + p % 4, "w", scores) for p in range(12)])
    sites.write.partitionBy("pwmid").parquet(str(tmp_path / "sites"))
    stored = spark.read.schema(SITES).parquet(str(tmp_path / "sites"))
    motifs = motif_rows(spark, *((n, f"M{n}", f"TF{n % 2}", 0.5) for n in (1, 2, 3, 4)))
    ids = spark.createDataFrame([(3,)], "pwmid bigint")
    names = spark.createDataFrame([("TF1",)], "tf_name string")
    plan = select_motifs(stored, motifs, ids, names)._jdf.queryExecution().executedPlan()
    filters = plan.toString().split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "dynamicpruning" in filters.lower()


def genome(spark, tmp_path):
    """Stored sites, and intervals on 24 chromosomes."""
    scores = (1.0, 2.0, 3.0, 4.0, 5.0)
    codes = [-1, -2, *range(1, 23)]
    sites = site_rows(spark, [(c, p, 1, "w", scores) for c in codes for p in range(0, 90_000, 9_000)])
    sites.write.parquet(str(tmp_path / "sites"))
    stored = spark.read.schema(SITES).parquet(str(tmp_path / "sites"))
    sample = [(c, 20_000 + 10 * abs(c), 40_000, "x") for c in codes]
    return stored, spark.createDataFrame(
        sample, "chromosome bigint, start bigint, stop bigint, bed_name string"
    )


def test_bounds_of_a_genome_reach_the_scan(spark, tmp_path):
    stored, sample = genome(spark, tmp_path)
    found = overlap_join(stored, sample)
    pushed = found._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    assert "Or(Or(Or(" in pushed
    assert found.count() == 24 * 2


def test_large_samples_thin_the_sites_first(spark, tmp_path):
    stored, sample = genome(spark, tmp_path)
    few = sorted(overlap_join(stored, sample).select("chromosome", "mutation_pos").collect())
    spark.conf.set("spark.sitelens.broadcastBytes", "3000")
    try:
        found = overlap_join(stored, sample)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        below = plan.split("SortMergeJoin")[1]
        assert "LeftSemi" in below
        assert sorted(found.select("chromosome", "mutation_pos").collect()) == few
        points = sample.select("chromosome", F.col("start").alias("mutation_pos"))
        assert position_join(stored, points).count() == 0
    finally:
        spark.conf.unset("spark.sitelens.broadcastBytes")


def test_a_long_interval_is_no_long_list(spark):
    one = spark.createDataFrame([(1, 1, 250_000_000, "x")], "chromosome bigint, start bigint, stop bigint, bed_name string")
    rows_ = explode_intervals(one)
    assert rows_.count() == 250_000_000
    assert rows_.agg(F.min("mutation_pos"), F.max("mutation_pos")).first()[:] == (1, 250_000_000)


def test_short_intervals_take_one_probe_of_each_site(spark, monkeypatch):
    from sitelens.operators import overlap

    asked = []
    plain = overlap.probes
    monkeypatch.setattr(overlap, "probes", lambda s, levels: asked.append(levels) or plain(s, levels))
    sites = spark.range(300).selectExpr("1L as chromosome", "id as mutation_pos")
    sample = spark.range(60).selectExpr(
        "1L as chromosome", "id * 5 as start", "id * 5 + id % 20 as stop", "string(id) as bed_name"
    )
    more = sample.union(spark.createDataFrame([(1, 100, 260, "long")], sample.schema))
    for intervals, levels in ((sample, (4,)), (more, (4, 8))):
        got = overlap.overlap_join(sites, intervals).select("mutation_pos", "bed_name").collect()
        want = [
            (p, r.bed_name) for r in intervals.collect() for p in range(r.start, min(r.stop, 299) + 1)
        ]
        assert sorted(map(tuple, got)) == sorted(want)
        assert asked.pop() == levels
