import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from sitelens import cli
from sitelens.operators.windows import positions, substitutions, tiles_of, windows
from sitelens.plans.intersect import intersect, intersect_minimal, intersect_samples
from sitelens.plans.tables import (
    compact_scattered,
    compact_sites,
    scattered_motifs,
    score_total,
    table_counts,
)
from sitelens.schemas import SITES
from sitelens.session import scratch_path
from sitelens.sinks.tables import (
    ROW_BYTES,
    append_sites,
    write_motifs,
    write_sites,
    write_sites_by_position,
)
from sitelens.sinks.text import preview, write_csv
from sitelens.sources.tables import read_motifs, read_sites


def many_sites(spark, n=6000):
    """A third and more of the rows belong to motif 1."""
    p = F.col("id")
    row = spark.range(n).select(
        (p % 3 + 1).alias("chromosome"),
        (n - p).alias("mutation_pos"),
        p.alias("chromosome_chunk"),
        F.when(p % 5 < 2, 1).otherwise(p % 7).cast("bigint").alias("pwmid"),
        *((p % k == 0).alias(c) for k, c in enumerate(SITES.names[4:9], start=2)),
        *((p / k).alias(c) for k, c in enumerate(SITES.names[9:], start=2)),
    )
    return row


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_sites_are_stored_by_motif_in_order(spark, tmp_path):
    path = str(tmp_path / "tfbs.pq")
    sites = many_sites(spark)
    write_sites(sites, path)
    assert sorted(d for d in os.listdir(path) if "=" in d) == [f"pwmid={n}" for n in range(7)]
    stored = read_sites(spark, path)
    assert stored.schema == SITES
    assert rows(stored) == rows(sites)
    for directory in os.listdir(path):
        if "=" in directory:
            for name in os.listdir(os.path.join(path, directory)):
                if name.endswith(".parquet"):
                    one = spark.read.parquet(os.path.join(path, directory, name)).coalesce(1)
                    keys = [r[:2] for r in one.select("chromosome", "mutation_pos").collect()]
                    assert keys == sorted(keys)


def test_a_hot_motif_is_split(spark, tmp_path):
    path = str(tmp_path / "tfbs.pq")
    sites = many_sites(spark, 40_000).repartition(8)
    write_sites(sites, path, target_bytes=100_000)
    files = [f for f in os.listdir(f"{path}/pwmid=1") if f.endswith(".parquet")]
    assert len(files) > 1
    assert read_sites(spark, path).count() == 40_000


def test_files_follow_sizes(spark, tmp_path):
    """More motifs than reducers, and a table far above the target."""
    path = str(tmp_path / "tfbs.pq")
    sites = many_sites(spark, 30_000).withColumn(
        "pwmid", F.when(F.col("mutation_pos") % 3 == 0, 0).otherwise(F.col("mutation_pos") % 100)
    )
    target = 100_000
    write_sites(sites, path, target_bytes=target)
    for r in sites.groupBy("pwmid").count().collect():
        files = [f for f in os.listdir(f"{path}/pwmid={r.pwmid}") if f.endswith(".parquet")]
        assert len(files) == -(-r["count"] * ROW_BYTES // target)
    assert rows(read_sites(spark, path)) == rows(sites.select(*SITES.names))


def test_compaction_leaves_one_file_per_motif(spark, tmp_path):
    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    sites = many_sites(spark)
    sites.repartition(6).write.partitionBy("pwmid").parquet(source)
    compact_sites(spark, source, target)
    for n in range(7):
        files = [f for f in os.listdir(f"{target}/pwmid={n}") if f.endswith(".parquet")]
        assert len(files) == 1
    assert rows(read_sites(spark, target)) == rows(sites)


def test_writers_restore_the_session(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    write_sites(many_sites(spark, 10), str(tmp_path / "a"))
    assert spark.conf.get(key) == before


def test_csv_parts_have_headers(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    write_csv(spark.range(100).repartition(3), path, partitions=5)
    parts = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(parts) == 5
    assert all(open(os.path.join(path, f)).readline() == "id\n" for f in parts)


def test_counts_and_preview(spark):
    counts = table_counts(many_sites(spark, 50), spark.range(3))
    assert rows(counts) == [("tf_info", 3), ("tfbs", 50)]
    assert preview(spark.range(100)).count() == 20


def session_with(master, **settings):
    context = SimpleNamespace(
        master=master,
        getConf=lambda: SimpleNamespace(get=lambda key: settings.get(key.replace(".", "_"))),
        getCheckpointDir=lambda: None,
    )
    return SimpleNamespace(sparkContext=context)


def test_scratch_is_the_shared_folder_of_the_session(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    cluster = session_with("yarn", spark_checkpoint_dir="hdfs://h/shared")
    assert scratch_path(cluster, "x").startswith("hdfs://h/shared/sitelens-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session_with("yarn"), "x")


@pytest.mark.parametrize("tile", [1, 2, 100])
def test_window_rows(spark, tile):
    seq = "A" * 29 + "CGN" + "T" * 29
    fragments = spark.createDataFrame([(1, seq), (2, "A" * 58)], "chunk_id bigint, seq string")
    tiles = tiles_of(fragments, tile)
    assert tiles.count() == -(-3 // tile)
    places = positions(tiles).selectExpr("chunk_id", "offset + p")
    assert rows(places) == [(1, 30), (1, 31), (1, 32)]
    got = rows(windows(tiles, 2))
    assert got == [
        (1, p, s, seq[s - 1 : s + 1]) for p in (30, 31, 32) for s in (p - 1, p)
    ]
    changed = substitutions(windows(tiles, 2).where("p = 30 and s = 30"))
    assert rows(changed.select("place", "base", "forward", "reverse")) == sorted(
        (place, b, w, w[::-1].translate(str.maketrans("ACGT", "TGCA")))
        for place in (0, 1)
        for b in "ACGT"
        for w in ["CG"[:place] + b + "CG"[place + 1 :]]
    )
    assert substitutions(windows(tiles, 2).where("p = 32")).count() == 0


def test_unknown_sample_kind(spark):
    with pytest.raises(ValueError, match="'.txt'"):
        intersect(spark, None, None, "/data/sample.txt")


def test_command_line_from_fragments_to_results(spark, tmp_path, monkeypatch):
    """Scan, build, compact, and all three sample kinds, on files as users have them."""
    monkeypatch.setattr("pyspark.sql.SparkSession.Builder.getOrCreate", lambda self: spark)
    flank = "T" * 29
    (tmp_path / "fragments.tsv").write_text(
        "chrom\tstart\ta\tb\tc\td\te\tseq\n"
        + f"chrX\t1000\t.\t.\t.\t.\t.\t{flank}TACTG{flank}\n"
        + f"chr8\t2000\t.\t.\t.\t.\t.\t{flank}TACGN{flank}\n"
    )
    (tmp_path / "thresholds.tsv").write_text("M1.txt\t9.0\nM2.txt\t2.0\n")
    (tmp_path / "pwms").mkdir()
    matrix = "Pos\tA\tC\tG\tT\n1\t.7\t.1\t.1\t.1\n2\t.1\t.7\t.1\t.1\n3\t.1\t.1\t.7\t.1\n"
    for name in ("M1.txt", "M2.txt"):
        (tmp_path / "pwms" / name).write_text(matrix)
    (tmp_path / "motifs.csv").write_text(
        "Motif_ID,TF\n"
        + "".join(f"M{n},TF{n},s,D,f,d,t,i,y,a,{n},M{n}.txt,{n}.0\n" for n in (1, 2))
    )
    run = lambda command, **options: cli.main(
        [command] + [x for k, v in options.items() for x in (f"--{k}", str(tmp_path / v))]
    )
    run("scan", fragments="fragments.tsv", thresholds="thresholds.tsv", pwms="pwms", output="hits")
    hits = sorted(r.value for r in spark.read.text(str(tmp_path / "hits")).collect())
    assert hits[-1] == (
        "X 1033 1034 1 2 110 1.143 1.143 NaN NaN 1.143 3.089 3.089 1.143 NaN NaN"
    )
    assert [h.split()[:6] for h in hits[:-1]] == [
        ["8", str(p), str(p + 1), "2", "2", "0"] for p in (2031, 2032, 2033)
    ]
    run("build", motifs="motifs.csv", hits="hits", output="db")
    run("compact", source="db/tfbs.pq", output="compacted/tfbs.pq")
    motifs = read_motifs(spark, str(tmp_path / "db/tf_info.pq"))
    assert [r.row_id for r in motifs.orderBy("row_id").collect()] == [1, 2]
    write_motifs(motifs, str(tmp_path / "compacted/tf_info.pq"))
    run("count", tables="compacted")
    (tmp_path / "s.bed").write_text("chrX 1030 1033 peak\n8 2032 2032 other\n")
    (tmp_path / "s.vcf").write_text("#c\nX\t1033\trs1\tT\tg\n")
    (tmp_path / "s.ez").write_text("id,name\n2,TF2\n1\n")
    expected = {
        "bed": {("-1", "1033", "peak"), ("8", "2032", "other")},
        "vcf": {("-1", "1033", "rs1")},
        "ez": {("-1", "1033", None), *(("8", str(p), None) for p in (2031, 2032, 2033))},
    }
    for kind, wanted in expected.items():
        run("intersect", tables="compacted", sample=f"s.{kind}", output=f"{kind}.csv")
        got = spark.read.csv(str(tmp_path / f"{kind}.csv"), header=True).collect()
        last = {"bed": "bed_name", "vcf": "vcf_name"}.get(kind)
        assert {(r.chromosome, r.mutation_pos, r[last] if last else None) for r in got} == wanted
        if kind == "vcf":
            assert (got[0].mutation_max_score, got[0].tf_info_name) == ("3.089", "TF2")
    views = {t.name for t in spark.catalog.listTables()}
    assert {"tfbs", "tf_info", "bed", "vcf", "pwmid", "tf_name"} <= views


def scan_figures(df):
    """Files that a query's scan of sites opens and rows that come out of it."""
    execution = df._jdf.queryExecution()
    df._jdf.rdd().count()
    found, todo = [], [execution.executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getName()
        if "AdaptiveSparkPlanExec" in kind:
            todo.append(node.executedPlan())
        elif "QueryStageExec" in kind:
            todo.append(node.plan())
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
        if "FileSourceScanExec" in kind:
            metrics = node.metrics()
            found.append(tuple(metrics.apply(k).value() for k in ("numFiles", "numOutputRows")))
    return found


def test_sites_by_position_are_read_in_part(spark, tmp_path):
    sites = many_sites(spark, 60_000).repartition(6)
    by_motif, by_position = str(tmp_path / "m.pq"), str(tmp_path / "p.pq")
    write_sites(sites, by_motif)
    written = write_sites_by_position(sites, by_position, target_bytes=400_000)
    assert written.rows == 60_000 and sum(written.by_motif.values()) == 60_000
    stored = read_sites(spark, by_position)
    assert stored.schema == SITES
    assert rows(stored) == rows(sites)
    sample = spark.createDataFrame(
        [(2, 100, 130, "a"), (2, 59_000, 59_010, "b")], "chromosome long, start long, stop long, bed_name string"
    )
    results, figures = [], []
    for path in (by_motif, by_position):
        found = intersect_minimal(read_sites(spark, path), sample)
        results.append(rows(found))
        figures.append(scan_figures(found))
    assert results[0] == results[1] and len(results[0]) == 14
    (motif_files, motif_rows_), (position_files, position_rows) = figures[0][0], figures[1][0]
    every = sum(name.endswith(".parquet") for _, _, names in os.walk(by_position) for name in names)
    assert motif_files == 7 and position_files <= every // 2
    assert 3 * position_rows < motif_rows_


def test_a_hot_position_is_cut(spark, tmp_path):
    path = str(tmp_path / "p.pq")
    sites = many_sites(spark, 20_000).withColumn(
        "mutation_pos", F.when(F.col("pwmid") < 4, 7).otherwise(F.col("mutation_pos")).cast("long")
    ).withColumn("chromosome", F.when(F.col("pwmid") == 5, None).otherwise(2).cast("long"))
    write_sites_by_position(sites, path, target_bytes=200_000)
    assert rows(read_sites(spark, path).fillna(0)) == rows(sites.fillna(0))
    largest = spark.read.parquet(path).groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0]
    assert largest < 6_000


def test_a_write_measures_what_it_wrote(spark, tmp_path):
    sites = many_sites(spark)
    written = write_sites(sites, str(tmp_path / "tfbs.pq"))
    stored = read_sites(spark, str(tmp_path / "tfbs.pq"))
    assert written.rows == stored.count()
    assert written.total_score == pytest.approx(score_total(stored).first()[0])
    assert written.by_motif == {r.pwmid: r["count"] for r in stored.groupBy("pwmid").count().collect()}
    nothing = write_sites(sites.limit(0), str(tmp_path / "none.pq"))
    assert (nothing.rows, nothing.by_motif) == (0, {})


def listing(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


def test_only_scattered_motifs_are_compacted(spark, tmp_path):
    path = str(tmp_path / "tfbs.pq")
    sites = many_sites(spark).withColumn(
        "pwmid", F.when(F.col("pwmid") == 6, None).otherwise(F.col("pwmid"))
    )
    write_sites(sites.where("pwmid < 4"), path)
    loose = sites.where("pwmid >= 4 or pwmid is null").repartition(5)
    loose.write.mode("append").partitionBy("pwmid").parquet(path)
    before = listing(path)
    assert sorted(str(r.pwmid) for r in scattered_motifs(spark, path).collect()) == ["4", "5", "None"]
    written = compact_scattered(spark, path)
    assert sorted(map(str, written.by_motif)) == ["4", "5", "None"]
    after = listing(path)
    kept = {f for f in before if any(f"pwmid={n}/" in f for n in range(4))}
    assert {f: before[f] for f in kept} == {f: after[f] for f in kept}
    assert len(after) == len(kept) + 3
    assert rows(read_sites(spark, path).fillna(-1)) == rows(sites.fillna(-1))
    # nothing is left to do
    assert compact_scattered(spark, path) is None
    assert listing(path) == after


def test_many_samples_in_one_pass(spark, tmp_path):
    sites_path = str(tmp_path / "tfbs.pq")
    write_sites(many_sites(spark), sites_path)
    sites = read_sites(spark, sites_path)
    motifs = spark.createDataFrame(
        [(n, f"M{n}", f"TF{n}", 1.5) for n in range(7)],
        "row_id long, motif_id string, name string, score_threshold double",
    )
    beds, vcfs = [], []
    for n in range(50):
        beds.append(tmp_path / f"s{n}.bed")
        # files of three and of four columns: each file's first line says which lines count
        extra = " name" if n % 2 else ""
        beds[-1].write_text(f"chr{n % 3 + 1}\t{100 * n} {100 * n + 40}{extra}\nchr1 5\nchr2\t7 9{extra}\n")
        vcfs.append(tmp_path / f"s{n}.vcf")
        vcfs[-1].write_text(f"#x\nchr{n % 3 + 1}\t{100 * n + 1}\tv{n}\tA\tC\n")
    found = intersect_samples(spark, sites, motifs, [str(p) for p in beds + vcfs])
    for kind, files in ((".bed", beds), (".vcf", vcfs)):
        got = sorted((os.path.basename(r.sample), *r[:-1]) for r in found[kind].collect())
        # eight of them one by one
        some = files[:8]
        each = [(p.name, *r) for p in some for r in intersect(spark, sites, motifs, str(p)).collect()]
        assert [g for g in got if g[0] in {p.name for p in some}] == sorted(each) and each
        assert len({g[0] for g in got}) > 15
        plan = found[kind]._jdf.queryExecution().executedPlan().toString()
        assert plan.split("Initial Plan")[0].count("tfbs.pq") == 1
    write_csv(found[".bed"], str(tmp_path / "out"), by=["sample"])
    assert any(d.startswith("sample=") and d.endswith(".bed") for d in os.listdir(tmp_path / "out"))
    with pytest.raises(ValueError, match="common pass"):
        intersect_samples(spark, sites, motifs, ["x.ez"])


def test_numbers_of_parquet_rows_need_no_copy(spark, tmp_path):
    from sitelens.operators import row_id

    path = str(tmp_path / "rows")
    wide = spark.range(5000).select("id", F.repeat(F.lit("x"), 500).alias("text"))
    wide.repartitionByRange(7, "id").write.option("parquet.block.size", 50_000).parquet(path)
    copies = []
    plain, row_id.scratch_path = row_id.scratch_path, lambda s, n: copies.append(n) or plain(s, n)
    try:
        numbered = row_id.with_row_id(spark.read.parquet(path))
    finally:
        row_id.scratch_path = plain
    assert copies == ["split-sizes"]
    # splits of another size change nothing
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = sorted((r.row_id, r.id) for r in numbered.select("row_id", "id").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(n + 1, n) for n in range(5000)]
    filtered = row_id.with_row_id(spark.read.parquet(path).where("id % 2 = 1"))
    assert sorted(r.row_id for r in filtered.collect()) == list(range(1, 2501))


def test_many_motifs_share_directories(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("sitelens.sinks.tables.MOTIF_DIRECTORIES", 50)
    monkeypatch.setattr("sitelens.sinks.tables.SHARED_DIRECTORIES", 8)
    path = str(tmp_path / "tfbs.pq")
    motif = F.when(F.col("mutation_pos") % 300 == 0, None).otherwise(F.col("mutation_pos") % 300)
    sites = many_sites(spark).withColumn("pwmid", motif.cast("long"))
    first = sites.where("pwmid % 2 = 0 or pwmid is null")
    written = write_sites(first, path)
    assert len(written.by_motif) == 150
    made = [d for d in os.listdir(path) if "=" in d]
    assert 8 <= len(made) <= 12 and all(d.startswith("first_pwmid=") for d in made)
    assert rows(read_sites(spark, path).fillna(-1)) == rows(first.select(*SITES.names).fillna(-1))
    # rows added in small files join the directories that are there, and are compacted with them
    append_sites(sites.where("pwmid % 2 = 1 and pwmid < 200").repartition(5), path)
    before = listing(path)
    compact_scattered(spark, path)
    after = listing(path)
    kept = {f for f in before if f in after}
    assert kept and len(after) == len(made) and {f: after[f] for f in kept} == {f: before[f] for f in kept}
    wanted = sites.where("pwmid % 2 = 0 or pwmid < 200 or pwmid is null").select(*SITES.names)
    assert rows(read_sites(spark, path).fillna(-1)) == rows(wanted.fillna(-1))
    for name in after:
        one = spark.read.parquet(name).coalesce(1).select("pwmid", "chromosome", "mutation_pos")
        keys = [tuple(r) for r in one.fillna(-1).collect()]
        assert keys == sorted(keys)
    assert compact_scattered(spark, path) is None


def test_samples_are_parsed_once(spark, tmp_path):
    sites = many_sites(spark)
    motifs = spark.createDataFrame(
        [(n, f"M{n}", f"TF{n}", 1.5) for n in range(7)],
        "row_id long, motif_id string, name string, score_threshold double",
    )
    bed, vcf = tmp_path / "a.bed", tmp_path / "a.vcf"
    bed.write_text("chr1\t100 140\nchr1 5\nchr2\t7 9\n")
    vcf.write_text("#x\nchr1\t102\tv1\tA\tC\n")
    found = intersect_samples(spark, sites, motifs, [str(bed), str(vcf)])
    single = [intersect(spark, sites, motifs, str(x)) for x in (bed, vcf)]
    for one, many in zip(single, found.values(), strict=True):
        assert one.count() == many.count() > 0
        for df in (one, many):
            assert "FileScan text" not in df._jdf.queryExecution().executedPlan().toString()
