"""

Every query runs over whole given tables; ``sitelens.fixtures`` derives sites, motifs, samples and
fragments from them.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sitelens import fixtures as fx  # noqa: E402
from sitelens.functions.chromosome import (  # noqa: E402
    chromosome_from_file_name,
)
from sitelens.functions.pwm import log_odds, smooth  # noqa: E402
from sitelens.functions.sites import allele_flags  # noqa: E402
from sitelens.functions.sequence import code_text, reverse_complement  # noqa: E402
from sitelens.operators.row_id import with_row_id  # noqa: E402
from sitelens.operators.scan import scan_motifs, scan_tiles  # noqa: E402
from sitelens.operators.sizing import extents  # noqa: E402
from sitelens.operators.windows import (  # noqa: E402
    base_codes,
    substitutions,
    tiles_of,
    weighted_windows,
)
from sitelens.plans import intersect as plans  # noqa: E402
from sitelens.plans import tables  # noqa: E402
from sitelens.schemas import MOTIFS, SITES, STRAND_SCORES  # noqa: E402
from sitelens.session import scratch_path  # noqa: E402
from sitelens.sinks.tables import (  # noqa: E402
    append_sites,
    write_motifs,
    write_sites,
    write_sites_by_position,
)
from sitelens.sinks.text import preview, write_csv, write_hits  # noqa: E402
from sitelens.sources.hits import parse_hits, read_hits  # noqa: E402
from sitelens.sources.long_lines import read_fragment_tiles  # noqa: E402
from sitelens.sources.motif_info import parse_motif_info, read_motif_info  # noqa: E402
from sitelens.sources.samples import (  # noqa: E402
    parse_intervals,
    parse_selection,
    parse_variants,
)
from sitelens.sources.scan_inputs import (  # noqa: E402
    number_pwms,
    read_fragments,
    read_pwms,
    read_thresholds,
    with_motif_numbers,
)
from sitelens.sources.tables import load_tables, read_motifs, read_sites  # noqa: E402

try:  # the operators over training text may be taken out
    import corpus_pipeline  # noqa: E402
    from sitelens.llm import registry  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "sitelens.llm"):
        raise
    corpus_pipeline = registry = None

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def _sites(spark, d):
    return fx.derived(spark, d, "sites").select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in SITES.fields)
    )


def _motifs(spark, d):
    return fx.derived(spark, d, "motifs")


def _intervals(spark, d):
    return fx.derived(spark, d, "intervals")


def _variants(spark, d):
    flags = allele_flags(F.col("alt"))
    return fx.derived(spark, d, "variants").withColumns({**flags, "vcf_name": F.col("name")})


def _rounded(df, names, digits=3):
    """Round doubles, and turn a negative zero into zero."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in names})


def _saved_text(spark, lines, name):
    path = scratch_path(spark, name)
    lines.write.text(path)
    return path


# Site queries


@_query
def interval_intersect(spark, d):
    return plans.intersect_intervals(_sites(spark, d), _motifs(spark, d), _intervals(spark, d))


@_query
def interval_intersect_exploded(spark, d):
    return plans.intersect_positions(_sites(spark, d), _motifs(spark, d), _intervals(spark, d))


@_query
def interval_intersect_minimal(spark, d):
    return plans.intersect_minimal(_sites(spark, d), _intervals(spark, d))


@_query
def variant_annotate(spark, d):
    return plans.annotate_variants(_sites(spark, d), _motifs(spark, d), _variants(spark, d))


@_query
def variant_annotate_gains(spark, d):
    return plans.annotate_variants(
        _sites(spark, d), _motifs(spark, d), _variants(spark, d), only_gains=True
    )


@_query
def motif_selection(spark, d):
    ids, names = parse_selection(fx.selection_lines(spark, d))
    return plans.select_motifs(_sites(spark, d), _motifs(spark, d), ids, names)


@_query
def sample_dispatch_bed(spark, d):
    sample = _saved_text(spark, fx.interval_lines(spark, d, bad=False), "sample.bed")
    return plans.intersect(spark, _sites(spark, d), _motifs(spark, d), sample)


@_query
def sample_dispatch_vcf(spark, d):
    sample = _saved_text(spark, fx.variant_lines(spark, d), "sample.vcf")
    return plans.intersect(spark, _sites(spark, d), _motifs(spark, d), sample)


@_query
def sample_dispatch_ez(spark, d):
    sample = _saved_text(spark, fx.selection_lines(spark, d), "sample.ez")
    return plans.intersect(spark, _sites(spark, d), _motifs(spark, d), sample)


def _saved_samples(spark, lines, name):
    """Files of four samples, dealt by the lines' positions, in one pass."""
    folder = scratch_path(spark, "samples")
    n = F.split("value", r"\s+")[1].cast("bigint") % 4
    dealt = lines.withColumn("n", n).where(F.col("n").between(0, 3))
    dealt = dealt.select("value", F.concat("n", F.lit(f".{name}")).alias("file"))
    dealt.write.partitionBy("file").text(folder)
    made = {x.file for x in dealt.select("file").distinct().collect()}
    paths = {f"{x}.{name}": f"{folder}/file={x}.{name}" for x in range(4)}
    for missing in paths.keys() - made:
        spark.createDataFrame([], "value string").write.text(paths[missing])
    return list(paths.values())


@_query
def intersect_many_intervals(spark, d):
    """All sample files in one pass over the sites."""
    paths = _saved_samples(spark, fx.interval_lines(spark, d, bad=False), "bed")
    found = plans.intersect_samples(spark, _sites(spark, d), _motifs(spark, d), paths)[".bed"]
    return found.withColumn("sample", _sample_number())


@_query
def intersect_many_variants(spark, d):
    paths = _saved_samples(spark, fx.variant_lines(spark, d, bad=False), "vcf")
    found = plans.intersect_samples(spark, _sites(spark, d), _motifs(spark, d), paths)[".vcf"]
    return found.withColumn("sample", _sample_number())


def _sample_number():
    return F.regexp_extract("sample", "/file=([0-9])[.]", 1).cast("bigint")


# Parsers and readers


@_query
def parse_interval_lines(spark, d):
    return parse_intervals(fx.interval_lines(spark, d), n_cols=4)


@_query
def parse_variant_lines(spark, d):
    return parse_variants(fx.variant_lines(spark, d))


@_query
def parse_selection_ids(spark, d):
    return parse_selection(fx.selection_lines(spark, d))[0]


@_query
def parse_selection_names(spark, d):
    return parse_selection(fx.selection_lines(spark, d))[1]


@_query
def parse_motif_lines(spark, d):
    return parse_motif_info(fx.motif_lines(spark, d))


@_query
def parse_hit_lines(spark, d):
    return tables.sites_from_hits(parse_hits(fx.hit_lines(spark, d)))


@_query
def chromosome_from_file(spark, d):
    names = fx.load(spark, d, "orders").selectExpr(
        "o_orderkey",
        "concat('/data/chr', case o_custkey % 24 when 22 then 'X' when 23 then 'Y'"
        " else cast(o_custkey % 24 + 1 as string) end, '_', lpad(o_orderkey, 6, '0'), '.bed')"
        " as path",
    )
    return names.select("o_orderkey", chromosome_from_file_name(F.col("path")).alias("label"))


@_query
def read_motif_table(spark, d):
    """Metadata text to the numbered dimension, through the stored form.

    The text is written in order over many part files, so the file order gives the numbers back.
    """
    source = _saved_text(spark, fx.motif_lines(spark, d, bad=False), "motifs.csv")
    numbered = read_motif_info(spark, source)
    path = scratch_path(spark, "tf_info.pq")
    write_motifs(numbered, path)
    return read_motifs(spark, path)


@_query
def row_index(spark, d):
    parts = with_row_id(spark.read.parquet(f"{d}/part.parquet"))
    return parts.select("row_id", "p_partkey", "p_name")


def _fragment_file(spark, d):
    fragments = fx.derived(spark, d, "fragments").orderBy("chunk_id")
    lines = fragments.selectExpr(
        "case chromosome when -1 then 'chrX' when -2 then 'chrY' else concat('chr', chromosome) end"
        " as chrom",
        "start",
        *(f"'.' as f{n}" for n in range(3, 8)),
        "seq",
    )
    path = scratch_path(spark, "fragments.tsv")
    lines.write.option("header", True).option("sep", "\t").option("emptyValue", "").csv(path)
    return path


@_query
def read_fragment_file(spark, d):
    return read_fragments(spark, _fragment_file(spark, d))


@_query
def read_tiled_fragments(spark, d):
    tiles = read_fragment_tiles(spark, _fragment_file(spark, d), tile=256, split=1 << 20)
    return tiles.withColumn("tile", F.col("tile").cast("string"))


def _saved_thresholds(spark, d):
    path = scratch_path(spark, "thresholds.tsv")
    motifs = fx.nation_pwms(spark, d).groupBy("pwmid", "motif_file").agg(
        F.max("threshold").alias("threshold")
    )
    ordered = motifs.orderBy("pwmid").select("motif_file", "threshold")
    ordered.write.option("sep", "\t").csv(path)
    return path


@_query
def read_threshold_file(spark, d):
    return read_thresholds(spark, _saved_thresholds(spark, d))


def _saved_pwms(spark, d):
    """One directory per motif with a header line and numbered rows, as matrix files have them."""
    rows = (
        fx.nation_pwms(spark, d)
        .groupBy("motif_file", "i")
        .agg(F.array_sort(F.collect_list(F.struct("b", "p"))).alias("cells"))
        .select(
            "motif_file",
            F.col("i").alias("line"),
            F.concat_ws("\t", F.col("i") + 1, F.col("cells.p").cast("array<string>")).alias("value"),
        )
    )
    headers = rows.select("motif_file").distinct().select(
        "motif_file", F.lit(-1).alias("line"), F.lit("Pos\tA\tC\tG\tT").alias("value")
    )
    path = scratch_path(spark, "pwms")
    (
        rows.unionAll(headers)
        .repartition("motif_file")
        .sortWithinPartitions("motif_file", "line")
        .select("motif_file", "value")
        .write.partitionBy("motif_file")
        .text(path)
    )
    return path


@_query
def number_by_motif_table(spark, d):
    """Thresholds listed backwards, under the numbers that the motif table gives their files."""
    listed = (
        fx.nation_pwms(spark, d)
        .groupBy("motif_file", "threshold")
        .agg(F.max("pwmid").alias("n"))
        .orderBy(F.desc("n"))
        .select(F.concat_ws("\t", "motif_file", "threshold").alias("value"))
    )
    thresholds = read_thresholds(spark, _saved_text(spark, listed, "thresholds.tsv"))
    motifs = load_nation_motifs(spark, d)
    return with_motif_numbers(thresholds, motifs)


def load_nation_motifs(spark, d):
    """File names in the order of the nations' keys, as a motif table has them."""
    nations = fx.load(spark, d, "nation")
    return nations.selectExpr(
        "concat('nation', n_nationkey, '.txt') as file", "n_nationkey + 1 as row_id"
    )


@_query
def read_pwm_directory(spark, d):
    thresholds = read_thresholds(spark, _saved_thresholds(spark, d))
    name = F.regexp_extract(F.col("_metadata.file_path"), "motif_file=([^/]+)/", 1)
    cells = number_pwms(read_pwms(spark, _saved_pwms(spark, d), F.url_decode(name)), thresholds)
    return _rounded(cells, ["p"], 9)


# Stored tables and sinks


@_query
def write_read_sites(spark, d):
    path = scratch_path(spark, "tfbs.pq")
    write_sites(_sites(spark, d), path)
    return read_sites(spark, path)


@_query
def write_read_sites_by_position(spark, d):
    path = scratch_path(spark, "tfbs.pq")
    write_sites_by_position(_sites(spark, d), path)
    return read_sites(spark, path)


@_query
def interval_intersect_by_position(spark, d):
    """The interval query over sites that are stored by position."""
    path = scratch_path(spark, "tfbs.pq")
    write_sites_by_position(_sites(spark, d), path)
    return plans.intersect_intervals(read_sites(spark, path), _motifs(spark, d), _intervals(spark, d))


@_query
def written_site_figures(spark, d):
    """Rows and scores a motif, as a write of the sites measured them on its way."""
    written = write_sites(_sites(spark, d), scratch_path(spark, "tfbs.pq"))
    rows = [(m, n, written.rows, written.total_score) for m, n in written.by_motif.items()]
    columns = "pwmid long, n_rows long, all_rows long, total_score double"
    return _rounded(spark.createDataFrame(rows, columns), ["total_score"], 2)


@_query
def compact_scattered_sites(spark, d):
    """Motifs of many files are compacted in place; those of one file stay as they are."""
    path = scratch_path(spark, "tfbs.pq")
    sites = _sites(spark, d)
    write_sites(sites.where("pwmid % 2 = 0"), path)
    append_sites(sites.where("pwmid % 2 = 1 or pwmid is null").repartition(8), path)
    tables.compact_scattered(spark, path)
    return read_sites(spark, path)


@_query
def compact_site_table(spark, d):
    scattered, path = scratch_path(spark, "scattered.pq"), scratch_path(spark, "tfbs.pq")
    _sites(spark, d).write.parquet(scattered)
    tables.compact_sites(spark, scattered, path)
    return read_sites(spark, path)


@_query
def write_read_motifs(spark, d):
    path = scratch_path(spark, "tf_info.pq")
    write_motifs(_motifs(spark, d), path)
    return read_motifs(spark, path)


@_query
def build_site_tables(spark, d):
    """Text inputs to both stored tables, and the interval query on them."""
    hits = _saved_text(spark, fx.hit_lines(spark, d), "hits")
    motif_csv = _saved_text(spark, fx.motif_lines(spark, d), "motifs.csv")
    path = scratch_path(spark, "tables")
    tables.build_tables(spark, motif_csv, hits, path)
    sites, _ = load_tables(spark, path)
    return plans.intersect_minimal(sites, _intervals(spark, d))


@_query
def csv_round_trip(spark, d):
    result = interval_intersect(spark, d)
    path = scratch_path(spark, "result.csv")
    write_csv(result, path, partitions=4)
    return spark.read.csv(path, header=True, schema=result.schema)


@_query
def hit_text_round_trip(spark, d):
    hits = parse_hits(fx.hit_lines(spark, d))
    path = scratch_path(spark, "hits")
    write_hits(hits, path)
    return _rounded(read_hits(spark, path), STRAND_SCORES)


@_query
def preview_sites(spark, d):
    keys = ["mutation_pos", "chromosome", "pwmid", "wt_max_score", "chromosome_chunk"]
    ordered = _sites(spark, d).select(*keys).orderBy(*keys)
    return preview(ordered)


@_query
def site_counts(spark, d):
    return tables.table_counts(_sites(spark, d), _motifs(spark, d))


@_query
def score_sum(spark, d):
    return _rounded(tables.score_total(_sites(spark, d)), ["total_score"], 2)


@_query
def interval_extent(spark, d):
    return extents(_intervals(spark, d), "start", "stop")


@_query
def chromosome_filter(spark, d):
    return tables.on_chromosome(_sites(spark, d), -2)


# Scan


@_query
def encode_base_text(spark, d):
    fragments = fx.derived(spark, d, "fragments")
    return fragments.select("chunk_id", code_text(F.col("seq")).alias("codes"))


@_query
def encode_base_codes(spark, d):
    """Code arrays, folded to a number per fragment that depends on every code and its place."""
    codes = base_codes(fx.derived(spark, d, "fragments")).select(
        "chunk_id", "offset", F.posexplode("codes").alias("q", "code")
    )
    return codes.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("n_codes"),
        F.sum(F.col("code").cast("bigint") * (F.col("offset") + F.col("q") + 1)).alias("weighted"),
    )


@_query
def reverse_complement_text(spark, d):
    fragments = fx.derived(spark, d, "fragments")
    return fragments.select("chunk_id", reverse_complement(F.col("seq")).alias("reverse"))


@_query
def pwm_smooth(spark, d):
    return _rounded(smooth(fx.part_cells(spark, d)), ["p"], 9)


@_query
def pwm_logodds(spark, d):
    cells = smooth(fx.part_cells(spark, d))
    return _rounded(
        cells.select("pwmid", "i", "b", log_odds(F.col("p"), F.col("b")).alias("llr")), ["llr"], 9
    )


@_query
def kmer_windows(spark, d):
    return (
        weighted_windows(tiles_of(fx.derived(spark, d, "fragments")), 6)
        .groupBy("window")
        .agg(F.sum("weight").cast("bigint").alias("n_windows"))
    )


@_query
def window_substitutions(spark, d):
    counted = (
        weighted_windows(tiles_of(fx.derived(spark, d, "fragments")), 5)
        .groupBy("window")
        .agg(F.sum("weight").cast("bigint").alias("n_windows"))
    )
    return substitutions(counted)


@_query
def motif_scan(spark, d):
    hits = scan_motifs(fx.derived(spark, d, "fragments"), fx.nation_pwms(spark, d))
    return _rounded(hits, STRAND_SCORES)


@_query
def scan_tiled_fragments(spark, d):
    tiles = read_fragment_tiles(spark, _fragment_file(spark, d))
    return _rounded(scan_tiles(tiles, fx.nation_pwms(spark, d)), STRAND_SCORES)


@_query
def scan_then_annotate(spark, d):
    hits = scan_motifs(fx.derived(spark, d, "fragments"), fx.nation_pwms(spark, d))
    annotated = plans.annotate_variants(
        tables.sites_from_hits(hits), _motifs(spark, d), _variants(spark, d)
    )
    return _rounded(annotated, ["wt_max_score", "mutation_max_score"])


def entry(spark: SparkSession) -> DataFrame:
    """Sites inside intervals, with their motif."""
    return interval_intersect(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    if registry is None:
        return dict(_QUERIES)
    return {**_QUERIES, **registry.queries(), "pipeline": corpus_pipeline.run}


# Oracles

_T = {name: statement.format(all=", 'g'") for name, statement in fx.TABLES.items()}
_SITES = ", ".join(
    ["chromosome", "mutation_pos", "use_w", "use_a", "use_c", "use_g", "use_t", "wt_max_score"]
    + [f"{b}_mutation_max_score" for b in "acgt"]
)
_SITES_ALL = _SITES.replace("mutation_pos,", "mutation_pos, chromosome_chunk, pwmid,", 1)


def _with(*names: str) -> str:
    return "with " + ", ".join(f"{n} as ({_T[n]})" for n in names)


_INTERVALS = f"""{_with("sites", "motifs", "intervals")}
    select s.{_SITES.replace(", ", ", s.")}, m.motif_id, m.name, m.score_threshold, i.bed_name
    from sites s join intervals i on s.chromosome = i.chromosome
         and s.mutation_pos between i.start and i.stop
    join motifs m on s.pwmid = m.row_id"""

_ALLELE = """case upper(v.alt) when 'A' then s.a_mutation_max_score
    when 'C' then s.c_mutation_max_score when 'G' then s.g_mutation_max_score
    when 'T' then s.t_mutation_max_score end"""

_VARIANTS = f"""{_with("sites", "motifs", "variants")}
    select s.chromosome, s.mutation_pos, v.reference, v.alt, v.name, s.wt_max_score,
           {_ALLELE} as mutation_max_score, m.motif_id, m.name as tf_info_name,
           m.score_threshold, v.name as vcf_name
    from sites s join variants v on s.chromosome = v.chromosome and s.mutation_pos = v.mutation_pos
    join motifs m on s.pwmid = m.row_id"""

_GAINED = """ where case upper(v.alt) when 'A' then s.use_a when 'C' then s.use_c
    when 'G' then s.use_g when 'T' then s.use_t else false end"""

_SELECTION = f"""{_with("sites", "motifs")}
    select s.{_SITES.replace(", ", ", s.")}, m.motif_id, m.name, m.score_threshold
    from sites s join motifs m on s.pwmid = m.row_id
    where m.name in (select concat('TF', p_size) from part where p_type = 'SMALL')
      and m.row_id in (select p_size + 1 from part)"""

_MOTIF_COLUMNS = ", ".join(MOTIFS.names[:-1])

_HITS = """with hits as (
    select case when l_partkey % 26 < 22 then l_partkey % 26 + 1
                when l_partkey % 26 = 22 then -1 when l_partkey % 26 = 23 then -2 end as chromosome,
           l_orderkey as mutation_pos, l_partkey + 1 as chunk_id, l_suppkey + 1 as pwmid,
           l_orderkey % 16 as bits, l_quantity as wt_fwd, l_quantity - l_tax as wt_rev,
           l_quantity + l_tax as a_fwd, cast(null as double) as a_rev,
           l_discount as c_fwd, l_tax as c_rev,
           case when l_linenumber < 7 then l_quantity end as g_fwd, cast(null as double) as g_rev,
           cast(null as double) as t_fwd, cast(null as double) as t_rev
    from lineitem)"""

_CELLS = """cells as (
    select p_partkey + 1 as pwmid, cast(i as int) as i, cast(b as int) as b,
           ((p_partkey * 7 + i * 3 + b * b * 5) % 10 + p_partkey % 3) / 40.0::double as p
    from (select p_partkey, i, unnest([1, 2, 3, 4]) as b
          from (select p_partkey, unnest([0, 1, 2, 3, 4, 5]) as i from part)))"""

_SMOOTH = """smoothed as (
    select pwmid, i, b,
           case when min(p) over (partition by pwmid) = 0
                then (p + 0.001) / (sum(p) over (partition by pwmid, i) + 0.004) else p end as p
    from cells)"""

_PWMS = """raw as (
    select n_nationkey, i, b,
           cast(pow((n_nationkey * 7 + i * 3 + b * b * 3 + b * n_nationkey) % 10, 2) as double) as v
    from (select n_nationkey, i, unnest([1, 2, 3, 4]) as b
          from (select cast(n_nationkey as bigint) as n_nationkey,
                       unnest(range(0, n_nationkey % 2 + 6)) as i from nation))),
  pwms as (
    select n_nationkey + 1 as pwmid, cast(4.8125 + n_nationkey % 2 * 0.25 as double) as threshold,
           n_nationkey % 2 + 6 as k, cast(i as int) as i, cast(b as int) as b,
           v / sum(v) over (partition by n_nationkey, i) as p
    from raw)"""

_POSITIONS = f"""fragments as ({_T["fragments"]}),
  letters as (
    select chunk_id, length(seq) as len, unnest(range(1, length(seq) + 1)) as q,
           unnest(string_split(seq, '')) as letter
    from fragments where length(seq) > 0)"""


def _window_sql(k: int) -> str:
    """Windows with the number of reportable positions that each covers."""
    text = " || ".join(
        ["letter"] + [f"lead(letter, {j}) over (partition by chunk_id order by q)" for j in range(1, k)]
    )
    return f"""counted as (
    select w as "window", cast(sum(least(s + {k - 1}, len - 29) - greatest(s, 30) + 1) as bigint)
           as n_windows
    from (select len, q as s, upper({text}) as w from letters)
    where least(s + {k - 1}, len - 29) >= greatest(s, 30)
    group by all)"""


# The scan by way of word numbers: every word of a motif's length is scored once per motif, with
# and without a substitution; windows are then looked up by their number.
_SCAN = f"""with {_PWMS}, {_POSITIONS},
  llr as (
    select pwmid, threshold, k, i, b, ln(p / 0.25) as l
    from (select pwmid, threshold, k, i, b,
                 case when min(p) over (partition by pwmid) = 0
                      then (p + 0.001) / (sum(p) over (partition by pwmid, i) + 0.004)
                      else p end as p
          from pwms)),
  motif as (select distinct pwmid, threshold, k from llr),
  words as (
    select k, word, i, cast(word // cast(pow(4, k - 1 - i) as bigint) % 4 + 1 as int) as b
    from (select k, word, unnest(range(0, k)) as i
          from (select k, unnest(range(0, cast(pow(4, k) as bigint))) as word
                from (select distinct k from motif)))),
  plain as (
    select f.pwmid, f.k, f.threshold, w.word, sum(f.l order by w.i) as fwd,
           sum(r.l order by w.i) as rev
    from words w join llr f on f.k = w.k and f.i = w.i and f.b = w.b
    join llr r on r.pwmid = f.pwmid and r.i = w.k - 1 - w.i and r.b = 5 - w.b
    group by all),
  targets as (
    select k, word, place, old, base,
           word + (base - old) * cast(pow(4, k - 1 - place) as bigint) as target
    from (select k, word, i as place, b as old, unnest([1, 2, 3, 4]) as base from words)
    where base <> old),
  changed as (
    select n.pwmid, n.threshold, t.k, t.word, t.place, t.base, n.fwd, n.rev
    from targets t join plain n on n.k = t.k and n.word = t.target),
  useful as (
    select pwmid, k, word from plain where greatest(fwd, rev) > threshold
    union select pwmid, k, word from changed where greatest(fwd, rev) >= threshold),
  codes as (
    select chunk_id, len, q, nullif(strpos('acgt', letter), 0) - 1 as c from letters),
  seven as (
    select chunk_id, len, q, c, {
        " * 4 + ".join(["((((((c"] + [f"lead(c, {j}) over w)" for j in range(1, 6)])
    }) as six, lead(c, 6) over w as last
    from codes window w as (partition by chunk_id order by q)),
  wins as (
    select chunk_id, q as s, 6 as k, six as word from seven
    union all select chunk_id, q, 7, six * 4 + last from seven),
  spots as (
    select distinct chunk_id, pwmid, k, s + place as p
    from (select v.chunk_id, u.pwmid, v.k, v.s, unnest(range(0, v.k)) as place
          from wins v join useful u on u.k = v.k and u.word = v.word)),
  inside as (
    select t.chunk_id, t.pwmid, t.k, t.p, c.c + 1 as own
    from spots t join codes c on c.chunk_id = t.chunk_id and c.q = t.p
    where t.p >= 30 and t.p <= c.len - 29),
  reached as (
    select chunk_id, pwmid, k, p, own, place, p - place as s
    from (select *, unnest(range(0, k)) as place from inside)),
  covering as (
    select r.chunk_id, r.pwmid, r.p, r.own, r.place, v.word
    from reached r join wins v on v.chunk_id = r.chunk_id and v.k = r.k and v.s = r.s),
  wild as (
    select c.chunk_id, c.pwmid, c.p, any_value(c.own) as own,
           greatest(max(coalesce(n.fwd, 0)), -99999) as wt_fwd,
           greatest(max(coalesce(n.rev, 0)), -99999) as wt_rev
    from covering c left join plain n on n.pwmid = c.pwmid and n.word = c.word
    group by c.chunk_id, c.pwmid, c.p),
  mutated as (
    select c.chunk_id, c.pwmid, c.p, c.base,
           greatest(max(coalesce(n.fwd, 0)), -99999) as fwd,
           greatest(max(coalesce(n.rev, 0)), -99999) as rev
    from (select *, unnest([1, 2, 3, 4]) as base from covering) c
    left join changed n on n.pwmid = c.pwmid and n.word = c.word and n.place = c.place
         and n.base = c.base
    where c.base is distinct from c.own
    group by c.chunk_id, c.pwmid, c.p, c.base),
  judged as (
    select x.*, m.threshold, w.wt_fwd, w.wt_rev, greatest(x.fwd, x.rev) >= m.threshold as gains,
           greatest(w.wt_fwd, w.wt_rev) > m.threshold as passes
    from mutated x join wild w using (chunk_id, pwmid, p) join motif m using (pwmid)),
  hits as (
    select chunk_id, pwmid, p, any_value(wt_fwd) as wt_fwd, any_value(wt_rev) as wt_rev,
           sum(case when gains then cast(pow(10, base - 1) as bigint) else 0 end) as event,
           bool_or(passes) as passes, {
    ", ".join(
        f"max(case when base = {n} and (gains or passes) then {d} end) as {b}_{d}"
        for n, b in enumerate("acgt", start=1)
        for d in ("fwd", "rev")
    )
}
    from judged group by chunk_id, pwmid, p)"""

_HIT_ROWS = f"""select f.chromosome, f.start + h.p as mutation_pos, h.chunk_id, h.pwmid,
       cast(h.event as bigint) as event, {
    ", ".join(f"round(h.{c}, 3) + 0.0 as {c}" for c in STRAND_SCORES)
}
    from hits h join fragments f using (chunk_id) where h.event > 0 or h.passes"""


def oracle_sql() -> dict[str, str]:
    if registry is None:
        return _own_oracles()
    return {**_own_oracles(), **registry.oracle_sql()}


def _own_oracles() -> dict[str, str]:
    sites, intervals = _with("sites"), _with("intervals")
    site_rows = f"{sites} select {_SITES_ALL} from sites"
    interval_rows = f"{intervals} select chromosome, start, stop, bed_name from intervals"
    variant_rows = f"""{_with("variants")}
        select chromosome, mutation_pos, name, reference, alt, upper(alt) = 'A' as use_a,
               upper(alt) = 'C' as use_c, upper(alt) = 'G' as use_g, upper(alt) = 'T' as use_t,
               name as vcf_name from variants"""
    motif_rows = f"{_with('motifs')} select {_MOTIF_COLUMNS} from motifs"
    minimal = f"""select s.chromosome, s.pwmid, s.wt_max_score from sites s join intervals i
        on s.chromosome = i.chromosome and s.mutation_pos between i.start and i.stop"""
    hit_sites = """select chromosome, mutation_pos, chunk_id as chromosome_chunk, pwmid,
        bits = 0 as use_w, (bits & 1) > 0 as use_a, (bits & 2) > 0 as use_c,
        (bits & 4) > 0 as use_g, (bits & 8) > 0 as use_t,
        greatest(wt_fwd, wt_rev) as wt_max_score, greatest(a_fwd, a_rev) as a_mutation_max_score,
        greatest(c_fwd, c_rev) as c_mutation_max_score,
        greatest(g_fwd, g_rev) as g_mutation_max_score,
        greatest(t_fwd, t_rev) as t_mutation_max_score from hits"""
    return {
        "interval_intersect": _INTERVALS,
        "interval_intersect_exploded": _INTERVALS,
        "interval_intersect_minimal": f"{_with('sites', 'intervals')} {minimal}",
        "variant_annotate": _VARIANTS,
        "variant_annotate_gains": _VARIANTS + _GAINED,
        "motif_selection": _SELECTION,
        "sample_dispatch_bed": _INTERVALS,
        "sample_dispatch_vcf": _VARIANTS,
        "sample_dispatch_ez": _SELECTION,
        "parse_interval_lines": interval_rows,
        "parse_variant_lines": variant_rows,
        "parse_selection_ids": "select cast(p_size + 1 as bigint) as pwmid from part",
        "parse_selection_names": """select concat('TF', p_size) as tf_name from part
            where p_type = 'SMALL'""",
        "parse_motif_lines": motif_rows,
        "parse_hit_lines": f"{_HITS} {hit_sites}",
        "chromosome_from_file": """select o_orderkey, case o_custkey % 24 when 22 then 'X'
            when 23 then 'Y' else cast(o_custkey % 24 + 1 as varchar) end as label from orders""",
        "read_motif_table": f"{_with('motifs')} select {_MOTIF_COLUMNS}, row_id from motifs",
        "row_index": """select row_number() over (order by p_partkey) as row_id, p_partkey, p_name
            from part""",
        "read_fragment_file": f"""{_with("fragments")}
            select chunk_id, chromosome, start, seq from fragments""",
        "read_tiled_fragments": f"""{_with("fragments")}, placed as (
                select *, unnest(range(0, length(seq) - 58, 256)) as place from fragments)
            select chunk_id, chromosome, start, place as "offset",
                substr(seq, place + 1, 314) as tile from placed""",
        "read_threshold_file": f"""with {_PWMS}
            select distinct pwmid, concat('nation', pwmid - 1, '.txt') as motif_file, threshold
            from pwms""",
        "number_by_motif_table": f"""with {_PWMS}
            select distinct pwmid, concat('nation', pwmid - 1, '.txt') as motif_file, threshold
            from pwms""",
        "read_pwm_directory": f"""with {_PWMS}
            select pwmid, threshold, i, b, round(p, 9) + 0.0 as p from pwms""",
        "write_read_sites": site_rows,
        "write_read_sites_by_position": site_rows,
        "compact_scattered_sites": site_rows,
        "interval_intersect_by_position": _INTERVALS,
        "intersect_many_intervals": _INTERVALS.replace("i.bed_name", "i.bed_name, i.start % 4 as sample"),
        "intersect_many_variants": _VARIANTS.replace(
            "as vcf_name", "as vcf_name, v.mutation_pos % 4 as sample"
        ),
        "written_site_figures": f"""{sites}
            select pwmid, count(*) as n_rows, cast(sum(count(*)) over () as bigint) as all_rows,
                   round(sum(sum(wt_max_score)) over (), 2) + 0.0 as total_score
            from sites group by pwmid""",
        "compact_site_table": site_rows,
        "write_read_motifs": f"{_with('motifs')} select {_MOTIF_COLUMNS}, row_id from motifs",
        "build_site_tables": f"{_HITS}, sites as ({hit_sites}), intervals as ({_T['intervals']})"
        f" {minimal}",
        "csv_round_trip": _INTERVALS,
        "hit_text_round_trip": f"""{_HITS}
            select chromosome, mutation_pos, chunk_id, pwmid,
                   (bits & 1) + (bits >> 1 & 1) * 10 + (bits >> 2 & 1) * 100
                   + (bits >> 3 & 1) * 1000 as event,
                   {", ".join(f"round({c}, 3) + 0.0 as {c}" for c in STRAND_SCORES)} from hits""",
        "preview_sites": f"""{sites}
            select mutation_pos, chromosome, pwmid, wt_max_score, chromosome_chunk from sites
            order by all limit 20""",
        "site_counts": f"""{_with("sites", "motifs")}
            select 'tf_info' as table_name, count(*) as n_rows from motifs
            union all select 'tfbs', count(*) from sites""",
        "score_sum": f"{sites} select round(sum(wt_max_score), 2) + 0.0 as total_score from sites",
        "interval_extent": f"""{intervals}
            select chromosome, min(start) as start_pos, max(stop) as stop_pos from intervals
            group by chromosome""",
        "chromosome_filter": f"{sites} select {_SITES_ALL} from sites where chromosome = -2",
        "encode_base_text": f"""{_with("fragments")}
            select chunk_id, translate(seq, 'acgtn', '12340') as codes from fragments""",
        "encode_base_codes": f"""with {_POSITIONS}
            select chunk_id, count(*) as n_codes,
                   cast(sum(q * strpos('acgt', letter)) as bigint) as weighted
            from letters group by chunk_id""",
        "reverse_complement_text": f"""{_with("fragments")}
            select chunk_id, reverse(translate(seq, 'acgt', 'tgca')) as "reverse"
            from fragments""",
        "pwm_smooth": f"""with {_CELLS}, {_SMOOTH}
            select pwmid, i, b, round(p, 9) + 0.0 as p from smoothed""",
        "pwm_logodds": f"""with {_CELLS}, {_SMOOTH}
            select pwmid, i, b, round(ln(p / 0.25), 9) + 0.0 as llr from smoothed""",
        "kmer_windows": f"with {_POSITIONS}, {_window_sql(6)} select * from counted",
        "window_substitutions": f"""with {_POSITIONS}, {_window_sql(5)}
            select "window", n_windows, place, base, forward,
                   reverse(translate(forward, 'ACGT', 'TGCA')) as "reverse"
            from (select "window", n_windows, cast(place as int) as place, base,
                         substr("window", 1, place) || base || substr("window", place + 2)
                         as forward
                  from (select *, unnest(['A', 'C', 'G', 'T']) as base
                        from (select *, unnest(range(0, 5)) as place from counted
                              where "window" not like '%N%')))""",
        "motif_scan": f"{_SCAN} {_HIT_ROWS}",
        "scan_tiled_fragments": f"{_SCAN} {_HIT_ROWS}",
        "scan_then_annotate": f"""{_SCAN}, motifs as ({_T["motifs"]}),
            variants as ({_T["variants"]}), found as ({_HIT_ROWS}),
            sites as (select chromosome, mutation_pos, pwmid,
                greatest(wt_fwd, wt_rev) as wt_max_score,
                greatest(a_fwd, a_rev) as a_mutation_max_score,
                greatest(c_fwd, c_rev) as c_mutation_max_score,
                greatest(g_fwd, g_rev) as g_mutation_max_score,
                greatest(t_fwd, t_rev) as t_mutation_max_score from found)
            {_VARIANTS[_VARIANTS.index("select s.chromosome, s.mutation_pos, v.reference") :]}""",
    }
