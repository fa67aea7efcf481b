"""Inputs of the registered queries, derived from the given tables as wholes.

Statements in ``TABLES`` run in Spark and in the SQL oracle alike; ``{all}`` is the oracle's extra
argument for replacing every match. Text lines are made in Spark only: the oracle states what the
parsed lines must give.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _code(key):
    return f"case {key} % 24 when 22 then -1 when 23 then -2 else {key} % 24 + 1 end"


def _label(key):
    return f"case {key} % 24 when 22 then 'X' when 23 then 'chrY' else concat('chr', cast({key} % 24 + 1 as string)) end"


_BITS = "(l_orderkey + l_linenumber)"

TABLES = {
    "sites": f"""
        select {_code("l_partkey")} as chromosome, l_orderkey as mutation_pos,
               l_partkey + 1 as chromosome_chunk, l_suppkey + 1 as pwmid,
               {_BITS} % 16 = 0 as use_w,
               ({_BITS} & 1) > 0 as use_a, ({_BITS} & 2) > 0 as use_c,
               ({_BITS} & 4) > 0 as use_g, ({_BITS} & 8) > 0 as use_t,
               l_quantity as wt_max_score,
               l_quantity + l_tax as a_mutation_max_score,
               l_quantity - l_tax as c_mutation_max_score,
               l_quantity + l_discount as g_mutation_max_score,
               case when l_linenumber < 7 then l_quantity - l_discount end as t_mutation_max_score
        from lineitem""",
    "motifs": """
        select concat('M', cast(s_suppkey as string)) as motif_id,
               concat('TF', cast(s_nationkey as string)) as name,
               'species' as species, 'D' as status,
               concat('family', cast(s_nationkey % 5 as string)) as family_name, 'dbd' as dbd,
               'PBM' as motif_type, s_name as msource_identifier, 'source' as msource_type,
               'author' as msource_author, s_suppkey * 3 as pmid,
               concat(s_name, '.txt') as file, s_acctbal as score_threshold,
               s_suppkey + 1 as row_id
        from supplier""",
    "intervals": f"""
        select {_code("o_custkey")} as chromosome, o_orderkey as start,
               o_orderkey + o_custkey % 20 as stop, replace(o_orderpriority, ' ', '_') as bed_name
        from orders""",
    "variants": f"""
        select {_code("user_id")} as chromosome, event_id as mutation_pos,
               concat('v', cast(event_id as string)) as name,
               substr('ACGT', cast(event_id % 4 + 1 as int), 1) as reference,
               case when event_id % 10 = 0 then 'A,C'
                    else substr('acgt', cast((event_id + 1) % 4 + 1 as int), 1) end as alt
        from events""",
    "fragments": f"""
        select doc_id + 1 as chunk_id, {_code("doc_id")} as chromosome,
               cast(floor(doc_id / 24) as bigint) * 250 as start,
               translate(lower(regexp_replace(text, '[^A-Za-z]', 'z'{{all}})),
                         'abcdefghijklmnopqrstuvwxyz', 'acgtacgtacgtacgtacgtacgtan') as seq
        from documents""",
}

# Lines that the parsers must drop, as users' files have them.
BAD_INTERVALS = ["track name=peaks", "chr1 5", ""]
BAD_VARIANTS = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT", ""]
BAD_SELECTIONS = ["pwmid, tf_name", "1,TF1,more", "x,TF2", ""]
BAD_MOTIFS = ["Motif_ID,Name,Species", ""]
BAD_HITS = ["", "  "]


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of ``TABLES`` over the given files."""
    statement = TABLES[name].format(all="")
    table = statement.rsplit("from ", 1)[1].strip()
    return spark.sql(
        statement.replace(f"from {table}", "from {source}"), source=load(spark, sf_dir, table)
    )


def _with_lines(lines: DataFrame, extra: list[str]) -> DataFrame:
    spark = lines.sparkSession
    return lines.unionAll(spark.createDataFrame([(x,) for x in extra], "value string"))


def interval_lines(spark, sf_dir, bad=True):
    lines = load(spark, sf_dir, "orders").selectExpr(
        f"concat({_label('o_custkey')}, '\t', o_orderkey, ' ', o_orderkey + o_custkey % 20, ' ',"
        " replace(o_orderpriority, ' ', '_')) as value"
    )
    return _with_lines(lines, BAD_INTERVALS) if bad else lines


def variant_lines(spark, sf_dir, bad=True):
    lines = derived(spark, sf_dir, "variants").selectExpr(
        "concat_ws('\t', case chromosome when -1 then 'chrX' when -2 then 'Y'"
        " else cast(chromosome as string) end, mutation_pos, name, reference, concat(alt, ' '),"
        " '.', 'PASS') as value"
    )
    return _with_lines(lines, BAD_VARIANTS) if bad else lines


def selection_lines(spark, sf_dir, bad=True):
    """Every part selects a motif number; small parts also name a factor."""
    lines = load(spark, sf_dir, "part").selectExpr(
        "concat(p_size + 1, case p_type when 'SMALL' then concat(', TF', p_size) else '' end)"
        " as value"
    )
    return _with_lines(lines, BAD_SELECTIONS) if bad else lines


def motif_lines(spark, sf_dir, bad=True):
    """Metadata lines in the order of the motif numbers."""
    columns = derived(spark, sf_dir, "motifs").orderBy("row_id").drop("row_id")
    lines = columns.select(F.concat_ws(",", *columns.columns).alias("value"))
    return _with_lines(lines, BAD_MOTIFS) if bad else lines


def hit_lines(spark, sf_dir):
    """Hits from line items: X and Y by label, unknown labels too, ``NaN`` for missing scores."""
    lines = load(spark, sf_dir, "lineitem").selectExpr(
        """concat_ws(' ',
            case l_partkey % 26 when 22 then 'X' when 23 then 'Y' when 24 then 'M' when 25 then '0'
                 else cast(l_partkey % 26 + 1 as string) end,
            l_orderkey, l_orderkey + 1, l_partkey + 1, l_suppkey + 1,
            concat((l_orderkey >> 3) & 1, (l_orderkey >> 2) & 1, (l_orderkey >> 1) & 1,
                   l_orderkey & 1),
            l_quantity, l_quantity - l_tax, l_quantity + l_tax, 'NaN', l_discount, l_tax,
            case when l_linenumber < 7 then cast(l_quantity as string) else 'NaN' end, 'NaN',
            'NaN', 'NaN') as value"""
    )
    return _with_lines(lines, BAD_HITS)


def part_cells(spark, sf_dir):
    """A six-row matrix per part; every motif holds zeros somewhere or nowhere, by its key."""
    return (
        load(spark, sf_dir, "part")
        .select("p_partkey", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("i"))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("b"))
        .selectExpr(
            "p_partkey + 1 as pwmid",
            "i",
            "b",
            "((p_partkey * 7 + i * 3 + b * b * 5) % 10 + p_partkey % 3) / cast(40 as double) as p",
        )
    )


def nation_pwms(spark, sf_dir):
    """A matrix of six or seven rows per nation with its threshold."""
    k = F.expr("cast(n_nationkey % 2 as int) + 6")
    cell = "cast(pow((n_nationkey * 7 + i * 3 + b * b * 3 + b * n_nationkey) % 10, 2) as double)"
    cells = (
        load(spark, sf_dir, "nation")
        .select("n_nationkey", F.explode(F.sequence(F.lit(0), k - 1)).alias("i"))
        .select("*", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("b"))
        .selectExpr("*", f"{cell} as v")
    )
    total = cells.groupBy("n_nationkey", "i").agg(F.sum("v").alias("total"))
    return cells.join(total, ["n_nationkey", "i"]).selectExpr(
        "cast(n_nationkey + 1 as bigint) as pwmid",
        "concat('nation', n_nationkey, '.txt') as motif_file",
        "cast(4.8125 + n_nationkey % 2 * 0.25 as double) as threshold",
        "i",
        "b",
        "v / total as p",
    )
