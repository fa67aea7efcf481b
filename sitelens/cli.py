"""Command line: ``python -m sitelens.cli <command>`` or through ``spark-submit``."""

import argparse

from pyspark.sql import SparkSession

from sitelens.functions.pwm import EVEN_BACKGROUND
from sitelens.operators.scan import scan_tiles
from sitelens.operators.windows import tiles_of
from sitelens.plans import tables
from sitelens.plans.intersect import intersect, intersect_samples
from sitelens.sinks.tables import TARGET_BYTES
from sitelens.sinks.text import preview, write_csv, write_hits
from sitelens.sources.long_lines import read_fragment_tiles
from sitelens.sources.motif_info import read_motif_info
from sitelens.sources.scan_inputs import (
    number_pwms,
    read_fragments,
    read_pwms,
    read_thresholds,
    with_motif_numbers,
)
from sitelens.sources.tables import load_tables


def _intersect(spark, args):
    sites, motifs = load_tables(spark, args.tables)
    result = intersect(
        spark,
        sites,
        motifs,
        args.sample,
        bed_col=args.bed_col,
        n_cols=args.n_cols,
        half_open=args.half_open,
        only_gains=args.only_gains,
    )
    write_csv(result, args.output, args.partitions)


def _intersect_many(spark, args):
    sites, motifs = load_tables(spark, args.tables)
    found = intersect_samples(
        spark,
        sites,
        motifs,
        args.samples.split(","),
        bed_col=args.bed_col,
        n_cols=args.n_cols,
        half_open=args.half_open,
        only_gains=args.only_gains,
    )
    for kind, result in found.items():
        write_csv(result, f"{args.output}/{kind.removeprefix('.')}", by=["sample"])


def _scan(spark, args):
    thresholds = read_thresholds(spark, args.thresholds)
    if args.motifs:
        thresholds = with_motif_numbers(thresholds, read_motif_info(spark, args.motifs))
    pwms = number_pwms(read_pwms(spark, args.pwms), thresholds)
    if args.long_lines:
        tiles = read_fragment_tiles(spark, args.fragments)
    else:
        tiles = tiles_of(read_fragments(spark, args.fragments))
    hits = scan_tiles(
        tiles, pwms, background=tuple(args.background), smoothing=not args.no_smoothing
    )
    write_hits(hits, args.output)


def _build(spark, args):
    print(tables.build_tables(spark, args.motifs, args.hits, args.output, args.by_position))


def _compact(spark, args):
    if not args.output:
        tables.compact_scattered(spark, args.source, args.target_bytes)
        return
    tables.compact_sites(spark, args.source, args.output, args.target_bytes)


def _preview(spark, args):
    sites, _ = load_tables(spark, args.tables)
    if args.chromosome is not None:
        sites = tables.on_chromosome(sites, args.chromosome)
    preview(sites).show()


def _count(spark, args):
    sites, motifs = load_tables(spark, args.tables)
    tables.table_counts(sites, motifs).show()
    tables.score_total(sites).show()


COMMANDS = {
    "intersect": (_intersect, ["tables", "sample", "output"]),
    "scan": (_scan, ["fragments", "thresholds", "pwms", "output"]),
    "build": (_build, ["motifs", "hits", "output"]),
    "intersect_many": (_intersect_many, ["tables", "samples", "output"]),
    "compact": (_compact, ["source"]),
    "count": (_count, ["tables"]),
    "preview": (_preview, ["tables"]),
}


def main(argv=None):
    parser = argparse.ArgumentParser(prog="sitelens")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, (_, options) in COMMANDS.items():
        command = commands.add_parser(name)
        for option in options:
            command.add_argument(f"--{option}", required=True)
        if name == "intersect":
            command.add_argument("--partitions", type=int)
        if name in ("intersect", "intersect_many"):
            command.add_argument("--bed_col", type=int, default=0)
            command.add_argument("--n_cols", type=int)
            command.add_argument("--half_open", action="store_true")
            command.add_argument("--only_gains", action="store_true")
        if name == "scan":
            command.add_argument("--motifs", help="metadata whose order numbers the motifs")
            command.add_argument("--background", type=float, nargs=4, default=EVEN_BACKGROUND)
            command.add_argument("--no_smoothing", action="store_true")
            command.add_argument("--long_lines", action="store_true")
        if name == "build":
            command.add_argument("--by_position", action="store_true")
        if name == "compact":
            command.add_argument("--output", help="another directory; without, in place")
            command.add_argument("--target_bytes", type=int, default=TARGET_BYTES)
        if name == "preview":
            command.add_argument("--chromosome", type=int)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"sitelens-{args.command}").getOrCreate()
    COMMANDS[args.command][0](spark, args)


if __name__ == "__main__":
    main()
