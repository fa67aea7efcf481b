"""Fragment files whose lines may be as long as a chromosome, cut into tiles while they are read.

A text reader makes a row of each line. Here two passes over byte ranges are made instead. The
first finds lines: a task looks at one range, and yields place and length of the sequence of each
line that starts there; of the last one it looks for the end beyond the range. The second deals runs of tiles over the tasks, and each reads the bytes of
its runs only. No task ever holds more of a line than a block, no row is larger than a tile, and
the sequence is not shuffled.
"""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.chromosome import chromosome_code
from sitelens.functions.text import strip
from sitelens.operators.row_id import dense_numbers
from sitelens.operators.sizing import is_small, sized_join_side
from sitelens.operators.window_scores import FLANK
from sitelens.operators.windows import TILE
from sitelens.session import scratch_path

# Bytes of a file that one task looks for lines in, and bytes it holds at a time.
SPLIT, BLOCK = 1 << 26, 1 << 20
# Bytes that the fields before the sequence may have together.
HEAD = 1 << 16
# Tiles that are read at once.
RUN = 64

_END = re.compile(rb"[\t\n]")
_SPACE = b" \t\r\n\f\v"
_LINES = "path string, split long, at long, fields int, chrom string, start string, first long, length long"


def _open(path: str):
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    system, place = fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


class _Blocks:
    """Searches in a file; one block of it is held."""

    def __init__(self, file):
        self.file, self.size = file, file.size()
        self.number, self.block = -1, b""

    def at(self, place: int) -> tuple[bytes, int]:
        """The block that holds ``place``, and where."""
        number, inside = divmod(place, BLOCK)
        if number != self.number:
            self.number, self.block = number, self.file.read_at(BLOCK, number * BLOCK)
        return self.block, inside

    def find(self, what: re.Pattern, place: int, stop: int | None = None) -> int:
        """Where the next match begins; the file's size if there is none in the blocks up to ``stop``."""
        while place < min(self.size, self.size if stop is None else stop):
            block, inside = self.at(place)
            if hit := what.search(block, inside):
                return place - inside + hit.start()
            place += len(block) - inside
        return self.size

    def byte(self, place: int) -> bytes:
        block, inside = self.at(place)
        return block[inside : inside + 1]

    def between(self, low: int, high: int) -> bytes:
        return self.file.read_at(high - low, low)

    def stripped(self, low: int, high: int) -> tuple[int, int]:
        """The range without white space at its ends."""
        while low < high and self.byte(low) in _SPACE:
            low += 1
        while low < high and self.byte(high - 1) in _SPACE:
            high -= 1
        return low, high


_LINE_END, _SOLID = re.compile(rb"\n"), re.compile(rb"[^ \t\r\n\f\v]")


def _lines_in(path: str, begin: int, end: int) -> Iterator[tuple]:
    """The lines that start between two places of a file, without blank ones."""
    with _open(path) as file:
        blocks = _Blocks(file)
        at = begin if begin == 0 else blocks.find(_LINE_END, begin - 1, end) + 1
        while at < min(end, blocks.size):
            ends = []
            place = at
            while len(ends) < 8:
                stop = blocks.find(_END, place)
                ends.append(stop)
                place = stop + 1
                if stop == blocks.size or blocks.byte(stop) == b"\n":
                    break
            line_end = ends[-1]
            if line_end < blocks.size and blocks.byte(line_end) == b"\t":
                line_end = blocks.find(_LINE_END, place)
            if blocks.find(_SOLID, at) < line_end:
                if len(ends) < 8:
                    yield path, begin, at, len(ends), None, None, 0, 0
                elif ends[6] - at > HEAD:
                    raise ValueError(f"{path}: {ends[6] - at} bytes before the sequence at {at}")
                else:
                    chrom, start = blocks.between(at, ends[1]).split(b"\t")
                    first, last = blocks.stripped(ends[6] + 1, ends[7])
                    texts = chrom.decode("utf-8", "replace"), start.decode("utf-8", "replace")
                    yield path, begin, at, 8, *texts, first, last - first
            at = line_end + 1


def _batches(rows: Iterator[tuple], names: list[str], most: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*held)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*held)], names)


def _find_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string()]
    schema = pa.schema(
        list(zip((x.split()[0] for x in _LINES.split(", ")), [*kinds, pa.int64(), pa.int64()]))
    )
    for batch in batches:
        for path, begin, end in zip(*(batch.column(x).to_pylist() for x in ("path", "begin", "end"))):
            for found in _batches(_lines_in(path, begin, end), schema.names, 4096):
                yield found.cast(schema)


def fragment_lines(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """``chunk_id, chromosome, start, path, first, length``: where each line's sequence lies.

    As :func:`sitelens.sources.scan_inputs.read_fragments`: the first line of a file is its header,
    blank lines take no number, lines of fewer than 8 fields fail. Files must be uncompressed.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    packed = F.col("path").rlike(r"\.(gz|bz2|zst|lz4|snappy|deflate|xz)$")
    said = F.concat(F.lit("a compressed file cannot be cut: "), F.col("path"))
    files = files.withColumn("path", F.when(packed, F.raise_error(said).cast("string")).otherwise(F.col("path")))
    begins = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split).cast("long")))
    splits = (
        files.where("length > 0")
        .select("path", begins.alias("begin"))
        .withColumn("end", F.col("begin") + split)
        .repartition(partitions, "path", "begin")
    )
    place = scratch_path(spark, "fragment-lines")
    splits.mapInArrow(_find_lines, _LINES).write.parquet(place)
    lines = spark.read.parquet(place)
    heads = lines.groupBy("path").agg(F.min("at").alias("head"))
    lines = lines.join(sized_join_side(heads, is_small(heads)), "path").where("at > head").drop("head")
    short = F.concat(F.lit("fragment line of "), "fields", F.lit(" fields in "), "path")
    checked = F.when(F.col("fields") == 8, F.col("first")).otherwise(F.raise_error(short).cast("long"))
    numbered = dense_numbers(lines.withColumn("first", checked), ["path", "split"], "at", "chunk_id")
    return numbered.select(
        "chunk_id",
        chromosome_code(F.col("chrom")).alias("chromosome"),
        strip(F.col("start")).cast("bigint").alias("start"),
        "path",
        "first",
        "length",
    )


_TILES = {
    "chunk_id": pa.int64(),
    "chromosome": pa.int64(),
    "start": pa.int64(),
    "offset": pa.int64(),
    "tile": pa.binary(),
}


def _cut(tile: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """The tiles of each run."""
        path, file = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != path:
                    if file:
                        file.close()
                    path, file = row["path"], _open(row["path"])
                begin = row["run"] * RUN * tile
                size = min(RUN * tile + 2 * FLANK, row["length"] - begin)
                held = file.read_at(size, row["first"] + begin)
                if len(held) != size:
                    raise ValueError(f"{path} has changed while it was read")
                own = row["chunk_id"], row["chromosome"], row["start"]
                yield [
                    (*own, begin + x, held[x : x + tile + 2 * FLANK])
                    for x in range(0, size - 2 * FLANK, tile)
                ]
        if file:
            file.close()

    def packed(tiles: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*tiles), _TILES.values())
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in columns], list(_TILES))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # short sequences leave a task together, about a block of them
        held, size = [], 0
        for run in rows(batches):
            held += run
            size += sum(len(x[-1]) for x in run)
            if size >= BLOCK:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    return read


def read_fragment_tiles(
    spark: SparkSession,
    path: str,
    tile: int = TILE,
    partitions: int | None = None,
    split: int = SPLIT,
) -> DataFrame:
    """``chunk_id, chromosome, start, offset, tile``, as ``tiles_of(read_fragments(spark, path))``.

    Files must be readable by the tasks through Arrow's file systems.
    """
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = fragment_lines(spark, path, split)
    centre = F.col("length") - 2 * FLANK
    last = F.floor((centre - 1) / F.lit(tile * RUN)).cast("int")
    runs = lines.where(centre > 0).withColumn("run", F.explode(F.sequence(F.lit(0), last)))
    return (
        runs.repartition(partitions, "chunk_id", "run")
        .sortWithinPartitions("path", "first", "run")
        .mapInArrow(_cut(tile), "chunk_id long, chromosome long, start long, offset long, tile binary")
    )
