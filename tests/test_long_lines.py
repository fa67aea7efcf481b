"""Fragment files cut into tiles while they are read."""

import random

import pytest

from sitelens.operators.windows import tiles_of
from sitelens.sources import long_lines
from sitelens.sources.long_lines import fragment_lines, read_fragment_tiles
from sitelens.sources.scan_inputs import read_fragments

HEAD = "chrom\tstart\ta\tb\tc\td\te\tseq\n"


def line(chrom, start, seq, more=""):
    return f"{chrom}\t{start}\t.\t.\t\t.\t.\t{seq}{more}\n"


def rows(df):
    return sorted(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in df.collect())


@pytest.fixture
def folder(tmp_path):
    draw = random.Random(5)

    def bases(n):
        return "".join(draw.choices("ACGTacgtn", k=n))

    first = HEAD + line("chr1", 0, bases(5000)) + "\n  \n" + line("chrX", 7, bases(58))
    first += line("8", 100, " " + bases(59) + " ", "\tmore\tfields") + line("chr3", 5, "")
    first += "".join(line("chr2", i, bases(i)) for i in range(40, 90)) + line("chr9", 1, bases(3000))
    (tmp_path / "a.tsv").write_text(first)
    (tmp_path / "b.tsv").write_text(HEAD.replace("\n", "\r\n") + line("chrY", 3, bases(700), "\r"))
    (tmp_path / "c.tsv").write_text("\n" + HEAD + line("chr4", 3, bases(400)).rstrip("\n"))
    (tmp_path / "d.tsv").write_text("")
    (tmp_path / "e.tsv").write_text(HEAD)
    return str(tmp_path)


@pytest.mark.parametrize("split", [50, 64, 1000, 1 << 20])
def test_as_the_text_reader(spark, folder, split):
    want = rows(tiles_of(read_fragments(spark, folder), 100))
    assert rows(read_fragment_tiles(spark, folder, tile=100, split=split)) == want


def test_a_long_line_is_read_in_several_tasks(spark, tmp_path):
    seq = "ACGTTGCA" * 700_000
    (tmp_path / "long.tsv").write_text(HEAD + line("chr1", 10, seq) + line("chr2", 20, seq[:100]))
    tiles = read_fragment_tiles(spark, str(tmp_path), partitions=8).cache()
    sizes = tiles.selectExpr("octet_length(tile) as n", "spark_partition_id() as task")
    longest, tasks = sizes.selectExpr("max(n)", "count(distinct task)").first()
    assert longest == long_lines.TILE + 2 * long_lines.FLANK and tasks > 1
    for r in tiles.collect():
        assert bytes(r["tile"]).decode() == (seq if r["chunk_id"] == 1 else seq[:100])[
            r["offset"] : r["offset"] + longest
        ]
    assert tiles.where("chunk_id = 1").count() == -(-(len(seq) - 58) // long_lines.TILE)


def test_bad_lines_fail(spark, tmp_path):
    (tmp_path / "a.tsv").write_text(HEAD + line("chr1", 1, "ACGT") + "chr1\t9\t.\n")
    with pytest.raises(Exception, match="fragment line of 3 fields"):
        read_fragment_tiles(spark, str(tmp_path)).collect()
    packed = tmp_path / "packed"
    packed.mkdir()
    (packed / "a.tsv.gz").write_bytes(b"x")
    with pytest.raises(Exception, match="cannot be cut"):
        fragment_lines(spark, str(packed)).collect()


def test_no_lines(spark, tmp_path):
    (tmp_path / "a.tsv").write_text(HEAD)
    assert read_fragment_tiles(spark, str(tmp_path)).count() == 0


def test_tiles_of_short_sequences_leave_together(tmp_path):
    import pyarrow as pa

    from sitelens.sources.long_lines import _cut

    path = tmp_path / "f.tsv"
    path.write_bytes(b"acgt" * 25 * 40)
    rows = [
        {"path": f"file:{path}", "chunk_id": n, "chromosome": None if n % 9 else 1, "start": n,
         "first": 100 * n, "length": 100, "run": 0}
        for n in range(40)
    ]
    batches = list(_cut(16)(iter([pa.RecordBatch.from_pylist(rows)])))
    assert len(batches) == 1 and batches[0].num_rows == 40 * 3
    got = batches[0].to_pylist()
    assert [r["offset"] for r in got[:3]] == [0, 16, 32] and len(got[2]["tile"]) == 68
    assert all(r["tile"] == (b"acgt" * 25)[r["offset"] : r["offset"] + 16 + 58] for r in got)
