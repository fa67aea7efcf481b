import zlib

import numpy as np

from sitelens.llm.sharding import sampled_splitters


def test_shards_are_even_and_slots_gapless(frame, prose):
    rows = [(i, prose(i, 5 + i % 90)) for i in range(400)]
    rows += [(1000 + i, "the same text again and again") for i in range(250)]
    rows += [(None, None), (None, None), (7, None), (8, ""), (5, rows[5][1])]
    got = sampled_splitters(frame(*rows)).toPandas()
    assert len(got) == len(rows) and set(got["law"]) == {"bytes"}
    assert got["grown_shard"].isna().all()
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows)
    assert sorted(zip(got["size"], got["text_crc32"])) == want
    sizes = got.groupby("shard")["size"].sum()
    assert list(sizes.index) == list(range(8))
    assert sizes.max() - sizes.min() <= 2 * got["size"].max()
    for _, own in got.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))


def test_copies_stand_side_by_side(frame, prose):
    rows = [(i, prose(i)) for i in range(60)] + [(100 + i, prose(3)) for i in range(3)]
    got = sampled_splitters(frame(*rows)).toPandas()
    copies = got[got["text_crc32"] == zlib.crc32(prose(3).encode())]
    assert copies["shard"].max() - copies["shard"].min() <= 1


def test_one_long_record_and_few_rows(frame):
    got = sampled_splitters(frame((1, "a" * 200_000), (2, "b"), (3, "c"))).toPandas()
    assert len(got) == 3 and got["shard"].between(0, 7).all()
    assert np.isin(got["slot"], [0, 1, 2]).all()


def test_empty(frame):
    assert sampled_splitters(frame()).count() == 0


def test_ranges_hold_few_records(spark, frame, prose, monkeypatch):
    """A third of the rows are null: they are most of no range's bytes, but are cut all the same."""
    from sitelens.llm import sharding

    monkeypatch.setattr(sharding, "RANGE_ROWS", 40)
    rows = [(i, prose(i, 40)) for i in range(1600)] + [(5000 + i, None) for i in range(800)]
    kept = sharding.records(frame(*rows)).cache()
    bounds = sharding.split_points(kept, 8)
    held = kept.groupBy(sharding._in_range(bounds).alias("range")).count().toPandas()
    assert held["count"].max() <= 2 * 40
    same = sharding.records(frame(*[(1, "a copy")] * 500 + [(2, "other")])).cache()
    assert len(sharding.split_points(same, 8)) >= 1


def test_against_a_plain_sort(frame, prose):
    """Shard and slot follow from running totals over all records in the order of their keys."""
    from sitelens.llm import sharding

    rows = [(i, prose(i % 250, 3 + i % 70)) for i in range(500)]
    rows += [(600 + i, None) for i in range(90)] + [(None, "x"), (3, None), (3, None)]
    df = frame(*rows)
    kept = sharding.records(df).toPandas().astype({"doc_id": "Int64"})
    kept = kept.sort_values(["place", "doc_id", "text_crc32", "size"], na_position="first")
    size = kept["size"].to_numpy()
    middle = size.cumsum() - size / 2
    shard = np.minimum(np.floor(middle * 8 / size.sum()), 7).astype(int)
    slot = [int((shard[:i] == x).sum()) for i, x in enumerate(shard)]
    none = kept["doc_id"].fillna(-1).astype(int)
    want = sorted(zip(none, size.tolist(), kept["text_crc32"], shard.tolist(), slot))
    got = sampled_splitters(df).toPandas()
    none = got["doc_id"].fillna(-1).astype(int)
    assert sorted(zip(none, got["size"], got["text_crc32"], got["shard"], got["slot"])) == want
