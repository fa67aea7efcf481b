import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sitelens.llm import prefix_trie
from sitelens.llm.prefix_trie import fattest, list_hashes, prefix_tree

SCHEMA = "conv_id long, turn long, role string, text string, size string, rep int, d string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def brute(rows):
    """Nodes by listing every prefix of every conversation."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(abs(c) % 5) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if whole[c] == p)
        up = min(members[p[:-1]]) if p else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(m), len(p), up, len(m), children[p], leaves[p], saved[p], sha))
    return sorted(out, key=str)


def drawn(seed, convs, most, words):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-40, 3 * convs), convs):
        for turn in range(draw.randint(1, most)):
            text = draw.choice(words)
            rows.append((c, turn if draw.random() < 0.95 else None, draw.choice(("user", None)), text))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "rows",
    [
        drawn(1, 60, 12, ["a", "b", "ü"]),
        drawn(2, 40, 40, ["a", "a", "a", "b", None]),
        # copies, a chain of prefixes, and one long conversation
        [(c, t, "u", "same") for c in range(0, 100, 5) for t in range(4 + c // 25)]
        + [(1000, t, "u", f"t{t}") for t in range(300)]
        + [(1005, t, "u", f"t{t % 299}") for t in range(300)],
    ],
    ids=["bushy", "long", "chains"],
)
def test_equals_all_prefixes(spark, rows, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 3)
    monkeypatch.setattr(prefix_trie, "LISTED", 3)
    got = prefix_tree(table(spark, rows).repartition(3))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    assert got.columns == (
        "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"
    ).split()


def test_nulls_empty_and_repeated(spark):
    long_text = "word " * 300_000
    rows = [
        (None, 0, "user", "nobody's"), (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""),
        (2, 0, None, ""), (5, 1, "user", long_text), (5, 0, "x", long_text),
    ]
    got = prefix_tree(table(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    assert prefix_tree(table(spark, [])).count() == 0
    assert prefix_tree(table(spark, [(None, 0, "u", "t")])).count() == 0


def test_a_turnless_conversation_ends_at_the_root(spark):
    # crc32("8") % 9 turns of the absent conversation 5, then what follows of its own: none
    assert zlib.crc32(b"8") % 9 > 1
    got = prefix_tree(table(spark, [(8, 0, "user", "hello")])).collect()
    assert [tuple(r)[:7] for r in got] == [(8, 0, None, 1, 0, 1, 0)]
    assert got[0].ends_sha256 == hashlib.sha256(b"8").hexdigest()


def test_four_batches_make_the_same_tree(spark):
    rows = drawn(3, 50, 20, ["a", "a", "b"])
    four = prefix_tree(table(spark, rows), batches=4)
    assert sorted(map(tuple, four.collect()), key=str) == brute(rows)


def test_fattest(spark):
    pairs = [(a, b) for a in range(0, 40) for b in range(a + 1, 70)] + [(0, 1 << 40), ((1 << 40) - 3, (1 << 40) + 5)]
    got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", fattest(F.col("a"), F.col("b")))
    for a, b, f in got.collect():
        if b < 100:
            assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)
        else:
            assert f == 1 << 40


def test_list_hashes_stream(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "LISTED", 7)
    rows = [(r, c) for r in (1, 5) for c in range(-20, 20 * r)]
    got = dict(list_hashes(spark.createDataFrame(rows, "rep long, conv_id long").repartition(5)).collect())
    for r in (1, 5):
        joined = ",".join(str(c) for c in range(-20, 20 * r))
        assert got[r] == hashlib.sha256(joined.encode()).hexdigest()
