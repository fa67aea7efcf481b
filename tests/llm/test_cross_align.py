import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sitelens.llm import cross_align
from sitelens.llm.cross_align import Pair, alignment, shared_cuts
from sitelens.llm.token_ids import tokenizer_path

A, B = (tokenizer_path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def brute(rows):
    """By the libraries, text by text, and by sets of ends."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel  # noqa: F401

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = cross_align._byte_letters()

    def tokens(text):
        if not text:
            return [], []
        whole = (" " + text).encode()
        found = a.encode(" " + text, add_special_tokens=False)
        one = [(i, bytes(letters[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
        two = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            two.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        if b"".join(x for _, x in one) != whole or b"".join(x for _, x in two) != whole:
            return [], []
        return one, two

    def ends(run):
        at, out = 0, {}
        for n, (i, x) in enumerate(run):
            at += len(x)
            out[at] = n
        return out

    docs, counts = [], Counter()
    for i, text in rows:
        one, two = tokens(text)
        ea, eb = ends(one), ends(two)
        cuts = sorted(set(ea) & set(eb))
        links = [(one[ea[c]][0], two[eb[c]][0]) for c in cuts]
        said, x, y = [], 0, 0
        for c in cuts:
            left = ",".join(str(t[0]) for t in one[x : ea[c] + 1])
            right = ",".join(str(t[0]) for t in two[y : eb[c] + 1])
            said.append(f"{left}|{right}")
            x, y = ea[c] + 1, eb[c] + 1
        counts.update(links)
        docs.append((i, len(one), len(two), links, ";".join(said)))
    top = {}
    for (_, y), k in counts.items():
        top[y] = max(top.get(y, 0), k)
    return sorted(
        (
            (
                i, na, nb, len(links), len(links), sum(counts[p] == top[p[1]] for p in links),
                sum(counts[p] for p in links), hashlib.sha256(s.encode()).hexdigest() if s else "",
            )
            for i, na, nb, links, s in docs
        ),
        key=str,
    )


ODD = [
    None, "", " ", "a", " two  blanks ", "line\nbreak\n\nmore", "tab\there", "naïve café — 漢字かな交じり文",
    "<s> </s> <|endoftext|> <0x41> <unk>", "a▁b", " nbsp　wide", "é combining", "\x00nul\x7f",
    "123456789012345678901234567890", "https://example.com/a?b=c&d=e#f", "x" * 3000, "😀" * 50, "-" * 101,
]


def test_equals_brute_force(spark, frame, prose, monkeypatch):
    monkeypatch.setattr(cross_align, "RUN", 500)
    monkeypatch.setattr(cross_align, "DICTIONARY", 400)
    monkeypatch.setattr(cross_align, "LINKS", 150)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(i, prose(i % 17, 60)) for i in range(100, 140)]
    rows += [(None, prose(3, 60)), (7, "the same id again"), (200, prose(9, 20_000))]
    got = alignment(frame(*rows).repartition(3))
    assert got.columns == (
        "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256"
    ).split()
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_no_rows_and_no_tokens(spark, frame):
    assert alignment(frame((1, "x")).limit(0)).count() == 0
    got = alignment(frame((1, None), (2, ""))).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


rising = st.sets(st.integers(1, 60), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(rising, rising), min_size=1, max_size=5))
def test_cuts_are_all_common_ends(texts):
    ends_a, ends_b, bounds, base = [], [], [], 0
    for a, b in texts:
        a, b = sorted(a | {61}), sorted(b | {61})
        bounds.append((len(ends_a), len(ends_a) + len(a), len(ends_b), len(ends_b) + len(b)))
        ends_a += [base + x for x in a]
        ends_b += [base + x for x in b]
        base += 61
    last_a, last_b = shared_cuts(np.array(ends_a), np.array(ends_b), *np.array(bounds).T)
    common = sorted(set(ends_a) & set(ends_b))
    assert [ends_a[i] for i in last_a] == common
    assert [ends_b[i] for i in last_b] == common


def test_long_runs_without_a_cut():
    draw = random.Random(5)
    odd = sorted(draw.sample(range(1, 400_001, 2), 100_000))
    even = sorted(draw.sample(range(2, 400_001, 2), 100_000))
    a, b = np.array([*odd, 400_002]), np.array([*even, 400_002])
    last_a, last_b = shared_cuts(a, b, *(np.array([x]) for x in (0, len(a), 0, len(b))))
    assert last_a.tolist() == [len(a) - 1] and last_b.tolist() == [len(b) - 1]


@pytest.mark.parametrize("text", ["a b", "\nx y\nz", "<|endoftext|> x", "don't stop  now"])
def test_ids_are_the_libraries(text):
    both = Pair(A, B)
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(A)
    plain.encode_special_tokens = True
    (a,), (b,) = both.ids([text])
    assert a == plain.encode(" " + text, add_special_tokens=False).ids
    assert b == both.b.encode(text)


def test_words_are_divided_as_whole_texts_are(prose):
    both = Pair(A, B)
    texts = [x or "" for x in ODD] + [prose(i, 300) for i in range(5)] + ["a\nb c\n d", "x\n", "\n", "a,b. c's"]
    task = cross_align._Task(both, 0)
    row = task.run(list(range(len(texts))), texts)
    whole = cross_align.groups_texts(both, cross_align.divided(both, *both.ids(texts)))
    assert row["groups_sha256"] == [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in whole]
    assert sum(task.times) == sum(row["n_groups"])


def test_words_without_tokens_before_a_stop(frame):
    """A word that is not its tokens' bytes, with a full stop after it."""
    rows = [(1, "one \u2581two. three"), (2, "one two. three,"), (3, "\u2581a,")]
    assert sorted((tuple(r) for r in alignment(frame(*rows)).collect()), key=str) == brute(rows)


def test_plain_words_are_not_encoded_as_texts(monkeypatch):
    """The library's rules are asked only where they can matter."""
    task, asked = cross_align._Task(Pair(A, B), 0), []
    same = task.both._same
    monkeypatch.setattr(task.both, "_same", lambda led, found: asked.append(led) or same(led, found))

    class Library:
        model = task.both.a.model

        def encode_batch_fast(self, texts, **_):
            assert texts == ["\nnew", " don't"] or not texts
            return real.encode_batch_fast(texts, **_)

    real, task.both.a = task.both.a, Library()
    task.run([1], ["plain words\nnew don't caf\u00e9"])
    assert sorted(x for led in asked for x in led) == sorted([" plain", " words", "\nnew", " don't", " caf\u00e9"])


@pytest.mark.parametrize("most, size", [(0, 1), (255, 1), (256, 2), (65_535, 2), (65_536, 3), (1 << 24, 4)])
def test_numbers_take_the_bytes_they_need(most, size):
    numbers = np.array([7, most, 0], dtype="<u4")
    planes = cross_align._planes(numbers.tobytes())
    assert len(planes) == 3 * size
    assert cross_align._numbers(planes, 3).tolist() == numbers.tolist()
    assert cross_align._planes(b"") == b"" and not len(cross_align._numbers(b"", 0))


def test_links_meet_one_dictionary_at_a_time(spark, frame, prose, monkeypatch):
    """A task with many dictionaries hands Python each with its own runs, and has let the vocabularies go."""
    monkeypatch.setattr(cross_align, "RUN", 500)
    monkeypatch.setattr(cross_align, "LINKS", 150)
    rows = [(i, prose(i % 17, 60)) for i in range(60)]
    real = cross_align.ranked

    def watched(answers, runs):
        from sitelens.llm import common

        out = real(answers, runs)
        assert sum(sum(x) for x in runs["n_groups"].to_pylist()) < 1000
        assert not any(type(x).__name__ == "Pair" for _, x in common._HELD)
        return out

    monkeypatch.setattr(cross_align, "ranked", watched)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        got = alignment(frame(*rows).coalesce(1)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
