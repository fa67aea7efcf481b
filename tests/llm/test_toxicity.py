import zlib

import numpy as np
import pytest

from sitelens.llm.common import held
from sitelens.llm.deobfuscate import (
    LETTERS,
    Restorer,
    decode,
    gram_counts,
    lattice,
    log_chances,
    single_letters,
)
from sitelens.llm.toxicity import Model, clean_documents, sparse_logistic, toxicity_scores

LABELS = "doc_id long, quality int, toxic int"
BAD = ["idiot", "moron", "scum"]


def corpus(prose, n=240):
    """Every third document holds a bad word."""
    rows = []
    for i in range(n):
        words = prose(i, 40).split()
        if i % 3 == 0:
            words.insert(i % 30, BAD[i // 3 % 3])
        rows.append((i, " ".join(words)))
    return rows


@pytest.fixture(scope="module")
def restorer(frame, prose):
    return Restorer(log_chances(gram_counts(frame(*corpus(prose)))))


def test_counts_are_those_of_all_words(frame):
    counts = gram_counts(frame((1, "ab, AB"), (2, "b"), (3, None))).reshape([LETTERS] * 4)
    assert counts[0, 0, 0, 1] == 2 and counts[0, 0, 1, 2] == 2 and counts[0, 0, 0, 2] == 1
    assert counts[0, 1, 2, 0] == 2 and counts[0, 0, 2, 0] == 1
    assert counts.sum() == 8


@pytest.mark.parametrize(
    ("written", "meant"),
    [
        ("1d10t", "idiot"),
        ("i.d.i.o.t", "idiot"),
        ("idiooot!!", "idiot"),
        ("m0r0n", "moron"),
        ("$cum", "scum"),
        ("SCUM", "scum"),
        ("i d i o t", "idiot"),
        ("id​iot", "idiot"),
    ],
)
def test_disguises(restorer, written, meant):
    assert meant in restorer.words(f"the {written} was")


def test_plain_words_stay(restorer, prose):
    text = prose(5)
    assert restorer.words(text) == {w.strip(".").lower() for w in text.split()}
    assert restorer.words(None) == restorer.words("") == restorer.words("42 17 ---") == set()


def test_decoding_finds_the_cheapest_path():
    """Against all paths of small lattices."""
    draw = np.random.default_rng(2)
    chances = log_chances(draw.integers(0, 50, LETTERS**4))

    def cost(text, extra):
        at, total = 0, extra
        for letter in [*text, " "]:
            k = 0 if letter == " " else ord(letter) - 96
            if k or at % LETTERS:
                total -= chances[at * LETTERS + k]
            at = (at * LETTERS + k) % LETTERS**3 if k else 0
        return total

    for word in ["1d0", "a.b", "x11", "aaab", "4-4"]:
        slots = lattice(word)
        paths = [("", 0.0)]
        for slot in slots:
            paths = [(t + m, c + e) for t, c in paths for m, e in slot]
        best = min(cost(t, c) for t, c in paths)
        got = decode(slots, chances)
        assert min(cost(t, c) for t, c in paths if " ".join(t.split()) == got) == pytest.approx(best, abs=1e-4)


def test_single_letters():
    assert list(single_letters("he said s c u m. and a b c".split())) == ["s c u m"]


def test_sparse_logistic_separates():
    rows, columns = np.array([0, 1, 2, 3, 4, 5]), np.array([0, 0, 0, 1, 1, 1])
    w, b = sparse_logistic(rows, columns, np.array([1.0, 1, 1, 0, 0, 0]), 2)
    assert w[0] + b > 2 and w[1] + b < -2


def test_held_out_scores(spark, frame, prose):
    rows = corpus(prose) + [(1000, "the m0r0n was here"), (1001, None), (1002, ""), (3, "repeated id")]
    labels = spark.createDataFrame(
        [(i, 1, int(i % 3 == 0)) for i in range(240)] + [(None, None, None), (5000, 1, 1)], LABELS
    )
    docs = frame(*rows)
    got = {(r.doc_id, r.score): r for r in toxicity_scores(docs, labels).collect()}
    assert len(got) >= len(rows) - 3
    for r in got.values():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    predicted = {i: r.predicted for (i, _), r in got.items()}
    right = sum(predicted[i] == int(i % 3 == 0) for i in range(240) if i != 3)
    assert right >= 0.97 * 239
    assert predicted[1000] == 1 and predicted[1001] == predicted[1002] == 0
    kept = clean_documents(docs, labels)
    assert kept.columns == docs.columns and 1000 not in {r.doc_id for r in kept.collect()}


def test_without_labels(spark, frame):
    labels = spark.createDataFrame([], LABELS)
    assert [r.score < 0.5 for r in toxicity_scores(frame((1, "a")), labels).collect()] == [True]
    assert toxicity_scores(frame(), labels).count() == 0


def test_equal_texts_with_opposite_labels_are_toxic(spark, frame):
    from sitelens.llm.toxicity import _labelled

    rows = [(i, "the same text") for i in range(20)]
    for order in (rows, rows[::-1]):
        labels = spark.createDataFrame([(i, i % 2) for i, _ in order], "doc_id long, toxic int")
        (row,) = _labelled(frame(*order), labels).collect()
        assert row.toxic == 1


def test_signs_in_spark_are_those_of_words(spark):
    from sitelens.llm.toxicity import _by_sign, signs

    words = ["a", "abcd", "abcde", "éàüöß", "ab😀cdefgh", "abcdefghij"]
    frame_ = spark.createDataFrame([(1, 1, words)], "key long, toxic int, words array<string>")
    assert sorted(r.word for r in _by_sign(frame_).collect()) == sorted({x for w in words for x in signs(w)})


def test_very_long_text(spark, frame):
    text = "word " * 200_000 + "idiot"
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity_scores(frame((1, text), (2, None)), labels).count() == 2


def test_tasks_of_a_worker_share_restored_words(restorer, monkeypatch):
    asked, restore = [], Restorer._restore
    monkeypatch.setattr(Restorer, "_restore", lambda self, token: asked.append(token) or restore(self, token))
    model = Model(restorer.chances, {"idiot": 2.0, "mor-": 1.0}, -1.0)
    first = held(model, model.scorer)("one id1ot and morons")
    assert held(model, model.scorer)("morons and one id1ot") == first == 1 / (1 + np.exp(-2.0))
    assert sorted(asked) == ["and", "id1ot", "morons", "one"]
    other = Model(restorer.chances, {}, -1.0)
    assert held(other, other.scorer)("id1ot") == 1 / (1 + np.exp(1.0))
