import textwrap

import pytest
from pyspark.sql import functions as F

from sitelens.llm.licenses import (
    BLOT,
    LONGEST,
    TEMPLATES,
    _blotted,
    _grams,
    _templates,
    _windows,
    _words,
    compared,
    license_notices,
)


def test_words_and_runs(spark):
    row = spark.createDataFrame([("Öl, CC BY-NC 4.0!",), ("",), (None,)], "line string").select(
        _words(F.col("line")).alias("w"), _grams(_words(F.col("line")), 2).alias("g")
    )
    got = row.collect()
    assert got[0].w == ["öl", "cc", "by", "nc", "4", "0"]
    assert got[0].g == ["öl cc", "cc by", "by nc", "nc 4", "4 0"]
    assert got[1].w == [] and got[1].g == []


def wrapped(family, which):
    return textwrap.wrap(TEMPLATES[family][which], 42)


@pytest.fixture(scope="module")
def found(frame, prose):
    rows = [(i, prose(i, 20) + "\n" + prose(1000 + i, 20)) for i in range(40)]
    rows += [(100 + k, prose(k, 9) + "\n" + own[0]) for k, own in enumerate(TEMPLATES.values())]
    rows += [
        (200, prose(7, 60) + " Licensed under the Apache License, Version 2.0. " + prose(8, 60)),
        (201, "The driver renewed a license at the public office."),
        (202, None),
        (203, ""),
        (None, "RELEASED UNDER THE MIT LICENSE!!\n\nReleased under the MIT License."),
        (204, "Released under the MIT License."),
        (204, "Released under the MIT License."),
        (300, "\n".join(wrapped("MIT", 3))),
        (301, "# " + "\n# ".join(wrapped("BSD", 2)) + "\n" + prose(9, 30)),
        (302, " * " + "\n * ".join(wrapped("GPL-3.0", 1))),
        (303, "// " + "\r\n// ".join(wrapped("Apache-2.0", 2))),
        (304, "Released under the MIT License. Licensed under the Apache License, Version 2.0."),
        (305, prose(3, 3000) + " " + " ".join(wrapped("CC0-1.0", 1)) + " " + prose(4, 3000)),
        (306, prose(3, 9) + "\n \t\n" + "Licensed under CC BY-SA 4.0.\n\n\nLicensed under CC BY 4.0."),
        (307, "This work is licensed under the GNU General Public License, version 3."),
    ]
    return license_notices(frame(*rows)).collect()


def test_families(found):
    got = sorted((r.doc_id, r.paragraph, r.family) for r in found if r.doc_id is not None)
    want = [(100 + k, 0, family) for k, family in enumerate(TEMPLATES)]
    want += [(200, 0, "Apache-2.0"), (204, 0, "MIT"), (204, 0, "MIT")]
    want += [(300, 0, "MIT"), (301, 0, "BSD"), (302, 0, "GPL-3.0"), (303, 0, "Apache-2.0")]
    want += [(304, 0, "Apache-2.0"), (304, 0, "MIT"), (305, 0, "CC0-1.0")]
    want += [(306, 1, "CC-BY-SA-4.0"), (306, 2, "CC-BY-4.0"), (307, 0, "GPL-3.0")]
    assert got == sorted(want)
    assert sorted(r.paragraph for r in found if r.doc_id is None) == [0, 1]


def test_predictions_are_confirmed(found):
    assert all(r.chance > 0.5 and r.similarity >= 0.7 for r in found)


def test_empty(frame):
    assert license_notices(frame()).count() == 0


def test_every_run_lies_whole_in_a_window(spark):
    sizes = [0, 1, LONGEST, LONGEST + 1, 2 * LONGEST, 2 * LONGEST + 1, 3 * LONGEST, 7 * LONGEST + 5]
    rows = spark.createDataFrame([([str(i) for i in range(n)],) for n in sizes], "words array<string>")
    for row in rows.select("words", _windows(F.col("words")).alias("w")).collect():
        held = {tuple(w[i : i + LONGEST]) for w in row.w for i in range(max(1, len(w) - LONGEST + 1))}
        n = len(row.words)
        assert {tuple(row.words[i : i + LONGEST]) for i in range(max(1, n - LONGEST + 1))} <= held
        assert max(map(len, row.w)) <= 2 * LONGEST and sum(map(len, row.w)) <= 2 * n


def test_words_of_a_notice_are_blotted(spark):
    rows = spark.createDataFrame(
        [("a b c d e x b c".split(), ["a b c", "b c d"]), ([], ["a b c"]), (["a", "b"], ["a b"])],
        "words array<string>, triples array<string>",
    )
    got = [r.w for r in rows.select(_blotted(F.col("words"), F.col("triples")).alias("w")).collect()]
    assert got == [[BLOT] * 4 + "e x b c".split(), [], [BLOT, BLOT]]


def test_similarity_against_brute_force(spark, prose):
    import re

    cut = lambda x: re.sub(r"[\W_]+", " ", x.lower()).split()
    runs = lambda w, n: {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)}
    texts = [x for own in TEMPLATES.values() for x in own]
    texts = [*texts, *(prose(i, 9) + " " + x[: len(x) * 2 // 3] for i, x in enumerate(texts))]
    rows = spark.createDataFrame([(i, cut(x)) for i, x in enumerate(texts)], "at long, words array<string>")
    got = {(r["at"], r.family): r.similarity for r in compared(rows, _templates(spark), ["at"]).collect()}
    want = {}
    for i, text in enumerate(texts):
        own = runs(cut(text), 3) | runs(cut(text), 2)
        for family, templates in TEMPLATES.items():
            sets = [runs(cut(x), 3 if len(cut(x)) >= 3 else 2) for x in templates]
            if best := max(len(own & x) / len(x) for x in sets):
                want[i, family] = best
    assert got == pytest.approx(want)


def test_extra_columns_with_clashing_names(spark):
    rows = [(1, "Released under the MIT License.", "x", "y", 1.0, 2)]
    docs = spark.createDataFrame(
        rows, "doc_id int, text string, family string, words string, chance double, `at` int"
    )
    assert [(r.doc_id, r.family) for r in license_notices(docs).collect()] == [(1, "MIT")]


def test_every_window_of_the_corpus_counts(frame, prose):
    """Distinct windows above any former bound stay, and equal sets of features are one row."""
    from sitelens.llm import licenses

    assert not hasattr(licenses, "FIT_PARAGRAPHS")
    docs = frame(*((i, f"{prose(i, 5)} license n{i}") for i in range(21_000)))
    templates = licenses._templates(docs.sparkSession)
    known = licenses.vocabulary(templates)
    windows = licenses.paragraphs(docs, ["license"])
    others = licenses._others(windows, templates)
    grams = sorted(x.gram for x in known.collect())
    sets = licenses._feature_sets(licenses._training(templates, others), grams)
    rows = [r for r in sets.collect() if r.own == licenses.CLASSES.index(licenses.OTHER)]
    assert sum(r.n for r in rows) == 21_000 and len(rows) == 1
    assert [grams[g] for g in rows[0].held] == ["license"]
