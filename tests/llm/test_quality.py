import zlib

import numpy as np

from sitelens.llm.quality import class_prior, fit, good_documents, measures, quality_scores

LABELS = "doc_id long, quality int, toxic int"


def corpus(prose):
    """Every fifth document is junk of some kind."""
    rows = []
    for i in range(500):
        text = prose(i, 30 + i % 60)
        if i % 5 == 4:
            word = text.split()[0]
            text = [" ".join([word] * 60), text.upper().replace(" ", "!! "), text.replace(" ", "### ")][
                i // 5 % 3
            ]
        rows.append((i, text))
    return rows


def test_held_out_accuracy(spark, frame, prose):
    rows = corpus(prose) + [(900, None), (901, ""), (None, prose(1)), (0, prose(0, 30))]
    labels = spark.createDataFrame(
        [(i, int(i % 5 != 4), 0) for i in range(0, 500, 2)] + [(None, 1, 0), (None, None, None)], LABELS
    )
    docs = frame(*rows)
    got = quality_scores(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 500]
    right = sum(r.predicted == int(r.doc_id % 5 != 4) for r in held)
    assert right >= 0.95 * len(held)
    kept = good_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)


def test_risk_is_that_of_positives_and_unlabelled():
    draw = np.random.default_rng(0)
    width = len(measures(""))
    positive = draw.normal(1, 1, (2000, width))
    unlabelled = np.vstack([draw.normal(1, 1, (1400, width)), draw.normal(-1, 1, (600, width))])
    score, prior = fit(positive, unlabelled)
    assert 0.5 < prior < 0.75  # errs on the low side
    good = score.chance(unlabelled) >= 0.3
    assert good[:1400].mean() > 0.95 and good[1400:].mean() < 0.05


def test_prior_of_equal_samples_is_high():
    draw = np.random.default_rng(1)
    assert class_prior(draw.normal(size=3000), draw.normal(size=3000)) > 0.9


def test_without_labels_or_documents(spark, frame):
    none = spark.createDataFrame([], LABELS)
    got = quality_scores(frame((1, "a"), (2, None)), none).collect()
    assert [(r.score, r.predicted) for r in got] == [(0.5, 1)] * 2
    assert quality_scores(frame(), none).count() == 0


def test_long_text():
    assert np.isfinite(measures("word " * 200_000)).all() and np.isfinite(measures("x" * 500_000)).all()
