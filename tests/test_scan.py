"""The scan against worked rows and against a position-by-position model."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sitelens.operators.scan import pack_motifs, scan_motifs
from sitelens.schemas import STRAND_SCORES

FRAGMENT = "chunk_id bigint, chromosome bigint, start bigint, seq string"
CELL = "pwmid bigint, threshold double, i int, b int, p double"
FLANK = "T" * 29
PWM = [[0.7, 0.1, 0.1, 0.1], [0.1, 0.7, 0.1, 0.1], [0.1, 0.1, 0.7, 0.1]]
ZERO_PWM = [[0.7, 0.3, 0.0, 0.0], *PWM[1:]]


def cells(spark, *motifs):
    rows = [
        (number, threshold, i, b, p)
        for number, (threshold, matrix) in enumerate(motifs, start=1)
        for i, row in enumerate(matrix)
        for b, p in enumerate(row, start=1)
    ]
    return spark.createDataFrame(rows, CELL)


def fragments(spark, *seqs, start=1000):
    return spark.createDataFrame([(n, 8, start, s) for n, s in enumerate(seqs, 1)], FRAGMENT)


def rounded(hits):
    cols = [F.round(c, 3).alias(c) for c in STRAND_SCORES]
    rows = hits.select("chunk_id", "pwmid", "mutation_pos", "event", *cols).collect()
    key = lambda r: r[:3]
    return sorted((tuple(None if v is None else v + 0 for v in r) for r in rows), key=key)


def model(seqs, motifs, start=1000, smoothing=True):
    """Plain statement of the rules, one position, window and base at a time."""
    out = []
    for chunk, seq in enumerate(seqs, 1):
        codes = ["ACGT".find(c.upper()) for c in seq]
        for number, (threshold, matrix) in enumerate(motifs, 1):
            if smoothing and any(p == 0 for row in matrix for p in row):
                matrix = [[(p + 0.001) / (sum(r) + 0.004) for p in r] for r in matrix]
            llr = [[math.log(p / 0.25) if p > 0 else -math.inf for p in r] for r in matrix]
            k = len(matrix)
            for p in range(29, len(seq) - 29):
                best = [[-99999.0, -99999.0] for _ in range(5)]
                for s in range(p - k + 1, p + 1):
                    window = codes[s : s + k]
                    for m in range(5):
                        if -1 in window:
                            f = r = 0.0
                        else:
                            w = list(window)
                            if m:
                                w[p - s] = m - 1
                            f = sum(llr[i][w[i]] for i in range(k))
                            r = sum(llr[i][3 - w[k - 1 - i]] for i in range(k))
                        best[m] = [max(best[m][0], f), max(best[m][1], r)]
                passes = max(best[0]) > threshold
                event, scores = 0, list(best[0])
                for m in range(1, 5):
                    other = codes[p] != m - 1
                    gain = other and max(best[m]) >= threshold
                    event += 10 ** (m - 1) if gain else 0
                    scores += best[m] if gain or (other and passes) else [None, None]
                if event or passes:
                    scores = [None if x is None else round(x, 3) + 0.0 for x in scores]
                    out.append((chunk, number, start + p + 1, event, *scores))
    return sorted(out, key=lambda r: r[:3])


N = None
CASES = {
    "TACGN": [
        (1031, 0, 3.089, -2.749, N, N, 1.143, -0.803, 1.143, -0.803, 1.143, -0.803),
        (1032, 0, 3.089, 0.0, 1.143, 0.0, N, N, 1.143, 0.0, 1.143, 0.0),
        (1033, 0, 3.089, 0.0, 1.143, 0.0, 1.143, 0.0, N, N, 1.143, 0.0),
    ],
    "TACTG": [(1033, 110, 1.143, 1.143, N, N, 1.143, 3.089, 3.089, 1.143, N, N)],
}


@pytest.mark.parametrize("middle", CASES)
def test_worked_rows(spark, middle):
    hits = scan_motifs(fragments(spark, FLANK + middle + FLANK), cells(spark, (2.0, PWM)))
    assert [r[2:] for r in rounded(hits)] == CASES[middle]


def test_gain_inside_the_flank_is_not_reported(spark):
    hits = scan_motifs(fragments(spark, FLANK + "TCAAC" + FLANK), cells(spark, (3.0, PWM)))
    assert rounded(hits) == []


def test_unsmoothed_zero_hits_the_floor(spark):
    seqs = [FLANK + m + FLANK for m in CASES]
    hits = scan_motifs(fragments(spark, *seqs), cells(spark, (2.0, ZERO_PWM)), smoothing=False)
    assert [r[2:] for r in rounded(hits)] == [
        (1031, 10, 3.089, -1.65, N, N, 2.242, 0.296, -99999.0, -1.65, -99999.0, -0.803),
        (1032, 0, 3.089, 0.0, 1.143, 0.0, N, N, 1.143, 0.296, 1.143, 0.0),
        (1033, 0, 3.089, 0.0, 1.143, 0.0, 1.143, 0.0, N, N, 1.143, 0.0),
        (1033, 110, 1.143, 1.143, N, N, 2.242, 3.089, 3.089, 2.242, N, N),
    ]


def test_length_edges(spark):
    frags = fragments(spark, "A" * 58, "ACG" * 19 + "AC", "", start=0)
    assert [r[2:] for r in rounded(scan_motifs(frags, cells(spark, (2.0, PWM))))] == [
        (30, 0, 3.089, 1.143, 1.143, -0.803, 1.143, -0.803, N, N, 1.143, -0.803)
    ]


def random_matrix(rng, k, zero_share=0.0):
    rows = []
    for _ in range(k):
        v = [0.0 if rng.random() < zero_share else rng.random() ** 3 for _ in range(4)]
        v[rng.randrange(4)] += 1.0
        rows.append([x / sum(v) for x in v])
    return rows


@pytest.mark.parametrize("smoothing", [True, False])
def test_against_model_over_lengths_and_tiles(spark, smoothing):
    rng = random.Random(7)
    seqs = [
        "".join(rng.choice("ACGTacgtACGTACGTACGTN") for _ in range(n)) for n in (59, 75, 140, 401)
    ]
    motifs = [
        (rng.choice([0.0, 0.12, 0.25]) * k - 1.3, random_matrix(rng, k, zero))
        for k, zero in ((1, 0), (2, 0.3), (5, 0), (6, 0.2), (7, 0), (12, 0.1), (13, 0), (30, 0.05))
    ]
    expected = model(seqs, motifs, smoothing=smoothing)
    assert len(expected) > 500
    for tile in (7, 64, 1 << 14):
        hits = scan_motifs(
            fragments(spark, *seqs), cells(spark, *motifs), smoothing=smoothing, tile=tile
        )
        got = rounded(hits)
        assert [r[:4] for r in got] == [r[:4] for r in expected]
        for g, e in zip(got, expected):
            assert g[4:] == pytest.approx(e[4:], abs=2e-3)


def test_more_motifs_than_one_pass(spark, monkeypatch):
    rng = random.Random(3)
    seqs = ["".join(rng.choice("ACGT") for _ in range(200))]
    motifs = [(2.0, random_matrix(rng, 4)) for _ in range(7)]
    monkeypatch.setattr("sitelens.operators.scan.MOTIFS_PER_PASS", 3)
    hits = scan_motifs(fragments(spark, *seqs), cells(spark, *motifs))
    assert [r[:4] for r in rounded(hits)] == [r[:4] for r in model(seqs, motifs)]


def test_unreachable_motifs_are_dropped(spark):
    packed = pack_motifs(cells(spark, (3.0, PWM), (3.2, PWM), (-1.0, PWM)))
    assert sorted(r.pwmid for r in packed.collect()) == [1, 3]
    hits = scan_motifs(fragments(spark, "A" * 99), cells(spark, (9.0, PWM)))
    assert hits.collect() == []


def test_long_or_broken_matrices_are_refused(spark):
    frags = fragments(spark, "A" * 99)
    with pytest.raises(ValueError, match="31 rows"):
        scan_motifs(frags, cells(spark, (1.0, PWM * 10 + PWM[:1])))
    with pytest.raises(ValueError, match="four cells"):
        scan_motifs(frags, cells(spark, (1.0, PWM)).where("not (i = 1 and b = 2)"))
    doubled = cells(spark, (1.0, PWM)).unionAll(cells(spark, (1.0, PWM)).where("i = 0 and b = 1"))
    with pytest.raises(ValueError, match="four cells"):
        scan_motifs(frags, doubled)
    with pytest.raises(ValueError, match="four cells"):
        scan_motifs(frags, cells(spark, (1.0, PWM)).withColumn("i", F.col("i") + 29))
    with pytest.raises(ValueError, match="40 rows"):
        scan_motifs(frags, cells(spark, (1.0, PWM * 13 + PWM[:1])))
