import numpy as np
from pyspark.sql import functions as F

from sitelens.llm.neighbours import hilbert, nearest

SCHEMA = "vec_id long, embedding array<float>, rank int, label int"


def brute(rows, asks, top=5):
    rows = [(i, np.array(v, "float32").astype("float64")) for i, v in rows]
    out = []
    for q, a in rows:
        if asks(q):
            score = [
                (-(a @ b) / (np.sqrt(a @ a) * np.sqrt(b @ b)), i) for i, b in rows if i != q
            ]
            out += [(q, k + 1, i, -s) for k, (s, i) in enumerate(sorted(score)[:top])]
    return sorted(out)


def found(spark, rows, top=5):
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA)
    got = nearest(df, F.col("vec_id") % 50 == 0, top).collect()
    return sorted(tuple(r) for r in got)


def test_curve_visits_neighbours():
    n = 3
    cells = np.array(np.meshgrid(*[np.arange(1 << n)] * 3)).reshape(3, -1).T
    place = hilbert(cells, n)
    assert sorted(place) == list(range(1 << (3 * n)))
    steps = np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_recall_against_all_pairs(spark):
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=16).tolist()) for i in range(600)]
    got, want = found(spark, rows), brute(rows, lambda i: i % 50 == 0)
    hit = len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want})
    assert hit >= 0.95 * len(want)
    score = {(q, i): s for q, _, i, s in want}
    assert all(abs(score[q, i] - s) < 1e-12 for q, _, i, s in got if (q, i) in score)


def test_equal_vectors_and_bad_ones(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(i, one) for i in range(0, 120)]
    good = rows + [(200, [1.0, 2.0, 3.1]), (201, [3.0, 1.0, 0.0])]
    bad = [(150, None), (250, [0.0, 0.0, 0.0]), (300, [1.0, None, 2.0]), (350, [float("nan"), 1.0, 1.0])]
    bad += [(400, [float("inf"), 1.0, 1.0]), (None, one), (450, [])]
    got = found(spark, good + bad)
    assert [x[:3] for x in got] == [x[:3] for x in brute(good, lambda i: i % 50 == 0)]


def test_recall_with_many_windows(spark, monkeypatch):
    """Windows too small for the table are widened, up to ``WIDEST``, and then more are read."""
    from sitelens.llm import neighbours

    monkeypatch.setattr(neighbours, "WINDOW", 8)
    monkeypatch.setattr(neighbours, "WIDEST", 16, raising=False)
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=64).tolist()) for i in range(4000)]
    got, want = found(spark, rows), brute(rows, lambda i: i % 50 == 0)
    hit = len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want})
    assert hit >= 0.9 * len(want)


def test_equal_ids_with_other_vectors(spark):
    draw = np.random.default_rng(5)
    rows = [(i % 60, draw.normal(size=8).tolist()) for i in range(150)]
    near = draw.normal(size=8)
    rows += [(100, (near + 0.01 * draw.normal(size=8)).tolist()) for _ in range(14)]
    rows += [(7, rows[0][1]), (8, rows[0][1])]
    got, want = found(spark, rows), brute(rows, lambda i: i % 50 == 0)
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in got], [x[3] for x in want])


def test_few_candidates_and_other_lengths(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [1.0, 0.0, 0.0])]
    assert [x[:3] for x in found(spark, rows)] == [(0, 1, 1)]


def test_empty(spark):
    assert found(spark, []) == []


def test_ties_go_to_the_smallest_ids(spark):
    """Multiples of one vector have cosine 1, whatever rounding makes of their components."""
    for one in ([1.0, 0.0, 0.0, 0.0], [0.1, 0.3, 0.7], [-2.0, 5.0]):
        rows = [(i, [k * x for x in one]) for i, k in zip(range(60), range(1, 61))]
        want = [(q, k + 1, i, 1.0) for q in (0, 50) for k, i in enumerate([x for x in range(6) if x != q][:5])]
        assert found(spark, rows) == want


def test_ties_in_many_windows(spark, monkeypatch):
    """A direction that most rows share, and ties of other directions, in windows of eight ranks."""
    from sitelens.llm import neighbours

    monkeypatch.setattr(neighbours, "WINDOW", 8)
    rows = [(i, [2.0 ** (i % 7), 0.0, 0.0]) for i in range(0, 400, 2)]
    rows += [(i, [3.0, 4.0 * (-1) ** i, 0.0]) for i in (1, 3, 5, 7, 9, 14_002)]
    rows += [(i, [1.0, 0.0, float(i)]) for i in range(1001, 1100, 2)]
    got = found(spark, rows)
    shared = [x for x in got if x[0] % 100 == 0 or x[0] in (50, 150, 250, 350)]
    want = [
        (q, k + 1, i, 1.0)
        for q in range(0, 400, 50)
        for k, i in enumerate([x for x in range(0, 12, 2) if x != q][:5])
    ]
    assert shared == want


def test_clashing_columns(spark):
    draw = np.random.default_rng(6)
    rows = [(i, draw.normal(size=4).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in ("entry", "key", "key2", "dims", "asks", "low", "kin", "rank", "score", "query_id", "n"):
        df = df.withColumn(name, F.lit("x"))
    got = sorted(tuple(x) for x in nearest(df, F.col("vec_id") % 50 == 0).collect())
    want = brute([(i, v) for i, v in rows], lambda i: i % 50 == 0)
    assert [x[:3] for x in got] == [x[:3] for x in want]
