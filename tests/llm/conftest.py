import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label string, _row int"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from ``(doc_id, text)`` pairs, with columns of clashing names."""

    def make(*rows):
        full = [(i, t, "en", "src", len(t or ""), "x", 1) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def prose():
    """Invented sentences, the same for a seed."""

    def make(seed, words=120):
        draw = random.Random(seed)
        parts = "an er on in at th re ti en or ha wh ou st nd es ing ed ly".split()
        out, new = [], True
        for _ in range(words):
            word = "".join(draw.choices(parts, k=draw.randint(1, 4)))
            out.append(word.capitalize() if new else word)
            new = draw.random() < 0.1
            if new:
                out[-1] += "."
        return " ".join(out)

    return make
