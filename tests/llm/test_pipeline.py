import pytest

import corpus_pipeline
from sitelens.llm.near_dedup import near_duplicates

QUESTION = "what is the name of the river that runs through all of the towns in this valley today"


@pytest.fixture(scope="module")
def folder(spark, frame, prose, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rows, labels = [], []
    for i in range(150):
        text, bad = prose(i, 40 + i % 50), i % 10 == 9
        if bad:
            text = " ".join([text.split()[0]] * 50)
        elif i % 7 == 3:
            text += " idiot"
        rows.append((i, text))
        labels.append((i, int(not bad), int(i % 7 == 3 and not bad)))
    rows += [(500 + i, prose(2, 42)) for i in range(5)]
    rows += [(600, prose(700, 60) + "\n" + QUESTION + ".")]
    frame(*rows).repartition(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, QUESTION)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, left = docs.columns, []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id for r in docs.collect()}
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id for r in docs.collect()}
        assert after <= before
        assert number == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        left.append(after)
    good, clean, single, unleaked, packed = left
    assert not {i for i in good if i < 150 and i % 10 == 9}
    assert len(good) >= 0.95 * 141
    assert not {i for i in clean if i < 150 and i % 7 == 3}
    assert len(single & {2, *range(500, 505)}) == 1
    assert 600 in single and 600 not in unleaked and unleaked == packed


def test_nothing_similar_is_left(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.keep_one(spark, docs, folder)
    assert near_duplicates(kept).where("not kept").count() == 0


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).groupBy("sequence_id").sum("length").count() > 0
