from collections import Counter

from pyspark.sql import functions as F

from sitelens.llm.rollups import Ledger, counted, maintained, with_ids
from sitelens.llm.token_ids import WordEncoder, tokenizer_path

FILE = "byte_bpe_50k.json"


def recounted(rows):
    known = WordEncoder(tokenizer_path(FILE))
    docs, tokens = Counter(), Counter()
    for source, lang, text in rows:
        for version, n in (
            ("byte_bpe_50k", len(known.ids([text or ""])[0]) // 4),
            ("words", len((text or "").encode().split())),
        ):
            docs[source, lang, version] += 1
            tokens[source, lang, version] += n
    return {k: (docs[k], tokens[k]) for k in docs}


def totals(df):
    return {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in df.collect()}


def table(spark, rows):
    full = [(i, t, s, g, 0) for i, s, g, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, source string, lang string, tokens int")


def test_changes_add_up(spark, prose, tmp_path):
    rows = [(i, f"s{i % 3}", "en" if i % 2 else None, prose(i, 5 + i)) for i in range(30)]
    rows += [(50, None, "de", None), (51, "s0", "en", ""), (1, "s9", "en", "again"), (None, "s1", "en", "no id")]
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert totals(ledger.totals()) == {}
    assert not ledger.delete(9, spark.createDataFrame([(1,)], "doc_id long"))
    count = lambda r: counted(table(spark, r), tokenizer_path(FILE), "byte_bpe_50k")
    assert ledger.insert(1, count(rows))
    assert totals(ledger.totals()) == recounted([r[1:] for r in rows])
    gone = spark.createDataFrame([(1,), (2,), (777,), (None,)], "doc_id long")
    assert ledger.delete(2, gone)
    new = [(3, "s7", "fr", "new text here"), (888, "s7", "fr", "absent")]
    assert ledger.revise(3, count(new))
    left = [r for r in rows if r[0] not in (1, 2, 3)] + new[:1]
    assert totals(ledger.totals()) == recounted([r[1:] for r in left])
    for again in (ledger.insert(1, count(rows)), ledger.delete(2, gone), ledger.revise(3, count(new))):
        assert not again
    assert totals(ledger.totals()) == recounted([r[1:] for r in left])


def test_half_written_batch_does_not_count(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    one = counted(table(spark, [(1, "s", "en", "a b")]), tokenizer_path(FILE), "byte_bpe_50k")
    one.write.parquet(ledger._entries(1))  # the sums are missing, as after a crash
    assert totals(ledger.totals()) == {} and not ledger.committed(1)
    assert ledger.insert(1, one)
    assert totals(ledger.totals()) == recounted([("s", "en", "a b")])


def test_query_against_recount(spark, prose, tmp_path):
    rows = [(i, "s", "en", prose(i, 9)) for i in range(20)]
    docs = table(spark, rows)
    labels = spark.createDataFrame(
        [(i, int(i % 4 != 0), int(i % 5 == 0)) for i in range(25)], "doc_id long, quality int, toxic int"
    )
    want = [
        ("s", "en", t.lower() if i % 5 == 0 else t) for i, _, _, t in rows if i % 4 != 0
    ]
    assert totals(maintained(docs, labels, str(tmp_path / "l"))) == recounted(want)
    none = maintained(docs.where(F.lit(False)), labels, str(tmp_path / "m"))
    assert none.count() == 0


def test_rows_are_found_by_id_whatever_their_number(spark):
    rows = spark.range(2000).select(
        F.when(F.col("id") % 50 == 7, None).otherwise(F.col("id") % 700).alias("doc_id"),
        F.repeat(F.lit("text "), 20).alias("text"),
        F.lit(1).alias("_extra"),
    )
    ids = spark.createDataFrame([(x,) for x in [None, 5, 5, 6, 699, 10_000]], "doc_id long")
    expected = sorted(r.doc_id for r in rows.collect() if r.doc_id in (5, 6, 699))
    for bound in ("1000000", "0"):
        spark.conf.set("spark.sitelens.broadcastBytes", bound)
        try:
            found = with_ids(rows, ids)
            plan = found._jdf.queryExecution().optimizedPlan().toString()
        finally:
            spark.conf.unset("spark.sitelens.broadcastBytes")
        assert found.columns == rows.columns
        assert sorted(r.doc_id for r in found.collect()) == expected
        assert ("bit_or" in plan) == (bound == "0")


def test_long_texts_and_clashing_columns(spark, tmp_path):
    text = "word " * 400_000
    full = spark.createDataFrame(
        [(1, text, "s", "en", 3, "x", 1)],
        "doc_id long, text string, source string, lang string, documents int, tokenizer string, batch int",
    )
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.insert(1, counted(full, tokenizer_path(FILE), "byte_bpe_50k"))
    assert totals(ledger.totals()) == recounted([("s", "en", text)])
