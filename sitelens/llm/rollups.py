"""Token counts kept by signed changes.

A batch inserts, deletes or revises documents. It is turned into signed entries: plus for what comes,
minus for what goes, by document and tokenizer version, with the document's source and language.
Totals are sums of entries, so they follow by adding a batch's sums to those before. A batch is
committed under its own name, once: writing it again, after a failure or by mistake, changes nothing.

Defined results: a null text has no tokens; null sources and languages are groups of their own. Rows
with equal ids are inserted each by itself and go together. Changes of an id that is absent, and rows
of a deletion or revision without an id, do nothing (a revision of an absent id inserts nothing).
Insertions of nothing are committed too; a deletion or revision on a ledger without entries is not, as
there is nothing that it could change. Without any entry the totals are empty. Texts of any length are
counted whole; other columns are ignored, whatever their names.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm.common import stored
from sitelens.llm.token_ids import batches, encoder, tokenizer_path
from sitelens.operators.sizing import is_small

_GROUP = ["source", "lang", "tokenizer"]
_ENTRY = ["doc_id", *_GROUP, "documents", "tokens"]


def counted(docs: DataFrame, path: str, version: str) -> DataFrame:
    """``doc_id, source, lang, tokenizer, documents, tokens``: two versions of counts a document.

    ``version`` names the tokenizer file at ``path``; ``words`` counts runs without white space.
    """

    @F.pandas_udf("long")
    def tokens(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = encoder(path)
        for texts in parts:
            runs = batches([x or "" for x in texts])
            yield pd.Series([len(x) // 4 for run in runs for x in known.ids(run)], dtype="int64")

    text = F.coalesce(docs["text"], F.lit(""))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    both = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"],
        docs["lang"],
        tokens(text).alias("by_file"),
        words.alias("by_word"),
    )
    stack = f"stack(2, '{version}', by_file, 'words', by_word) as (tokenizer, tokens)"
    return both.selectExpr("doc_id", "source", "lang", stack).withColumn(
        "documents", F.lit(1).cast("long")
    ).select(*_ENTRY)


#: Bits of the map that thins rows before ids too many for a broadcast are joined, as a power of two.
MAP_BITS = 24


def with_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` whose ``doc_id`` is among ``ids``, without moving the others.

    Ids that were measured to fit are broadcast. More are hashed to a bit map of fixed size, which is
    broadcast instead; only rows that it lets through are shuffled and compared with the ids.
    """
    ids = ids.select("doc_id").where("doc_id is not null").distinct()
    if is_small(ids):
        return rows.join(F.broadcast(ids), "doc_id", "left_semi")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << MAP_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    words = ids.groupBy(F.shiftright(place, 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    marked = rows.withColumn("_word", F.shiftright(place, 6)).join(F.broadcast(words), "_word")
    set_ = F.call_function("getbit", "_bits", place.bitwiseAND(63).cast("int")) == 1
    return marked.where(set_).select(*rows.columns).join(ids.hint("merge"), "doc_id", "left_semi")


class Ledger:
    """Committed batches in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _exists(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def committed(self, batch: int) -> bool:
        """Whether all of the batch is there; Spark leaves the mark when a write is whole."""
        return all(self._exists(f"{p}/_SUCCESS") for p in (self._entries(batch), self._sums(batch)))

    def _entries(self, batch: int) -> str:
        return f"{self.path}/entries/batch={batch}"

    def _sums(self, batch: int) -> str:
        return f"{self.path}/sums/batch={batch}"

    def _listed(self, kind: str) -> list[str]:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        if not self._exists(f"{self.path}/{kind}"):
            return []
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(root)
        names = [x.getPath().toString() for x in files]
        return [x for x in names if self.committed(int(x.rpartition("=")[2]))]

    def _read(self, kind: str) -> DataFrame | None:
        paths = self._listed(kind)
        return self.spark.read.parquet(*paths) if paths else None

    def standing(self, ids: DataFrame) -> DataFrame | None:
        """Entries of the documents ``ids``, summed: what of them counts now."""
        entries = self._read("entries")
        if entries is None:
            return None
        own = with_ids(entries, ids)
        sums = [F.sum(x).alias(x) for x in ("documents", "tokens")]
        return own.groupBy("doc_id", *_GROUP).agg(*sums).where("documents != 0 or tokens != 0")

    def _commit(self, batch: int, entries: DataFrame) -> bool:
        if self.committed(batch):
            return False
        entries.select(*_ENTRY).write.mode("overwrite").parquet(self._entries(batch))
        stored_entries = self.spark.read.parquet(self._entries(batch))
        sums = stored_entries.groupBy(*_GROUP).agg(
            F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")
        )
        sums.coalesce(1).write.mode("overwrite").parquet(self._sums(batch))
        return True

    def insert(self, batch: int, counts: DataFrame) -> bool:
        """Commit new documents' counts (as of ``counted``); False if the batch was there already."""
        return not self.committed(batch) and self._commit(batch, counts)

    def delete(self, batch: int, ids: DataFrame) -> bool:
        """Commit the departure of documents."""
        if self.committed(batch):
            return False
        gone = self.standing(ids)
        return gone is not None and self._commit(batch, _negative(gone))

    def revise(self, batch: int, counts: DataFrame) -> bool:
        """Commit other counts for documents that are there, of the versions that ``counts`` has."""
        if self.committed(batch):
            return False
        counts = stored(counts, "revised-counts")
        there = self.standing(counts)
        if there is None:
            return False
        versions = counts.select("tokenizer").distinct()
        gone = there.join(F.broadcast(versions), "tokenizer", "left_semi")
        known = there.where("documents > 0").select("doc_id").distinct()
        return self._commit(
            batch, _negative(gone).unionByName(with_ids(counts, known).select(*_ENTRY))
        )

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, documents, tokens`` over all committed batches."""
        sums = self._read("sums")
        if sums is None:
            schema = "source string, lang string, tokenizer string, documents long, tokens long"
            return self.spark.createDataFrame([], schema)
        added = sums.groupBy(*_GROUP).agg(
            F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")
        )
        return added.where("documents != 0 or tokens != 0")


def _negative(entries: DataFrame) -> DataFrame:
    return entries.withColumns({x: -F.col(x) for x in ("documents", "tokens")}).select(*_ENTRY)


def maintained(docs: DataFrame, labels: DataFrame, path: str) -> DataFrame:
    """Totals after documents came, rejected ones went and toxic ones were revised, each twice.

    Rejected documents have a label of quality 0; toxic ones are counted anew in lower case.
    """
    ledger = Ledger(docs.sparkSession, path)
    file, version = tokenizer_path("byte_bpe_50k.json"), "byte_bpe_50k"
    rejected = labels.where("quality = 0").select(F.col("doc_id").cast("long").alias("doc_id"))
    toxic = labels.where("toxic = 1").select(F.col("doc_id").cast("long").alias("doc_id"))
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text", "source", "lang")
    revised = with_ids(docs, toxic).withColumn("text", F.lower("text"))
    for _ in range(2):  # every batch comes again, as after a failure
        ledger.insert(1, counted(docs, file, version))
        ledger.delete(2, rejected)
        ledger.revise(3, counted(revised, file, version))
    return ledger.totals()
