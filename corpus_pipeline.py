"""The corpus pipeline: documents to packed sequences, one stage after the other.

Each stage is a function of ``(spark, docs, sf_dir)``; its result is written as Parquet and read
again as the next one's ``docs``. All but the last return rows of ``docs`` with all their columns;
labels and benchmark come from ``sf_dir``. Stages hand texts to Python in small batches, since a batch
is held on both sides of the pipe, and the JVM keeps the buffers of the largest one.
"""

from pyspark.sql import DataFrame, SparkSession

from sitelens.llm.common import stored, table
from sitelens.llm.decontaminate import uncontaminated
from sitelens.llm.near_dedup import representatives
from sitelens.llm.packing import pack_documents
from sitelens.llm.quality import good_documents
from sitelens.llm.toxicity import clean_documents

#: Texts that are handed to a Python worker at once, at most.
TEXTS = 256


def small_batches(spark: SparkSession) -> None:
    """No more than ``TEXTS`` rows in an Arrow batch of this session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXTS:
        spark.conf.set(key, TEXTS)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    small_batches(spark)
    return good_documents(docs, table(spark, sf_dir, "labels"))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that it rejects go."""
    small_batches(spark)
    return clean_documents(docs, table(spark, sf_dir, "labels"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicates: one document of each group stays."""
    small_batches(spark)
    return representatives(docs)


def keep_unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that leak a benchmark item go."""
    small_batches(spark)
    return uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: a row for each piece, with its sequence and its place there."""
    small_batches(spark)
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("toxicity", keep_clean),
    ("near_dedup", keep_one),
    ("decontamination", keep_unleaked),
    ("best_fit_packing", pack),
]

#: Trained models, tokenizers and similarity of word sets are not SQL's.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
