"""Scratch space of a session."""

import posixpath
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the session names in ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a folder of its own.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sitelens-")
    return posixpath.join(root, f"sitelens-{uuid.uuid4().hex}", name)


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to the scratch folder and read from there, for what is read several times."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
