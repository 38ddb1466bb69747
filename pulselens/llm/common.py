"""Helpers shared by the operators: columns, scratch folder, package shipping."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulselens.session import checkpoint_base

#: Bytes of text that one numpy pass handles at a time; a longer single text is a pass of its own.
SLICE_BYTES = 1 << 22


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed on the executors (a checkout on a shared path)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if root not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, have) if x)


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows are written to the shared checkpoint folder and read from there."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_base(df.sparkSession))
    return df.checkpoint()


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so that other columns cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
