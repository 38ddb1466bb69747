"""From raw documents to a mixed training order: each stage calls one operator of ``pulselens.llm``.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and read again as the next
stage's ``docs``.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulselens.llm import stages
from pulselens.session import shared_dir

STAGES = [
    ("language_id", stages.language_id),
    ("simhash_near_dedup", stages.simhash_near_dedup),
    ("substring_dedup", stages.substring_dedup),
    ("benchmark_decontamination", stages.benchmark_decontamination),
    ("source_mix", stages.source_mix),
]

#: SQL cannot express fingerprints and language models; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; intermediate tables go to the shared folder in ``spark.checkpoint.dir``."""
    base = shared_dir(spark, "corpus-pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
