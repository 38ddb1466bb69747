"""The daily slice table sink (A4).

The reference appends every run, so a retried run doubles a day.  Here the
table is partitioned by ``event_date`` and written with dynamic partition
overwrite: a re-run replaces exactly the days it computed, nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselens.sources.tables import SLICE_SCHEMA


def write_slices(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a slice report; ``mode='overwrite'`` replaces only the days present."""
    out = df.select([F.col(f.name).cast(f.dataType) for f in SLICE_SCHEMA.fields])
    (out.repartition("event_date")            # one writer task per day: few, large files
        .sortWithinPartitions("dimension", "dimension_value")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path))


def read_slices(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(SLICE_SCHEMA).parquet(path)
    return df.select([f.name for f in SLICE_SCHEMA.fields])


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that a job wrote itself and no longer reads; nothing happens where there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))
