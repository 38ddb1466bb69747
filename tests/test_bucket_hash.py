"""Bucket hashes equal to the XXH64 of other engines."""

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from pulselens.functions import hashing

EDGES = [0, 1, 2, 49, 255, 256, 65_535, 2**31 - 1, 2**31, 2**32 - 1, 2**32, 2**53 + 1, 2**63 - 1, -1, -2, -2**31, -2**63]


def fits(v: int, width: int) -> bool:
    return width == 8 or -2**31 <= v < 2**32


@pytest.mark.parametrize("width", [4, 8])
@pytest.mark.parametrize("seed", [0, 1, 42, 2**64 - 1])
def test_equals_the_library_on_edge_values(spark, width, seed):
    df = spark.createDataFrame([(v,) for v in EDGES] + [(None,)], "v long")
    got = {r.v: r.h for r in df.select("v", hashing.xxh64_int(F.col("v"), width, seed).alias("h")).collect()}
    want = {v: xxhash.xxh64_intdigest((v % 2 ** (8 * width)).to_bytes(width, "little"), seed) if fits(v, width) else None for v in EDGES}
    assert {v: None if h is None else h % 2**64 for v, h in got.items()} == {**want, None: None}


@pytest.mark.parametrize("width", [4, 8])
def test_buckets_are_unsigned_remainders_in_spark_and_sql(spark, width):
    n = 50
    got = {r.id: r.b for r in spark.range(5000).select("id", hashing.user_bucket(F.col("id"), n, f"xxh64_{width}").alias("b")).collect()}
    want = {i: xxhash.xxh64_intdigest(i.to_bytes(width, "little")) % n for i in range(5000)}
    assert got == want
    sql = f"SELECT i, {hashing.user_bucket_sql('i', n, f'xxh64_{width}')} FROM range(5000) t(i)"
    assert dict(duckdb.connect().execute(sql).fetchall()) == want


def test_the_inverse_is_one(spark):
    for target in (0, 1, 2**63, 2**64 - 1, 123_456_789):
        x = hashing.long_with_hash(target)
        assert xxhash.xxh64_intdigest((x % 2**64).to_bytes(8, "little"), hashing.SPARK_SEED) == target


def test_an_unknown_method_is_refused():
    with pytest.raises(ValueError):
        hashing.user_bucket(F.lit(1), 50, "xxh32")
