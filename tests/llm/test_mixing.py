"""Pfair mixing and the pipeline."""

import collections
import hashlib
import random
from fractions import Fraction
from math import ceil, floor

import duckdb
import pytest
from pyspark.sql import functions as F

from pulselens.llm import mixing, queries, stages
from tests.llm.conftest import make_docs


def plain_schedule(parts):
    """Earliest deadline first, slot by slot."""
    d, k, out = sum(parts.values()), collections.Counter(), []
    for t in range(d):
        ready = [(ceil(Fraction((k[s] + 1) * d, m)), i, s) for i, (s, m) in enumerate(sorted(parts.items()))
                 if floor(Fraction(k[s] * d, m)) <= t]
        due, _, s = min(ready)
        assert due > t
        out.append(s)
        k[s] += 1
    return out


@pytest.mark.parametrize("weights", [{"a": 5, "b": 3, "c": 1, "d": 1}, {"a": 1}, {"a": 90, "b": 7, "c": 2, "d": 1}, {"a": 1, "b": 1, "c": 1}])
def test_schedule_is_pfair(spark, weights):
    w = spark.createDataFrame(list(weights.items()), "source string, weight long")
    rows = sorted(mixing.schedule(w, 100).collect(), key=lambda r: r.slot)
    parts = {r.key: r.m for r in rows}
    assert [r.slot for r in rows] == list(range(rows[0].d)) and rows[0].d == sum(parts.values())
    assert [r.key for r in rows] == plain_schedule(parts)
    given = collections.Counter()
    for t, r in enumerate(rows):
        given[r.key] += 1
        assert all(abs(given[s] - Fraction((t + 1) * m, r.d)) < 1 for s, m in parts.items())


def test_weights_bounds(spark):
    w = spark.createDataFrame([("a", 1), ("b", 0), ("c", None), (None, 2), ("d", -1)], "source string, weight long")
    assert {r.key for r in mixing.schedule(w).collect()} == {"=a", ""}
    with pytest.raises(ValueError):
        mixing.schedule(w, max_sources=1)
    assert mixing.schedule(w.where("false")).collect() == []


def test_thousands_of_sources(spark):
    docs = spark.range(12_000).selectExpr("id AS doc_id", "concat('s', id % 6000) AS source")
    rows = mixing.mix(docs, block_docs=8).collect()
    assert len(rows) == 12_000 and sorted({r.mix_slot for r in rows}) == list(range(6000))
    assert all(r.mix_rank in (0, 1) for r in rows)


def test_sql_follows_exact_weights_on_skewed_sources(spark, tmp_path):
    """A hot source, sources of odd sizes and rows without source."""
    sizes = {"hot": 3001, "b": 1009, "c": 613, None: 97, "d": 10, "e": 1}
    rows = [(s, n) for s, n in sizes.items() for _ in range(n)]
    random.Random(2).shuffle(rows)
    docs = make_docs(spark, [(i, "t", "en", s) for i, (s, _) in enumerate(rows)])
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    columns = ["doc_id", "source", "mix_rank", "mix_slot", "mix_pos", "mix_on_target"]
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES['op4_source_mix']})").fetchall()
    got = queries.op4_source_mix(spark, str(tmp_path)).select(columns).collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) == len(rows)


def test_mix_of_odd_tables(spark, messy, none, messy_rows):
    w = spark.createDataFrame([("a", 2), ("b", 1), (None, 1)], "source string, weight long")
    got = mixing.mix(messy, w, block_docs=2, period=20)
    rows = got.collect()
    assert len(rows) == len(messy_rows) and set(messy.columns) <= set(got.columns) and len(got.columns) == len(set(got.columns))
    assert all((r.mix_slot is None) == (r.source not in ("a", "b", None)) for r in rows)
    placed = sorted((r for r in rows if r.mix_pos is not None), key=lambda r: r.mix_pos)
    assert len({r.mix_pos for r in placed}) == len(placed)
    for s in ("a", "b", None):
        own = [r for r in placed if r.source == s]
        assert [r.mix_rank for r in own] == list(range(len(own)))
        key = lambda r: hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()
        assert [key(r) for r in own] == sorted(map(key, own))
    # up to the first source's end no slot is empty and no source is a block away from its share
    on = [r for r in placed if r.mix_on_target]
    assert on and [r.mix_pos for r in on] == list(range(len(on)))
    n = collections.Counter()
    share = {"a": Fraction(1, 2), "b": Fraction(1, 4), None: Fraction(1, 4)}
    for t in range(len(on) // 2):
        n[on[2 * t].source] += 1
        assert on[2 * t].source == on[2 * t + 1].source
        assert all(abs(n[s] - (t + 1) * x) < 1 for s, x in share.items())
    assert mixing.mix(none, w).collect() == [] and mixing.mix(none).collect() == []


@pytest.mark.parametrize("weights, period", [(None, 1000), ({"hot": 1407, **{f"s{i}": 451 + i for i in range(19)}}, 50)])
def test_shares_follow_the_given_weights(spark, weights, period):
    """A third of the rows in one source: no rounding of the weights may add up over the periods."""
    sizes = {"hot": 7000, **{f"s{i}": 700 + i for i in range(19)}}
    docs = spark.createDataFrame([(i, s) for s, n in sizes.items() for i in range(n)], "doc_id long, source string")
    given = mixing.root_weights(docs) if weights is None else spark.createDataFrame(list(weights.items()), "source string, weight long")
    w = {r.source: r.weight for r in given.collect()}
    total, n = sum(w.values()), collections.Counter()
    rows = mixing.mix(docs, given, block_docs=1, period=period).collect()
    assert len(rows) == sum(sizes.values()) and len({r.mix_pos for r in rows}) == len(rows)
    on = sorted((r.mix_slot, r.source) for r in rows if r.mix_on_target)
    assert len(on) > 8000 and [t for t, _ in on] == list(range(len(on)))
    for t, s in on:
        n[s] += 1
        assert all(abs(n[x] * total - (t + 1) * w[x]) < total for x in ("hot", "s0", "s18", s))


def test_place_does_not_depend_on_partitions(spark, messy):
    one = None
    for n in ("3", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = sorted((str(r.doc_id), str(r.source), r.mix_pos) for r in mixing.mix(messy).collect())
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert one is None or got == one
        one = got


def test_mix_stage_writes_in_order(spark, tmp_path):
    r = random.Random(0)
    docs = make_docs(spark, [(i, "t", "en", r.choice("aaab")) for i in range(300)])
    stages.source_mix(spark, docs, "").write.parquet(f"{tmp_path}/out")
    parts = (spark.read.parquet(f"{tmp_path}/out").select("mix_pos", F.input_file_name().alias("f"),
                                                          F.monotonically_increasing_id().alias("i")).collect())
    by_file = collections.defaultdict(list)
    for x in sorted(parts, key=lambda x: x.i):
        by_file[x.f].append(x.mix_pos)
    assert all(v == sorted(v) for v in by_file.values())
    ranges = sorted((v[0], v[-1]) for v in by_file.values())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_native_plan(spark, messy):
    plan = mixing.mix(messy)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
