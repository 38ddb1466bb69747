"""The pipeline and the query registry against brute force on the small tables."""

import collections
import re

import corpus_pipeline
from pulselens.llm import queries, stages
from tests.conftest import SF001
from tests.llm.test_dedup import plain_components, plain_cut, plain_fingerprint, plain_leaks


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in queries.op3_language_id(spark, SF001).collect() if r.lang_pred != "und" and r.score > 0.5}
    rows = sorted((r.doc_id, r.text, r.lang, r.source) for r in docs.collect() if r.doc_id in kept)
    roots = plain_components([plain_fingerprint(t) for _, t, _, _ in rows], 4)
    rows = [x for k, (x, g) in enumerate(zip(rows, roots)) if k == g]
    cut = {i: (n, text) for i, _, n, text in plain_cut(rows, 13)}
    rows = [(i, cut[i][1] if cut[i][0] else t, lang, s) for i, t, lang, s in rows]
    words = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())
    seeds = {w for _, t in items for w in words(t)}
    rows = [x for x in rows if not (seeds & set(words(x[1])) and plain_leaks_of(x[1], items))]
    got = corpus_pipeline.run(spark, SF001).collect()
    assert sorted((r.doc_id, r.text, r.n_chars) for r in got) == sorted((i, t, len(t)) for i, t, _, _ in rows)
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r.mix_pos):
        by[r.source].append(r.mix_rank)
    assert all(v == list(range(len(v))) for v in by.values())
    assert collections.Counter(r.source for r in got) == collections.Counter(s for _, _, _, s in rows)


def plain_leaks_of(text, items):
    """Only alignments on which some five words in a row or nearly so agree need the slow check."""
    grams = lambda t: {tuple(w[i:i + 2]) for w in [re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())] for i in range(len(w))}
    own = grams(text)
    return plain_leaks(text, [(i, t) for i, t in items if len(own & grams(t)) >= 4])


def test_stage_names_and_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "substring_dedup",
                                                       "benchmark_decontamination", "source_mix"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF001).schema.names == docs.schema.names, name
    assert set(docs.columns) < set(stages.source_mix(spark, docs, SF001).columns)


def test_every_operator_has_a_query():
    assert {int(k[2:].split("_")[0]) for k in queries.Q} == set(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.Q)
