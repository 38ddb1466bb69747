"""Phrase collocations against brute force; the guarantee of the summaries."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from pulselens.llm import phrases
from tests.llm.conftest import make_docs


def plain_counts(rows, most):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return f, n


def plain_collocations(rows, threshold=30, most=4, top=2000, share=80):
    out = []
    every, total = plain_counts(rows, most)
    for lang, f in every.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        gone = {p[i:j] for p, a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and p[i:j] in cand and 100 * a >= share * cand[p[i:j]]}
        best = []
        for p, a in cand.items():
            if p not in gone:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, total[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(best)[:top])]
    return sorted(out)


def told(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def lines(seed, count):
    r = random.Random(seed)
    vocabulary = [w for w in "the of and to Zug é日 a-b x 10% naïve".split()]
    fixed = ["once upon a time", "the end of the line", "in the\tmiddle  of", "à la carte"]
    out = []
    for _ in range(count):
        text = ""
        for _ in range(r.randint(0, 30)):
            text += r.choice([r.choice(vocabulary), r.choice(fixed), r.choice(fixed).upper(), f"w{r.randint(0, 400)}"])
            text += r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "! ? "])
        out.append((text, r.choice(["en", "en", "en", "de", None, "und"])))
    return out


@pytest.mark.parametrize("filter_bytes", [64, 1 << 16])
def test_equals_brute_force_even_with_a_full_filter(spark, filter_bytes):
    rows = lines(1, 2500)
    docs = make_docs(spark, [(i, t, lang, "a") for i, (t, lang) in enumerate(rows)])
    want = plain_collocations(rows)
    assert len(want) > 100
    assert told(phrases.collocations(docs, filter_bytes=filter_bytes)) == want


def test_other_parameters(spark):
    rows = lines(2, 200)
    docs = make_docs(spark, [(i, t, lang, "a") for i, (t, lang) in enumerate(rows)])
    got = told(phrases.collocations(docs, threshold=8, max_words=3, top=25, share=50, filter_bytes=1 << 16))
    assert got == plain_collocations(rows, 8, 3, 25, 50)
    with pytest.raises(ValueError):
        phrases.collocations(docs, max_words=5)


def test_messy_and_empty(spark, messy, messy_rows, none):
    rows = [(t, lang) for _, t, lang, _ in messy_rows]
    assert told(phrases.collocations(messy, threshold=5, filter_bytes=1 << 16)) == plain_collocations(rows, 5)
    assert told(phrases.collocations(messy, threshold=300, filter_bytes=1 << 16)) == plain_collocations(rows, 300)
    assert told(phrases.collocations(none)) == []


def test_counts_beyond_64_bits_stay_exact(spark):
    """Scores of very large counts: the same expression over a made count table."""
    row = spark.sql("select cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) div cast(l + r as decimal(20,0)) as s "
                    "from values (4000000000000000001L, 4000000000000000002L, 4000000000000000005L) t(a, l, r)").first()
    assert row.s == 2000000 * 4000000000000000001 // 8000000000000000007


@given(st.lists(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 9)), max_size=80), max_size=8), st.integers(2, 40), st.booleans())
@settings(max_examples=200, deadline=None)
def test_no_frequent_key_is_lost(summaries, threshold, eager):
    true, mass = Counter(), 0
    for s in summaries:
        for k, n in s:
            true[k] += n
            mass += n
    mg = phrases.MisraGries(mass // threshold + 1)
    for s in summaries:
        mg.merge(np.array([k for k, _ in s], np.uint64), np.array([n for _, n in s], np.int64))
        if eager:
            mg.reduce()
            assert len(mg.key) <= mg.capacity
    found = set(mg.survivors(threshold).tolist())
    assert {k for k, n in true.items() if n >= threshold} <= found
    assert mg.lost < threshold
    held = dict(zip(mg.key.tolist(), mg.n.tolist()))
    assert all(held.get(k, 0) <= n <= held.get(k, 0) + mg.lost for k, n in true.items())


@given(st.sets(st.integers(0, 2**48 - 1), min_size=1, max_size=300))
@settings(max_examples=100, deadline=None)
def test_sent_hashes_come_back(keys):
    key = np.array(sorted(keys), np.uint64) << np.uint64(16)
    assert phrases._decoded(phrases._coded(key)).tolist() == key.tolist()
