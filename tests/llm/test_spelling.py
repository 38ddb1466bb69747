"""Spelling variants against brute force; filters and their groups."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pulselens.llm import bloom, queries, spelling
from tests.conftest import SF001
from tests.llm.conftest import make_docs

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_vocabulary(rows, misspell=97):
    n = Counter()
    for i, t in rows:
        for w in RUN.findall(t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if misspell and h % misspell == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def plain_near(vocab):
    """By the words with one place masked, and the words with one letter less."""
    near = defaultdict(set)
    masked = defaultdict(set)
    for w in vocab:
        for i in range(len(w)):
            masked[w[:i], w[i + 1:]].add(w)
            less = w[:i] + w[i + 1:]
            if less in vocab:
                near[w].add(less)
                near[less].add(w)
    for group in masked.values():
        for a in group:
            near[a] |= group - {a}
    return near


def plain_variants(rows, misspell=97):
    vocab = plain_vocabulary(rows, misspell)
    near = plain_near(vocab)
    form = {}
    for w, n in vocab.items():
        best = min(near[w], key=lambda x: (-vocab[x], x), default=None)
        form[w] = best if best is not None and vocab[best] >= 2 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), n, len(near[w]), vocab[form[w]] if form[w] else -1) for w, n in vocab.items())


def told(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = queries.op11_spelling_variants(spark, SF001)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants(rows)
    assert len(want) > 500 and told(got) == want


@pytest.mark.parametrize("filter_bytes", [64, 640, 1 << 20])
def test_many_near_words_in_any_number_of_groups(spark, filter_bytes):
    r = random.Random(5)
    stems = ["".join(r.choice("abcé") for _ in range(r.randint(5, 9))) for _ in range(40)]
    stems += ["x" * 70, "x" * 69 + "y", "x" * 71, "x" * 63, "x" * 64, "aabbc" * 40]
    text = " ".join(w for s in stems for w in [s] * r.randint(3, 40))
    for _ in range(150):
        s, k = r.choice(stems), r.randint(0, 4)
        text += f" {s[:k]}{r.choice(['', 'a', 'zé', 'ÿ'])}{s[k + 1:]}" * r.randint(1, 5)
    rows = [(1, text), (2, text.upper()), (3, None)]
    docs = make_docs(spark, [(i, t, None, None) for i, t in rows])
    assert told(spelling.variants(docs, 97, filter_bytes=filter_bytes)) == plain_variants(rows)


def test_chains_of_forms_lead_to_one_root(spark):
    words = ["aaaaaaaa"]
    for k in range(8):
        words.append(words[-1][:k] + "b" + words[-1][k + 1:])
    text = " ".join(w for k, w in enumerate(words) for _ in range(3 * 2 ** k))
    got = {r.word: r for r in spelling.variants(make_docs(spark, [(1, text, None, None)])).collect()}
    assert {r.root for r in got.values()} == {"b" * 8} and got["b" * 8].form is None
    assert got["a" * 8].form == words[1]


def test_ties_take_the_smaller_word(spark):
    text = " ".join(["above"] * 6 + ["abode"] * 6 + ["abole"] * 3)
    got = {r.word: r for r in spelling.variants(make_docs(spark, [(1, text, None, None)])).collect()}
    assert got["abole"].form == "abode" and got["abole"].n_near == 2 and got["above"].form is None


def test_messy_and_empty(spark, messy, messy_rows, none):
    rows = [(i, t) for i, t, _, _ in messy_rows]
    assert told(spelling.variants(messy, 97)) == plain_variants(rows)
    assert told(spelling.variants(messy, 0)) == plain_variants(rows, 0)
    assert told(spelling.variants(none, 97)) == []
    short = make_docs(spark, [(1, "to be", None, None)])
    assert told(spelling.variants(short, 97)) == []


def test_checksum_of_long_words():
    words = [b"a" * n for n in (1, 63, 64, 65, 200)]
    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    start = end - [len(w) for w in words]
    before = np.array([zlib.crc32(b"7:")] * len(words), np.uint32)
    assert spelling._crc32(data, start, end, before).tolist() == [zlib.crc32(b"7:" + w) for w in words]


def test_filter_holds_its_keys_and_few_others():
    r = np.random.default_rng(2)
    h = r.integers(0, 2**64, 20_000, dtype=np.uint64)
    n = len(h) * spelling.WORD_BITS // bloom.BLOCK_BITS + 1
    data = bloom.blocks(h, bloom.block_of(h, n), 0, n)
    assert len(bloom.holds(data, h, bloom.block_of(h, n))) == len(h)
    other = r.integers(0, 2**64, 200_000, dtype=np.uint64)
    assert len(bloom.holds(data, other, bloom.block_of(other, n))) < 0.01 * len(other)
