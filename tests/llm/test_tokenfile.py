"""Token ids in patched frame-of-reference blocks: round trips, the library's ids, order and access by position."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from pulselens.llm import queries, tokenfile
from tests.conftest import SF001

WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["don't DON'T we'll it's", "e\u0301bc E\u0301", "x\u2003y\u00a0z", "<|endoftext|> a<|endoftext|>b <|EndOfText|> <|x", "日本語 😀 ß ẞ İstanbul ΣΑΣ",
       "tab\x1cq\x1fz", "3.14 1,000 ½ x²", "\x00 a\x00b", "× ÷ µ ª º", "", " \t\n", "a" * 3000, "ÀÖ×ØÞßàöøÿ Íí Àà", "Ã Ãa", "éa\u0301 É"]


@given(st.lists(st.integers(0, 2**32 - 1), max_size=700), st.sampled_from([8, 64, 128, 256]), st.sampled_from([0.01, 0.5, 0.9, 1.0]),
       st.integers(0, 700), st.integers(0, 700))
@settings(max_examples=150, deadline=None)
def test_round_trip(ids, block, percentile, a, b):
    x = np.array(ids, np.uint32)
    payload = tokenfile.pack(x, block, percentile)
    assert tokenfile.unpack(payload).tolist() == ids
    assert tokenfile.unpack(payload, a, b).tolist() == ids[a:b]


def test_few_large_ids_do_not_widen_a_block():
    x = np.full(128, 1000, np.uint32) + np.arange(128, dtype=np.uint32) % 8
    x[[3, 77]] = 2**32 - 1
    n, block, begin = tokenfile.block_starts(tokenfile.pack(x))
    assert (n, block, len(begin)) == (128, 128, 2)
    assert begin[1] - begin[0] == 6 + 3 * 16 + 2 * 5


def test_payload_must_have_the_magic():
    with pytest.raises(ValueError):
        tokenfile.unpack(b"none of it....")


@pytest.mark.parametrize("name, pieces", [("word_bpe_49k.json", True), ("word_bpe_49k.json", False), ("byte_bpe_50k.json", False)])
def test_encoder_equals_library(spark, name, pieces):
    path = public_tokenizers.path(name)
    with open(path, "rb") as f:
        encoder = tokenfile.Encoder(f.read(), pieces, room=200)
    library = Tokenizer.from_file(path)
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").select("text").collect()]
    for i in range(0, len(texts), 10):
        part = texts[i:i + 10]
        ids, size = encoder.encode(pa.array(part))
        for t, got in zip(part, np.split(ids, np.cumsum(size)[:-1])):
            assert got.tolist() == library.encode(t or "", add_special_tokens=False).ids


def test_pieces_are_refused_where_the_vocabulary_needs_whole_texts():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        raw = f.read()
    with pytest.raises(ValueError):
        tokenfile.Encoder(raw, True)


def plain(rows):
    """Documents in order with their ids by the library."""
    library = Tokenizer.from_file(WORDS)
    return {(i, t): [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}


def check(got, rows):
    want = plain(rows)
    known = sorted((i for i, _ in rows if i is not None))
    assert sorted((r.doc_id for r in got if r.doc_id is not None)) == known and len(got) == len(rows)
    got = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in got if r.doc_id is not None] == known
    assert [r.doc_id for r in got[:len(got) - len(known)]] == [None] * (len(got) - len(known))
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    digest = lambda ids: (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(i), *digest(want[i, t])) for i, t in rows)
    return got, want


def test_query_equals_library(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    check(queries.op13_token_ids(spark, SF001).collect(), rows)


def test_messy(spark, messy, messy_rows, none, tmp_path):
    path = tokenfile.write_ids(messy, WORDS, f"file://{tmp_path}/a")
    got, want = check(tokenfile.read_documents(spark, path).collect(), [(i, t) for i, t, _, _ in messy_rows])
    every = [x for r in sorted(tokenfile.read_range(spark, path, 0, 1 << 40).collect(), key=lambda r: r.start) for x in r.ids]
    assert sorted(every) == sorted(x for i, t, _, _ in messy_rows for x in want[i, t])
    found = sorted(tokenfile.read_range(spark, path, 3000, 9001).collect(), key=lambda r: r.start)
    assert found[0].start == 3000 and [x for r in found for x in r.ids] == every[3000:9001]
    empty = tokenfile.write_ids(none, WORDS, f"file://{tmp_path}/b")
    assert tokenfile.read_documents(spark, empty).collect() == []


def test_no_end_id(spark, tmp_path):
    docs = spark.createDataFrame([(2, "b c"), (1, None), (3, "b")], "doc_id long, text string")
    path = tokenfile.write_ids(docs, WORDS, f"file://{tmp_path}/a", end_id=None)
    assert [tuple(r)[:3] for r in tokenfile.read_documents(spark, path).orderBy("doc_id").collect()] == [(1, 0, 0), (2, 0, 2), (3, 2, 1)]
