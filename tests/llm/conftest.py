import random

import pytest
from pyspark.sql import types as T

#: Names that operators use for their own columns, here as extra columns of the input.
CLASHES = ["fp", "component_id", "score", "lang_pred", "block", "low", "key", "n_words", "matches", "content", "h", "range",
           "last", "place", "bucket", "at", "held_out", "label", "f0", "mix_pos", "mix_slot", "source_key", "kept",
           "part", "tie", "ids", "word", "n", "phrase", "form", "root", "start", "first"]

_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                        T.StructField("n_chars", T.LongType()), *(T.StructField(c, T.StringType()) for c in CLASHES)])


def make_docs(spark, rows):
    """Documents ``(doc_id, text, lang, source)`` with extra columns whose names clash."""
    full = [(i, t, lang, src, None if t is None else len(t), *(["x"] * len(CLASHES))) for i, t, lang, src in rows]
    return spark.createDataFrame(full, _SCHEMA)


def sentence(r, n, stem="abcdefgh"):
    return " ".join("".join(r.choice(stem) for _ in range(r.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls, empty, blank and very long texts, repeated rows and ids, copies and shared passages."""
    r = random.Random(3)
    long = sentence(r, 30_000)
    shared = sentence(r, 40)
    rows = [(i, sentence(r, r.randint(1, 80)), r.choice(["en", "de", None]), r.choice(["a", "b", None])) for i in range(40)]
    rows += [(50, long, "en", "a"), (51, long, "en", "a"), (52, "", "en", "a"), (53, None, "en", "a"), (54, " \t\n ", "de", "b"),
             (55, "Zß Ünïcödé 日本語 😀 \x0b tail", "de", "b"), (None, shared + " x", "en", "a"), (None, None, None, None),
             (None, shared, None, "b")]
    rows += [(60 + i, sentence(r, 5) + " " + shared + "\n" + sentence(r, 6), "en", "c") for i in range(6)]
    rows += [(70, rows[3][1], "en", "b"), (71, rows[3][1], "en", "b"), (72, "one two", "en", "b"), (72, "one two", "en", "b"),
             (73, rows[4][1] + " tail", "en", "b"), (-5, shared, "de", "c"), (74, "123 !!! --", None, "a")]
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return make_docs(spark, messy_rows)


@pytest.fixture(scope="session")
def none(spark):
    return make_docs(spark, [])
