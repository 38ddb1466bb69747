"""Document fingerprints by consistent weighted sampling (Ioffe 2010).

A document is a set of terms (words), each weighing as often as it occurs.  For each of ``samples`` draws every term has
fixed gamma-distributed numbers that come from its hash alone; the term whose transformed weight is smallest is the
sample, together with the level its weight reached.  Two documents agree in a sample with the probability of their
generalised Jaccard similarity: the sum of smaller weights over the sum of larger ones.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from .common import id_text, n_partitions, ship_package
from .textkit import U64, mix, utf8, word_hashes, words

#: Texts that one numpy pass takes, and bits of the hash that name the text instead of the term.
_TEXTS, _TEXT_BITS = 2048, 12
_CHUNK_BYTES = 1 << 21
_PAIRS = 4096
_TERM = ~U64((1 << _TEXT_BITS) - 1)


def _draws(term: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2, 1) ``r``, the logarithm of another, and uniform ``beta`` for each term and sample."""
    k = np.arange(1, samples + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)
    x = mix(term[:, None] + k)
    y = mix(term[:, None] ^ (k * U64(0xC2B2AE3D27D4EB4F)))

    def uniform(z: np.ndarray, shift: int) -> np.ndarray:
        return ((z >> U64(shift)) & U64(0xFFFFFF)).astype(np.float32) * np.float32(2 ** -24) + np.float32(2 ** -25)

    r = -(np.log(uniform(x, 40)) + np.log(uniform(x, 16)))
    c = np.log(-(np.log(uniform(y, 40)) + np.log(uniform(y, 16))))
    beta = ((x & U64(0xFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(2 ** -16)
    return r, c, beta


def signatures(column: pa.Array, samples: int) -> np.ndarray:
    """``(texts, samples)`` 16-bit codes; a text without words has code 0 everywhere.  At most ``_TEXTS`` texts."""
    data, at = utf8(column)
    s, e, first = words(data, at)
    n = len(column)
    doc = np.repeat(np.arange(n, dtype=U64), np.diff(first))
    pair = np.sort((word_hashes(data, s, e) & _TERM) | doc)
    cut = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
    weight = np.log(np.diff(np.concatenate([cut, [len(pair)]])).astype(np.float32))
    pair = pair[cut]
    term, doc = pair & _TERM, (pair & ~_TERM).astype(np.int64)
    best = np.full((n, samples), np.inf, np.float32)
    code = np.zeros((n, samples), np.uint16)
    for i in range(0, len(pair), _PAIRS):
        rows = slice(i, i + _PAIRS)
        order = np.argsort(doc[rows], kind="stable")
        t, d, w = term[rows], doc[rows][order], weight[rows][order]
        distinct, back = np.unique(t, return_inverse=True)
        r, c, beta = (z[back[order]] for z in _draws(distinct, samples))
        level = np.floor(w[:, None] / r + beta)
        value = c - r * (level - beta + 1)
        begin = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        low = np.minimum.reduceat(value, begin, axis=0)
        here = d[begin]
        better = low < best[here]
        best[here] = np.where(better, low, best[here])
        size = np.diff(np.concatenate([begin, [len(d)]]))
        hit = (value == np.repeat(low, size, axis=0)) & np.repeat(better, size, axis=0)
        at_pair, at_sample = np.nonzero(hit)
        h = t[order][at_pair] + level[at_pair, at_sample].astype(np.int64).view(U64) * U64(0xD6E8FEB86659FD93)
        code[d[at_pair], at_sample] = (mix(h) >> U64(48)).astype(np.uint16)
    return code


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, row by row."""
    return (a == b).mean(axis=1)


def _hex(codes: np.ndarray) -> list[str]:
    raw = codes.astype(">u2").tobytes()
    width = codes.shape[1] * 2
    return [raw[i:i + width].hex() for i in range(0, len(raw), width)]


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _ordered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(range, last, place, doc_id, text)``: rows dealt to ranges of the id order; the row that follows each range's last
    one is repeated at its end (``last`` true), the first row of all after the last.

    Ranges are cut at approximate quantiles, and there are four times as many as shuffle partitions.  Rows without id
    come first, in the order of a hash of their text; equal ids are ordered by text.
    """
    spark = docs.sparkSession
    n = 4 * n_partitions(spark)
    base = id_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    cuts = docs.select(F.percentile_approx(F.col(id_col).cast("long").cast("double"), [i / n for i in range(1, n)], 10 * n)).first()[0]
    splits = [float("-inf"), *sorted(set(cuts or [])), float("inf")]
    by_id = Bucketizer(splits=splits if len(splits) > 2 else [float("-inf"), 0.0, float("inf")], inputCol="at",
                       outputCol="bucket", handleInvalid="keep")
    known = by_id.transform(base.withColumn("at", F.col("doc_id").cast("double")))
    h = F.xxhash64("text")
    place = F.coalesce("doc_id", h)
    spread = F.shiftright(F.shiftright(h, 40) * n, 24) - n - 1  # hash ranges of rows without id: all below 0
    rows = known.select(F.when(F.col("doc_id").isNull(), spread - n).otherwise(F.col("bucket").cast("long")).alias("range"),
                        place.alias("place"), "doc_id", "text")
    heads = rows.groupBy("range").agg(F.min("place").alias("place"))
    every = Window.orderBy("range")  # one row a range
    ahead = heads.select("place", "range", F.coalesce(
        F.lag("range").over(every), F.max("range").over(Window.partitionBy())).alias("before"))
    follow = (rows.join(F.broadcast(ahead), ["range", "place"]).groupBy("before", "place")
              .agg(F.min("text").alias("text")))
    return rows.select("range", F.lit(False).alias("last"), "place", "doc_id", "text").unionAll(
        follow.select(F.col("before").alias("range"), F.lit(True).alias("last"), "place",
                      F.lit(None).cast("long").alias("doc_id"), "text"))


def fingerprints(docs: DataFrame, samples: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``.

    A fingerprint is ``samples`` 16-bit codes in hex; ``near_*`` is the share of equal codes.  The next row is that of
    the next larger ``doc_id``, and the first after the last; rows without id stand before all others.  A null text is
    empty, texts without words have the fingerprint of the empty text, equal texts equal fingerprints.  Repeated rows
    follow one another; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    n = n_partitions(spark)
    rows = (_ordered(docs, id_col, text_col).repartitionById(n, F.pmod("range", F.lit(n)).cast("int"))
            .sortWithinPartitions("range", "last", "place", "text"))  # four whole ranges to a partition

    def compare(ids: list, texts: list, keep: list[bool]) -> pa.RecordBatch:
        """Rows but the last, which is only the next of the one before; ``keep`` is false for repeated heads."""
        own = signatures(pa.array(texts, pa.large_string()), samples)
        new = [edited(a, b) for a, b in zip(texts, texts[1:])]
        changed = signatures(pa.array(new, pa.large_string()), samples)
        out = pa.RecordBatch.from_arrays(
            [pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
             pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
             pa.array(_hex(own[:-1]), pa.string()), pa.array(_hex(changed), pa.string()),
             pa.array(likeness(own[:-1], changed)), pa.array(likeness(own[:-1], own[1:]))], names=_COLUMNS)
        return out.filter(pa.array(keep[:-1]))

    def run(batches):
        ids: list = []
        texts: list[str] = []
        keep: list[bool] = []
        size = 0
        for batch in batches:
            for b in batch.to_pylist():
                ids.append(b["doc_id"])
                texts.append(b["text"])
                keep.append(not b["last"])
                size += len(b["text"])
                if size >= _CHUNK_BYTES and len(texts) > 1 or len(texts) == _TEXTS:
                    yield compare(ids, texts, keep)
                    ids, texts, keep, size = ids[-1:], texts[-1:], keep[-1:], len(texts[-1])
        if len(texts) > 1:
            yield compare(ids, texts, keep)

    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")


_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
