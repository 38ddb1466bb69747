"""Benchmark decontamination by spaced-seed hashing.

A seed is five words of a window seen through a fixed mask, which ignores the other positions: a substituted word under
an ignored position does not change the hash.  Seeds of the documents are joined with the seeds of the benchmark; each
hit fixes an alignment of a document with an item, and the aligned words around it are compared one by one.  A document
is contaminated by an item if some aligned stretch of at least ``min_words`` words agrees in ``similarity`` of them.

The benchmark is the small side: it is read in blocks of a bounded size, each broadcast as sorted seed hashes, so the
documents are read without any shuffle.  A benchmark larger than one block is joined block by block.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import SLICE_BYTES, id_text, ship_package
from .textkit import PUNCTUATION, U64, mix, run_starts, slices, utf8, word_hashes, words

#: All masks of five words within a span of five to seven words: first and last position always count.
WEIGHT, LONGEST = 5, 7
MASKS = tuple((0, *inner, span - 1) for span in range(WEIGHT, LONGEST + 1)
              for inner in combinations(range(1, span - 1), WEIGHT - 2))
#: Masks over whole items too short for those: all words of an item of fewer than five; of five, all but one.
SHORT = {**{n: (tuple(range(n)),) for n in range(1, WEIGHT)},
         WEIGHT: tuple(tuple(k for k in range(WEIGHT) if k != out) for out in range(WEIGHT))}
_FACTOR = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                            0xA0761D6478BD642F)]
_FILTER_BITS = 22


class _Words:
    """Lower-cased words (letters and digits; punctuation separates) of a column of texts."""

    def __init__(self, column: pa.Array):
        data, at = utf8(pc.utf8_lower(pc.fill_null(column, "")))
        self.starts, ends, self.first = words(data, at, PUNCTUATION)
        self.h = word_hashes(data, self.starts, ends)

    def seeds(self, mask: tuple[int, ...], span: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all stretches of ``span`` words (up to the mask's last position) seen through the mask, and the word at
        which each starts."""
        last = mask[-1] if span is None else span - 1
        at = np.flatnonzero(run_starts(self.first, last + 1))
        n = max(0, len(self.h) - last)
        total = np.zeros(n, U64)
        for k, offset in enumerate(mask):
            total += self.h[offset:offset + n] * _FACTOR[k]
        return mix(total[at]), at


def _index(items: list[tuple[int, str]]) -> dict:
    """Seeds of a block of benchmark items, sorted by hash, with a bitmap that rules out most other hashes."""
    w = _Words(pa.array([t for _, t in items], pa.string()))
    item = np.repeat(np.arange(len(items)), np.diff(w.first))
    hashes, places, kinds = [], [], []
    for kind, mask in enumerate(MASKS):
        h, at = w.seeds(mask)
        hashes.append(h + U64(kind))
        places.append(at)
    # items of up to five words are also looked up as wholes; documents try those lengths that occur alone
    sizes, short = np.diff(w.first), []
    for span, masks in SHORT.items():
        if (sizes == span).any():
            for mask in masks:
                kind = len(MASKS) + len(short)
                h, at = w.seeds(mask, span)
                whole = sizes[item[at]] == span
                hashes.append(h[whole] + U64(kind))
                places.append(at[whole])
                short.append((mask, span))
    h, at = np.concatenate(hashes), np.concatenate(places)
    order = np.argsort(h, kind="stable")
    h, at = h[order], at[order]
    seen = np.zeros(1 << _FILTER_BITS, bool)
    seen[(h >> U64(64 - _FILTER_BITS)).astype(np.int64)] = True
    return {"ids": np.array([i for i, _ in items], np.int64), "first": w.first, "words": w.h, "item": item,
            "hash": h, "at": at, "seen": seen, "short": short}


def best_stretch(equal: np.ndarray, min_words: int, similarity: float) -> tuple[int, int, float]:
    """``(start, words, share)`` of the longest stretch of at least ``min_words`` with that share of equal words.

    Of equally long stretches the first; ``(0, 0, 0.0)`` if there is none.
    """
    n = len(equal)
    if n < min_words:
        return 0, 0, 0.0
    count = np.concatenate([[0], np.cumsum(equal)])
    score = count - similarity * np.arange(n + 1) + 1e-9 * np.arange(n + 1)
    # the longest stretch ends at some j and starts at the first i whose score is not above the score at j
    low = np.minimum.accumulate(score)
    start = np.searchsorted(-low, -score[min_words:], "left")
    length = np.arange(min_words, n + 1) - start
    length[length < min_words] = 0
    k = int(np.argmax(length))
    if not length[k]:
        return 0, 0, 0.0
    i, m = int(start[k]), int(length[k])
    return i, m, float(count[i + m] - count[i]) / m


def _matches(batch: pa.RecordBatch, index: dict, min_words: int, similarity: float) -> tuple[np.ndarray, list[list]]:
    w = _Words(batch.column(batch.schema.get_field_index("text")))
    doc_of = np.repeat(np.arange(batch.num_rows), np.diff(w.first))
    found: set[tuple[int, int, int]] = set()
    for kind, (mask, span) in enumerate([*((m, None) for m in MASKS), *index["short"]]):
        h, at = w.seeds(mask, span)
        h += U64(kind)
        maybe = np.flatnonzero(index["seen"][(h >> U64(64 - _FILTER_BITS)).astype(np.int64)])
        if not len(maybe):
            continue
        h, at = h[maybe], at[maybe]
        low, high = np.searchsorted(index["hash"], h, "left"), np.searchsorted(index["hash"], h, "right")
        for a, l, r in zip(at[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist()):
            d = int(doc_of[a])
            for p in index["at"][l:r].tolist():
                # the alignment: where in the document the item's first word would be
                found.add((d, int(index["item"][p]), a - int(w.first[d]) - p + int(index["first"][index["item"][p]])))
    out: list[list] = [[] for _ in range(batch.num_rows)]
    for d, i, shift in sorted(found):
        a, b = index["first"][i], index["first"][i + 1]
        s, e = w.first[d], w.first[d + 1]
        low, high = max(0, -shift), min(b - a, e - s - shift)
        equal = index["words"][a + low:a + high] == w.h[s + shift + low:s + shift + high]
        at, n, share = best_stretch(equal, min(min_words, int(b - a)), similarity if b - a >= WEIGHT else 1.0)
        if n:
            out[d].append({"item_id": int(index["ids"][i]), "start": int(shift + low + at), "n_words": n, "similarity": share})
    return np.diff(w.first), out


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_words: int = 13, similarity: float = 0.8,
               block_bytes: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, content, n_words, matches)``; ``matches`` lists ``(item_id, start, n_words,
    similarity)`` of each aligned stretch, ``start`` counted in the document's words; ``content`` is the text's hash.

    An item of fewer than ``min_words`` words must agree over its whole length, one of fewer than five words in every word
    (so an item of one common word matches each document that holds it); one without words matches nothing.  Null texts have no words; items with null text or id are left out; empty tables give no
    rows or no matches; repeated rows are judged alike; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
                             ).where("item_id is not null and text is not null")
    size = bench.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    text = id_text(docs, id_col, text_col).withColumn("content", F.xxhash64("text"))
    row = ("doc_id long, content long, n_words long, "
           "matches array<struct<item_id: long, start: long, n_words: long, similarity: double>>")

    def joined(block: int) -> DataFrame:
        part = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        items = sorted((x.item_id, x.text) for x in part.distinct().collect())
        index = spark.sparkContext.broadcast(_index(items))

        def run(batches):
            for batch in batches:
                for b in slices(batch, limit=SLICE_BYTES):
                    n, m = _matches(b, index.value, min_words, similarity)
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n), pa.array(m, _MATCHES)],
                                                     names=["doc_id", "content", "n_words", "matches"])

        return text.mapInArrow(run, row)

    out = joined(0)
    if blocks > 1:
        # a row's matches from all blocks meet by id and content; each block counts a repeated row once
        for i in range(1, blocks):
            out = out.unionAll(joined(i))
        out = (out.groupBy("doc_id", "content", "n_words")
               .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("matches")))).alias("matches"),
                    F.expr(f"count(*) div {blocks}").alias("copies"))
               .withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))))
    return out.select("doc_id", "content", "n_words", "matches")


_MATCHES = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()),
                               ("similarity", pa.float64())]))
