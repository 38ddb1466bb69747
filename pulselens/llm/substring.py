"""Substring dedup by relative Lempel-Ziv parsing over blocks of documents.

Documents are dealt to blocks.  Every block is both a reference (it indexes the phrases, runs of ``window`` words, of
its documents) and a target (its documents are parsed against the indices of all blocks).  A document's greedy parse
starts a factor at the first phrase that an earlier document holds, extends it word by word while that same earlier
document goes on matching at the following words, and looks up the phrases that straddle the factor's end before it goes
on.  Factors of at least ``window`` words are the duplicate spans.

What crosses the network, besides one shuffle of the texts by block that all steps reuse:

1. anchors: the smallest hash of the five-word runs inside each phrase.  Equal phrases have equal anchors, and
   neighbouring phrases mostly share theirs, so a block sends one row per distinct anchor (about a fifth of its words).
   Only anchors found in two or more documents go on;
2. phrases under such anchors: one row per distinct phrase of a block, answered with the smallest document id that
   holds it and the phrase's first word there, if that id is smaller than some document's id in the block.

A phrase that very many documents share sends at most one row per block, so no key has more rows than there are
blocks, and a block's share of memory is bounded by the number of blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import SLICE_BYTES, id_text, n_partitions, ship_package
from .textkit import run_hashes, run_starts, slices, utf8, word_hashes, words

#: Words of an anchor.
ANCHOR = 5
#: Bytes of text in a block, on average; a task holds one block at a time.
BLOCK_BYTES = 64 << 20


class _Parsed:
    """Words of a run of rows, and the hashes of their phrases."""

    def __init__(self, batch: pa.RecordBatch, window: int):
        self.data, self.at = utf8(batch.column(batch.schema.get_field_index("text")))
        self.starts, self.ends, self.first = words(self.data, self.at)
        self.h = word_hashes(self.data, self.starts, self.ends)
        self.window = window
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        self.known = ~np.asarray(ids.is_null())
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.at_phrase = np.flatnonzero(run_starts(self.first, window))
        self.doc = np.repeat(np.arange(len(self.ids)), np.diff(self.first))[self.at_phrase]
        keep = self.known[self.doc]
        self.at_phrase, self.doc = self.at_phrase[keep], self.doc[keep]

    def anchors(self) -> np.ndarray:
        k = min(ANCHOR, self.window)
        g = run_hashes(self.h, k)
        n, low, span = self.window - k + 1, g, 1
        while span * 2 <= n:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < n:
            rest = n - span
            low = np.minimum(low[:len(low) - rest], low[rest:])
        return low[self.at_phrase]

    def phrases(self) -> np.ndarray:
        return run_hashes(self.h, self.window)[self.at_phrase]

    def places(self) -> np.ndarray:
        """The first word of each phrase, counted in its document."""
        return self.at_phrase - self.first[self.doc]


def _distinct(key: np.ndarray, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys with the smallest and the largest id of each, and the first place in the document of the smallest."""
    if not len(key):
        return key, low, high, place
    order = np.argsort(key, kind="stable")
    key, low, high, place = key[order], low[order], high[order], place[order]
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    least = np.minimum.reduceat(low, cut)
    here = low == np.repeat(least, np.diff(np.concatenate([cut, [len(key)]])))
    return (key[cut], least, np.maximum.reduceat(high, cut),
            np.minimum.reduceat(np.where(here, place, np.iinfo(np.int64).max), cut))


def _index(block: int, parts: list[tuple]) -> pa.Table:
    parts = parts or [(np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)]
    key, low, high, place = _distinct(*(np.concatenate(x) for x in zip(*parts)))
    place = place.astype(np.uint32).byteswap().astype(np.uint64) << np.uint64(32)
    return pa.table({"differ": pa.array(high ^ low), "place": pa.array((place | np.uint64(block)).view(np.int64)),
                     "key": pa.array(key.view(np.int64)), "low": pa.array(low)})


#: The columns that hardly change from row to row stand together, which halves what a compressed row adds to its hash;
#: for the same reason the largest id is given by the bits in which it differs from the smallest, mostly none, and
#: ``place`` holds the block in its lower half and the place, smallest byte last, in its upper half, next to the hash.
_INDEX = "differ long, place long, key long, low long"


def _member(sorted_keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are in ``sorted_keys``, and where."""
    if not len(sorted_keys):
        return np.zeros(len(key), bool), np.zeros(len(key), np.int64)
    where = np.minimum(np.searchsorted(sorted_keys, key), len(sorted_keys) - 1)
    return sorted_keys[where] == key, where


def _sorted(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The keys in ascending order, and the row of each."""
    key = table.column("key").to_numpy().view(np.uint64)
    order = np.argsort(key)
    return key[order], order


def _held(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, order = _sorted(table)
    place = table.column("place").to_numpy()[order].view(np.uint64) >> np.uint64(32)
    return key, table.column("low").to_numpy()[order], place.astype(np.uint32).byteswap().astype(np.int64)


def _chunks(table: pa.Table):
    for batch in table.to_batches():
        yield from slices(batch, limit=SLICE_BYTES)


def parse(held_by: np.ndarray, held_at: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """Greedy factors ``(first word, words, reference, first word there)`` of one document.

    ``held_by[i]`` is the reference that holds the phrase starting at word i, or -1, and ``held_at[i]`` the phrase's
    place in it.  A factor goes on word by word while the same reference holds the next phrase at its next word, so the
    reference holds the whole factor.  At its end the phrases that straddle the boundary are looked up before the parse
    moves on: the factors cover every word of every held phrase, and neighbours may overlap.
    """
    at = np.flatnonzero(held_by >= 0)
    if not len(at):
        return []
    ref, there = held_by[at], held_at[at]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (ref[1:] != ref[:-1]) | (np.diff(there) != 1)]))
    stop = np.concatenate([new[1:], [len(at)]])
    return [(int(at[i]), int(at[j - 1] - at[i]) + window, int(ref[i]), int(there[i])) for i, j in zip(new, stop)]


def factors(docs: DataFrame, window: int = 13, blocks: int | None = None,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, text, n_words, n_removed, kept, factors)``.

    ``factors`` lists ``(start, n_words, ref_doc, ref_start)``: the ``n_words`` words from ``start`` on are those of
    ``ref_doc`` from its word ``ref_start`` on.  Words covered by any of them are removed.  ``kept`` is the text without
    them: unchanged if nothing is removed, else the kept words joined by one space.  Words are runs of other than the
    six ASCII white-space bytes, unchanged.  A phrase's reference is the first place in the document of the smallest id
    that holds it; if several rows have that id, a factor's phrases may be in different ones of them.

    A phrase counts as a duplicate only if a smaller ``doc_id`` holds it, judged on the input.  A null text has no
    words; a text of fewer than ``window`` words has no phrase; repeats inside one document, or among rows with the
    same id, are left; a null ``doc_id`` has no order: its text stays whole and is no reference; an empty table gives
    no rows; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    text = id_text(docs, id_col, text_col)
    if blocks is None:
        size = text.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        blocks = max(4 * n_partitions(spark), -(-size // BLOCK_BYTES))
    deal = F.coalesce(F.col("doc_id"), F.xxhash64("text"))
    text = text.withColumn("block", F.pmod(F.xxhash64(deal), F.lit(blocks)).cast("int"))

    def anchors(table: pa.Table) -> pa.Table:
        parts = []
        for b in _chunks(table):
            p = _Parsed(b, window)
            ids = p.ids[p.doc]
            parts.append(_distinct(p.anchors(), ids, ids, np.zeros(len(ids), np.int64)))
        return _index(table.column("block")[0].as_py(), parts)

    def phrases(table: pa.Table, shared: pa.Table) -> pa.Table:
        if not table.num_rows or not shared.num_rows:
            return _index(0, [])
        known, _ = _sorted(shared)
        parts = []
        for b in _chunks(table):
            p = _Parsed(b, window)
            hit, _ = _member(known, p.anchors())
            ids = p.ids[p.doc][hit]
            parts.append(_distinct(p.phrases()[hit], ids, ids, p.places()[hit]))
        return _index(table.column("block")[0].as_py(), parts)

    def apply(table: pa.Table, held: pa.Table) -> pa.Table:
        index = _held(held)
        out = [_cut(b, *index, window) for b in _chunks(table)]
        return pa.Table.from_batches(out, schema=_CUT)

    by_block = text.groupBy("block")
    per_key = Window.partitionBy("key")
    block = F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("block")
    upper = F.col("first").bitwiseAND(F.lit(-1 << 32)).alias("place")
    # window functions take plain columns only: an expression in one would cross the network as a further column
    shared = (by_block.applyInArrow(anchors, _INDEX)
              .withColumns({"lowest": F.min("low").over(per_key), "highest": F.max("low").over(per_key),
                            "least": F.min("differ").over(per_key), "most": F.max("differ").over(per_key)})
              .where("lowest < highest or least <> 0 or most <> 0").select(block, "key"))
    # an id lies in one block, so the smallest one's row of a key is unique
    held = (by_block.cogroup(shared.groupBy("block")).applyInArrow(phrases, _INDEX)
            .withColumns({"lowest": F.min("low").over(per_key), "first": F.min_by("place", "low").over(per_key)})
            .where("lowest < (low ^ differ)").select(block, upper, "key", F.col("lowest").alias("low")))
    return by_block.cogroup(held.groupBy("block")).applyInArrow(
        apply, "doc_id long, text string, n_words long, n_removed long, kept string, "
               "factors array<struct<start: long, n_words: long, ref_doc: long, ref_start: long>>")


_FACTOR = pa.struct([("start", pa.int64()), ("n_words", pa.int64()), ("ref_doc", pa.int64()),
                     ("ref_start", pa.int64())])
_CUT = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                  ("kept", pa.string()), ("factors", pa.list_(_FACTOR))])


def _cut(batch: pa.RecordBatch, keys: np.ndarray, lows: np.ndarray, places: np.ndarray, window: int) -> pa.RecordBatch:
    """Parse each row's text against the held phrases and remove what the factors cover."""
    p = _Parsed(batch, window)
    hit, where = _member(keys, p.phrases())
    hit[hit] = lows[where[hit]] < p.ids[p.doc[hit]]
    ref, there, at, doc = lows[where[hit]], places[where[hit]], p.at_phrase[hit], p.doc[hit]
    texts = batch.column(batch.schema.get_field_index("text"))
    kept: list = texts.to_pylist()
    n_words, removed = np.diff(p.first), np.zeros(len(kept), np.int64)
    spans: list[list] = [[] for _ in kept]
    raw = p.data
    bound = np.searchsorted(doc, np.arange(len(kept) + 1))
    for d in np.unique(doc):
        a, b = p.first[d], p.first[d + 1]
        held_by = np.full(b - a, -1, np.int64)
        rows = slice(bound[d], bound[d + 1])
        # references are numbered within the document, as an id may be negative
        names, held_by[at[rows] - a] = np.unique(ref[rows], return_inverse=True)
        held_at = np.zeros(b - a, np.int64)
        held_at[at[rows] - a] = there[rows]
        found = parse(held_by, held_at, window)
        gone = np.zeros(b - a + 1, np.int64)
        for s, m, *_ in found:
            gone[s] += 1
            gone[s + m] -= 1
        stay = np.cumsum(gone[:-1]) == 0
        removed[d] = b - a - int(stay.sum())
        spans[d] = [{"start": s, "n_words": m, "ref_doc": int(names[r]), "ref_start": x} for s, m, r, x in found]
        kept[d] = b" ".join([raw[x:y].tobytes() for x, y in
                             zip(p.starts[a:b][stay].tolist(), p.ends[a:b][stay].tolist())]).decode("utf-8")
    ids = batch.column(batch.schema.get_field_index("doc_id"))
    return pa.RecordBatch.from_arrays(
        [ids, texts, pa.array(n_words), pa.array(removed), pa.array(kept, pa.string()), pa.array(spans, pa.list_(_FACTOR))],
        schema=_CUT)
