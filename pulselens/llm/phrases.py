"""Phrase collocations: frequent word sequences by mergeable Misra-Gries summaries, counted exactly in a second pass.

First pass.  A task summarises its texts as counts of n-gram hashes, no count above the threshold, parted by hash range; that
is a Misra-Gries summary that has dropped nothing.  The summaries of a hash partition meet in one task, which merges them at a
capacity above (the partition's mass / threshold).  So no n-gram of ``threshold`` occurrences is lost: what a summary
subtracts from any counter is at most its mass by its capacity.  (Counts above the threshold are cut to it before: such an
n-gram is frequent by that summary alone, and a phrase that holds a third of the corpus then weighs no more than others.)
The survivors fill a Bloom filter of a fixed size.

Words and pairs come first, then triples and quadruples whose pairs all survived.

Second pass.  N-grams that pass the filters are counted exactly, as texts, by an ordinary aggregation.  A filter that is small
for its survivors lets more n-grams through to be counted; it never changes a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import bloom
from .common import SLICE_BYTES, n_partitions, saved, ship_package
from .textkit import U64, distinct, mix, runs, slices, utf8, word_hashes

#: N-grams whose counts a task holds before it sends a summary, and n-grams in a row of a sent summary.
_HELD, _SENT = 2_000_000, 2048
#: Capacity of a summary as a multiple of the least that the guarantee asks for; more drops more infrequent n-grams.
SLACK = 2
#: Parts of a language's candidates that are ranked apart before the best of all parts are.
_RANKED = 256

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
_OUTSIDE = _BREAK.copy()
_OUTSIDE[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ---------------------------------------------------------------- summaries

class MisraGries:
    """Counters of at most ``capacity`` keys.  Any key's count is too low by at most ``lost``."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.key, self.n = np.zeros(0, U64), np.zeros(0, np.int64)
        self._new: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def merge(self, key: np.ndarray, n: np.ndarray) -> None:
        """Add another summary's counters (its ``lost``, if it has any, adds to this one's)."""
        self._new.append((key, n))
        self._size += len(key)
        if self._size > max(self.capacity, 1 << 18):
            self.reduce()

    def reduce(self) -> None:
        if self._new:
            every = np.concatenate([self.key, *(k for k, _ in self._new)])
            self.key, back = np.unique(every, return_inverse=True)
            self.n = np.bincount(back, np.concatenate([self.n, *(n for _, n in self._new)]), len(self.key)).astype(np.int64)
            self._new, self._size = [], 0
        if len(self.key) > self.capacity:
            cut = int(np.partition(self.n, len(self.n) - self.capacity - 1)[len(self.n) - self.capacity - 1])
            self.lost += cut
            keep = self.n > cut
            self.key, self.n = self.key[keep], self.n[keep] - cut

    def survivors(self, threshold: int) -> np.ndarray:
        """All keys whose true count can be ``threshold`` or more, in ascending order."""
        self.reduce()
        return self.key[self.n + self.lost >= threshold]


# ---------------------------------------------------------------- n-grams of a run of texts

class _Scan:
    """Words of a run of texts; n-grams are known by the place of their first word."""

    def __init__(self, batch: pa.RecordBatch):
        raw, at = utf8(batch.column(1))
        self.data = _LOWER[raw]
        self.s, self.e, first = runs(~_OUTSIDE[raw], at)
        self.h = word_hashes(self.data, self.s, self.e)
        langs = pc.fill_null(batch.column(0), "und").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        count = np.diff(first)
        doc = np.repeat(np.arange(len(count)), count)
        self.lang = langs.indices.to_numpy()[doc]
        breaks = np.concatenate([[0], np.cumsum(_BREAK[raw], dtype=np.int32)])
        #: Whether a word and the next one stand in one piece.
        self.follows = np.zeros(len(self.s), bool)
        self.follows[:-1] = (breaks[self.e[:-1]] == breaks[self.s[1:]]) & (doc[1:] == doc[:-1])

    def key(self, place: np.ndarray, n: int) -> np.ndarray:
        """Hashes of the n-grams at those places, with their languages."""
        salt = np.array([xxhash.xxh64_intdigest(x.encode()) for x in self.langs] or [0], U64)
        g = mix(self.h[place] ^ salt[self.lang[place]])
        for i in range(1, n):
            g = mix(g * U64(0x9E3779B97F4A7C15) + self.h[place + i])
        return g

    def words(self) -> np.ndarray:
        return np.arange(len(self.s))

    def pairs(self) -> np.ndarray:
        return np.flatnonzero(self.follows)

    def longer(self, pairs: np.ndarray, n: int) -> np.ndarray:
        """Places of the n-grams whose pairs are all among those at ``pairs``."""
        held = np.zeros(len(self.s) + n, bool)
        held[pairs] = True
        out = held[:len(self.s)].copy()
        for i in range(1, n - 1):
            out &= held[i:len(self.s) + i]
        return np.flatnonzero(out)


def _short(h: np.ndarray) -> np.ndarray:
    """What summaries and filters keep of a hash: its upper 48 bits.  N-grams that share them are merely counted as one in
    the first pass, so more may survive."""
    return h & U64(0xFFFFFFFFFFFF0000)


def _coded(key: np.ndarray) -> bytes:
    """Ascending short hashes: the first, then steps of as many bytes as the widest asks for."""
    step = np.diff(key >> U64(16))
    width = max(1, -(-int(step.max(initial=0)).bit_length() // 8))
    return bytes([width]) + key[:1].tobytes() + step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _decoded(raw: bytes) -> np.ndarray:
    width = raw[0]
    step = np.zeros((1 + (len(raw) - 9) // width, 8), np.uint8)
    step[1:, :width] = np.frombuffer(raw, np.uint8, offset=9).reshape(-1, width)
    return (np.cumsum(step.view("<u8")[:, 0], dtype=U64) << U64(16)) + np.frombuffer(raw, U64, 1, 1)


def _merged(held: list[tuple[np.ndarray, np.ndarray]], most: int) -> tuple[np.ndarray, np.ndarray]:
    key, back = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return key, np.minimum(np.bincount(back, np.concatenate([n for _, n in held]), len(key)), most).astype(np.int64)


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))


def _passing(scan: _Scan, filters: list[np.ndarray], n: int, pairs: np.ndarray | None) -> np.ndarray:
    """Places of the n-grams that the filters hold (the first has words and pairs, the second longer ones)."""
    place = scan.words() if n == 1 else scan.pairs() if n == 2 else scan.longer(pairs, n)
    bits = filters[0 if n < 3 else 1]
    h = _short(scan.key(place, n))
    return place[bloom.holds(bits, h, bloom.block_of(h, len(bits) * 8 // bloom.BLOCK_BITS))]


def _survivors(texts: DataFrame, sizes: tuple[int, ...], threshold: int, filter_bytes: int, before: bytes | None) -> bytes:
    """The filter of all n-grams of those sizes that occur ``threshold`` times or more (and of few others).

    ``before``: the filter of words and pairs; n-grams with a pair outside it are not looked at.
    """
    spark = texts.sparkSession
    n_parts = n_partitions(spark)
    n_blocks = max(1, filter_bytes * 8 // bloom.BLOCK_BITS)
    shared = spark.sparkContext.broadcast(before)  # filter_bytes

    def send(key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """A row with the mass for each hash partition, and rows with the counters."""
        part = bloom.block_of(key, n_parts)
        edge = np.searchsorted(part, np.arange(n_parts + 1))
        total = np.concatenate([[0], np.cumsum(n)])
        rows = [(p, 0, int(total[b] - total[a]), b"", b"") for p, (a, b) in enumerate(zip(edge, edge[1:])) if b > a]
        for p, (a, b) in enumerate(zip(edge.tolist(), edge[1:].tolist())):
            rows += [(p, 1, 0, _coded(key[i:min(i + _SENT, b)]), n[i:min(i + _SENT, b)].astype("<u4" if threshold > 255 else "u1").tobytes())
                     for i in range(a, b, _SENT)]
        for i in range(0, len(rows), 500):
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[i:i + 500]), _SUMMARY)], names=_NAMES)

    def summarise(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        bits = None if shared.value is None else np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for b in slices(batch, limit=SLICE_BYTES):
                scan = _Scan(b)
                if bits is None:
                    keys = [scan.key(scan.words() if n == 1 else scan.pairs(), n) for n in sizes]
                else:
                    pairs = _passing(scan, [bits], 2, None)
                    keys = [scan.key(scan.longer(pairs, n), n) for n in sizes]
                key = _short(np.concatenate(keys))
                held.append(_merged([(key, np.ones(len(key), np.int64))], threshold))
                size += len(held[-1][0])
                if size > _HELD:
                    held = [_merged(held, threshold)]
                    size = len(held[0][0])
                    if size > _HELD // 2:
                        yield from send(*held[0])
                        held, size = [], 0
        if held:
            yield from send(*_merged(held, threshold))

    def merge(batches):
        mass, summary, part = 0, None, None
        for b in batches:
            for p, kind, m, key, n in zip(*(b.column(i) for i in range(5))):
                if kind.as_py() == 0:  # all masses come first
                    part = p.as_py()
                    mass += m.as_py()
                    continue
                summary = summary or MisraGries(SLACK * mass // threshold + 1)
                summary.merge(_decoded(key.as_py()),
                              np.frombuffer(n.as_buffer(), "<u4" if threshold > 255 else "u1").astype(np.int64))
        if summary is not None:
            h = summary.survivors(threshold)
            first, last = part * n_blocks // n_parts, -(-(part + 1) * n_blocks // n_parts)
            made = bloom.blocks(h, bloom.block_of(h, n_blocks), first, last - first)
            yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([made.tobytes()], pa.binary())], names=["first", "bits"])

    dealt = (texts.mapInArrow(summarise, "part int, kind int, mass long, keys binary, counts binary")
             .repartitionById(n_parts, F.col("part")).sortWithinPartitions("part", "kind"))
    out = np.zeros(n_blocks * bloom.BLOCK_BITS // 8, np.uint8)
    for r in dealt.mapInArrow(merge, "first long, bits binary").collect():  # the filter's blocks: filter_bytes in all
        part = np.frombuffer(bytes(r.bits), np.uint8)
        at = r.first * bloom.BLOCK_BITS // 8
        out[at:at + len(part)] |= part  # neighbouring partitions may share a block
    return out.tobytes()


_NAMES = ["part", "kind", "mass", "keys", "counts"]
_SUMMARY = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]


# ---------------------------------------------------------------- exact counts

def _groups(scan: _Scan, place: np.ndarray, n: int, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-grams grouped exactly: the place of one of each group, and the size of each group."""
    ids = np.stack([scan.lang[place].astype(np.int64), *(word[place + i] for i in range(n))])
    coded = pa.array(scan.key(place, n)).dictionary_encode()
    group = coded.indices.to_numpy().astype(np.int64)
    first = np.empty(len(coded.dictionary), np.int64)
    first[group] = np.arange(len(group))
    if (ids != ids[:, first][:, group]).any():  # two n-grams share a hash: group by the words themselves
        _, first, group = np.unique(ids, axis=1, return_index=True, return_inverse=True)
    return place[first], np.bincount(group.ravel(), minlength=len(first))


def frequent_phrases(docs: DataFrame, threshold: int = 30, max_words: int = 4, filter_bytes: int = 32 << 20,
                     text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, size, phrase, f)``: every phrase of up to ``max_words`` (4 at most) words with ``threshold`` or more
    occurrences in its language, counted exactly; size 0 gives the number of all words of each language.

    A-Z are in lower case.  Phrases do not reach over ``. , ; : ! ?`` or a line break; words are parted by spaces and
    tabs, and a phrase joins them by one space.  A null language is ``und``.
    """
    if not 2 <= max_words <= 4:
        raise ValueError("phrases have two to four words")
    spark = docs.sparkSession
    ship_package(spark)
    texts = _texts(docs, text_col, lang_col)
    filters = [_survivors(texts, (1, 2), threshold, filter_bytes, None)]
    if max_words > 2:
        filters.append(_survivors(texts, tuple(range(3, max_words + 1)), threshold, filter_bytes, filters[0]))
    shared = spark.sparkContext.broadcast(filters)

    def count(batches):
        bits = [np.frombuffer(x, np.uint8) for x in shared.value]
        for batch in batches:
            for b in slices(batch, limit=SLICE_BYTES):
                scan = _Scan(b)
                total = np.bincount(scan.lang, minlength=len(scan.langs)).tolist()
                lang, size, phrase, f = list(scan.langs), [0] * len(total), [""] * len(total), total
                first, word, _, _ = distinct(scan.data, scan.s, scan.e)
                spelt = [scan.data[x:y].tobytes().decode() for x, y in zip(scan.s[first].tolist(), scan.e[first].tolist())]
                pairs = None
                for n in range(1, max_words + 1):
                    place = _passing(scan, bits, n, pairs)
                    pairs = place if n == 2 else pairs
                    if len(place):
                        one, many = _groups(scan, place, n, word)
                        lang += [scan.langs[i] for i in scan.lang[one].tolist()]
                        size += [n] * len(one)
                        phrase += map(" ".join, zip(*([spelt[i] for i in word[one + k].tolist()] for k in range(n))))
                        f += many.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(size, pa.int32()), pa.array(phrase, pa.string()),
                                                  pa.array(f, pa.int64())], names=["lang", "size", "phrase", "f"])

    return (texts.mapInArrow(count, "lang string, size int, phrase string, f long").groupBy("lang", "size", "phrase")
            .agg(F.sum("f").alias("f")).where((F.col("f") >= threshold) | (F.col("size") == 0)))


# ---------------------------------------------------------------- collocations

def _wide(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def collocations(docs: DataFrame, threshold: int = 30, max_words: int = 4, top: int = 2000, share: int = 80,
                 filter_bytes: int = 32 << 20, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases by score, count and spelling.

    A phrase of two or more words with ``a >= threshold`` occurrences is cut once; ``l`` and ``r`` count its two parts, and
    ``score`` is floor(2,000,000 a / (l + r)) of the cut that scores lowest (of ties the one after fewest words); ``n``
    counts all words of the language.  Phrases inside a longer frequent one of at least ``share`` percent of their count
    are left out.  A null or empty text has no words; repeated rows count each; a table without frequent phrases gives no
    rows; other columns are not read.
    """
    table = saved(frequent_phrases(docs, threshold, max_words, filter_bytes, text_col, lang_col))
    parts = table.where("size between 1 and 3").select("lang", F.col("phrase").alias("part"), "f")
    phrases = table.where("size >= 2").select("lang", "size", "phrase", F.col("f").alias("a"))
    cuts = phrases.select("lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = (cuts.withColumn("part", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring_index(phrase, ' ', k - size)"))
            .join(parts.withColumnRenamed("f", "l"), ["lang", "part"])
            .join(parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]))
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) div cast(l + r as decimal(20,0))")
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    longer = phrases.where("size >= 3").select("lang", F.col("a").alias("longer"), F.split("phrase", " ").alias("w"))
    inner = F.expr("flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), "
                   "i -> concat_ws(' ', slice(w, i, m)))))")
    around = longer.select("lang", "longer", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    within = (_wide("longer") * 100 >= _wide("a") * share) & F.col("longer").isNotNull()
    kept = (scored.join(around, ["lang", "phrase"], "left").where(~F.coalesce(within, F.lit(False)))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = kept.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(_RANKED)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order))).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    words = table.where("size = 0").select("lang", F.col("f").alias("n"))
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
