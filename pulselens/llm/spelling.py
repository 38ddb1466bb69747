"""Spelling variants: words within one edit of each other, found by Bloom-guided neighbourhoods.

The vocabulary (words with their counts) is a distributed table.  A blocked Bloom filter of each word length is built from
it and broadcast; every word generates its one-edit neighbours (deletions, and replacements by a larger letter: all other
edits are these, seen from the other word) and probes them against the filter of their length.  Only positives are
shuffled, to an exact join with the vocabulary, which removes the filters' false positives.

Filters go out in groups of at most ``filter_bytes``, so a broadcast does not grow with the vocabulary; a length whose filter
is larger is split by ranges of the hash.  A larger vocabulary takes more passes over it, each probing other neighbours.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bloom
from .common import SLICE_BYTES, id_text, n_partitions, saved, ship_package
from .textkit import U64, distinct, mix, runs, slices, utf8

#: Lengths from here on share one filter.
LONGEST = 64
#: Bits of a filter for each word, and of the filter of long words, which have more neighbours and are longer to send.
WORD_BITS, LONG_WORD_BITS = 16, 64

_ASCII = np.zeros(256, bool)
_ASCII[[*range(65, 91), *range(97, 123)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ---------------------------------------------------------------- the vocabulary

def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def _crc32(data: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each word's bytes, carried on from the checksum ``before`` it."""
    out = before ^ np.uint32(0xFFFFFFFF)
    rows, at = np.arange(len(start)), start
    for _ in range(64):
        if not len(rows):
            break
        c = out[rows]
        out[rows] = _CRC[(c ^ data[at]) & 0xFF] ^ c >> np.uint32(8)
        go = np.flatnonzero(at + 1 < end[rows])
        rows, at = rows[go], at[go] + 1
    out ^= np.uint32(0xFFFFFFFF)
    for r, a in zip(rows.tolist(), at.tolist()):  # the rest of long words
        out[r] = zlib.crc32(data[a:end[r]].tobytes(), int(out[r]))
    return out


def _words(ids: list, column: pa.Array, misspell: int, least: int) -> tuple[list[str], np.ndarray]:
    """The distinct words of a run of texts and how often each occurs."""
    raw, at = utf8(column)
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    inside = _ASCII[raw]
    inside[lead] = inside[lead + 1] = True  # U+00C0 to U+00FF: the byte C3 and one more
    s, e, first = runs(inside, at)
    data = _LOWER[raw]
    wide = np.concatenate([[0], np.cumsum(raw == 0xC3)])
    length = e - s - (wide[e] - wide[s])
    doc = np.repeat(np.arange(len(ids)), np.diff(first))
    keep = np.flatnonzero(length >= least)
    s, e, length, doc = s[keep], e[keep], length[keep], doc[keep]
    changed: dict[str, int] = {}
    if misspell:
        salt = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
        h = _crc32(data, s, e, salt[doc])
        hit = h % np.uint32(misspell) == 0
        for a, b, x in zip(s[hit].tolist(), e[hit].tolist(), h[hit].tolist()):
            word = data[a:b].tobytes().decode()
            k = x % len(word)
            if len(word) > least:
                word = word[:k] + word[k + 1:]
                changed[word] = changed.get(word, 0) + 1
        s, e = s[~hit], e[~hit]
    where, group, _, _ = distinct(data, s, e)
    n = np.bincount(group, minlength=len(where))
    words = [data[a:b].tobytes().decode() for a, b in zip(s[where].tolist(), e[where].tolist())]
    return words + list(changed), np.concatenate([n, np.fromiter(changed.values(), np.int64, len(changed))])


def vocabulary(docs: DataFrame, misspell: int = 0, least_length: int = 5, least_count: int = 3, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``(word, n)``: maximal runs of ASCII letters and U+00C0 to U+00FF, A-Z in lower case, of at least ``least_length``
    code points and ``least_count`` occurrences.

    With ``misspell`` above 0, h being the CRC-32 of ``<doc_id>:<run>`` in UTF-8, a run whose h that number divides loses
    its code point h % length (counted before the length is judged).
    """
    ship_package(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for b in slices(batch, limit=SLICE_BYTES):
                words, n = _words(b.column(0).to_pylist(), b.column(1), misspell, least_length)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

    return (id_text(docs, id_col, text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


# ---------------------------------------------------------------- neighbourhoods

def _term(place: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """What a letter at a place adds to its word's hash."""
    return mix((place.astype(U64) << U64(9)) + letter.astype(U64) + U64(0x9E3779B97F4A7C15))


def _finish(total: np.ndarray, length: int) -> np.ndarray:
    return mix(total + U64(length) * U64(0xD1B54A32D192ED03))


def _matrices(words: list[str], room: int = 1 << 18):
    """Words of equal length as rows of code points: ``(rows, letters)``, at most ``room`` letters (or one word) at a time."""
    raw = [w.encode("latin-1") for w in words]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    order = np.argsort(size, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        if len(rows):
            step = max(1, room // int(size[rows[0]]))
            for i in range(0, len(rows), step):
                part = rows[i:i + step]
                yield part, np.frombuffer(b"".join([raw[r] for r in part.tolist()]), np.uint8).reshape(len(part), -1)


def word_hashes(letters: np.ndarray) -> np.ndarray:
    n = letters.shape[1]
    return _finish(_term(np.arange(n), letters).sum(axis=1, dtype=U64), n)


def deletions(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and place of every deletion, one of each run of equal letters."""
    m, n = letters.shape
    place = np.arange(n)
    before = np.zeros((m, n), U64)
    np.cumsum(_term(place[:-1], letters[:, :-1]), axis=1, out=before[:, 1:])
    after = np.zeros((m, n), U64)
    after[:, :-1] = np.cumsum(_term(place[:-1], letters[:, 1:])[:, ::-1], axis=1, dtype=U64)[:, ::-1]
    other = np.ones((m, n), bool)
    other[:, 1:] = letters[:, 1:] != letters[:, :-1]
    row, at = np.nonzero(other)
    return _finish(before[row, at] + after[row, at], n - 1), row, at


def replacements(letters: np.ndarray, alphabet: list[int]):
    """Hash, row and place of every replacement by a larger letter: one yield for each letter of the alphabet."""
    n = letters.shape[1]
    place = np.arange(n)
    own = _term(place, letters)
    rest = own.sum(axis=1, dtype=U64)[:, None] - own
    for c in alphabet:
        row, at = np.nonzero(letters < c)
        if len(row):
            yield c, _finish(rest[row, at] + _term(place, np.uint8(c))[at], n), row, at


class _Group:
    """Filters that are broadcast together: of each length some of its blocks (``first`` to ``last`` of ``total``)."""

    def __init__(self):
        self.parts: dict[int, tuple[int, int, int, int]] = {}
        self.n_blocks = 0

    def add(self, length: int, first: int, last: int, total: int) -> None:
        self.parts[length] = (first, last, total, self.n_blocks)
        self.n_blocks += last - first

    def locate(self, h: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes of words of that length this group can judge, and their blocks in it."""
        part = self.parts.get(min(length, LONGEST))
        if part is None:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first, last, total, at = part
        block = bloom.block_of(h, total)
        rows = np.flatnonzero((block >= first) & (block < last)) if last - first < total else np.arange(len(h))
        return rows, block[rows] - first + at


def _groups(counts: dict[int, int], filter_bytes: int) -> list[_Group]:
    """Every block of every length's filter, in groups of at most ``filter_bytes``."""
    room = max(1, filter_bytes * 8 // bloom.BLOCK_BITS)
    out = [_Group()]
    for length, n in sorted(counts.items()):
        total = -(-n * (LONG_WORD_BITS if length >= LONGEST else WORD_BITS) // bloom.BLOCK_BITS)
        first = 0
        while first < total:
            if out[-1].n_blocks >= room or length in out[-1].parts:
                out.append(_Group())
            last = min(total, first + room - out[-1].n_blocks)
            out[-1].add(length, first, last, total)
            first = last
    return out


def _positives(words: DataFrame, group: _Group, alphabet: list[int]) -> DataFrame:
    """``(word, n, other)``: neighbours of words that the group's filters may hold."""
    spark = words.sparkSession

    def place(batches):
        for b in batches:
            for _, letters in _matrices(b.column(0).to_pylist()):
                h = word_hashes(letters)
                rows, block = group.locate(h, letters.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(h[rows].view(np.int64))], names=["block", "h"])

    data = bloom.gather(words.mapInArrow(place, "block long, h long"), group.n_blocks)
    shared = spark.sparkContext.broadcast(bytes(data))  # at most filter_bytes

    def probe(batches):
        bits = np.frombuffer(shared.value, np.uint8)

        def hits(h, length):
            rows, block = group.locate(h, length)
            return rows[bloom.holds(bits, h[rows], block)]

        for b in batches:
            words, n = b.column(0).to_pylist(), b.column(1).to_numpy()
            for who, letters in _matrices(words):
                length = letters.shape[1]
                found: list[tuple[int, str]] = []
                if min(length - 1, LONGEST) in group.parts:
                    h, row, at = deletions(letters)
                    for i in hits(h, length - 1).tolist():
                        w, k = words[who[row[i]]], at[i]
                        found.append((who[row[i]], w[:k] + w[k + 1:]))
                if min(length, LONGEST) in group.parts:
                    for c, h, row, at in replacements(letters, alphabet):
                        for i in hits(h, length).tolist():
                            w, k = words[who[row[i]]], at[i]
                            found.append((who[row[i]], w[:k] + chr(c) + w[k + 1:]))
                rows = [r for r, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([words[r] for r in rows], pa.string()), pa.array(n[rows] if rows else [], pa.int64()),
                     pa.array([w for _, w in found], pa.string())], names=["word", "n", "other"])

    return words.mapInArrow(probe, "word string, n long, other string")


def near_words(vocab: DataFrame, filter_bytes: int = 64 << 20) -> DataFrame:
    """``(word, n, other, n_other)``: both directions of every pair of words that one inserted, deleted or replaced code
    point parts.  ``vocab (word, n)`` holds distinct words of code points below U+0100; others are an error."""
    spark = vocab.sparkSession
    ship_package(spark)
    words = vocab.select("word", "n").repartition(n_partitions(spark), "word")
    size = F.least(F.length("word"), F.lit(LONGEST))
    counts = {r.k: r.n for r in vocab.groupBy(size.alias("k")).agg(F.count("*").alias("n")).collect()}  # at most LONGEST rows
    letters = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().where("c != ''")
    alphabet = sorted(ord(r.c) for r in letters.collect())  # the letters of one byte: at most 256
    out = None
    for group in _groups(counts, filter_bytes):
        found = _positives(words, group, alphabet)
        out = found if out is None else out.unionAll(found)
    exact = out.join(vocab.select(F.col("word").alias("other"), F.col("n").alias("n_other")), "other")
    both = F.array(F.struct("word", "n", "other", "n_other"),
                   F.struct(F.col("other").alias("word"), F.col("n_other").alias("n"), F.col("word").alias("other"), F.col("n").alias("n_other")))
    return exact.select(F.explode(both).alias("x")).select("x.*")


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """``(word, root)`` of every word of ``forms (word, root)``, where ``root`` is the next form.

    Forms at least double in count, so a chain has no more steps than ``most`` has doublings; each round doubles the steps
    followed.
    """
    steps = max(1, int(math.log2(max(most, 2))))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        ahead = forms.select(F.col("word").alias("root"), F.col("root").alias("further"))
        forms = saved(forms.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
    return forms


def variants(docs: DataFrame, misspell: int = 0, least_length: int = 5, least_count: int = 3, ratio: int = 2,
             filter_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of the vocabulary (see ``vocabulary``).

    ``form`` is the near word of largest count (of ties the smallest in code-point order), if that count is at least
    ``ratio`` (2 or more) times the word's, else null; ``root`` is where the forms lead, the word itself without one.
    A null or empty text has no words; a null id counts as empty in the misspelling rule; repeated rows count each; an
    empty table gives no rows; other columns are not read.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2, so that chains of forms end")
    vocab = saved(vocabulary(docs, misspell, least_length, least_count, id_col, text_col))
    most = vocab.agg(F.max("n")).first()[0]
    near = near_words(vocab, filter_bytes) if most else None
    empty = vocab.select("word", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("struct<m:bigint,w:string>").alias("best")).limit(0)
    told = empty if near is None else near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_other")).alias("m"), F.col("other").alias("w"))).alias("best"))
    enough = -F.col("best.m") >= ratio * F.col("n")
    table = saved(vocab.join(told, "word", "left").select(
        "word", F.when(enough, F.col("best.w")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, -F.col("best.m")).alias("form_n")))
    roots = _roots(table.where("form is not null").select("word", F.col("form").alias("root")), most or 1)
    return table.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
