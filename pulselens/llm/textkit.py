"""Vectorised word scanning and hashing over the UTF-8 buffers of Arrow string columns.

A batch of texts is one byte array with offsets.  Words, their 64-bit hashes and the hashes of runs of consecutive
words come from prefix sums, so no Python loop runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
#: Any odd multiplier has an inverse modulo 2**64; prefix sums then give the hash of every range of words.
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
#: Words whose powers are kept.
_RANGE = 1 << 18
#: The bytes of a word that are hashed eight at a time.
_LONG = 512
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)

#: The six white-space bytes that separate words.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Everything but ASCII letters, digits and bytes of non-ASCII characters.
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
#: Everything but ASCII letters and bytes of non-ASCII characters.
NON_LETTERS = PUNCTUATION.copy()
NON_LETTERS[48:58] = True


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Row ranges of at most ``limit`` bytes of text (or a single longer text)."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0), np.int64)
    total = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null: empty) and each text's offset, with one offset more than texts."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, data = column.buffers()
    if where is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(where, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def words(data: np.ndarray, at: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each text the index of its first word (with one more at the end)."""
    return runs(~separators[data], at)


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for the maximal runs of bytes that are ``inside``, within each text."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    edge = np.empty(len(inside) + 1, bool)
    edge[0] = True
    edge[1:] = ~inside
    edge[at] = True  # a text's first byte never continues a word of the text before it
    starts = np.flatnonzero(inside & edge[:-1])
    edge[:-1] = ~inside
    edge[-1] = True
    edge[at] = True
    ends = np.flatnonzero(inside & edge[1:]) + 1
    return starts, ends, np.searchsorted(starts, at)


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
             flag: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words grouped exactly: the first word of each group, each word's group, and two hashes of each group.  Words of
    unequal ``flag``, where one is given, are not equal.

    The second hash is the length of words of up to eight bytes, whose first hash tells them apart at equal length.
    Where two words of the batch share the first hash and not the second, groups are made by the bytes themselves.
    """
    h = word_hashes(data, starts, ends)
    check = (ends - starts).astype(U64)
    long = np.flatnonzero(check > 8)
    check[long] = word_hashes(data, starts[long], ends[long], 1)
    if flag is not None:
        h ^= flag.astype(U64) * U64(0x9FB21C651E98DF25)
        check ^= flag.astype(U64) << U64(63)
    coded = pa.array(h).dictionary_encode()
    group = coded.indices.to_numpy().astype(np.int64)
    first = np.empty(len(coded.dictionary), np.int64)
    first[group[::-1]] = np.arange(len(group) - 1, -1, -1)
    if (check != check[first][group]).any():  # a shared first hash: group by the bytes themselves
        raw = data.tobytes()
        seen: dict[tuple[bytes, bool], int] = {}
        flags = [False] * len(starts) if flag is None else flag.tolist()
        group = np.fromiter((seen.setdefault((raw[a:b], f), len(seen)) for a, b, f in zip(starts.tolist(), ends.tolist(), flags)),
                            np.int64, len(starts))
        first = np.empty(len(seen), np.int64)
        first[group[::-1]] = np.arange(len(group) - 1, -1, -1)
    return first, group, h[first], check[first]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit, in place."""
    h ^= h >> U64(30)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, U64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > _RANGE:
        return _powers(base, n)
    if base not in _TABLES:
        _TABLES[base] = _powers(base, _RANGE)
    return _TABLES[base]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes, whatever its place: a bijection is applied after each eight bytes, so words of
    up to eight bytes and equal length never share a hash, and no pattern of repeated characters cancels out.  Words of
    more than ``_LONG`` bytes take XXH64."""
    size = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    h = mix(size.astype(U64) * U64(_BYTE_BASE) + U64(seed * 2 + 1))
    rows, at, left = np.arange(len(starts)), starts, size
    while len(rows):
        h[rows] = mix(h[rows] ^ (lanes[at] & _KEEP[np.minimum(left, 8)]))
        go = np.flatnonzero((left > 8) & (size[rows] <= _LONG))
        rows, at, left = rows[go], at[go] + 8, left[go] - 8
    for i in np.flatnonzero(size > _LONG).tolist():
        h[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes(), seed)
    return h


def run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """The hash of the ``n`` consecutive words from each position on; the last ``n - 1`` positions have none."""
    m = len(h) - n + 1
    out = np.empty(max(m, 0), U64)
    step = _RANGE - n - 1
    for i in range(0, max(m, 0), step):
        j = min(i + step, m)
        part = h[i:j + n - 1]
        power, inverse = _tables(_WORD_BASE, len(part) + 1)
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(part * power[:len(part)], out=total[1:])
        k = j - i
        out[i:j] = mix((total[n:n + k] - total[:k]) * inverse[:k])
    return out


def run_starts(first: np.ndarray, n: int) -> np.ndarray:
    """True for each word from which ``n`` words of the same text go on; ``first`` as given by ``words``."""
    total = int(first[-1])
    last = np.repeat(first[1:], np.diff(first))
    return np.arange(total) + n <= last


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]
