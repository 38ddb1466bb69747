"""Token ids of a corpus as a binary file format of patched frame-of-reference blocks.

A written corpus is a folder with two Parquet tables, which Spark's committer makes visible as a whole, whatever tasks
were lost or repeated on the way:

``segments``: rows ``(part, first, n_ids, payload, doc_ids, doc_sizes)`` in ascending order of document.  A segment holds
    whole documents, at least ``SEGMENT`` ids but in a part's last one; ``first`` is the number of ids before it in its part.
``parts``: one row a part, ``(part, start, n_ids, n_docs)``; ``start`` is the number of ids in all parts before it.

A payload is, in little-endian order: the magic ``PFR1``, the number of ids (u32), the ids of a block (u32), then the start
of every block and the end of the last one (u32 each, from the payload's first byte), then the blocks.  A block is its
minimum (u32), a width in bits (u8), the number of exceptions (u8), the differences to the minimum packed at that width
(the lowest bits of each; a last block is filled up with zeros), the positions of the exceptions (u8 each) and what their
differences have above the width (u32 each).  The width is that of the block's ``PERCENTILE``-th difference, so a few large
ids do not widen all others.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import SLICE_BYTES, id_text, n_partitions, ship_package
from .textkit import SPACES, distinct, slices, utf8, words

#: Ids of a block (positions of exceptions are one byte), and the least ids of a segment.
BLOCK, SEGMENT = 128, 4096
PERCENTILE = 0.9
MAGIC = b"PFR1"
_HEAD = 12


# ---------------------------------------------------------------- the format

def _bits(x: np.ndarray) -> np.ndarray:
    """Bits of each number (0 for 0)."""
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def pack(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    """The payload of ``ids`` (unsigned, below 2**32); ``block`` is at most 256 and a multiple of 8."""
    ids = np.asarray(ids, np.uint32)
    n = len(ids)
    k = -(-n // block)
    x = np.zeros(k * block, np.uint32)
    x[:n] = ids
    real = (np.arange(k * block) < n).reshape(k, block)
    x = x.reshape(k, block)
    low = np.where(real, x, np.uint32(0xFFFFFFFF)).min(axis=1) if k else np.zeros(0, np.uint32)
    x = np.where(real, x - low[:, None], np.uint32(0))
    size = real.sum(axis=1)
    # the percentile is taken among a block's own ids: zeros that fill up the last block sort first
    at = block - size + np.maximum(np.ceil(size * percentile).astype(np.int64) - 1, 0)
    width = _bits(np.take_along_axis(np.sort(x, axis=1), at[:, None], axis=1)[:, 0]) if k else np.zeros(0, np.int64)
    high = np.where(width[:, None] < 32, x.astype(np.uint64) >> width[:, None].astype(np.uint64), np.uint64(0))
    odd = high > 0
    n_odd = odd.sum(axis=1)
    body = width * (block // 8)
    length = 6 + body + 5 * n_odd
    begin = _HEAD + 4 * (k + 1) + np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    out = np.zeros(int(begin[-1]), np.uint8)
    out[:4] = np.frombuffer(MAGIC, np.uint8)
    out[4:_HEAD] = np.array([n, block], "<u4").view(np.uint8)
    out[_HEAD:_HEAD + 4 * (k + 1)] = begin.astype("<u4").view(np.uint8)
    b = begin[:-1]
    out[b[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(k, 4)
    out[b + 4], out[b + 5] = width, n_odd
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        raw = x[rows].astype("<u4").view(np.uint8).reshape(len(rows), block, 4)
        bits = np.unpackbits(raw, axis=2, bitorder="little")[:, :, :w].reshape(len(rows), block * w)
        out[b[rows, None] + 6 + np.arange(w * block // 8)] = np.packbits(bits, axis=1, bitorder="little")
    row, col = np.nonzero(odd)
    rank = np.arange(len(row)) - np.concatenate([[0], np.cumsum(n_odd)])[row]
    where = b[row] + 6 + body[row]
    out[where + rank] = col
    spot = (where + n_odd[row] + 4 * rank)[:, None] + np.arange(4)
    out[spot] = high[row, col].astype("<u4").view(np.uint8).reshape(len(row), 4)
    return out.tobytes()


def block_starts(payload: bytes) -> tuple[int, int, np.ndarray]:
    """Ids of the payload, ids of a block, and where each block starts (with the end of the last)."""
    if payload[:4] != MAGIC:
        raise ValueError("not a payload of patched frame-of-reference blocks")
    n, block = np.frombuffer(payload, "<u4", 2, 4).tolist()
    return n, block, np.frombuffer(payload, "<u4", -(-n // block) + 1, _HEAD).astype(np.int64)


def unpack(payload: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The ids ``start`` to ``stop`` of a payload; only the blocks that hold them are read."""
    n, block, begin = block_starts(payload)
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, np.uint32)
    first, last = start // block, -(-stop // block)
    data = np.frombuffer(payload, np.uint8)
    b = begin[first:last]
    k = len(b)
    low = data[b[:, None] + np.arange(4)].reshape(-1).view("<u4").astype(np.uint32)
    width, n_odd = data[b + 4].astype(np.int64), data[b + 5].astype(np.int64)
    x = np.zeros((k, block), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        raw = data[b[rows, None] + 6 + np.arange(w * block // 8)]
        bits = np.zeros((len(rows), block, 32), np.uint8)
        bits[:, :, :w] = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(rows), block, w)
        x[rows] = np.packbits(bits, axis=2, bitorder="little").reshape(len(rows), -1).view("<u4").reshape(len(rows), block)
    row = np.repeat(np.arange(k), n_odd)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(n_odd) - n_odd, n_odd)
    where = (b + 6 + width * (block // 8))[row]
    col = data[where + rank]
    high = data[(where + n_odd[row] + 4 * rank)[:, None] + np.arange(4)].reshape(-1).view("<u4").astype(np.uint64)
    x[row, col] |= (high << width[row].astype(np.uint64)).astype(np.uint32)
    x += low[:, None]
    return x.reshape(-1)[start - first * block:stop - first * block]


# ---------------------------------------------------------------- ids of texts

class Encoder:
    """Ids of whole texts by the tokenizers library.

    ``pieces`` is for vocabularies that lower-case, drop white space, cut between letters, single digits and other
    characters, and mark the last token of a piece by an ending (``word_bpe_49k.json``; the constructor tries some texts).
    Texts are then cut at ASCII white space, and words of plain Latin characters into such pieces; the library sees each
    distinct piece, and each other word, once (up to ``room`` are remembered, by 128 bits of hash).  Otherwise it sees
    whole texts.
    """

    def __init__(self, raw: bytes, pieces: bool, room: int = 1_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_buffer(raw)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pieces, self.room = pieces, room
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ending = json.loads(raw)["model"].get("end_of_word_suffix")
        if ending:
            self.ends[[i for t, i in vocabulary.items() if t.endswith(ending)]] = True
        # plain pieces are cut and in lower case already: the same model without those steps; bytes go by their characters
        spec = json.loads(raw) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.model = Tokenizer.from_str(json.dumps(spec)) if pieces else None
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # a lower-case letter of Latin-1 is the byte C3 and one of these; all other bytes in question stand for themselves
        self.bytes = [(chr(c.encode()[1]), byte_level.pre_tokenize_str(c)[0][0][1]) for c in "ßàí"]
        self._forget()
        if pieces:
            for text in ("Ab,c", "x  Y9", "ÀB12?!z", "(ok)", "q\tr_s", "it's"):
                if not ending or self.encode(pa.array([text]))[0].tolist() != self._library([text])[0].tolist():
                    raise ValueError("this vocabulary asks for whole texts (pieces=False)")

    def _forget(self) -> None:
        self.key = self.check = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.flat, self.begin, self.n, self.n_ids = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), 0, 0

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _remember(self, ids: np.ndarray, size: np.ndarray) -> None:
        n, end = self.n + len(size), self.n_ids + len(ids)
        while len(self.flat) < end:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.begin) < n + 1:
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.flat[self.n_ids:end] = ids
        self.begin[self.n + 1:n + 1] = self.n_ids + np.cumsum(size)
        self.n, self.n_ids = n, end

    def _learn(self, data: np.ndarray, s: np.ndarray, e: np.ndarray, plain: np.ndarray) -> None:
        """Append the ids of distinct pieces: plain ones joined by spaces, and parted again where a token ends a piece;
        then the others, which may be several pieces to the library, one by one."""
        every = np.flatnonzero(plain)
        for i in range(0, len(every), _JOINED):
            rows = every[i:i + _JOINED]
            size = e[rows] - s[rows]
            ends = np.cumsum(size + 1)
            text = np.full(int(ends[-1]), 32, np.uint8)
            off = np.repeat(ends - size - 1, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            text[off] = data[off + np.repeat(s[rows] - (ends - size - 1), size)]
            joined = text.tobytes().decode("latin-1")
            for byte, character in self.bytes:
                joined = joined.replace(byte, character)
            ids = np.array(self.model.encode(joined, add_special_tokens=False).ids, np.uint32)
            stop = np.flatnonzero(self.ends[ids]) + 1
            if len(stop) != len(rows):
                raise ValueError("this vocabulary asks for whole texts (pieces=False)")
            self._remember(ids, np.diff(stop, prepend=0))
        rest = [data[a:b].tobytes().decode() for a, b in zip(s[~plain].tolist(), e[~plain].tolist())]
        for i in range(0, len(rest), _JOINED):
            found = self._library(rest[i:i + _JOINED])
            self._remember(np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found)))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: empty), one after another, and how many each has."""
        if self.pieces:
            data, at = utf8(column)
            data, s, e, plain = cut_pieces(data, at)
            where, back, h, check = distinct(data, s, e)
            order = np.argsort(h)
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            where, h, check = where[order], h[order], check[order]
            if (h[1:] != h[:-1]).all():  # else two pieces share a hash, and the library sees the whole texts
                ids, size = self._known(h, check, rank[back], lambda new: (data, s[where[new]], e[where[new]], plain(where[new])))
                ends = np.concatenate([[0], np.cumsum(size)])
                return ids, np.diff(ends[np.searchsorted(s, at)])
        found = self._library([x or "" for x in column.to_pylist()])
        return np.concatenate([np.zeros(0, np.uint32), *found]), np.fromiter(map(len, found), np.int64, len(found))

    def _known(self, key, check, back, spell) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces ``key[back]``, one after another, and the number of ids of each."""
        if self.n > self.room:
            self._forget()
        at = np.searchsorted(self.key, key)
        near = np.minimum(at, max(self.n - 1, 0))
        have = (self.key[near] == key) & (self.check[near] == check) if self.n else np.zeros(len(key), bool)
        new = np.flatnonzero(~have)
        if len(new):
            found = spell(new)
            order = new[np.argsort(~found[3], kind="stable")]  # in the order in which they are appended
            rank = np.empty(len(key), np.int64)
            rank[order] = self.n + np.arange(len(order))
            self._learn(*found)
            self.key, self.check = np.insert(self.key, at[new], key[new]), np.insert(self.check, at[new], check[new])
            self.place = np.insert(self.place, at[new], rank[new])
            # where each key stands now: a remembered one that shares a hash but not the check stands after the new one
            at = np.searchsorted(self.key, key)
        place = self.place[at] if len(key) else at
        start = self.begin[place][back]
        size = (self.begin[place + 1] - self.begin[place])[back]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(start - (ends - size), size) + np.arange(total)], size


#: Pieces that go to the library at once.
_JOINED = 128

# Kinds of bytes: white space, letters, digits, other printable ASCII; and what makes its word no plain one: the apostrophe
# (contractions are cut otherwise), control characters, and characters outside ASCII but for the letters of Latin-1.
_SPACE, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[ord("'")] = _OTHER
_KIND[SPACES] = _SPACE


def cut_pieces(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Callable]:
    """The bytes with plain words in lower case, start and end byte of every piece, and a function that tells of some
    pieces whether they are of a plain word."""
    s, e, _ = words(data, at)
    kind = _KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]  # the signs for times and divided by are no letters
    kind[lead] = kind[lead + 1] = _LETTER
    kind[np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))] = _OTHER  # special strings begin so
    odd = np.unique(np.searchsorted(s, np.flatnonzero(kind == _OTHER), "right") - 1)  # the words that are not plain
    size = e[odd] - s[odd]
    inside = np.repeat(s[odd] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    kind[inside] = _OTHER
    begin = np.zeros(len(data) + 1, bool)
    begin[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    begin[s] = True
    end = begin[1:].copy()
    begin[:-1] &= kind != _SPACE
    end[e - 1] = True
    end &= kind != _SPACE
    low = _LOWER[data]
    low[inside] = data[inside]
    tail = lead[(data[lead + 1] <= 0x9E) & (kind[lead] == _LETTER)] + 1
    low[tail] += 32
    start = np.flatnonzero(begin[:-1])

    def plain(pieces: np.ndarray) -> np.ndarray:
        return kind[start[pieces]] != _OTHER

    return low, start, np.flatnonzero(end) + 1, plain


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


_READY: dict[tuple[int, bool], Encoder] = {}


def _encoder(raw: bytes, pieces: bool) -> Encoder:
    """One encoder in a Python worker."""
    key = (zlib.crc32(raw), pieces)
    if key not in _READY:
        _READY.clear()
        _READY[key] = Encoder(raw, pieces)
    return _READY[key]


# ---------------------------------------------------------------- writing

def _id_cuts(docs: DataFrame, id_col: str, n: int) -> list[int]:
    """About ``n`` equal ranges of the ids, cut at quantiles (a scan of the id column alone)."""
    found = docs.select(F.percentile_approx(F.col(id_col).cast("long"), [i / n for i in range(1, n)], 10 * n)).first()[0]
    return sorted(set(found or []))


def _packed(parts: Iterator[tuple[int, int, np.ndarray]], width: int) -> Iterator[dict]:
    """Segments of the documents ``(part, doc_id, ids)``, which come in order."""
    ids: list[np.ndarray] = []
    names: list = []
    at = size = 0
    part = None

    def segment() -> dict:
        every = np.concatenate(ids).astype(np.uint32)
        return {"part": part, "first": at, "n_ids": len(every), "payload": pack(every), "doc_ids": names,
                "doc_sizes": [len(x) for x in ids]}

    for p, doc, raw in parts:
        if ids and (p != part or size >= SEGMENT):
            yield segment()
            at, size, ids, names = at + size, 0, [], []
        if p != part:
            part, at = p, 0
        ids.append(raw)
        names.append(doc)
        size += len(raw)
    if ids:
        yield segment()


_SEGMENT_TYPE = pa.schema([("part", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary()),
                           ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64()))])


def write_ids(docs: DataFrame, vocabulary_path: str, path: str, end_id: int | None = 1, pieces: bool = True,
              id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the ids of every row's whole text to the new folder ``path``, in ascending order of id; returns ``path``.

    ``end_id`` closes every document (None: nothing does).  The ids are the library's, without added special tokens;
    special strings inside a text are its default's.  ``pieces``: see ``Encoder``.  A null or empty text has the end id
    alone.  Rows without id stand before all others, by a hash of their text; rows of equal ids are ordered by that hash,
    and repeated rows are all written.  An empty table gives a folder without segments; other columns are not read.

    Ids cross the network, not texts: two bytes each where the vocabulary allows it.  Rows are dealt to ranges of the id
    order, four to a partition; each range is a part of its own.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(vocabulary_path, "rb") as f:
        raw = spark.sparkContext.broadcast(f.read())  # the public file's size
    from tokenizers import Tokenizer
    top = max([end_id or 0, *Tokenizer.from_file(vocabulary_path).get_vocab(with_added_tokens=True).values()])
    kind = "<u2" if top < 1 << 16 else "<u4"
    n = n_partitions(spark)
    cuts = np.array(_id_cuts(docs, id_col, 4 * n), np.int64)
    spread = 4 * n

    def encode(batches):
        encoder = _encoder(raw.value, pieces)
        end = np.zeros(0, kind) if end_id is None else np.array([end_id], kind)
        for batch in batches:
            for b in slices(batch, limit=SLICE_BYTES):
                ids, size = encoder.encode(b.column(1))
                ids = ids.astype(kind)
                stop = np.cumsum(size)
                tie = b.column(2).to_numpy(zero_copy_only=False)
                key = b.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                part = np.searchsorted(cuts, key, "left")
                gone = np.asarray(b.column(0).is_null())
                part[gone] = ((tie[gone] >> 32) * spread >> 32) - spread  # below 0, in the order of the hash
                made = [ids[e - s:e].tobytes() + end.tobytes() for s, e in zip(size.tolist(), stop.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), b.column(0), b.column(2), pa.array(made, pa.binary())],
                                                 names=["part", "doc_id", "tie", "ids"])

    def write(batches):
        def rows():
            for b in batches:
                for p, d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                    yield p, d, np.frombuffer(x.as_buffer(), kind)
        for s in _packed(rows(), 4):
            yield pa.RecordBatch.from_pylist([s], schema=_SEGMENT_TYPE)

    base = id_text(docs, id_col, text_col).withColumn("tie", F.xxhash64(F.coalesce("text", F.lit(""))))
    coded = base.mapInArrow(encode, "part long, doc_id long, tie long, ids binary")
    dealt = (coded.repartitionById(n, F.pmod("part", F.lit(n)).cast("int")).sortWithinPartitions("part", "doc_id", "tie", "ids")
             .select("part", "doc_id", "ids"))
    dealt.mapInArrow(write, "part long, first long, n_ids long, payload binary, doc_ids array<long>, doc_sizes array<long>"
                     ).write.parquet(f"{path}/segments")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    (spark.read.parquet(f"{path}/segments").groupBy("part").agg(F.sum("n_ids").alias("n_ids"), F.sum(F.size("doc_ids")).cast("long").alias("n_docs"))
     .select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"), "n_ids", "n_docs")
     .write.parquet(f"{path}/parts"))
    return path


# ---------------------------------------------------------------- reading

def _located(spark: SparkSession, path: str) -> DataFrame:
    """Segments with the place of their first id in the corpus."""
    parts = spark.read.parquet(f"{path}/parts").select("part", "start")
    segments = spark.read.parquet(f"{path}/segments")
    return segments.join(F.broadcast(parts), "part").withColumn("start", F.col("start") + F.col("first"))  # a row a part


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document of a written folder, decoded from its payloads.

    Map only: a segment holds whole documents.
    """
    ship_package(spark)

    def run(batches):
        for b in batches:
            out: list[tuple] = []
            for payload, start, names, sizes in zip(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                ids = unpack(payload.as_buffer().to_pybytes()).astype("<u4").tobytes()
                at = 0
                for doc, n in zip(names, sizes):
                    out.append((doc, start + at, n, zlib.crc32(ids[4 * at:4 * (at + n)])))
                    at += n
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*out) if out else [[]] * 4)],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (_located(spark, path).select("payload", "start", "doc_ids", "doc_sizes")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """``(start, ids)``: the corpus's ids from ``start`` to before ``stop``, a row for each segment that holds some.

    Of each such segment only the blocks that hold asked-for ids are unpacked.
    """
    ship_package(spark)

    def run(batches):
        for b in batches:
            at = b.column(1).to_pylist()
            found = [unpack(p.as_buffer().to_pybytes(), max(0, start - s), stop - s).tolist() for p, s in zip(b.column(0), at)]
            yield pa.RecordBatch.from_arrays([pa.array([max(s, start) for s in at], pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                                             names=["start", "ids"])

    held = _located(spark, path).where((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start))
    return held.select("payload", "start").mapInArrow(run, "start long, ids array<long>")
