"""Token counts of a byte-level BPE vocabulary by heap-and-linked-list pair merging.

A text is cut into pieces by the vocabulary's fixed pattern.  A piece's bytes form a linked list; a heap holds its
adjacent pairs by merge rank.  The lowest pair is merged, its new neighbours enter the heap, until no pair has a rank.
The count is the initial symbols less the merges; no identifiers are produced.  Counts of short pieces are remembered.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import SLICE_BYTES, id_text, ship_package
from .textkit import slices, texts_of

#: Fixed value: the pattern of byte-level pre-tokenisation (white space as in Unicode's White_Space).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


class Vocabulary:
    """Merge ranks by byte strings, and the special strings that count as one token each."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        if model["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary is asked for")
        byte_of = {c: b for b, c in _byte_characters().items()}
        self.special = [t["content"] for t in spec.get("added_tokens", []) if t["content"]]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        ids = {bytes(byte_of[c] for c in s): i for s, i in model["vocab"].items() if all(c in byte_of for c in s)}
        self.symbol = [ids[bytes([b])] for b in range(256)]
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b = (bytes(byte_of[c] for c in x) for x in (a, b))
            self.merge[ids[a], ids[b]] = (rank, ids[a + b])


def _byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte: itself where printable, else from U+0100 on in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


def merged_length(piece: bytes, vocabulary: Vocabulary) -> int:
    """Symbols left of a piece after all merges, lowest rank first and leftmost of equals."""
    n = len(piece)
    if n < 2:
        return n
    merge = vocabulary.merge
    sym = [vocabulary.symbol[b] for b in piece]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(m[0], i, m[1]) for i in range(n - 1) if (m := merge.get((sym[i], sym[i + 1])))]
    heapq.heapify(heap)
    left = n
    while heap:
        _, i, new = heapq.heappop(heap)
        j = after[i]
        # a stale entry: its left symbol is gone, or the pair there has become another
        if sym[i] < 0 or j >= n or (m := merge.get((sym[i], sym[j]))) is None or m[1] != new:
            continue
        sym[i], sym[j] = new, -1
        k = after[i] = after[j]
        left -= 1
        if k < n:
            before[k] = i
            if m := merge.get((new, sym[k])):
                heapq.heappush(heap, (m[0], i, m[1]))
        h = before[i]
        if h >= 0 and (m := merge.get((sym[h], new))):
            heapq.heappush(heap, (m[0], h, m[1]))
    return left


class Counter(dict):
    """Tokens of a text; as a dictionary, the counts of pieces seen so far (the short ones, up to ``room``)."""

    def __init__(self, raw: bytes, room: int = 1_000_000):
        super().__init__()
        self.vocabulary, self.room = Vocabulary(raw), room
        self.pieces = regex.compile(PATTERN).findall
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, special))).split if special else lambda t: [t]

    def __missing__(self, piece: str) -> int:
        n = merged_length(piece.encode("utf-8", "surrogatepass"), self.vocabulary)
        if len(piece) <= 48:
            if len(self) >= self.room:
                self.clear()
            self[piece] = n
        return n

    def tokens(self, text: str) -> int:
        parts = self.cut(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.pieces(p))) for p in parts)


_READY: dict[str, Counter] = {}


def _counter(raw: bytes) -> Counter:
    """One counter for each vocabulary in a Python worker."""
    name = hashlib.sha256(raw).hexdigest()
    if name not in _READY:
        _READY.clear()
        _READY[name] = Counter(raw)
    return _READY[name]


def vocabulary_bytes(spark: SparkSession, path: str) -> bytes:
    """The file at ``path`` as the driver sees it; only this fixed public file is broadcast."""
    with open(path, "rb") as f:
        return f.read()


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row: what the vocabulary's library gives without added
    begin, end or padding tokens; special strings inside a text count as one token.

    A null or empty text has no bytes and no tokens; repeated rows are counted alike; an empty table gives no rows;
    other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    raw = spark.sparkContext.broadcast(vocabulary_bytes(spark, vocabulary_path))

    def run(batches):
        counter = _counter(raw.value)
        for batch in batches:
            for b in slices(batch, limit=SLICE_BYTES):
                texts = texts_of(b)
                n = np.fromiter(map(counter.tokens, texts), np.int64, len(texts))
                size = np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(n), pa.array(n > limit)],
                                                 names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
