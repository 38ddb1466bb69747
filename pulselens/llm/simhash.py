"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint's 64 bits are cut into segments of 23, 23 and 18 bits.  The perfect binary Golay code assigns every
23-bit word to one codeword within three bits; a segment's keys are the indices of the codewords of all words within
one bit of it (one or six indices), so two segments that differ in at most two bits share a key.

Four differing bits over three segments leave two cases (pigeonhole):

* no segment differs in more than two bits: the two texts share a triple of codeword indices, one of each segment;
* some segment differs in three or four: the other two differ in at most one bit together, so one of them is equal and
  the other shares a codeword index.

Rows with equal keys meet in one sorted partition; each candidate is verified by its exact bit distance.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import id_text, n_partitions, saved, ship_package
from .components import components
from .textkit import texts_of

SEED = 42
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Generator polynomial of the binary Golay code.
GENERATOR = 0xC75
#: The key scheme's guarantee.
MAX_BITS = 4
#: Parts that the members of one component are dealt to when they get its label.
_SALTS = 16


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: str, shingle: int) -> int:
    """A bit is 1 if set in over half of the XXH64 values of the word shingles (A-Z lower-cased, repeats included)."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # splits at the six ASCII white-space bytes
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return _majority(xxhash.xxh64_digest(line, SEED), 1)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    begins = (ends - size)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_digest
    return _majority(b"".join([digest(line[s:e], SEED) for s, e in zip(begins, ends[shingle - 1:].tolist())]),
                     len(begins))


def _majority(digests: bytes, n: int) -> int:
    """The bits set in over half of ``n`` big-endian digests."""
    count = np.zeros(64, np.int64)
    raw = np.frombuffer(digests, np.uint8).reshape(n, 8)
    for i in range(0, n, 1 << 16):
        count += np.unpackbits(raw[i:i + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` for every row; ``fp`` holds the 64 bits as a signed long.  A null or wordless text gives 0."""
    return _fingerprints(id_text(docs, id_col, text_col), shingle)


def _fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``fp`` in place of ``text``; columns after ``text`` are kept."""
    ship_package(docs.sparkSession)

    def run(batches):
        for b in batches:
            fp = [fingerprint(t, shingle) for t in texts_of(b)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(fp, np.uint64).view(np.int64)), *b.columns[2:]],
                names=["doc_id", "fp", *b.schema.names[2:]])

    more = "".join(f", {f.name} {f.dataType.simpleString()}" for f in docs.schema.fields[2:])
    return docs.mapInArrow(run, f"doc_id long, fp long{more}")


# ---------------------------------------------------------------- Golay keys

def _remainders(count: int) -> np.ndarray:
    """Remainder of ``m * x**11`` by the generator, for every 12-bit ``m``."""
    r = np.arange(count, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        r = np.where(r >> bit & 1, r ^ (GENERATOR << (bit - 11)), r)
    return r


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders; for each syndrome the error patterns that lead to its codewords (up to 6), and their number."""
    rem = _remainders(1 << 12)
    leader = np.zeros(1 << 11, np.int64)
    bits = [1 << i for i in range(23)]
    for a in range(23):
        for b in range(a, 23):
            for c in range(b, 23):
                e = bits[a] | bits[b] | bits[c]
                leader[(e & 0x7FF) ^ rem[e >> 11]] = e
    one = np.array([(b & 0x7FF) ^ rem[b >> 11] for b in bits])
    errors, count = np.zeros((1 << 11, 6), np.int64), np.zeros(1 << 11, np.int64)
    for s in range(1 << 11):
        found = sorted({int(leader[s]), *(int(b ^ leader[s ^ o]) for b, o in zip(bits, one))})
        errors[s, :len(found)], count[s] = found, len(found)
    return rem, errors, count


def golay_keys(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices (12 bits) of all words within one bit of each 23-bit word: ``(n, 6)`` and which of them count."""
    rem, errors, count = _tables()
    syndrome = (word & 0x7FF) ^ rem[word >> 11]
    return (word[:, None] ^ errors[syndrome]) >> 11, np.arange(6) < count[syndrome][:, None]


def keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(key, position)``: every key of every fingerprint, with the fingerprint's position."""
    fp = fp.astype(np.uint64)
    seg = [((fp >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in SEGMENTS]
    gol = [golay_keys(x) for x in seg]
    (a, am), (b, bm), (c, cm) = gol
    triple = (a[:, :, None, None] << 24) | (b[:, None, :, None] << 12) | c[:, None, None, :]
    mask = am[:, :, None, None] & bm[:, None, :, None] & cm[:, None, None, :]
    out, at = [triple[mask]], [np.nonzero(mask)[0]]
    tag = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                tag += 1
                k, m = gol[j]
                out.append(((seg[i][:, None] << 12) | k | (tag << 40))[m])
                at.append(np.nonzero(m)[0])
    return np.concatenate(out), np.concatenate(at)


# ---------------------------------------------------------------- links

def linked(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links (at most one less than members) that connect exactly what links of ``max_bits`` or fewer bits connect."""
    out: list[tuple[int, int]] = []
    left = fps.astype(np.uint64)
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                found, left = left[near], left[~near]
                out += [(int(x), int(y)) for y in found]
                queue += list(found)
    return out


def _links_of_sorted(batches, max_bits: int, max_run: int):
    """From rows sorted by key: verified links within each key.

    A key with more than ``max_run`` members gives its members alone (``b`` null), for ``_half_way``.
    """
    key0, members, over = None, [], False

    def close(rows):
        if over:
            return
        run = np.unique(np.concatenate(members)) if members else np.zeros(0, np.int64)
        if len(run) > 1:
            rows += linked(run.view(np.uint64), max_bits)

    for batch in batches:
        key = batch.column(0).to_numpy(zero_copy_only=False)
        fp = batch.column(1).to_numpy(zero_copy_only=False)
        if not len(key):
            continue
        rows: list[tuple[int, int]] = []
        alone: list[np.ndarray] = []
        cut = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        size = np.diff(cut)
        # runs of two are by far the most common; the first and last run of a batch may go on in another batch
        two = cut[:-1][1:-1][size[1:-1] == 2] if len(size) > 2 else np.zeros(0, np.int64)
        x, y = fp[two], fp[two + 1]
        near = np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)) <= max_bits
        rows += list(zip(x[near].view(np.uint64).tolist(), y[near].view(np.uint64).tolist()))
        whole = set((np.flatnonzero(size[1:-1] > 2) + 1).tolist()) if len(size) > 2 else set()
        for r in sorted({0, len(size) - 1} | whole):
            part = fp[cut[r]:cut[r + 1]]
            if r not in (0, len(size) - 1):
                if len(part) > max_run:
                    alone.append(part)
                else:
                    rows += linked(np.unique(part).view(np.uint64), max_bits)
                continue
            k = key[cut[r]]
            if k != key0:
                close(rows)
                key0, members, over = k, [], False
            if over:
                alone.append(part)
            else:
                members.append(part)
                if sum(map(len, members)) > max_run:
                    alone += members
                    members, over = [], True
        yield _pairs(rows, alone)
    rows = []
    close(rows)
    yield _pairs(rows, [])


def _pairs(rows: list[tuple[int, int]], alone: list[np.ndarray]) -> pa.RecordBatch:
    two = np.array(rows, np.uint64).reshape(-1, 2).view(np.int64)
    one = np.concatenate(alone) if alone else np.zeros(0, np.int64)
    a = pa.array(np.concatenate([two[:, 0], one]))
    b = pa.array(np.concatenate([two[:, 1], one]), mask=np.arange(len(two) + len(one)) >= len(two))
    return pa.RecordBatch.from_arrays([a, b], names=["a", "b"])


def _half_way(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links among ``fps (fp)`` without comparing them: two words at distance 2r or less share a word within r of both.

    Each word meets the smallest word that shares one of its ``1 + 64 + 2016`` half-way words (for four bits), so the
    rows grow with the number of words, not with its square.
    """
    masks = [0]
    if max_bits >= 2:
        masks += [1 << i for i in range(64)]
    if max_bits >= 4:
        masks += [(1 << i) | (1 << j) for i in range(64) for j in range(i)]
    signed = np.array(masks, np.uint64).view(np.int64).tolist()
    spread = fps.select("fp", F.explode(F.array(*[F.lit(m) for m in signed])).alias("m")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("m")).alias("z"))
    low = spread.groupBy("z").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    return spread.join(low, "z").where(F.col("fp") != F.col("b")).select(F.col("fp").alias("a"), "b").distinct()


def links(classes: DataFrame, max_bits: int = MAX_BITS, max_run: int = 200_000) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``classes (fp)``: their components are those of all links of at
    most ``max_bits`` (0 to 4) differing bits.  Not every pair of a group is emitted.

    ``max_run`` bounds what one task compares at a time; the members of larger keys go through half-way words instead.
    Half-way words need an even bound.
    """
    if max_bits not in (0, 2, 4):
        raise ValueError("max_bits must be 0, 2 or 4")
    spark = classes.sparkSession
    ship_package(spark)

    def emit(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(fp), 4096):
                part = fp[i:i + 4096]
                k, at = keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(part[at])], names=["key", "fp"])

    n = n_partitions(spark)
    # a fingerprint becomes up to 252 rows, so the few bytes of fingerprints are dealt to all tasks first
    found = saved(classes.select("fp").repartition(n, "fp").mapInArrow(emit, "key long, fp long")
                  .repartition(n, "key").sortWithinPartitions("key")
                  .mapInArrow(lambda it: _links_of_sorted(it, max_bits, max_run), "a long, b long").distinct())
    pairs = found.where("b is not null")
    hot = found.where("b is null").select(F.col("a").alias("fp"))
    if not hot.isEmpty():
        pairs = pairs.unionAll(_half_way(hot, max_bits))
    return pairs


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = MAX_BITS, max_run: int = 200_000,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at most ``max_bits`` differing bits, itself
    included.  Null and wordless texts have fingerprint 0 and link like any other; a null ``doc_id`` never is a
    component's name (null if the component has no other); repeated rows stay, each with its component; an empty table
    gives no rows; other columns are not read.
    """
    return _labelled(fingerprints(docs, shingle, id_col, text_col), max_bits, max_run).select("doc_id", "fp", "component_id")


def labelled_texts(docs: DataFrame, shingle: int = 4, max_bits: int = MAX_BITS, max_run: int = 200_000,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``near_duplicates`` with ``content``, a hash of the text, and ``root``, which tells components of one smallest
    ``doc_id`` apart."""
    texts = id_text(docs, id_col, text_col).withColumn("content", F.xxhash64("text"))
    return _labelled(_fingerprints(texts, shingle), max_bits, max_run)


def _labelled(fingerprinted: DataFrame, max_bits: int, max_run: int) -> DataFrame:
    fp = saved(fingerprinted)
    classes = fp.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(classes, max_bits, max_run))
    named = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", "root", F.pmod(F.xxhash64("fp"), F.lit(_SALTS)).alias("salt"))
    # a component may hold a third of all fingerprints: its label is repeated for each salt, its members are dealt by
    # salt; a fingerprint without links needs no label but its own
    low = named.where("root is not null").groupBy("root").agg(F.min("first_id").alias("component_id")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))))
    label = named.withColumn("root", F.coalesce("root", "fp")).join(low, ["root", "salt"], "left").select(
        "fp", "root", F.coalesce("component_id", "first_id").alias("component_id"))
    return fp.join(label, "fp")
