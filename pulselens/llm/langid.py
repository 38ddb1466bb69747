"""Language identification by segmentation-marginalised unigrams.

The pieces are those of a fixed public vocabulary; each language has a probability for every piece, learned by
expectation-maximisation.  A word's likelihood is the sum over all its segmentations into pieces, found by a forward
pass over its characters; a text's likelihood is the product over its words, and its language the most likely one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import SLICE_BYTES, ship_package
from .textkit import NON_LETTERS, distinct, slices, utf8, words

#: Probability of a single byte that no piece explains, the same in all languages.
BYTE_FLOOR = 1e-7
#: Count added to every piece of every language.
SMOOTHING = 0.02
_MARK = "▁".encode()


def vocabulary(path: str) -> list[bytes]:
    """The lower-cased letter pieces of a sentencepiece vocabulary; a leading space stands for its word mark."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    out = set()
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i):
            continue
        raw = sp.id_to_piece(i).lower().encode()
        raw = raw.replace(_MARK, b" ")
        body = raw[1:] if raw[:1] == b" " else raw
        if body and b" " not in body and not NON_LETTERS[np.frombuffer(body, np.uint8)].any():
            out.add(raw)
    return sorted(out | {b" "})


class Trie:
    """Pieces as byte strings: ``step`` follows one byte from many states at once."""

    def __init__(self, pieces: list[bytes]):
        key: dict[tuple[int, int], int] = {}
        piece = [-1]
        self.longest = max(map(len, pieces))
        for n, raw in enumerate(pieces):
            state = 0
            for b in raw:
                state = key.setdefault((state, b), len(key) + 1)
                if state == len(piece):
                    piece.append(-1)
            piece[state] = n
        flat = np.array([s * 256 + b for s, b in key], np.int64)
        order = np.argsort(flat)
        self.edge, self.to = flat[order], np.array(list(key.values()), np.int64)[order]
        self.piece = np.array(piece, np.int64)

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The next state, or -1."""
        want = state * 256 + byte
        at = np.minimum(np.searchsorted(self.edge, want), len(self.edge) - 1)
        return np.where(self.edge[at] == want, self.to[at], -1)

    def spans(self, text: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """All pieces inside equally long texts (one a row), by start: ``(start, end, rows, pieces)``."""
        n = text.shape[1]
        for i in range(n):
            rows = np.arange(len(text))
            state = np.zeros(len(text), np.int64)
            for j in range(i, min(n, i + self.longest)):
                state = self.step(state, text[rows, j].astype(np.int64))
                rows, state = rows[state >= 0], state[state >= 0]
                if not len(rows):
                    break
                hit = self.piece[state] >= 0
                if hit.any():
                    yield i, j + 1, rows[hit], self.piece[state[hit]]


def _by_length(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    order = np.argsort(size, kind="stable")
    cut = np.flatnonzero(np.diff(size[order])) + 1
    for rows in np.split(order, cut):
        if len(rows):
            raw = b"".join([texts[r] for r in rows.tolist()])
            yield rows, np.frombuffer(raw, np.uint8).reshape(len(rows), -1)


#: Bytes of a word that are segmented together; a longer word is a sequence of such parts.
PART = 64


def parts(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every part of the words, and the word each belongs to.

    A word of at most ``PART`` bytes is one part.  A longer one is cut after that many bytes, or up to three before, so
    that no character is cut; its pieces do not reach over a cut, which keeps unbroken texts linear.
    """
    long = np.flatnonzero(e - s > PART)
    if not len(long):
        return s, e, np.arange(len(s))
    cuts, owner = [], []
    for w in long.tolist():
        at = np.arange(s[w] + PART, e[w], PART)
        for _ in range(3):  # back to the first byte of a character
            at = np.where((data[at] & 0xC0) == 0x80, at - 1, at)
        cuts.append(at)
        owner.append(np.full(len(at), w))
    start, word = np.concatenate([s, *cuts]), np.concatenate([np.arange(len(s)), *owner])
    order = np.lexsort((start, word))
    start, word = start[order], word[order]
    last = np.append(word[1:] != word[:-1], True)
    return start, np.where(last, e[word], np.append(start[1:], 0)), word


def forward(trie: Trie, prob: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Log-likelihood of each text (with its leading space) in each language, over all segmentations."""
    out = np.zeros((len(texts), prob.shape[1]))
    for rows, text in _by_length(texts):
        m, n = text.shape
        alpha = np.zeros((n + 1, m, prob.shape[1]))
        alpha[0] = 1
        scale = np.zeros((m, prob.shape[1]))
        at = 0
        for i, j, who, piece in trie.spans(text):
            while at < i:  # every start up to i has pushed its mass on: byte fallback, then rescale what lies ahead
                at = _advance(alpha, scale, at, trie.longest)
            alpha[j, who] += alpha[i, who] * prob[piece]
        while at < n:
            at = _advance(alpha, scale, at, trie.longest)
        out[rows] = np.log(alpha[n]) + scale
    return out


def _advance(alpha: np.ndarray, scale: np.ndarray, at: int, longest: int) -> int:
    alpha[at + 1] += alpha[at] * BYTE_FLOOR
    if at % 16 == 15:  # keeps long words from vanishing: what pieces can have reached is divided by the mass here
        f = alpha[at + 1].copy()
        alpha[at + 1:at + 1 + longest] /= f
        scale += np.log(f)
    return at + 1


def fit(counts: dict[str, dict[bytes, int]], pieces: list[bytes], rounds: int = 3) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the probability of every piece in each, from word counts by EM over all segmentations.

    The words are parts (see ``parts``), with a leading space where a word begins.
    """
    trie = Trie(pieces)
    langs = sorted(counts)
    every = sorted({w for c in counts.values() for w in c})
    weight = np.array([[counts[x].get(w, 0) for x in langs] for w in every], float).reshape(len(every), len(langs))
    groups = []
    for rows, text in _by_length(every):
        groups.append((rows, text.shape, list(trie.spans(text))))
    prob = np.full((len(pieces), len(langs)), 1 / max(1, len(pieces)))
    for _ in range(rounds):
        total = np.full_like(prob, SMOOTHING)
        for rows, (m, n), spans in groups:
            a, b = np.zeros((n + 1, m, len(langs))), np.zeros((n + 1, m, len(langs)))
            a[0], b[n] = 1, 1
            pushed = 0
            for i, j, who, p in spans:
                while pushed < i:
                    a[pushed + 1] += a[pushed] * BYTE_FLOOR
                    pushed += 1
                a[j, who] += a[i, who] * prob[p]
            while pushed < n:
                a[pushed + 1] += a[pushed] * BYTE_FLOOR
                pushed += 1
            done = n
            for i, j, who, p in sorted(spans, key=lambda s: -s[0]):
                while done > i + 1:  # position done - 1 has all its pieces; add its byte fallback
                    done -= 1
                    b[done] += b[done + 1] * BYTE_FLOOR if done < n else 0
                b[i, who] += b[j, who] * prob[p]
            share = np.divide(weight[rows], a[n], out=np.zeros_like(a[n]), where=a[n] > 0)
            for i, j, who, p in spans:
                np.add.at(total, p, a[i, who] * prob[p] * b[j, who] * share[who])
        prob = total / total.sum(axis=0)
    return langs, prob


def _spelt(data: np.ndarray, start: np.ndarray, end: np.ndarray, head: np.ndarray) -> list[bytes]:
    """Parts as bytes, with a leading space where a word begins."""
    return [b" " * h + data[x:y].tobytes() for x, y, h in zip(start.tolist(), end.tolist(), head.tolist())]


def word_counts(docs: DataFrame, docs_per_lang: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``(lang, word, n)`` over a bounded sample: of each language the rows whose hash falls in the share of all hashes
    that ``docs_per_lang`` is of its rows (all rows of a smaller language); rows that repeat count once."""
    known = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
                        F.xxhash64(F.col(id_col), F.col(text_col)).alias("h")).where("lang is not null")
    share = known.groupBy("lang").agg((F.lit(float(docs_per_lang)) / F.count("*")).alias("share"))  # one row a language
    top = (known.join(F.broadcast(share), "lang").where(F.pmod("h", F.lit(1 << 40)) < F.col("share") * float(1 << 40))
           .dropDuplicates(["lang", "h"]))

    def run(batches):
        for batch in batches:
            for b in slices(batch, limit=SLICE_BYTES):
                data, at = utf8(pc.utf8_lower(b.column(1)))
                s, e, first = words(data, at, NON_LETTERS)
                lang = np.repeat(np.asarray(b.column(0).to_pylist(), object), np.diff(first))
                x, y, word = parts(data, s, e)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lang[word], pa.string()), pa.array(_spelt(data, x, y, x == s[word]), pa.binary())], names=["lang", "word"])

    return (top.select("lang", "text").mapInArrow(run, "lang string, word binary")
            .groupBy("lang", "word").agg(F.count("*").alias("n")))


def learn(docs: DataFrame, pieces: list[bytes], docs_per_lang: int = 250, rounds: int = 3, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Fit on a sample of about ``docs_per_lang`` documents a language, which does not grow with the table; its word
    counts go to the driver."""
    ship_package(docs.sparkSession)
    counts: dict[str, dict[bytes, int]] = {}
    for r in word_counts(docs, docs_per_lang, id_col, text_col, lang_col).toLocalIterator():
        counts.setdefault(r.lang, {})[bytes(r.word)] = r.n
    return fit(counts, pieces, rounds)


class _Scorer:
    """Scores texts; remembers the likelihoods of up to ``room`` distinct parts of words by two hashes."""

    def __init__(self, model: tuple[list[bytes], list[str], np.ndarray], room: int = 200_000):
        pieces, self.langs, self.prob = model
        self.trie, self.room = Trie(pieces), room
        self.key = self.check = np.zeros(0, np.uint64)
        self.value = np.zeros((0, len(self.langs)), np.float32)

    def likelihoods(self, h: np.ndarray, check: np.ndarray, spell) -> np.ndarray:
        """Log-likelihoods of the parts with the ascending hashes ``h``; ``spell(rows)`` gives their bytes."""
        at = np.minimum(np.searchsorted(self.key, h), max(len(self.key) - 1, 0))
        have = (self.key[at] == h) & (self.check[at] == check) if len(self.key) else np.zeros(len(h), bool)
        out = np.empty((len(h), len(self.langs)), np.float32)
        out[have] = self.value[at[have]]
        new = np.flatnonzero(~have)
        if len(new):
            out[new] = forward(self.trie, self.prob, spell(new))
            if len(self.key) + len(new) > self.room:
                self.key, self.check, self.value = h, check, out
            else:
                at = np.searchsorted(self.key, h[new])
                self.key, self.check = np.insert(self.key, at, h[new]), np.insert(self.check, at, check[new])
                self.value = np.insert(self.value, at, out[new], axis=0)
        return out

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Predicted language (index, -1: no letter) and posterior of each text, under equal priors."""
        low = pc.utf8_lower(pc.fill_null(column, ""))
        data, at = utf8(low)
        s, e, first = words(data, at, NON_LETTERS)
        n = len(low)
        if not self.langs:
            return np.full(n, -1), np.zeros(n)
        start, end, word = parts(data, s, e)
        head = start == s[word]
        where, group, h, check = distinct(data, start, end, head)
        order = np.argsort(h, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        where = where[order]
        like = self.likelihoods(h[order], check[order], lambda rows: _spelt(data, *(x[where[rows]] for x in (start, end, head))))
        edge = np.searchsorted(start, at)
        text = np.zeros((n, len(self.langs)))
        full = np.flatnonzero(np.diff(edge))
        if len(full):
            text[full] = np.add.reduceat(like[rank[group]], edge[full], axis=0, dtype=np.float64)
        best = text.argmax(axis=1)
        post = 1 / np.exp(text - text.max(axis=1, keepdims=True)).sum(axis=1)
        # bytes of non-ASCII characters count as letters above; only texts without ASCII letters need a closer look
        lettered = np.add.reduceat(np.concatenate([~NON_LETTERS[data] & (data < 128), [0]]).astype(np.int64),
                                   np.minimum(at[:-1], len(data)))
        lettered[np.diff(at) == 0] = 0
        for i in np.flatnonzero(lettered == 0).tolist():
            if not any(c.isalpha() for c in low[i].as_py()):
                best[i], post[i] = -1, 0.0
        return best, post


def _judged(docs: DataFrame, model: tuple[list[bytes], list[str], np.ndarray], text_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` as ``k0``, ``k1``, ... with ``lang_pred`` and ``score`` of the text."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # the public vocabulary's size times the number of languages
    sent = keep if text_col in keep else [*keep, text_col]
    text = sent.index(text_col)
    base = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(sent)])
    kept = [f"k{i}" for i in range(len(keep))]
    kinds = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in base.schema.fields[:len(keep)]),
                       "lang_pred string", "score double"])

    def run(batches):
        scorer = _Scorer(shared.value)
        langs = np.array([*scorer.langs, "und"], object)
        for batch in batches:
            for b in slices(batch, f"k{text}", SLICE_BYTES >> 2):
                best, post = scorer.texts(b.column(text))
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:len(kept)], pa.array(langs[best], pa.string()), pa.array(np.asarray(post, float))],
                    names=[*kept, "lang_pred", "score"])

    return base.mapInArrow(run, kinds)


def identify(docs: DataFrame, model: tuple[list[bytes], list[str], np.ndarray], id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row; ``model`` is ``(pieces, langs, prob)``.

    ``lang_pred`` is a learned language, the first of equally likely ones; ``score`` is its share of the likelihood,
    between 0 and 1.  A null or empty text, and one without letters, gives ``und`` and 0; so does every text if no
    language was learned.  Repeated rows are judged alike; an empty table gives no rows; other columns are not read.
    """
    return _judged(docs, model, text_col, [id_col]).select(F.col("k0").cast("long").alias("doc_id"), "lang_pred", "score")


def accepted(docs: DataFrame, model: tuple[list[bytes], list[str], np.ndarray], least: float = 0.5,
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with a score above ``least``."""
    return (_judged(docs, model, text_col, docs.columns).where((F.col("lang_pred") != "und") & (F.col("score") > least))
            .select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)]))
