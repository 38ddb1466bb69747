"""Quality scores by a regularised quadratic discriminant over transformed document statistics.

Each class of labelled documents gives a mean and a covariance of the statistics; covariances are shrunk towards the
pooled one and towards its diagonal.  A document's score is the posterior of label 1, from the difference of the two
Mahalanobis log-densities; the Cholesky factors are found once, on the driver, and sent with the means.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import SLICE_BYTES, id_text, saved, ship_package
from .textkit import slices, utf8, word_hashes, words

#: Statistics of a document, in the order of the feature vector.
STATISTICS = ("length", "symbols", "upper_case", "digits", "repeated_next", "distinct_words", "bare_symbols",
              "word_length", "stops", "line_breaks", "common_word")
#: Weight of the pooled covariance in each class's, and of the diagonal in the pooled one.
POOLED, DIAGONAL = 0.15, 0.05
_SHARE = 0.01

_CLASS = np.zeros(256, np.uint8)  # 0: letters, spaces and bytes of non-ASCII characters
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"()-"]] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3


def statistics(column: pa.Array) -> np.ndarray:
    """``(texts, statistics)``: shares as log-odds, counts as logarithms; a text without words has a zero vector's values
    of its shares (no symbols, no repeats, all words distinct).

    Shares are of a text's bytes or of its words, so none passes 1 and every statistic is finite."""
    data, at = utf8(column)
    n = len(column)
    size = np.diff(at)
    s, e, first = words(data, at)
    count = np.diff(first)
    doc = np.repeat(np.arange(n), count)
    h = word_hashes(data, s, e)

    def per_text(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return total[at[1:]] - total[at[:-1]]

    def per_word(flag: np.ndarray) -> np.ndarray:
        return np.bincount(doc[flag], minlength=n)

    def odds(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        x = part / np.maximum(whole, 1)
        return np.log((x + _SHARE) / (1 - x + _SHARE))

    kind = _CLASS[data]
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    order = np.lexsort((h, doc))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    begin = np.flatnonzero(new)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, doc[order][begin], np.diff(np.concatenate([begin, [len(h)]])))
    total = np.concatenate([[0], np.cumsum(kind == 1, dtype=np.int64)])
    bare = total[e] - total[s] == e - s
    out = np.empty((n, len(STATISTICS)))
    for i, x in enumerate((
            np.log1p(size), odds(per_text(kind == 1), size), odds(per_text(kind == 2), size),
            odds(per_text(kind == 3), size), odds(per_word(again), count), odds(np.bincount(doc[order][new], minlength=n), count),
            odds(per_word(bare), count), np.log1p(size / np.maximum(count, 1)), odds(per_text(data == 46), size),
            odds(per_text(data == 10), size), odds(most, count))):
        out[:, i] = x
    return out


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, f0, f1, ...)``: the statistics of every row's whole text (null: empty)."""
    ship_package(docs.sparkSession)
    names = [f"f{i}" for i in range(len(STATISTICS))]

    def run(batches):
        for batch in batches:
            for b in slices(batch, limit=SLICE_BYTES):
                x = statistics(b.column(1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), *(pa.array(np.ascontiguousarray(x[:, i])) for i in range(len(names)))],
                    names=["doc_id", *names])

    return id_text(docs, id_col, text_col).mapInArrow(run, ", ".join(["doc_id long", *(f"{x} double" for x in names)]))


class Discriminant:
    """Means, inverse Cholesky factors and log-determinants of both classes."""

    def __init__(self, prior: float, mean=None, factor=None, log_det=None):
        self.prior, self.mean, self.factor, self.log_det = prior, mean, factor, log_det

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.mean is None:
            return np.full(len(x), self.prior)
        density = []
        for k in (0, 1):
            z = (x - self.mean[k]) @ self.factor[k].T
            density.append(-0.5 * ((z * z).sum(axis=1) + self.log_det[k]))
        margin = density[1] - density[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def fit(labelled: DataFrame, label: str = "label") -> Discriminant:
    """From ``labelled (label, f0, f1, ...)``: one aggregation gives counts, sums and products of each class.

    With fewer than two rows of a class there is no discriminant: every score is the share of label 1 (0.5 without
    labels).
    """
    d = len(STATISTICS)
    names = [f"f{i}" for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    rows = {r["y"]: r for r in labelled.where(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("y")).agg(
        F.count("*").alias("n"), *[F.sum(x).alias(f"s_{x}") for x in names],
        *[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"p_{i}_{j}") for i, j in pairs]).collect()}
    n = {k: rows[k]["n"] if k in rows else 0 for k in (0, 1)}
    if min(n.values()) < 2:
        return Discriminant((n[1] / sum(n.values())) if sum(n.values()) else 0.5)
    mean, scatter = [], []
    for k in (0, 1):
        m = np.array([rows[k][f"s_{x}"] for x in names]) / n[k]
        p = np.zeros((d, d))
        for i, j in pairs:
            p[i, j] = p[j, i] = rows[k][f"p_{i}_{j}"] / n[k]
        mean.append(m)
        scatter.append(p - np.outer(m, m))
    pooled = (n[0] * scatter[0] + n[1] * scatter[1]) / (n[0] + n[1])
    pooled = (1 - DIAGONAL) * pooled + DIAGONAL * np.diag(np.diag(pooled)) + 1e-6 * np.eye(d)
    factor, log_det = [], []
    for k in (0, 1):
        lower = np.linalg.cholesky((1 - POOLED) * scatter[k] + POOLED * pooled)
        factor.append(np.linalg.inv(lower))
        log_det.append(2 * np.log(np.diag(lower)).sum())
    return Discriminant(n[1] / (n[0] + n[1]), mean, factor, log_det)


def score_quality(docs: DataFrame, labels: DataFrame, held_out, threshold: float = 0.3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Learns from all labelled rows for which the column expression ``held_out`` (over ``doc_id``) is false; labels other
    than 0 and 1, and labels of unknown documents, add nothing.  ``predicted`` is 1 if ``score >= threshold``.  A null
    text is empty; an empty text gets the score of its statistics; repeated rows are scored alike (and each teaches); an
    empty table gives no rows; other columns are not read.
    """
    stats = saved(document_statistics(docs, id_col, text_col).withColumn("held_out", held_out))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label"))
    model = fit(stats.where("not held_out").join(marks, "doc_id"))
    names = [f"f{i}" for i in range(len(STATISTICS))]

    def run(batches):
        for b in batches:
            x = np.column_stack([b.column(i + 2).to_numpy(zero_copy_only=False) for i in range(len(names))])
            p = model.score(x.reshape(b.num_rows, len(names)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return stats.select("doc_id", "held_out", *names).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")
