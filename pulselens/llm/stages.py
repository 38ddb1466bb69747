"""Stages of the corpus pipeline: ``(spark, docs, sf_dir) -> DataFrame`` with the columns of ``docs``.

A stage's decision is joined back by ``doc_id`` and a hash of the text, so rows that repeat both share it.  Names that a
stage needs for itself start with ``_pl_`` and cannot clash with columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from . import decontaminate, langid, mixing, simhash, substring


def _with_text(docs: DataFrame, new: DataFrame) -> DataFrame:
    """``docs`` with the texts of ``new (doc_id, text, kept)`` put in for equal id and text; ``n_chars``, where there is
    one, follows a new text."""
    new = new.select(F.col("doc_id").alias("_pl_id"), F.xxhash64("text").alias("_pl_hash"),
                     F.col("kept").alias("_pl_text")).dropDuplicates(["_pl_id", "_pl_hash"])
    out = docs.join(new, (F.col("doc_id") == F.col("_pl_id")) & (F.xxhash64("text") == F.col("_pl_hash")), "left")
    cols: list[Column] = []
    for c in docs.columns:
        col = F.col(f"`{c}`")
        if c == "text":
            col = F.coalesce("_pl_text", col)
        elif c == "n_chars":
            col = F.when(F.col("_pl_id").isNull(), col).otherwise(F.length("_pl_text").cast(docs.schema[c].dataType))
        cols.append(col.alias(c))
    return out.select(cols)


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


#: Rows of this remainder of crc32(doc_id as text) by 4 are held out of language learning.
LANG_HELD_OUT = 2


def held_out(remainder: int, of: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % of == remainder, F.lit(False))


def language_model(docs: DataFrame) -> tuple:
    """Pieces, languages and probabilities, learned from the rows that are not held out."""
    import public_tokenizers
    pieces = langid.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces, *langid.learn(docs.where(~held_out(LANG_HELD_OUT, 4)), pieces)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those of which no learned language explains more than half, go."""
    return langid.accepted(docs, language_model(docs), 0.5)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays, once.

    Rows of one doc_id whose texts are no near-duplicates are documents of their own: each group they are the smallest
    of keeps one.  Of several texts under a group's smallest doc_id the one with the smallest hash stays; of rows that
    repeat id and text the first by their other columns.  Rows without doc_id stay, as no id names them as copies.
    """
    out = simhash.labelled_texts(docs, shingle=4, max_bits=4)
    kept = (out.where("component_id = doc_id").groupBy("root").agg(F.min("component_id").alias("_pl_id"), F.min("content").alias("_pl_hash"))
            .select("_pl_id", "_pl_hash").distinct())
    # a scan of its own for rows without id: the filter reaches Parquet, which skips row groups that have none
    known, unknown = docs.where("doc_id is not null"), docs.where("doc_id is null")
    known = known.withColumn("_pl_content", F.xxhash64("text"))
    rest = known.join(kept, (F.col("doc_id") == F.col("_pl_id")) & (F.col("_pl_content") == F.col("_pl_hash")), "left_semi")
    order = [F.col(f"`{f.name}`") for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType) and f.name not in ("doc_id", "text")]
    first = Window.partitionBy("doc_id", "_pl_content").orderBy(*order, "doc_id")
    once = rest.withColumn("_pl_n", F.row_number().over(first)).where("_pl_n = 1").select(*_columns(docs))
    return once.unionAll(unknown)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words or more that a smaller doc_id holds go; texts without any stay as they are, byte for byte."""
    out = substring.factors(docs, window=13)
    return _with_text(docs, out.where("n_removed > 0"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a stretch of a benchmark item go."""
    leaks = decontaminate.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    lost = leaks.where("size(matches) > 0").select(F.col("doc_id").alias("_pl_id"), F.col("content").alias("_pl_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_pl_id")) & (F.xxhash64("text") == F.col("_pl_hash"))
    return docs.join(lost, same, "left_anti").select(*_columns(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mix, written in that order."""
    out = mixing.mix(docs)
    return out.repartitionByRange(F.col("mix_pos").asc_nulls_last()).sortWithinPartitions(F.col("mix_pos").asc_nulls_last())
