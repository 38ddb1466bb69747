"""Mixing sources to target weights by Pfair scheduling, with DataFrame and SQL functions only.

Each source's documents, in a hashed order, form blocks of ``block_docs``.  A source of weight ``m`` out of ``D``, the sum
of the weights, has its block ``k`` released at slot ``floor(k D / m)`` and due before slot ``ceil((k + 1) D / m)``.
Earliest deadline first then fills every slot and meets every window, so at each slot each source has given its exact
share to within less than one block.  Weights are the given integers over their common divisor, not rounded.  The
schedule repeats after ``D`` slots and is made once, up to there or to the last block of the table if that comes first.
Each slot depends on the one before, so one task makes it: (slots x sources) small steps, in pieces of bounded memory.

Numbering does not gather a source in one task: documents are dealt to ranges of the hashed order, ranges are counted,
and a document's number is the count of the ranges before plus its rank within its own range.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from .common import n_partitions, saved

#: Hex digits of the hash that name a range.
_DIGITS = 7
#: Slots of the schedule that one job makes.
_PIECE = 1 << 17
#: ``state`` holds each source's next block; the picks of ``period`` slots are gathered before they join the others.
_EDF = """
aggregate(
  sequence({start}L, {end}L - 1, {period}L),
  named_struct('state', state, 'parts', cast(array() AS array<array<struct<i: int, j: bigint, slot: bigint>>>)),
  (done, c) -> element_at(transform(array(aggregate(
    sequence(c, least(c + {period}L, {end}L) - 1),
    named_struct('state', done.state, 'picks', cast(array() AS array<struct<i: int, j: bigint, slot: bigint>>)),
    (acc, t) -> element_at(transform(
      array(array_min(filter(acc.state, y -> y.released <= t))),
      pick -> named_struct(
        'state', transform(acc.state, y -> if(y.i = pick.i, named_struct(
          'due', ((y.j + 2) * d + y.m - 1) div y.m, 'i', y.i, 'released', ((y.j + 1) * d) div y.m, 'j', y.j + 1, 'm', y.m), y)),
        'picks', array_append(acc.picks, named_struct('i', pick.i, 'j', pick.j, 'slot', t)))), 1))),
    part -> named_struct('state', part.state, 'parts', array_append(done.parts, part.picks))), 1))
"""


def source_key(col):
    """A key that is never null: rows without source are a source of their own."""
    return F.coalesce(F.concat(F.lit("="), col), F.lit(""))


def root_weights(docs: DataFrame, source_col: str = "source") -> DataFrame:
    """``(source, weight)``: integer weights in proportion to the square root of a source's documents."""
    return (docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count("*").alias("_n"))
            .select("source", F.round(F.sqrt(F.col("_n").cast("double")) * 1000).cast("long").alias("weight")))


def schedule(weights: DataFrame, period: int = 1000, max_sources: int | None = None, blocks: DataFrame | None = None) -> DataFrame:
    """``(key, m, d, j, slot)``: the slot of each of a source's ``m`` blocks in a period of ``d`` slots.

    ``m / d`` is the source's exact share.  With ``blocks (key, last)`` the schedule ends where the blocks up to ``last``
    of all these sources have a slot, if that is before ``d``.  ``period`` slots are worked out at a time; the result
    does not depend on it.  Null and non-positive weights leave a source out.  There may be any number of sources, at
    (slots x sources) steps and a row a source in the task that makes the schedule; ``max_sources`` refuses more than that
    many, for callers who want that.
    """
    w = (weights.where("weight > 0").select(source_key(F.col("source").cast("string")).alias("key"),
                                            F.col("weight").cast("long").alias("w")).groupBy("key").agg(F.max("w").alias("w")))
    w = saved(w)  # a row a source: the weights may come from a scan of all documents, which is made once
    n = w.count()
    if max_sources is not None and n > max_sources:
        raise ValueError(f"{n} sources, more than max_sources = {max_sources}")
    found = [r.w for r in w.select("w").collect()]
    divisor = math.gcd(*found) or 1
    total = sum(found) // divisor
    w = w.select("key", F.expr(f"w div {divisor}").alias("m"), F.lit(total).cast("long").alias("d"))
    end = total
    if blocks is not None and n:
        due = blocks.join(w, "key").agg(F.expr("max(((last + 1) * d + m - 1) div m)")).first()[0]
        end = min(total, due or 0)
    state = w.groupBy("d").agg(F.expr("array_sort(collect_list(struct(key, m)))").alias("sources")).selectExpr(
        "sources", "d", "transform(sources, (x, i) -> named_struct('due', (d + x.m - 1) div x.m, 'i', i, 'released', 0L, "
        "'j', 0L, 'm', x.m)) AS state")
    slots = w.selectExpr("key", "m", "d", "0L AS j", "0L AS slot").where("false")
    for start in range(0, end, _PIECE):
        run = _EDF.format(start=start, end=min(start + _PIECE, end), period=int(period))
        done = saved(state.selectExpr("sources", "d", f"{run} AS run").selectExpr("sources", "d", "run.state", "run.parts"))
        state = done.select("sources", "d", "state")
        slots = slots.unionByName(done.selectExpr("sources", "d", "explode(parts) AS part").selectExpr(
            "sources", "d", "inline(part)").selectExpr("sources[i].key AS key", "sources[i].m AS m", "d", "j", "slot"))
    return slots


def mix(docs: DataFrame, weights: DataFrame | None = None, block_docs: int = 8, period: int = 1000,
        id_col: str = "doc_id", source_col: str = "source", max_sources: int | None = None) -> DataFrame:
    """All rows of ``docs`` with ``mix_rank`` (number within the source), ``mix_slot`` and ``mix_pos`` (order of the mix),
    and ``mix_on_target``: up to this slot no source has run out, so every source's share deviates by less than a block
    from its given weight.

    After a source has run out its slots stay empty and the others keep their proportions; nothing is dropped or
    repeated.  Sources without a (positive) weight keep their rows, with null slot and position.  A null source is a
    source of its own, and there may be any number of them; rows with equal ids take neighbouring places; an empty table gives no rows.  Columns of ``docs``
    named like an output are replaced.
    """
    spark = docs.sparkSession
    out = ("mix_rank", "mix_slot", "mix_pos", "mix_on_target")
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in out]
    n = n_partitions(spark)
    keyed = docs.select(*columns, source_key(F.col(source_col).cast("string")).alias("_mx_key"),
                        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("_mx_hash"))
    share = F.conv(F.substring("_mx_hash", 1, _DIGITS), 16, 10).cast("long") * F.lit(n)
    keyed = keyed.withColumn("_mx_range", F.shiftright(share, 4 * _DIGITS).cast("int"))
    counted = keyed.groupBy("_mx_key", "_mx_range").agg(F.count("*").alias("_mx_n"))
    ranges = counted.withColumn("_mx_before", F.coalesce(F.sum("_mx_n").over(
        Window.partitionBy("_mx_key").orderBy("_mx_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranges = saved(ranges)  # a row a source and range
    # the number of the first block that is not full
    totals = ranges.groupBy(F.col("_mx_key").alias("key")).agg(F.expr(f"sum(_mx_n) div {int(block_docs)}").alias("last"))
    plan = saved(schedule(root_weights(docs, source_col) if weights is None else weights, period, max_sources, totals))
    # the first slot whose block is not full, over all scheduled sources
    ends = totals.join(plan, "key").where("j = last % m").selectExpr("(last div m) * d + slot AS ends")
    # the slots of a range's blocks: one row a block, not a document
    blocks = ranges.select(F.col("_mx_key").alias("key"), "_mx_range", F.expr(
        f"explode(sequence(_mx_before div {int(block_docs)}, (_mx_before + _mx_n - 1) div {int(block_docs)}))").alias("_mx_block"))
    sources = plan.select("key", "m", "d").distinct()
    blocks = blocks.join(F.broadcast(sources), "key").withColumn("j", F.expr("_mx_block % m"))
    found = (blocks.join(plan.select("key", "j", "slot"), ["key", "j"])
             .groupBy(F.col("key").alias("_mx_bk"), F.col("_mx_range").alias("_mx_br"))
             .agg(F.expr("transform(array_sort(collect_list(struct(_mx_block AS b, (_mx_block div m) * d + slot AS s))), x -> x.s)"
                         ).alias("_mx_slots")))
    ranges = ranges.join(found, (F.col("_mx_key") == F.col("_mx_bk")) & (F.col("_mx_range") == F.col("_mx_br")), "left").select(
        F.col("_mx_key").alias("_mx_k"), F.col("_mx_range").alias("_mx_r"), "_mx_before", "_mx_slots")
    within = Window.partitionBy("_mx_key", "_mx_range").orderBy("_mx_hash", F.col(id_col))
    ranked = (keyed.withColumn("_mx_rank", F.row_number().over(within).cast("long") - 1)
              .join(ranges, (F.col("_mx_key") == F.col("_mx_k")) & (F.col("_mx_range") == F.col("_mx_r")))
              .withColumn("mix_rank", F.col("_mx_before") + F.col("_mx_rank"))
              .withColumn("mix_slot", F.expr(f"element_at(_mx_slots, cast(mix_rank div {int(block_docs)} - "
                                             f"_mx_before div {int(block_docs)} + 1 AS int))")))
    return ranked.select(
        *columns, "mix_rank", "mix_slot", F.expr(f"mix_slot * {int(block_docs)} + mix_rank % {int(block_docs)}").alias("mix_pos"),
        F.coalesce(F.col("mix_slot") < ends.agg(F.min("ends")).scalar(), F.lit(False)).alias("mix_on_target"))
