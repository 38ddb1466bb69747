"""Connected components of a link table by alternating large-star and small-star steps (Kiveris et al. 2014).

Every step is one aggregation and one equi-join on a node.  The aggregated side has one row per node, so a node with
very many links is split by adaptive skew joins; links are de-duplicated after each step and never grow in number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import saved


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (or smaller-or-equal) neighbours on the smallest node it knows."""
    if large:
        both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(low, "a")
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            low.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``; ``root`` is the smallest node of its component.

    No links give no rows; repeated links and links of a node with itself change nothing.
    """
    links = saved(links.where(F.col("a") != F.col("b")).select("a", "b").distinct())

    def digest(df: DataFrame) -> tuple:
        h = F.xxhash64("a", "b")
        return tuple(df.agg(F.count("*"), F.sum(F.shiftright(h, 20)), F.sum(h.bitwiseAND(F.lit(0xFFFFF)))).first())

    seen = digest(links)
    while seen[0]:
        links = saved(_star(_star(links, True), False))
        now = digest(links)
        if now == seen:
            break
        seen = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
