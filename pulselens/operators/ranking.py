"""Global prefix sums and mid-ranks without an unpartitioned window.

A running sum ordered by a value over the whole table would force every row
into one task.  Instead (two levels):
  1. rows get an order-preserving bucket: the position of the value among K-1
     quantile bounds (percentiles of a deterministic hash sample, found by
     binary search), so buckets stay balanced even when one outlier stretches
     the range;
  2. per-bucket totals (at most K rows) get exclusive offsets with a window
     over the K rows only;
  3. inside each bucket a window partitioned by bucket adds the running sum,
     and the bucket offset is joined back (broadcast, K rows at most).
The input is one row per distinct value (counts per value, users), so a bucket
holds the distinct values that fall in its range.  K is the session's number
of shuffle partitions unless given; one bucket is a plain ordered window, for
inputs that a parameter bounds.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Values in the sample whose percentiles are the bounds.
SAMPLE = 10_000


def _quantile_buckets(df: DataFrame, order_col: str, n_buckets: int) -> DataFrame:
    """Bucket = number of the K-1 bounds that are <= v (binary search).

    The bounds are percentiles of the ``SAMPLE`` values of smallest hash (one
    scalar subquery in the same plan, no count), so they are identical
    whenever they are evaluated, and every use of the bucket column agrees."""
    m = n_buckets - 1
    v = F.col(order_col)
    sample = (df.where(v.isNotNull()).select(v.alias("_v"), F.xxhash64(v).alias("_h"))
                .orderBy("_h", "_v").limit(SAMPLE))
    probs = F.array(*[F.lit(i / n_buckets) for i in range(1, n_buckets)])
    bounds = sample.select(F.percentile("_v", probs)).scalar()
    steps = max(1, math.ceil(math.log2(m + 1)) + 1)

    # subqueries may not appear inside a higher-order function: project the
    # bounds as a column first and let the lambda read that column
    df = df.withColumn("_bounds", bounds)
    bcol = F.col("_bounds")

    def step(acc, _i):
        lo, hi = acc["lo"], acc["hi"]
        mid = F.least(F.floor((lo + hi) / F.lit(2)).cast("int"), F.lit(m - 1))
        right = F.coalesce(F.element_at(bcol, mid + F.lit(1)) <= v, F.lit(False))
        active = lo < hi
        return F.struct(F.when(active & right, mid + F.lit(1)).otherwise(lo).alias("lo"),
                        F.when(active & ~right, mid).otherwise(hi).alias("hi"))

    init = F.struct(F.lit(0).alias("lo"), F.lit(m).alias("hi"))
    bkt = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step, lambda acc: acc["lo"])
    return df.withColumn("_bkt", bkt.cast("int")).drop("_bounds")


def prefix_sums(df: DataFrame, order_col: str, cols: list[str], n_buckets: int | None = None,
                order_by: list[str] | None = None, key=None, by: list[str] | None = None) -> DataFrame:
    """Adds ``{c}_lt`` = sum of ``c`` over rows that come before the row.

    The order is ``order_by`` (default ``[order_col]``; rows must be unique
    and non-NULL in it).  ``key`` (default ``order_col``) is a numeric
    expression that never decreases along that order; it is only used to
    form the buckets, so it may be coarse (e.g. a double of a long id).
    ``by`` starts the sums anew for each of its (few) values."""
    order_by, by = order_by or [order_col], by or []
    base = df.columns
    if n_buckets is None:
        n_buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    before = (Window.unboundedPreceding, -1)
    if n_buckets <= 1:
        w = (Window.partitionBy(*by) if by else Window).orderBy(*order_by).rowsBetween(*before)
        return df.select(*base, *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}_lt") for c in cols])
    key = F.col(order_col) if key is None else key
    b = _quantile_buckets(df.withColumn("_key", key.cast("double")), "_key", n_buckets)
    totals = b.groupBy(*by, "_bkt").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    # window over at most n_buckets rows for each value of `by` (bounded by the parameter, not by the data)
    wk = (Window.partitionBy(*by) if by else Window).orderBy("_bkt").rowsBetween(*before)
    offsets = totals.select(*by, "_bkt", *[F.coalesce(F.sum(f"_t_{c}").over(wk), F.lit(0)).alias(f"_o_{c}") for c in cols])
    wi = Window.partitionBy(*by, "_bkt").orderBy(*order_by).rowsBetween(*before)
    within = b.select("*", *[F.coalesce(F.sum(c).over(wi), F.lit(0)).alias(f"_w_{c}") for c in cols])
    # at most n_buckets rows; with `by` their number depends on the data, so adaptive execution decides
    out = within.join(offsets if by else F.broadcast(offsets), [*by, "_bkt"], "inner")
    return out.select(*base, *[(F.col(f"_w_{c}") + F.col(f"_o_{c}")).alias(f"{c}_lt") for c in cols])


def value_counts(df: DataFrame, value: str, group: str, a, b, by: list[str] | None = None) -> DataFrame:
    """One row per distinct value (and ``by``) with the counts from groups ``a`` and ``b``."""
    g = F.col(group)
    x = df.where(g.isin(a, b) & F.col(value).isNotNull())
    return x.groupBy(*(by or []), F.col(value).alias("value")).agg(
        F.count_if(g == F.lit(a)).alias("c_a"), F.count_if(g == F.lit(b)).alias("c_b"))


def midranks(df: DataFrame, value: str, group: str, a, b, n_buckets: int | None = None) -> DataFrame:
    """E5: tie-averaged rank of each distinct value in the pooled sample."""
    p = prefix_sums(value_counts(df, value, group, a, b), "value", ["c_a", "c_b"], n_buckets)
    below = F.col("c_a_lt") + F.col("c_b_lt")
    ties = F.col("c_a") + F.col("c_b")
    return p.select("value", F.col("c_a").alias("n_a"), F.col("c_b").alias("n_b"),
                    (below.cast("double") + (ties.cast("double") + F.lit(1.0)) / F.lit(2.0)).alias("midrank"))
