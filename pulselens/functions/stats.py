"""Distribution tails as Column expressions (no scipy, no Python UDF).

Two-sided Student-t tail: with t = sqrt(nu)*tan(u) the t density is
proportional to cos(u)^(nu-1) on (-pi/2, pi/2), so

    p = int_theta^L cos^(nu-1) / int_0^L cos^(nu-1),  theta = atan(|t|/sqrt(nu)),

with L = min(pi/2, 12/sqrt(nu)) (the mass beyond is below 1e-30, so p is exactly 0
for |t| above about 12 at large nu) and theta
clipped to L.  Both integrals are composite Simpson sums over ``STEPS`` steps.
The normal tail uses exp(-x^2/2) on [|z|, |z|+12] over [0, 12].  The same
formulas are emitted as DuckDB SQL text for the oracles (``*_sql``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = 400


def _weight(i: Column) -> Column:
    return (F.when((i == 0) | (i == STEPS), F.lit(1.0))
             .when(i % 2 == 1, F.lit(4.0))
             .otherwise(F.lit(2.0)))


def _simpson_ratio(lo_n: Column, hi_n: Column, lo_d: Column, hi_d: Column, f, param: Column) -> Column:
    """(Simpson sum of f over [lo_n, hi_n]) / (Simpson sum over [lo_d, hi_d])
    in one loop.  The bounds, step sizes and the density parameter are
    computed once per row and carried in the accumulator, so an iteration
    only evaluates the density twice."""
    n = F.lit(float(STEPS))
    init = F.struct(F.lit(0.0).alias("num"), F.lit(0.0).alias("den"),
                    lo_n.alias("an"), ((hi_n - lo_n) / n).alias("hn"),
                    lo_d.alias("ad"), ((hi_d - lo_d) / n).alias("hd"), param.alias("k"))

    def step(acc, i):
        w = _weight(i)
        x = i.cast("double")
        return F.struct(
            (acc["num"] + w * f(acc["an"] + x * acc["hn"], acc["k"])).alias("num"),
            (acc["den"] + w * f(acc["ad"] + x * acc["hd"], acc["k"])).alias("den"),
            acc["an"].alias("an"), acc["hn"].alias("hn"), acc["ad"].alias("ad"), acc["hd"].alias("hd"),
            acc["k"].alias("k"))

    def finish(acc):
        return (acc["num"] * acc["hn"] / F.lit(3.0)) / (acc["den"] * acc["hd"] / F.lit(3.0))

    return F.aggregate(F.sequence(F.lit(0), F.lit(STEPS)), init, step, finish)


def t_two_sided_p(t: Column, nu: Column) -> Column:
    """Two-sided p-value of Student's t with ``nu`` (real) degrees of freedom."""
    big_l = F.least(F.lit(math.pi / 2), F.lit(12.0) / F.sqrt(nu))
    theta = F.least(F.atan(F.abs(t) / F.sqrt(nu)), big_l)

    def dens(u, k):
        return F.pow(F.greatest(F.cos(u), F.lit(0.0)), k)

    p = _simpson_ratio(theta, big_l, F.lit(0.0), big_l, dens, nu - F.lit(1.0))
    return F.when(t.isNull() | nu.isNull(), F.lit(None).cast("double")).otherwise(p)


def normal_two_sided_p(z: Column) -> Column:
    a = F.abs(z)

    def dens(x, _k):
        return F.exp(-x * x / F.lit(2.0))

    p = _simpson_ratio(a, a + F.lit(12.0), F.lit(0.0), F.lit(12.0), dens, F.lit(0.0))
    return F.when(z.isNull(), F.lit(None).cast("double")).otherwise(p)


# ---- the same tails as DuckDB SQL text (used by the oracle queries) --------

def _simpson_sql(lo: str, hi: str, f) -> str:
    h = f"(({hi}) - ({lo})) / {float(STEPS)}"
    w = f"(CASE WHEN i = 0 OR i = {STEPS} THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END)"
    body = f"{w} * {f(f'(({lo}) + i * {h})')}"
    return f"(list_sum(list_transform(range(0, {STEPS + 1}), lambda i: {body})) * {h} / 3.0)"


def t_two_sided_p_sql(t: str, nu: str) -> str:
    big_l = f"least({math.pi / 2!r}, 12.0 / sqrt({nu}))"
    theta = f"least(atan(abs({t}) / sqrt({nu})), {big_l})"

    def dens(u):
        return f"pow(greatest(cos({u}), 0.0), ({nu}) - 1.0)"

    return (f"(CASE WHEN ({t}) IS NULL OR ({nu}) IS NULL THEN NULL ELSE "
            f"{_simpson_sql(theta, big_l, dens)} / {_simpson_sql('0.0', big_l, dens)} END)")


def normal_two_sided_p_sql(z: str) -> str:
    a = f"abs({z})"

    def dens(x):
        return f"exp(-({x}) * ({x}) / 2.0)"

    return (f"(CASE WHEN ({z}) IS NULL THEN NULL ELSE "
            f"{_simpson_sql(a, f'{a} + 12.0', dens)} / {_simpson_sql('0.0', '12.0', dens)} END)")


def with_t_p_values(df, t: str, nu: str, keys: list[str], out: str = "p_value", partitions: int | None = None):
    """The t tail for many rows at once (e.g. one test per replicate).

    Same formula as ``t_two_sided_p``, but the Simpson grid is generated as
    rows (``explode(sequence(0, STEPS))``) and summed by ``keys`` with a
    plain aggregation, which runs in whole-stage codegen instead of an
    interpreted lambda.  When ``df`` is already partitioned by ``keys``
    (e.g. it comes out of a ``groupBy(keys)``), no shuffle is added.
    ``keys`` must identify the rows; all other columns are carried along.
    The rows are spread over ``partitions`` tasks first (default: the
    session's shuffle parallelism): the grid is STEPS+1 rows per input row,
    too much for the single partition AQE would coalesce a small input into."""
    n_part = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = df.repartition(n_part, *keys)
    tc, nc = F.col(t), F.col(nu)
    big_l = F.least(F.lit(math.pi / 2), F.lit(12.0) / F.sqrt(nc))
    theta = F.least(F.atan(F.abs(tc) / F.sqrt(nc)), big_l)
    carry = [c for c in df.columns if c not in keys]
    x = df.select(*keys, *carry, theta.alias("_a"), big_l.alias("_l"), (nc - F.lit(1.0)).alias("_k"),
                  F.explode(F.sequence(F.lit(0), F.lit(STEPS))).alias("_i"))
    n = F.lit(float(STEPS))
    i = F.col("_i")
    w = _weight(i)
    hn = (F.col("_l") - F.col("_a")) / n
    hd = (F.col("_l") - F.lit(0.0)) / n

    def dens(u):
        return F.pow(F.greatest(F.cos(u), F.lit(0.0)), F.col("_k"))

    agg = x.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in carry],
        (F.sum(w * dens(F.col("_a") + i.cast("double") * hn)) * F.first(hn) / F.lit(3.0)).alias("_num"),
        (F.sum(w * dens(F.lit(0.0) + i.cast("double") * hd)) * F.first(hd) / F.lit(3.0)).alias("_den"))
    p = F.when(F.col(t).isNull() | F.col(nu).isNull(), F.lit(None).cast("double")).otherwise(F.col("_num") / F.col("_den"))
    return agg.withColumn(out, p).drop("_num", "_den")


#: The polynomial of Zelen and Severo for the normal distribution (absolute error below 7.5e-8).
_CDF = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def normal_cdf_sql(x: str, suffix: str = "::DOUBLE") -> str:
    """SQL text of the normal distribution function; ``suffix`` makes a literal a double (``D`` in Spark)."""
    t = f"(1{suffix} / (1{suffix} + 0.2316419{suffix} * abs({x})))"
    poly = f"({_CDF[4]!r}{suffix})"
    for c in reversed(_CDF[:4]):
        poly = f"(({c!r}{suffix}) + {t} * {poly})"
    tail = f"(exp(-0.5{suffix} * ({x}) * ({x})) * 0.3989422804014327{suffix} * {t} * {poly})"
    return f"(CASE WHEN {x} >= 0 THEN 1{suffix} - {tail} ELSE {tail} END)"
