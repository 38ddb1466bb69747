"""A/A and A/B evaluation.

Each test ends in one row computed by a single aggregation plus Column
arithmetic; p-values come from the tail expressions in
``pulselens.functions.stats`` (no scipy, no Python UDF).  Resampling methods
(Poisson bootstrap, A/A subsamples) carry a replicate column instead of a
driver loop; weights and orders come from md5 hashes, so every replicate is
reproducible and identical when a task is retried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselens.functions.hashing import poisson1_from_uniform, poisson_power_from_uniform, uniform, user_bucket
from pulselens.functions.stats import normal_two_sided_p, t_two_sided_p, with_t_p_values
from pulselens.operators.filters import fixed_period
from pulselens.operators.metrics import group_ctr, likes_expr, ratio, views_expr
from pulselens.operators.ranking import prefix_sums, value_counts

REPORT_COLS = ["test", "metric", "group_a", "group_b", "n_a", "n_b", "statistic", "p_value", "estimate"]


# ---- Welch t-test -------------------------------------------------------------

def _moments(value: Column, group: Column, a, b) -> list[Column]:
    va = F.when(group == F.lit(a), value)
    vb = F.when(group == F.lit(b), value)
    return [F.count(va).alias("n_a"), F.count(vb).alias("n_b"),
            F.avg(va).alias("mean_a"), F.avg(vb).alias("mean_b"),
            F.var_samp(va).alias("var_a"), F.var_samp(vb).alias("var_b")]


def welch_columns(df: DataFrame, p_value: bool = True) -> DataFrame:
    """t, df and two-sided p from ``n_a, n_b, mean_a, mean_b, var_a, var_b``.
    n < 2 or zero variance in both groups gives NULL t and p."""
    sa = F.col("var_a") / F.col("n_a")
    sb = F.col("var_b") / F.col("n_b")
    se2 = F.nullif(sa + sb, F.lit(0.0))
    t = (F.col("mean_a") - F.col("mean_b")) / F.sqrt(se2)
    dof = se2 * se2 / (sa * sa / F.nullif(F.col("n_a") - 1, F.lit(0)) + sb * sb / F.nullif(F.col("n_b") - 1, F.lit(0)))
    out = df.withColumn("t", t).withColumn("df", dof)
    return out.withColumn("p_value", t_two_sided_p(F.col("t"), F.col("df"))) if p_value else out


def welch(df: DataFrame, value: str, a, b, group: str = "exp_group") -> DataFrame:
    """Two-sided Welch t-test of ``value`` between groups ``a`` and ``b``.
    Rows with NULL ``value`` are excluded and counted in ``n_excluded``."""
    g, v = F.col(group), F.col(value)
    s = df.where(g.isin(a, b)).agg(*_moments(v, g, a, b), F.count_if(v.isNull()).alias("n_excluded"))
    return (welch_columns(s)
            .select(F.lit(a).alias("group_a"), F.lit(b).alias("group_b"), "n_a", "n_b", "mean_a", "mean_b",
                    "var_a", "var_b", "t", "df", "p_value", "n_excluded"))


# ---- Mann-Whitney U and probability of superiority ------------------------------

#: The exact distribution of U is used up to this size of the smaller sample, and of both together (the counts of
#: arrangements then fit in a bigint).
EXACT_SMALLER, EXACT_BOTH = 8, 500


def exact_u_p(u_min: Column, n_a: Column, n_b: Column) -> Column:
    """Two-sided p-value of the smaller U of two samples without ties, from the exact distribution: the arrangements with
    U = 0, 1, ... are the coefficients of the product over i = 1..m of (1 - q^(n + i)) / (1 - q^i), m <= n the sizes.

    Twice the share of arrangements with U at most ``u_min`` (the distribution is symmetric), at most 1."""
    m, n = F.least(n_a, n_b).cast("int"), F.greatest(n_a, n_b).cast("int")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    start = F.transform(F.sequence(F.lit(0), u_min.cast("int")), lambda u: F.when(u == 0, one).otherwise(zero))

    def step(c, s):
        i = F.floor((s + F.lit(1)) / F.lit(2)).cast("int")       # steps 1, 2 are factor 1, steps 3, 4 factor 2, ...
        times = F.transform(c, lambda v, u: v - F.when(u >= n + i, F.get(c, u - n - i)).otherwise(zero))
        over = F.transform(c, lambda _v, u: F.aggregate(
            F.sequence(F.lit(0), F.floor(u / i).cast("int")), zero, lambda acc, k: acc + F.get(c, u - k * i)))
        return F.when(s % 2 == 1, times).otherwise(over)

    counts = F.aggregate(F.sequence(F.lit(1), m * 2), start, step)
    below = F.aggregate(counts, zero, lambda acc, v: acc + v)
    # the number of all arrangements, (n + m) over m; every quotient is whole
    total = F.aggregate(F.sequence(F.lit(1), m), one, lambda acc, i: F.floor((acc * (n + i)).cast("decimal(38,0)") / i).cast("bigint"))
    return F.least(F.lit(1.0), F.lit(2.0) * below.cast("double") / total.cast("double"))


def daily_group_ctr(feed: DataFrame, first_day, last_day, groups) -> DataFrame:
    """CTR of each group and day: few values a group, for tests of small samples."""
    df = fixed_period(feed, first_day, last_day).where(F.col("exp_group").isin(list(groups)))
    return (df.groupBy("exp_group", F.to_date("time").alias("date"))
              .agg(likes_expr().alias("likes"), views_expr().alias("views")).withColumn("ctr", ratio("likes", "views")))


def mann_whitney(df: DataFrame, value: str, a, b, group: str = "exp_group",
                 n_buckets: int | None = None, by: list[str] | None = None, method: str = "asymptotic") -> DataFrame:
    """X5 + X8: two-sided Mann-Whitney U (mid-ranks, tie-corrected variance,
    0.5 continuity correction, normal approximation), plus the exact
    P(A>B), P(tie), P(B>A) over all pairs; one row, or one for each value of
    ``by`` (e.g. the metric of a long table).

    Ranks are never materialised per user: values are first reduced to
    ``(value, count_a, count_b)``, then a two-level prefix sum gives the
    number of B values below each value.

    ``method="auto"`` takes the p-value from the exact distribution of U where there are no ties, the smaller sample has at
    most ``EXACT_SMALLER`` values and both at most ``EXACT_BOTH``, and adds a column ``exact`` that says where."""
    if method not in ("asymptotic", "auto"):
        raise ValueError("method must be 'asymptotic' or 'auto'")
    by = by or []
    p = prefix_sums(value_counts(df, value, group, a, b, by), "value", ["c_b"], n_buckets, by=by)
    ca, cb = F.col("c_a").cast("double"), F.col("c_b").cast("double")
    lt = F.col("c_b_lt").cast("double")
    t = ca + cb
    s = p.groupBy(*by).agg(F.sum("c_a").alias("n_a"), F.sum("c_b").alias("n_b"),
                           F.sum(ca * (lt + cb / F.lit(2.0))).alias("u_a"),
                           F.sum(ca * lt).alias("pairs_gt"), F.sum(ca * cb).alias("pairs_tie"),
                           F.sum(t * t * t - t).alias("tie_term"))
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    n = na + nb
    pairs = F.nullif(na * nb, F.lit(0.0))
    sigma = F.sqrt(na * nb / F.lit(12.0) * ((n + F.lit(1.0)) - F.col("tie_term") / F.nullif(n * (n - F.lit(1.0)), F.lit(0.0))))
    u_b = na * nb - F.col("u_a")
    z = (F.greatest(F.col("u_a"), u_b) - na * nb / F.lit(2.0) - F.lit(0.5)) / F.nullif(sigma, F.lit(0.0))
    p_value = F.when(F.col("z") <= 0, F.lit(1.0)).otherwise(normal_two_sided_p(F.col("z")))
    s = s.withColumn("u_b", u_b).withColumn("z", z)
    more = []
    if method == "auto":
        small = F.least("n_a", "n_b").between(1, EXACT_SMALLER) & (F.col("n_a") + F.col("n_b") <= EXACT_BOTH)
        s = s.withColumn("exact", F.coalesce(small & (F.col("tie_term") == 0), F.lit(False)))
        p_value = F.when(F.col("exact"), exact_u_p(F.least("u_a", "u_b"), F.col("n_a"), F.col("n_b"))).otherwise(p_value)
        more = ["exact"]
    return (s.withColumn("p_value", p_value)
             .withColumn("p_a_gt_b", F.col("pairs_gt") / pairs)
             .withColumn("p_tie", F.col("pairs_tie") / pairs)
             .withColumn("p_b_gt_a", F.lit(1.0) - F.col("p_a_gt_b") - F.col("p_tie"))
             .select(*by, F.lit(a).alias("group_a"), F.lit(b).alias("group_b"), "n_a", "n_b", "u_a", "u_b", "z",
                     "p_value", "p_a_gt_b", "p_tie", "p_b_gt_a", *more))


# ---- derived per-user metrics -----------------------------------------------------

def smoothed_ctr(users: DataFrame, alpha: float = 5.0, groups=None) -> DataFrame:
    """X2 input: ``(likes + alpha * g) / (views + alpha)`` with ``g`` the user's
    own group's global CTR.  With ``groups`` given the group CTR table has at
    most ``len(groups)`` rows and is broadcast; otherwise AQE decides."""
    g = group_ctr(users if groups is None else users.where(F.col("exp_group").isin(list(groups))))
    g = g.select("exp_group", F.col("global_ctr").alias("_g"))
    if groups is not None:
        users = users.where(F.col("exp_group").isin(list(groups)))
        g = F.broadcast(g)          # at most len(groups) rows
    sm = (F.col("likes") + F.lit(alpha) * F.col("_g")) / (F.col("views") + F.lit(alpha))
    return users.join(g, "exp_group", "inner").withColumn("smoothed_ctr", sm).drop("_g")


def linearized_likes(users: DataFrame, control) -> DataFrame:
    """X3 input: ``likes - CTR_control * views``; the control CTR is a scalar
    subquery (ratio of sums over the control group).  It aggregates the
    control rows conditionally instead of filtering first, so its plan is
    the same per-user aggregate as the main query and the exchange is reused
    (a filter would be pushed into a second scan)."""
    is_c = F.col("exp_group") == F.lit(control)
    c = users.select(F.sum(F.when(is_c, F.col("likes"))) /
                     F.nullif(F.sum(F.when(is_c, F.col("views"))), F.lit(0))).scalar()
    return users.withColumn("linearized_likes", F.col("likes") - c * F.col("views"))


def bucket_ctr(feed: DataFrame, first_day, last_day, groups, n_buckets: int = 50,
               method: str = "md5") -> DataFrame:
    """Users hashed into ``n_buckets`` buckets per group; CTR as the
    ratio of sums per bucket.  Summing events per (group, bucket) equals
    summing per-user sums, so one aggregation suffices."""
    df = fixed_period(feed, first_day, last_day).where(F.col("exp_group").isin(list(groups)))
    return (df.groupBy("exp_group", user_bucket(F.col("user_id"), n_buckets, method).alias("bucket"))
              .agg(likes_expr().alias("likes"), views_expr().alias("views"))
              .withColumn("bucket_ctr", ratio("likes", "views")))


def bucket_ctr_from_users(users: DataFrame, n_buckets: int = 50, method: str = "md5") -> DataFrame:
    """D11 from the per-user table (sums of per-user sums equal the sums over
    events), so a report that already has the users does not rescan events."""
    return (users.groupBy("exp_group", user_bucket(F.col("user_id"), n_buckets, method).alias("bucket"))
                 .agg(F.sum("likes").alias("likes"), F.sum("views").alias("views"))
                 .withColumn("bucket_ctr", ratio("likes", "views")))


# ---- resampling -----------------------------------------------------------------

def _default_partitions(df: DataFrame) -> int:
    """Tasks for a replicate explosion: the session's shuffle parallelism.
    The user table is small but the exploded work is users x replicates, so
    it is spread explicitly (AQE keeps a user-specified partition count)."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def poisson_bootstrap(users: DataFrame, a, b, n_boot: int = 2000, partitions: int | None = None,
                      hash_method: str = "md5") -> DataFrame:
    """``n_boot`` Poisson(1) re-weightings of users; per replicate the
    global CTR of each group and their difference.

    Users are spread over ``partitions`` tasks before the replicate column
    is generated; weights are hash-derived per ``(replicate, user)`` (md5 by
    default, reproducible in SQL; ``hash_method="xxhash64"`` is several times
    cheaper for very large user x replicate counts); the
    aggregation by replicate is partial per task, so a task ships at most
    ``n_boot`` rows and the users x replicates matrix never exists."""
    g = F.col("exp_group")
    x = users.where(g.isin(a, b)).select("exp_group", "user_id", "likes", "views")
    x = x.repartition(partitions or _default_partitions(users), "user_id")
    x = x.select("*", F.explode(F.sequence(F.lit(1), F.lit(n_boot))).alias("rep"))
    # the hash and the weight are projected once per row (referenced by four sums)
    x = x.withColumn("_u", uniform("rep", "user_id", method=hash_method))
    x = x.withColumn("_w", poisson1_from_uniform(F.col("_u")).cast("bigint")).drop("_u")
    w = F.col("_w")
    agg = x.groupBy("rep").agg(
        F.sum(F.when(g == F.lit(a), w * F.col("likes"))).alias("likes_a"),
        F.sum(F.when(g == F.lit(a), w * F.col("views"))).alias("views_a"),
        F.sum(F.when(g == F.lit(b), w * F.col("likes"))).alias("likes_b"),
        F.sum(F.when(g == F.lit(b), w * F.col("views"))).alias("views_b"))
    return (agg.withColumn("ctr_a", ratio("likes_a", "views_a"))
               .withColumn("ctr_b", ratio("likes_b", "views_b"))
               .withColumn("diff", F.col("ctr_b") - F.col("ctr_a")))


def poisson_bootstrap_counts(users: DataFrame, a, b, n_boot: int = 2000, partitions: int | None = None,
                             hash_method: str = "md5") -> DataFrame:
    """X9 on sufficient statistics: the same replicates' distribution as ``poisson_bootstrap``, without a row a user.

    A group's users of equal likes and views are one cell.  The weights of a cell of ``n`` users add up to a Poisson(n)
    variable, drawn as a sum over the binary digits of ``n``: for each digit that is set, one Poisson(2**digit) from its
    own uniform number.  Work is cells x replicates x digits: it depends on how many different users there are, not on how
    many users.  Replicates are reproducible, but not those of ``poisson_bootstrap``, which hashes user ids.
    """
    g = F.col("exp_group")
    cells = users.where(g.isin(a, b)).groupBy("exp_group", "likes", "views").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.repartition(partitions or _default_partitions(users), "exp_group", "likes", "views")
    digits = F.filter(F.sequence(F.lit(0), F.lit(62)), lambda i: F.getbit("n", i) == 1)
    x = cells.select("*", F.explode(F.sequence(F.lit(1), F.lit(n_boot))).alias("rep"), digits.alias("_digits"))
    x = x.select("exp_group", "likes", "views", "rep", F.explode("_digits").alias("digit"))
    x = x.withColumn("_u", uniform("rep", "exp_group", "likes", "views", "digit", method=hash_method))
    x = x.withColumn("_w", poisson_power_from_uniform(F.col("_u"), F.col("digit"))).drop("_u")
    w = F.col("_w")
    agg = x.groupBy("rep").agg(*[F.sum(F.when(g == F.lit(k), w * F.col(c))).alias(f"{c}_{n}")
                                 for k, n in ((a, "a"), (b, "b")) for c in ("likes", "views")])
    return (agg.withColumn("ctr_a", ratio("likes_a", "views_a"))
               .withColumn("ctr_b", ratio("likes_b", "views_b"))
               .withColumn("diff", F.col("ctr_b") - F.col("ctr_a")))


def bootstrap_diff_ci(boot: DataFrame, level: float = 0.95) -> DataFrame:
    """Mean, percentile interval and sign shares of ``ctr_b - ctr_a``."""
    lo, hi = (1 - level) / 2, 1 - (1 - level) / 2
    d = F.col("diff")
    return boot.agg(F.count(d).alias("n_reps"), F.avg(d).alias("mean_diff"),
                    F.percentile(d, lo).alias("ci_low"), F.percentile(d, hi).alias("ci_high"),
                    F.avg(F.when(d < 0, 1.0).otherwise(0.0)).alias("share_below_zero"),
                    F.avg(F.when(d > 0, 1.0).otherwise(0.0)).alias("share_above_zero"))


def aa_resample_pvalues(users: DataFrame, a, b, n_reps: int = 10000, k: int = 500,
                        value: str = "ctr", same_group: bool = False,
                        partitions: int | None = None, hash_method: str = "md5") -> DataFrame:
    """X11: ``n_reps`` A/A tests, each on exactly ``k`` users drawn without
    replacement from each group.  ``same_group=True`` draws both samples from
    group ``a`` (the reference's behaviour).  Users with NULL ``value`` are
    not eligible.  A group of fewer than ``k`` users gives no draw: its
    ``n_*`` is 0, the p-value NULL, and ``pool_*`` shows how many there are.

    One rule at every size: a group's users have the indices 0..n-1 by user id
    (distributed prefix sum); draw ``j`` of a replicate is the index
    ``floor(u(sample, replicate, j) * n)``, and the sample is the first ``k``
    distinct draws.  Work is O(users + k x replicates): the draws are made
    where the replicate is, without a shuffle, and joined to the users by
    (sample, index)."""
    g = F.col("exp_group")
    x = users.where(F.col(value).isNotNull())
    if same_group:
        pool = x.where(g == F.lit(a)).select("user_id", F.col(value).alias("v"),
                                              F.explode(F.array(F.lit(1), F.lit(2))).alias("s"))
    else:
        pool = x.where(g.isin(a, b)).select("user_id", F.col(value).alias("v"),
                                            F.when(g == F.lit(a), F.lit(1)).otherwise(F.lit(2)).alias("s"))
    sizes = pool.agg(*[F.count_if(F.col("s") == s).alias(f"n{s}") for s in (1, 2)])
    pairs = (sizes.select(F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.col(f"n{s}").alias("n")) for s in (1, 2)])).alias("p"),
                          F.lit(n_reps).alias("reps"))
                  .select("p.s", "p.n", F.explode(F.sequence(F.lit(1), F.col("reps"))).alias("rep"))
                  .repartition(partitions or _default_partitions(users), "rep", "s"))
    drawn = (pairs.select("rep", "s", "n", F.explode_outer(first_distinct_draws(F.col("n"), k, hash_method)).alias("idx"))
                  .join(_indexed(pool), ["s", "idx"], "left"))
    s = drawn.groupBy("rep").agg(*_moments(F.col("v"), F.col("s"), 1, 2),
                                 *[F.max(F.when(F.col("s") == i, F.col("n"))).alias(c) for i, c in ((1, "pool_a"), (2, "pool_b"))])
    s = welch_columns(s, p_value=False).select("rep", "n_a", "n_b", "mean_a", "mean_b", "t", "df", "pool_a", "pool_b")
    # one tail per replicate: generated grid + codegen'd sum, same partitioning by rep
    return with_t_p_values(s, "t", "df", ["rep"]).select("rep", "n_a", "n_b", "mean_a", "mean_b", "t", "df", "p_value",
                                                         "pool_a", "pool_b")


def _indexed(pool: DataFrame) -> DataFrame:
    """``(s, idx, v)``: the users of each sample numbered 0..n-1 by user id."""
    one = pool.select("s", "user_id", "v", (F.col("s") == 1).cast("bigint").alias("_in1"),
                      (F.col("s") == 2).cast("bigint").alias("_in2"))
    idx = prefix_sums(one, "user_id", ["_in1", "_in2"], order_by=["user_id", "s"])
    return idx.select("s", F.when(F.col("s") == 1, F.col("_in1_lt")).otherwise(F.col("_in2_lt")).alias("idx"), "v")


def first_distinct_draws(n: Column, k: int, hash_method: str = "md5") -> Column:
    """The first ``k`` distinct indices of the draw sequence of a row's ``(s, rep)``; none if ``n < k``, all if ``n = k``.

    The number of draws needed is a sum of geometric waiting times with mean ``mu`` and smallest odds ``p``.  A sequence
    of the usual length (six deviations above the mean) is tried first; the rare row for which it falls short goes on
    along the same sequence to a length that fails with odds below e^-40, as P(needed >= c mu) <=
    exp(-p mu (c - 1 - ln c))."""
    nd = n.cast("double")
    mu = nd * F.log((nd + 0.5) / (nd - k + 0.5))
    p = (nd - k + 1) / nd
    usual = F.ceil(mu + 6 * F.sqrt(mu / p) + 10)
    sure = F.ceil(F.greatest(F.lit(3.5), 1 + 80 / (p * mu)) * mu)

    def distinct(m: Column) -> Column:
        return F.array_distinct(F.transform(F.sequence(F.lit(1), m.cast("int")), lambda j: F.floor(
            uniform(F.col("s"), F.col("rep"), j, method=hash_method) * n).cast("bigint")))

    # evaluated row by row: the long sequence only where the usual one falls short
    tried = F.transform(F.array(distinct(usual)), lambda d: F.when(F.size(d) >= k, d).otherwise(distinct(sure)))
    return (F.when(n == k, F.sequence(F.lit(0).cast("bigint"), n - 1))
             .when(n > k, F.slice(F.element_at(tried, 1), 1, k)))


def aa_false_positive_rate(pvals: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Percent of A/A p-values ``<= alpha`` and a verdict."""
    r = pvals.agg(F.count(F.lit(1)).alias("n_reps"),
                  (F.avg(F.when(F.col("p_value") <= F.lit(alpha), 1.0).otherwise(0.0)) * F.lit(100.0)).alias("fpr_pct"))
    return r.withColumn("verdict", F.when(F.col("fpr_pct") <= F.lit(alpha * 100), F.lit("split ok"))
                                    .otherwise(F.lit("split suspicious")))


def histograms(values: DataFrame, bins: dict[str, tuple[float, float]]) -> DataFrame:
    """Counts per distribution, group and fixed-width bin ``floor((x - lo) / width)`` in one pass over ``values
    (distribution, grp, value)``; ``bins`` gives each distribution's ``(lo, width)``."""
    d, v = F.col("distribution"), F.col("value")
    lo = F.coalesce(*[F.when(d == k, F.lit(float(x))) for k, (x, _) in bins.items()])
    width = F.coalesce(*[F.when(d == k, F.lit(float(w))) for k, (_, w) in bins.items()])
    return (values.where(v.isNotNull())
                  .groupBy("distribution", "grp", F.floor((v - lo) / width).cast("bigint").alias("bin"))
                  .agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("bin_lo", lo + F.col("bin") * width))


def distribution(df: DataFrame, name: str, value, group) -> DataFrame:
    """Rows of one distribution for ``histograms``."""
    return df.select(F.lit(name).alias("distribution"), group.cast("string").alias("grp"), value.cast("double").alias("value"))


# ---- the side-by-side report ----------------------------------------------------------

def ab_values(users: DataFrame, a, b, alpha: float = 5.0, n_buckets: int = 50) -> DataFrame:
    """The values that the A/B tests compare as one long table ``(metric, exp_group, value)``."""
    # the control CTR comes from the per-user table as it is, so that its exchange is reused, not made again
    both = smoothed_ctr(linearized_likes(users, a), alpha, [a, b])
    per_user = both.select("exp_group", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in ("ctr", "smoothed_ctr", "linearized_likes")])).alias("x")).select("x.metric", "exp_group", "x.value")
    bk = bucket_ctr_from_users(users, n_buckets)
    return per_user.unionByName(bk.select(F.lit("bucket_ctr").alias("metric"), "exp_group", F.col("bucket_ctr").alias("value")))


def ab_superiority(users: DataFrame, a, b, alpha: float = 5.0, n_buckets: int = 50) -> DataFrame:
    """X8 for the three metrics of the Mann-Whitney tests, through one prefix sum."""
    values = ab_values(users, a, b, alpha, n_buckets).where(F.col("metric") != "linearized_likes")
    return mann_whitney(values, "value", a, b, by=["metric"]).select("metric", "p_a_gt_b", "p_tie", "p_b_gt_a")


def ab_report(feed: DataFrame, first_day, last_day, a, b, alpha: float = 5.0, n_boot: int = 2000,
              n_buckets: int = 50) -> DataFrame:
    """Every test of the A/B notebook side by side, one row per test.

    For the bootstrap ``statistic`` is the mean of ``ctr_b - ctr_a``, and
    ``p_value`` is the two-sided share ``2 * min(P(diff < 0), P(diff > 0))``."""
    from pulselens.operators.metrics import user_ctr
    users = user_ctr(feed, first_day, last_day, [a, b])
    values = ab_values(users, a, b, alpha, n_buckets)
    g, v = F.col("exp_group"), F.col("value")
    t = welch_columns(values.groupBy("metric").agg(*_moments(v, g, a, b))).select(
        F.lit("welch").alias("test"), "metric", F.lit(a).alias("group_a"), F.lit(b).alias("group_b"), "n_a", "n_b",
        F.col("t").alias("statistic"), "p_value", (F.col("mean_b") - F.col("mean_a")).alias("estimate"))
    # one prefix sum for all metrics
    mw = mann_whitney(values.where(F.col("metric") != "linearized_likes"), "value", a, b, by=["metric"]).select(
        F.lit("mann_whitney").alias("test"), "metric", "group_a", "group_b", "n_a", "n_b",
        F.col("u_a").alias("statistic"), "p_value", F.col("p_a_gt_b").alias("estimate"))
    ci = bootstrap_diff_ci(poisson_bootstrap(users, a, b, n_boot))
    boot = ci.select(F.lit("poisson_bootstrap").alias("test"), F.lit("global_ctr").alias("metric"),
                     F.lit(a).alias("group_a"), F.lit(b).alias("group_b"),
                     F.lit(None).cast("bigint").alias("n_a"), F.lit(None).cast("bigint").alias("n_b"),
                     F.col("mean_diff").alias("statistic"),
                     F.least(F.lit(1.0), F.lit(2.0) * F.least("share_below_zero", "share_above_zero")).alias("p_value"),
                     F.col("mean_diff").alias("estimate"))
    return t.unionByName(mw).unionByName(boot).select(*REPORT_COLS)
