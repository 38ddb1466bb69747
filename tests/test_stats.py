"""Tail expressions and test statistics against known values and properties."""

import math

import pytest
from pyspark.sql import functions as F

from pulselens.functions.stats import normal_two_sided_p, t_two_sided_p
from pulselens.operators import experiments, ranking


@pytest.mark.parametrize("t,nu,p", [(2.228139, 10.0, 0.05), (12.706205, 1.0, 0.05), (1.959964, 1e6, 0.05),
                                    (0.0, 5.0, 1.0), (2.570582, 5.0, 0.05)])
def test_t_tail_known_values(spark, t, nu, p):
    got = spark.range(1).select(t_two_sided_p(F.lit(t), F.lit(nu)).alias("p")).first().p
    assert got == pytest.approx(p, abs=2e-6)


def test_normal_tail(spark):
    r = spark.range(1).select(normal_two_sided_p(F.lit(1.959964)).alias("a"),
                              normal_two_sided_p(F.lit(2.575829)).alias("b")).first()
    assert r.a == pytest.approx(0.05, abs=1e-6)
    assert r.b == pytest.approx(0.01, abs=1e-6)


def _two_groups(spark, a_vals, b_vals):
    rows = [(1, i, float(v)) for i, v in enumerate(a_vals)] + [(2, 100 + i, float(v)) for i, v in enumerate(b_vals)]
    return spark.createDataFrame(rows, "exp_group int, user_id long, x double")


def test_welch_matches_formula(spark):
    a, b = [1, 2, 3, 4, 5.5], [2, 4, 6, 8, 10, 12]
    r = experiments.welch(_two_groups(spark, a, b), "x", 1, 2).first()
    ma, mb = sum(a) / len(a), sum(b) / len(b)
    va = sum((x - ma) ** 2 for x in a) / (len(a) - 1)
    vb = sum((x - mb) ** 2 for x in b) / (len(b) - 1)
    se = math.sqrt(va / len(a) + vb / len(b))
    assert r.t == pytest.approx((ma - mb) / se)
    dof = (va / len(a) + vb / len(b)) ** 2 / ((va / len(a)) ** 2 / (len(a) - 1) + (vb / len(b)) ** 2 / (len(b) - 1))
    assert r.df == pytest.approx(dof)
    assert 0 < r.p_value < 1


def test_welch_degenerate_is_null(spark):
    r = experiments.welch(_two_groups(spark, [1.0], [2.0, 3.0]), "x", 1, 2).first()
    assert r.t is None and r.p_value is None
    r = experiments.welch(_two_groups(spark, [1, 1, 1], [1, 1]), "x", 1, 2).first()
    assert r.t is None and r.p_value is None


def test_mann_whitney_ties(spark):
    # FIXTURES: values 1,1,2 vs 1,2,2 -> mid-ranks, U_A + U_B = 9, probabilities sum to 1
    df = _two_groups(spark, [1, 1, 2], [1, 2, 2])
    r = experiments.mann_whitney(df, "x", 1, 2).first()
    assert r.u_a + r.u_b == pytest.approx(9.0)
    assert r.u_a == pytest.approx(3.0)
    assert r.p_a_gt_b + r.p_b_gt_a + r.p_tie == pytest.approx(1.0)
    assert r.p_tie == pytest.approx(4 / 9)
    ranks = {row.value: row.midrank for row in ranking.midranks(df, "x", "exp_group", 1, 2).collect()}
    assert ranks == {1.0: 2.0, 2.0: 5.0}


def test_mann_whitney_against_bruteforce(spark):
    import random
    rnd = random.Random(7)
    a = [rnd.randint(0, 30) / 10 for _ in range(60)]
    b = [rnd.randint(0, 30) / 10 + 0.3 for _ in range(45)]
    r = experiments.mann_whitney(_two_groups(spark, a, b), "x", 1, 2, n_buckets=7).first()
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert r.u_a == pytest.approx(u)
    gt = sum(x > y for x in a for y in b) / (len(a) * len(b))
    assert r.p_a_gt_b == pytest.approx(gt)
    # normal approximation with tie correction and continuity correction
    n1, n2 = len(a), len(b)
    from collections import Counter
    t = Counter(a + b)
    n = n1 + n2
    s = math.sqrt(n1 * n2 / 12 * ((n + 1) - sum(c ** 3 - c for c in t.values()) / (n * (n - 1))))
    z = (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / s
    assert r.p_value == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-6)


def test_prefix_sums_bucket_independent(spark):
    df = spark.createDataFrame([(float(v), 1) for v in [5, 1, 3, 9, 7, 2, 8]], "v double, c int")
    for k in (1, 2, 3, 64):
        got = {r.v: r.c_lt for r in ranking.prefix_sums(df, "v", ["c"], k).collect()}
        assert got == {1.0: 0, 2.0: 1, 3.0: 2, 5.0: 3, 7.0: 4, 8.0: 5, 9.0: 6}


def test_zero_views_excluded(spark):
    # FIXTURES: a user with likes 2, views 0 -> ctr NULL, excluded, counted in n_excluded
    rows = [(1, 1, 2, 0), (1, 2, 1, 4), (1, 3, 2, 5), (2, 4, 1, 3), (2, 5, 3, 4)]
    users = spark.createDataFrame(rows, "exp_group int, user_id long, likes long, views long") \
                 .withColumn("ctr", F.col("likes") / F.nullif(F.col("views"), F.lit(0)))
    assert users.where("user_id = 1").first().ctr is None
    r = experiments.welch(users, "ctr", 1, 2).first()
    assert r.n_excluded == 1 and r.n_a == 2 and r.n_b == 2


def test_bootstrap_reproducible_and_centered(spark):
    rows = [(g, g * 1000 + i, i % 3, 5 + i % 4) for g in (1, 2) for i in range(200)]
    users = spark.createDataFrame(rows, "exp_group int, user_id long, likes long, views long")
    b1 = experiments.poisson_bootstrap(users, 1, 2, 300, partitions=3)
    b2 = experiments.poisson_bootstrap(users, 1, 2, 300, partitions=5)
    assert sorted(b1.collect()) == sorted(b2.collect())
    ci = experiments.bootstrap_diff_ci(b1).first()
    assert ci.n_reps == 300 and ci.ci_low <= ci.mean_diff <= ci.ci_high
    assert ci.ci_low < 0.0 < ci.ci_high     # identical groups: the interval covers 0


def test_aa_false_positive_rate_near_nominal(spark):
    import random
    rnd = random.Random(3)
    rows = [(g, g * 10000 + i, rnd.random()) for g in (2, 3) for i in range(400)]
    users = spark.createDataFrame(rows, "exp_group int, user_id long, ctr double")
    p = experiments.aa_resample_pvalues(users, 2, 3, n_reps=400, k=100)
    assert p.count() == 400
    r = experiments.aa_false_positive_rate(p).first()
    # 400 tests at 5 %: four standard deviations are 4.4 points
    assert 0.6 <= r.fpr_pct <= 9.4
    sizes = p.select("n_a", "n_b").distinct().collect()
    assert [tuple(x) for x in sizes] == [(100, 100)]


def test_prefix_sums_quantile_buckets_balanced_with_outlier(spark):
    from pyspark.sql import functions as F
    vals = [i / 1000 for i in range(2000)] + [1e6]
    df = spark.createDataFrame([(v, 1) for v in vals], "v double, c int")
    out = ranking.prefix_sums(df, "v", ["c"], 16)
    got = {r.v: r.c_lt for r in out.collect()}
    assert all(got[v] == i for i, v in enumerate(sorted(vals)))
    # equal-width buckets would put all but the outlier in one bucket; quantile buckets stay balanced
    from pulselens.operators.ranking import _quantile_buckets
    q = _quantile_buckets(df, "v", 16).groupBy("_bkt").count().agg(F.max("count")).first()[0]
    assert q <= 300


def test_prefix_sum_buckets_of_a_million_users_are_even(spark):
    from pulselens.operators.ranking import _quantile_buckets
    users = spark.range(1_000_000).select((F.col("id") * 7919).cast("double").alias("_key"))
    got = [r["count"] for r in _quantile_buckets(users, "_key", 64).groupBy("_bkt").count().collect()]
    assert len(got) == 64 and max(got) <= 2 * 1_000_000 / 64


def test_bootstrap_xxhash_weights_are_poisson(spark):
    rows = [(g, g * 1000 + i, i % 3, 5 + i % 4) for g in (1, 2) for i in range(300)]
    users = spark.createDataFrame(rows, "exp_group int, user_id long, likes long, views long")
    b = experiments.poisson_bootstrap(users, 1, 2, 200, partitions=4, hash_method="xxhash64")
    r = b.agg(F.avg("views_a").alias("m")).first()
    # E[sum of Poisson(1)-weighted views] = sum of views = 300 * 6.5 / ... exactly sum(views)
    total = sum(5 + i % 4 for i in range(300))
    assert abs(r.m - total) / total < 0.02


def _aa_users(spark, n):
    rows = [(g, g * 100_000 + i, float((i * 37) % 101)) for g in (2, 3) for i in range(n)]
    return rows, spark.createDataFrame(rows, "exp_group int, user_id long, ctr double")


def _uniform(*key):
    import hashlib
    return int(hashlib.md5("-".join(str(x) for x in key).encode()).hexdigest()[:13], 16) / 2 ** 52


@pytest.mark.parametrize("n,k", [(700, 500), (120, 10), (41, 10), (39, 10), (30, 30), (2500, 20)])
def test_aa_draws_exactly_k_by_one_rule(spark, n, k):
    """Below and above any ratio of pool to sample: the first k distinct draws of the hash sequence."""
    rows, users = _aa_users(spark, n)
    got = experiments.aa_resample_pvalues(users, 2, 3, n_reps=12, k=k).collect()
    assert len(got) == 12 and all((r.n_a, r.n_b, r.pool_a, r.pool_b) == (k, k, n, n) for r in got)
    value = {s: [v for g, u, v in sorted(rows, key=lambda r: r[1]) if g == s + 1] for s in (1, 2)}
    for r in got:
        for s, mean in ((1, r.mean_a), (2, r.mean_b)):
            seen, j = [], 0
            while len(seen) < k:
                j += 1
                i = math.floor(_uniform(s, r.rep, j) * n)
                if i not in seen:
                    seen.append(i)
            assert mean == pytest.approx(sum(value[s][i] for i in seen) / k)


def test_aa_short_pool_gives_null(spark):
    _, users = _aa_users(spark, 9)
    got = experiments.aa_resample_pvalues(users, 2, 3, n_reps=3, k=10).collect()
    assert [(r.n_a, r.n_b, r.p_value, r.pool_a, r.pool_b) for r in got] == [(0, 0, None, 9, 9)] * 3
    none = experiments.aa_resample_pvalues(users.where("false"), 2, 3, n_reps=2, k=10).collect()
    assert [(r.p_value, r.pool_a) for r in none] == [(None, 0)] * 2


def test_draws_go_on_where_the_usual_length_falls_short(spark):
    """All of a pool but one: the waiting time for the last index varies widely."""
    df = spark.range(1, 400).select(F.lit(1).alias("s"), F.col("id").alias("rep"), F.lit(12).cast("long").alias("n"))
    got = df.select(F.size(experiments.first_distinct_draws(F.col("n"), 11)).alias("k"),
                    F.size(F.array_distinct(experiments.first_distinct_draws(F.col("n"), 11))).alias("d")).distinct().collect()
    assert [(r.k, r.d) for r in got] == [(11, 11)]


def test_poisson_ladder_is_complete():
    from pulselens.functions.hashing import poisson1_cdf
    cdf = poisson1_cdf()
    assert len(cdf) > 12 and all(a < b < 1 for a, b in zip(cdf, cdf[1:]))
    assert 1 - cdf[-1] < 2 ** -48 and cdf[0] == pytest.approx(math.exp(-1))
    for k, c in enumerate(cdf):
        assert c == pytest.approx(sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)), abs=1e-15)


def test_poisson_weights_above_eight_occur(spark):
    from pulselens.functions.hashing import poisson1_from_uniform
    us = [0.0, 0.5, 0.99, 1 - 1e-6, 1 - 1e-9, 1 - 1e-12, 1 - 2 ** -52]
    got = [r.w for r in spark.createDataFrame([(u,) for u in us], "u double").select(poisson1_from_uniform(F.col("u")).alias("w")).collect()]
    assert got == sorted(got) and got[0] == 0 and got[3] >= 8
    assert got[-1] >= 14


def test_xxhash_buckets(spark):
    from pulselens.functions.hashing import user_bucket
    got = {r.b: r["count"] for r in spark.range(50_000).groupBy(user_bucket(F.col("id"), 50, "xxhash64").alias("b")).count().collect()}
    assert set(got) == set(range(50)) and max(got.values()) <= 1.2 * 1000 and min(got.values()) >= 0.8 * 1000
    again = spark.range(10).select(user_bucket(F.col("id"), 50, "xxhash64").alias("b")).collect()
    assert again == spark.range(10).repartition(3).orderBy("id").select(user_bucket(F.col("id"), 50, "xxhash64").alias("b")).collect()


# ---- bootstrap on sufficient statistics ---------------------------------------------------------

def test_poisson_tables_are_the_distribution():
    import math

    from pulselens.functions.hashing import TABLE_BITS, poisson_table
    for bit in (0, 3, TABLE_BITS):
        lam = 2 ** bit
        first, cdf = poisson_table(bit)
        p = [cdf[0]] + [b - a for a, b in zip(cdf, cdf[1:])]
        mean = sum((first + k) * x for k, x in enumerate(p))
        var = sum((first + k - lam) ** 2 * x for k, x in enumerate(p))
        assert abs(mean - lam) < 1e-9 * lam and abs(var - lam) < 1e-6 * lam
        assert abs(cdf[lam - first] - math.fsum(math.exp(k * math.log(lam) - lam - math.lgamma(k + 1)) for k in range(lam + 1))) < 1e-12


def test_draws_of_every_digit_have_poisson_mean_and_variance(spark):
    from pyspark.sql import functions as F

    from pulselens.functions.hashing import poisson_power_from_uniform
    n = 4000
    grid = spark.range(n).selectExpr("(id + 0.5D) / 4000D as u", "explode(array(0, 1, 2, 5, 10, 11, 16, 24)) as bit")
    got = grid.withColumn("x", poisson_power_from_uniform(F.col("u"), F.col("bit"))).groupBy("bit").agg(F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    for r in got.collect():
        lam = 2.0 ** r.bit
        assert abs(r.m - lam) < 0.02 * lam ** 0.5 + 1e-9 * lam and abs(r.v / lam - 1) < 0.02, r


def test_count_bootstrap_has_the_moments_of_the_user_bootstrap(spark):
    from pyspark.sql import functions as F

    from pulselens.operators import experiments
    users = spark.range(3000).selectExpr("cast(id % 2 as int) as exp_group", "id as user_id", "id % 3 as likes", "4L + id % 2 as views")
    boot = experiments.poisson_bootstrap_counts(users, 0, 1, 600).agg(
        F.count("*").alias("n"), F.avg("views_a").alias("m"), F.var_samp("views_a").alias("v"), F.corr("likes_a", "views_a").alias("c"),
        F.corr("views_a", "views_b").alias("between")).first()
    assert boot.n == 600
    # 1500 users of four views: the sum of Poisson weights times four
    assert abs(boot.m - 6000) < 4 * (1500 * 16 / 600) ** 0.5 and abs(boot.v / (1500 * 16) - 1) < 0.25
    assert boot.c > 0.5 and abs(boot.between) < 0.2


def test_count_bootstrap_work_does_not_follow_the_users(spark):
    from pulselens.operators import experiments
    small = spark.range(1000).selectExpr("0 as exp_group", "id as user_id", "1L as likes", "2L as views")
    large = spark.range(1_000_000).selectExpr("0 as exp_group", "id as user_id", "1L as likes", "2L as views")
    for users, n in ((small, 1000), (large, 1_000_000)):
        got = experiments.poisson_bootstrap_counts(users, 0, 1, 50).collect()
        assert len(got) == 50 and all(abs(r.likes_a - n) < 6 * n ** 0.5 and r.views_a == 2 * r.likes_a for r in got)
        assert all(r.likes_b is None for r in got)
