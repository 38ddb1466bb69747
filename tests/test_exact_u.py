"""The exact distribution of U against listed arrangements and known p-values."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from pulselens.operators import experiments


def table(spark, a, b):
    return spark.createDataFrame([(1, float(x)) for x in a] + [(2, float(x)) for x in b], "exp_group int, v double")


def listed(a, b):
    ranks = range(1, len(a) + len(b) + 1)
    u = lambda s: sum(s) - len(a) * (len(a) + 1) // 2
    mine = sum(x > y for x in a for y in b)
    low = min(mine, len(a) * len(b) - mine)
    all_u = [u(s) for s in itertools.combinations(ranks, len(a))]
    return min(1.0, 2 * sum(x <= low for x in all_u) / len(all_u))


@pytest.mark.parametrize("a,b", [([1], [2]), ([1, 2, 3], [4, 5, 6]), ([1, 4, 6], [2, 3, 5, 7, 8]), ([5, 9, 2, 7], [1, 3, 4, 6, 8, 10, 11]),
                                 ([1, 3, 5, 7, 9, 11, 13], [2, 4, 6, 8, 10, 12, 14]), (list(range(20, 32)), [1, 2, 35])])
def test_equals_all_arrangements(spark, a, b):
    r = experiments.mann_whitney(table(spark, a, b), "v", 1, 2, n_buckets=1, method="auto").first()
    assert r.exact and math.isclose(r.p_value, listed(a, b), rel_tol=1e-12)


def test_known_values(spark):
    # a textbook table: sizes 5 and 5, U = 2 has a two-sided p of 8/252; sizes 8 and 8, U = 13 one of 0.0498834
    df = spark.createDataFrame([(2, 5, 5), (13, 8, 8), (0, 8, 492)], "u long, a long, b long")
    got = [r.p for r in df.select(experiments.exact_u_p(F.col("u"), F.col("a"), F.col("b")).alias("p")).collect()]
    assert got[0] == pytest.approx(8 / 252, rel=1e-12)
    assert got[1] == pytest.approx(0.0498834, abs=1e-6)
    assert got[2] == pytest.approx(2 / math.comb(500, 8), rel=1e-12)


def test_used_only_where_documented(spark):
    ties = experiments.mann_whitney(table(spark, [1, 2, 3], [3, 4, 5]), "v", 1, 2, n_buckets=1, method="auto").first()
    many = experiments.mann_whitney(table(spark, range(0, 18, 2), range(1, 19, 2)), "v", 1, 2, n_buckets=1, method="auto").first()
    none = experiments.mann_whitney(table(spark, [1, 2], []), "v", 1, 2, n_buckets=1, method="auto").first()
    assert not ties.exact and not many.exact and not none.exact
    for args, r in ((([1, 2, 3], [3, 4, 5]), ties), ((range(0, 18, 2), range(1, 19, 2)), many)):
        assert r.p_value == experiments.mann_whitney(table(spark, *args), "v", 1, 2, n_buckets=1).first().p_value
    with pytest.raises(ValueError):
        experiments.mann_whitney(table(spark, [1], [2]), "v", 1, 2, method="exact")
