"""Impact estimators on synthetic daily series with a known effect."""

import datetime as dt
import math
import random

import pytest

from pulselens.operators import impact

PRE = (dt.date(2024, 1, 1), dt.date(2024, 1, 28))
POST = (dt.date(2024, 1, 29), dt.date(2024, 2, 4))


def _series(spark, jump):
    rnd = random.Random(11)
    rows = []
    for i in range(35):
        d = dt.date(2024, 1, 1) + dt.timedelta(days=i)
        base = 100.0 + rnd.gauss(0, 2)
        rows.append(("flat", d, base + (jump if d >= POST[0] else 0.0)))
        rows.append(("trend", d, 50.0 + 2.0 * i + (jump if d >= POST[0] else 0.0)))
    return spark.createDataFrame(rows, "metric string, date date, value double")


def test_prepost_and_trend_recover_effect(spark):
    df = _series(spark, 30.0)
    pp = {r.metric: r for r in impact.impact_prepost(df, PRE, POST).collect()}
    assert pp["flat"].abs_effect == pytest.approx(30.0, abs=3.0)
    assert pp["flat"].p_value < 1e-6
    assert pp["flat"].pred_low < pp["flat"].predicted < pp["flat"].pred_high
    tr = {r.metric: r for r in impact.impact_trend(df, PRE, POST).collect()}
    assert tr["trend"].slope == pytest.approx(2.0, abs=1e-9)
    assert tr["trend"].abs_effect == pytest.approx(30.0, abs=1e-6)


def test_local_level_detects_jump_and_not_noise(spark):
    with_jump = {r.metric: r for r in impact.impact_local_level(_series(spark, 30.0), PRE, POST).collect()}
    flat = with_jump["flat"]
    assert flat.n_pre == 28 and flat.n_post == 7
    assert flat.predicted == pytest.approx(100.0, abs=3.0)
    assert flat.abs_effect == pytest.approx(30.0, abs=4.0)
    assert flat.p_value < 0.01
    assert flat.pred_low < flat.predicted < flat.pred_high
    none = {r.metric: r for r in impact.impact_local_level(_series(spark, 0.0), PRE, POST).collect()}
    # this seed's post-period mean sits ~2 standard errors low, hence 0.01
    assert none["flat"].p_value > 0.01 and abs(none["flat"].abs_effect) < 3.0
    assert math.isclose(none["flat"].cum_predicted, none["flat"].predicted * 7)


def test_local_level_weekly_season(spark):
    rows = []
    for i in range(35):
        d = dt.date(2024, 1, 1) + dt.timedelta(days=i)
        weekly = [0, 5, 10, 5, 0, -10, -10][i % 7]
        rows.append(("m", d, 100.0 + weekly + (20.0 if d >= POST[0] else 0.0)))
    df = spark.createDataFrame(rows, "metric string, date date, value double")
    r = impact.impact_local_level(df, PRE, POST, season=7).first()
    assert r.abs_effect == pytest.approx(20.0, abs=1.0)
    assert r.p_value < 0.01


def test_local_level_against_plain_kalman(spark):
    """Any series keys; the same grid search and filter in plain Python."""
    rnd = random.Random(5)
    rows = [(m, g, dt.date(2024, 1, 1) + dt.timedelta(days=i), rnd.gauss(50, 5) + i * (m == "a"))
            for m in ("a", "b") for g in ("x", "y") for i in range(35)]
    df = spark.createDataFrame(rows + [("c", "x", PRE[0], 1.0)], "metric string, segment string, date date, value double")
    got = {(r.metric, r.segment): r for r in impact.impact_local_level(df, PRE, POST, keys=("metric", "segment")).collect()}
    assert got["c", "x"].predicted is None and got["c", "x"].n_pre == 1
    for key in (("a", "x"), ("b", "y")):
        y = [v for m, g, d, v in rows if (m, g) == key and d <= PRE[1]]
        post = [v for m, g, d, v in rows if (m, g) == key and POST[0] <= d <= POST[1]]
        mean = sum(y) / len(y)
        scale = sum((v - mean) ** 2 for v in y) / (len(y) - 1)
        best = None
        for i in range(impact.OBS_STEPS):
            for j in range(impact.LEVEL_STEPS + 1):
                r = scale * 10 ** (-4 + i * 4.5 / (impact.OBS_STEPS - 1))
                q = scale * (10 ** (-5 + (j - 1) * 5 / (impact.LEVEL_STEPS - 1)) if j else 0)
                mu, p, ll = y[0], r * 1000, 0.0
                for v in y[1:]:
                    f = p + q + r
                    ll -= 0.5 * (math.log(2 * math.pi * f) + (v - mu) ** 2 / f)
                    mu, p = mu + (p + q) / f * (v - mu), (1 - (p + q) / f) * (p + q)
                if best is None or ll > best[0] + 1e-9:
                    best = ll, mu, p, r, q
        _, mu, p, r, q = best
        h = len(post)
        var = sum(p + min(a, b) * q for a in range(1, h + 1) for b in range(1, h + 1)) + h * r
        x = got[key]
        assert x.predicted == pytest.approx(mu) and x.sigma_obs == pytest.approx(math.sqrt(r))
        assert x.pred_high - x.predicted == pytest.approx(1.959963984540054 * math.sqrt(var) / h)
        assert x.p_value == pytest.approx(math.erfc(abs(sum(post) - mu * h) / math.sqrt(2 * var)), abs=1e-6)


def _series(spark, values, name="m"):
    import datetime as dt
    return spark.createDataFrame([(name, dt.date(2024, 1, 1) + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)],
                                 "metric string, date date, value double")


def test_posterior_widens_the_interval_of_a_short_series(spark):
    from pulselens.operators import impact
    # the likeliest pair has no level noise; the others, which are nearly as likely, have some
    long_df = _series(spark, [10, 13, 9, 12, 10, 30, 31])
    pre, post = ("2024-01-01", "2024-01-05"), ("2024-01-06", "2024-01-07")
    one, = impact.impact_local_level(long_df, pre, post).collect()
    all_, = impact.impact_posterior(long_df, pre, post).collect()
    assert one.sigma_level < 0.2 * one.sigma_obs
    assert all_.pred_high - all_.pred_low > 1.1 * (one.pred_high - one.pred_low)
    assert all_.pred_low < all_.predicted < all_.pred_high
    assert all_.effect_low == all_.actual - all_.pred_high and 0 <= all_.p_tail < 0.05


def test_posterior_against_the_plain_mixture(spark):
    import math

    import numpy as np

    from pulselens.operators import impact
    values = [5.0, 7.0, 6.5, 6.0, 8.0, 7.5, 7.0, 9.0, 8.5, 8.0]
    pre, post = ("2024-01-01", "2024-01-07"), ("2024-01-08", "2024-01-10")
    got, = impact.impact_posterior(_series(spark, values), pre, post).collect()
    y, h = values[:7], 3
    scale = np.var(y, ddof=1)
    comps = []
    for i in range(impact.OBS_STEPS):
        for j in range(impact.LEVEL_STEPS + 1):
            r = scale * 10 ** (-4 + i * 4.5 / (impact.OBS_STEPS - 1))
            q = scale * (0 if j == 0 else 10 ** (-5 + (j - 1) * 5 / (impact.LEVEL_STEPS - 1)))
            mu, p, ll = y[0], r * 1000, 0.0
            for v in y[1:]:
                f = p + q + r
                ll -= 0.5 * (math.log(2 * math.pi * f) + (v - mu) ** 2 / f)
                mu, p = mu + (p + q) / f * (v - mu), (1 - (p + q) / f) * (p + q)
            comps.append((ll, mu, math.sqrt(h * h * p + q * h * (h + 1) * (2 * h + 1) / 6 + h * r) / h))
    top = max(c[0] for c in comps)
    w = np.array([math.exp(c[0] - top) for c in comps])
    w /= w.sum()
    cdf = lambda x: sum(a * 0.5 * math.erfc((m - x) / (s * math.sqrt(2))) for a, (_, m, s) in zip(w, comps))
    assert abs(got.predicted - sum(a * m for a, (_, m, _) in zip(w, comps))) < 1e-9
    assert abs(cdf(got.pred_low) - 0.025) < 1e-6 and abs(cdf(got.pred_high) - 0.975) < 1e-6
    assert abs(got.p_tail - min(cdf(got.actual), 1 - cdf(got.actual))) < 1e-6


def test_posterior_without_enough_days_is_null(spark):
    from pulselens.operators import impact
    got, = impact.impact_posterior(_series(spark, [1, 2, 3]), ("2024-01-01", "2024-01-02"), ("2024-01-03", "2024-01-03")).collect()
    assert got.n_pre == 2 and got.predicted is None and got.p_tail is None and got.actual is None
