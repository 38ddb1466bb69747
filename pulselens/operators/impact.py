"""Pre/post campaign impact (Y1-Y3) on daily metric series.

Y1 and Y2 are closed-form aggregations.  Y3 fits a local-level state-space
model per series: the days of a series form one array, a grid of variances is
exploded, and the Kalman filter is a fold over the array.  All three take any
series keys (metric, metric x segment).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselens.functions.stats import normal_cdf_sql, normal_two_sided_p, t_two_sided_p
from pulselens.functions.timeexpr import as_date
from pulselens.operators.filters import fixed_period
from pulselens.operators.metrics import daily_posts_dau, long_series, ratio

IMPACT_METRICS = ["active_posts", "dau", "likes", "views", "ctr"]


def daily_metric_long(feed: DataFrame, metrics=IMPACT_METRICS, first_day=None, last_day=None) -> DataFrame:
    """Daily series; with both days given, only that period is scanned."""
    if first_day is not None and last_day is not None:
        feed = fixed_period(feed, first_day, last_day)
    return long_series(daily_posts_dau(feed), "date", list(metrics))


def _periods(pre, post):
    return [as_date(x) for x in pre], [as_date(x) for x in post]


def impact_prepost(long_df: DataFrame, pre, post, t_q: float = 1.96, keys=("metric",)) -> DataFrame:
    """Flat counterfactual (pre-period mean) per series: actual and
    predicted averages, effect, relative effect, cumulative sums, a
    prediction interval (``t_q`` is the quantile to use) and the p-value of
    the mean shift (Welch-style t on the post vs pre values)."""
    (p0, p1), (q0, q1) = _periods(pre, post)
    d = F.col("date")
    in_pre = (d >= F.lit(p0)) & (d <= F.lit(p1))
    in_post = (d >= F.lit(q0)) & (d <= F.lit(q1))
    v = F.col("value")
    s = long_df.groupBy(*keys).agg(
        F.count(F.when(in_pre, v)).alias("n_pre"), F.avg(F.when(in_pre, v)).alias("mean_pre"),
        F.stddev_samp(F.when(in_pre, v)).alias("sd_pre"),
        F.count(F.when(in_post, v)).alias("n_post"), F.avg(F.when(in_post, v)).alias("actual"),
        F.sum(F.when(in_post, v)).alias("cum_actual"))
    half = F.lit(t_q) * F.col("sd_pre") * F.sqrt(F.lit(1.0) + F.lit(1.0) / F.col("n_pre"))
    se = F.col("sd_pre") * F.sqrt(F.lit(1.0) / F.col("n_pre") + F.lit(1.0) / F.col("n_post"))
    t = (F.col("actual") - F.col("mean_pre")) / F.nullif(se, F.lit(0.0))
    return (s.withColumn("predicted", F.col("mean_pre"))
             .withColumn("pred_low", F.col("mean_pre") - half)
             .withColumn("pred_high", F.col("mean_pre") + half)
             .withColumn("abs_effect", F.col("actual") - F.col("predicted"))
             .withColumn("rel_effect", ratio(F.col("abs_effect"), F.col("predicted")))
             .withColumn("cum_predicted", F.col("predicted") * F.col("n_post"))
             .withColumn("p_value", t_two_sided_p(t, (F.col("n_pre") - F.lit(1)).cast("double")))
             .select(*keys, "n_pre", "n_post", "actual", "predicted", "pred_low", "pred_high", "abs_effect",
                     "rel_effect", "cum_actual", "cum_predicted", "p_value"))


def impact_trend(long_df: DataFrame, pre, post, keys=("metric",)) -> DataFrame:
    """Y2: counterfactual = linear trend fitted on the pre-period
    (``regr_slope``/``regr_intercept`` on the day number)."""
    (p0, p1), (q0, q1) = _periods(pre, post)
    d = F.col("date")
    x = F.datediff(d, F.lit(p0)).cast("double")
    in_pre = (d >= F.lit(p0)) & (d <= F.lit(p1))
    in_post = (d >= F.lit(q0)) & (d <= F.lit(q1))
    v, xp = F.col("value"), F.when(in_post & F.col("value").isNotNull(), x)
    s = long_df.groupBy(*keys).agg(
        F.regr_slope(F.when(in_pre, v), x).alias("slope"), F.regr_intercept(F.when(in_pre, v), x).alias("intercept"),
        F.count(F.when(in_post, v)).alias("n_post"), F.avg(F.when(in_post, v)).alias("actual"),
        F.sum(F.when(in_post, v)).alias("cum_actual"), F.avg(xp).alias("_x"), F.sum(xp).alias("_sx"))
    return (s.where((F.col("n_post") > 0) & F.col("slope").isNotNull())
             .withColumn("predicted", F.col("intercept") + F.col("slope") * F.col("_x"))
             .withColumn("cum_predicted", F.col("intercept") * F.col("n_post") + F.col("slope") * F.col("_sx"))
             .withColumn("abs_effect", F.col("actual") - F.col("predicted"))
             .withColumn("rel_effect", ratio(F.col("abs_effect"), F.col("predicted")))
             .select(*keys, "slope", "intercept", "n_post", "actual", "predicted", "abs_effect",
                     "rel_effect", "cum_actual", "cum_predicted"))


# ---- Y3: local-level model per series ---------------------------------------------------

#: Grid of the two variances, relative to the series variance: powers of ten in even steps, and no level variance.
OBS_STEPS, LEVEL_STEPS = 19, 16
_STEP = """named_struct(
  'll', acc.ll - 0.5D * (ln(2D * pi() * (acc.p + q + r)) + (y - acc.mu) * (y - acc.mu) / (acc.p + q + r)),
  'mu', acc.mu + (acc.p + q) / (acc.p + q + r) * (y - acc.mu),
  'p', (1D - (acc.p + q) / (acc.p + q + r)) * (acc.p + q))"""


def _without_season(x: DataFrame, keys, season: int, p0) -> DataFrame:
    """Seasonal effects: the mean deviation of each phase (day number modulo ``season``) on the pre-period, centred;
    zero where a series has fewer than two seasons."""
    x = x.withColumn("_ph", F.pmod(F.datediff("date", F.lit(p0)), F.lit(season)))
    series, phase = Window.partitionBy(*keys), Window.partitionBy(*keys, "_ph")
    pre = F.col("in_pre")
    x = x.withColumn("_dev", F.col("value") - F.avg(F.when(pre, F.col("value"))).over(series))
    x = x.withColumn("_eff", F.coalesce(F.avg(F.when(pre, F.col("_dev"))).over(phase), F.lit(0.0)))
    x = x.withColumn("_n", F.count(F.when(pre, 1)).over(phase)).withColumn("_all", F.count(F.when(pre, 1)).over(series))
    centre = F.sum(F.when(pre, F.col("_eff") / F.col("_n"))).over(series) / F.lit(float(season))
    return x.withColumn("season", F.when(F.col("_all") >= 2 * season, F.col("_eff") - centre).otherwise(F.lit(0.0)))


def _local_level_grid(long_df: DataFrame, pre, post, keys, season: int | None) -> tuple[DataFrame, DataFrame, Column]:
    """Each series' sums, its filter for every pair of variances of the grid, and whether a series can be fitted."""
    (p0, p1), (q0, q1) = _periods(pre, post)
    d = F.col("date")
    x = (long_df.where(F.col("value").isNotNull())
                .select(*keys, "date", F.col("value").cast("double").alias("value"),
                        ((d >= F.lit(p0)) & (d <= F.lit(p1))).alias("in_pre"),
                        ((d >= F.lit(q0)) & (d <= F.lit(q1))).alias("in_post")))
    x = _without_season(x, keys, season, p0) if season else x.withColumn("season", F.lit(0.0))
    flat = F.col("value") - F.col("season")
    s = x.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(F.col("in_pre"), F.struct("date", flat.alias("y"))))).alias("days"),
        F.count(F.when(F.col("in_pre"), 1)).alias("n_pre"), F.count(F.when(F.col("in_post"), 1)).alias("n_post"),
        F.coalesce(F.nullif(F.var_samp(F.when(F.col("in_pre"), flat)), F.lit(0.0)), F.lit(1.0)).alias("scale"),
        F.avg(F.when(F.col("in_post"), F.col("value"))).alias("actual"),
        F.sum(F.when(F.col("in_post"), F.col("value"))).alias("cum_actual"),
        F.avg(F.when(F.col("in_post"), F.col("season"))).alias("season"))
    able = (F.col("n_pre") >= 3) & (F.col("n_post") > 0)
    obs = F.pow(F.lit(10.0), F.lit(-4.0) + F.col("i") * F.lit(4.5 / (OBS_STEPS - 1)))
    level = F.when(F.col("j") == 0, F.lit(0.0)).otherwise(
        F.pow(F.lit(10.0), F.lit(-5.0) + (F.col("j") - 1) * F.lit(5.0 / (LEVEL_STEPS - 1))))
    grid = (s.where(able).select(*keys, "scale", F.expr("transform(days, x -> x.y)").alias("ys"),
                                 F.explode(F.sequence(F.lit(0), F.lit(OBS_STEPS - 1))).alias("i"))
             .select("*", F.explode(F.sequence(F.lit(0), F.lit(LEVEL_STEPS))).alias("j"))
             .withColumn("r", obs * F.col("scale")).withColumn("q", level * F.col("scale"))
             .withColumn("fit", F.expr(f"aggregate(slice(ys, 2, size(ys)), named_struct('ll', 0D, 'mu', ys[0], "
                                       f"'p', r * 1000D), (acc, y) -> {_STEP})")))
    return s, grid, able


def impact_local_level(long_df: DataFrame, pre, post, keys=("metric",), season: int | None = None) -> DataFrame:
    """Local-level model (a random-walk level plus noise) fitted on the
    pre-period of every series by maximum likelihood over the variance grid;
    forecast of the post-period with a 95 % interval for its mean, effect,
    cumulative effect and a two-sided p-value of the summed effect.
    ``season=7`` adds weekly effects (estimated on the pre-period, removed
    before the filter, added back to the forecast).  Series with fewer than
    three pre-period days or no post-period day get NULL results."""
    keys = list(keys)
    s, grid, able = _local_level_grid(long_df, pre, post, keys, season)
    best = grid.groupBy(*keys).agg(F.max_by(F.struct("fit.mu", "fit.p", "r", "q"),
                                            F.struct(F.col("fit.ll"), -F.col("i"), -F.col("j"))).alias("b"))
    h, r, q = F.col("n_post").cast("double"), F.col("b.r"), F.col("b.q")
    # levels of the post-period days share the random walk: the sum of min(i, j) over all pairs of days
    var_sum = F.when(able, h * h * F.col("b.p") + q * h * (h + 1) * (2 * h + 1) / 6 + h * r)
    out = (s.join(best, keys, "left").withColumn("var_sum", var_sum)
            .withColumn("predicted", F.col("b.mu") + F.when(able, F.col("season")))
            .withColumn("actual", F.when(able, F.col("actual"))).withColumn("cum_actual", F.when(able, F.col("cum_actual")))
            .withColumn("half", F.lit(1.959963984540054) * F.sqrt("var_sum") / h)
            .withColumn("cum_predicted", F.col("predicted") * h)
            .withColumn("abs_effect", F.col("actual") - F.col("predicted"))
            .withColumn("z", (F.col("cum_actual") - F.col("cum_predicted")) / F.nullif(F.sqrt("var_sum"), F.lit(0.0))))
    return out.select(*keys, "n_pre", "n_post", "actual", "predicted", (F.col("predicted") - F.col("half")).alias("pred_low"),
                      (F.col("predicted") + F.col("half")).alias("pred_high"), "abs_effect",
                      ratio(F.col("abs_effect"), F.col("predicted")).alias("rel_effect"), "cum_actual", "cum_predicted",
                      normal_two_sided_p(F.col("z")).alias("p_value"), F.sqrt(r).alias("sigma_obs"),
                      F.sqrt(q).alias("sigma_level"))


# ---- Y3: posterior over the variances ----------------------------------------------------

#: Halvings of the bracket of a quantile.
HALVINGS = 50


def impact_posterior(long_df: DataFrame, pre, post, keys=("metric",), season: int | None = None, level: float = 0.95) -> DataFrame:
    """Y3 with the uncertainty of the variances: the local-level model averaged over its whole grid.

    Every pair of variances is weighted by its likelihood on the pre-period under a prior that is flat on the grid, i.e. on
    the logarithms of both variances (and one point without level noise).  The post-period's mean, had nothing happened,
    then has a mixture of normal distributions: ``predicted`` is its mean, ``pred_low`` and ``pred_high`` its quantiles (by
    bisection), ``p_tail`` the smaller of the probabilities of a mean as high, or as low, as the actual one, and
    ``prob_effect`` is 1 - ``p_tail``.  Cumulative values are those of the mean times the days.  Series with fewer than
    three pre-period days or no post-period day get NULL results.

    ``impact_local_level`` takes the best pair for certain; on a short series whose best pair has little level noise this
    interval is the wider one.
    """
    keys = list(keys)
    s, grid, _ = _local_level_grid(long_df, pre, post, keys, season)
    sums = s.select(*keys, F.col("n_post").cast("double").alias("h"), F.col("season").alias("_season"))
    var = "h * h * fit.p + q * h * (h + 1) * (2 * h + 1) / 6 + h * r"
    pairs = grid.join(sums, keys).select(*keys, "i", "j", F.col("fit.ll").alias("ll"), (F.col("fit.mu") + F.col("_season")).alias("mean"),
                                         F.expr(f"sqrt({var}) / h").alias("sd"))
    fits = pairs.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("i", "j", "ll", "mean", "sd"))).alias("c"), F.max("ll").alias("top"),
                                    F.min(F.expr("mean - 10D * sd")).alias("lo"), F.max(F.expr("mean + 10D * sd")).alias("hi"))
    fits = fits.withColumn("c", F.expr("transform(c, x -> named_struct('w', exp(x.ll - top), 'mean', x.mean, 'sd', x.sd))"))
    fits = fits.withColumn("all", F.expr("aggregate(c, 0D, (a, x) -> a + x.w)"))

    def below(x: str) -> str:
        return f"aggregate(c, 0D, (a, x) -> a + x.w * {normal_cdf_sql(f'(({x}) - x.mean) / x.sd', 'D')}) / all"

    def quantile(q: float) -> Column:
        mid = "(b.lo + b.hi) / 2D"
        return F.expr(f"aggregate(sequence(1, {HALVINGS}), named_struct('lo', lo, 'hi', hi), (b, k) -> "
                      f"if({below(mid)} < {q!r}D, named_struct('lo', {mid}, 'hi', b.hi), named_struct('lo', b.lo, 'hi', {mid})), "
                      f"b -> (b.lo + b.hi) / 2D)")

    fits = fits.withColumn("predicted", F.expr("aggregate(c, 0D, (a, x) -> a + x.w * x.mean) / all"))
    fits = fits.withColumn("pred_low", quantile((1 - level) / 2)).withColumn("pred_high", quantile(1 - (1 - level) / 2))
    x = s.join(fits, keys, "left")
    known = F.col("predicted").isNotNull()
    x = (x.withColumn("actual", F.when(known, F.col("actual"))).withColumn("cum_actual", F.when(known, F.col("cum_actual")))
          .withColumn("_below", F.when(known, F.expr(below("actual")))).withColumn("p_tail", F.least("_below", 1 - F.col("_below"))))
    n = F.col("n_post")
    return x.select(*keys, "n_pre", "n_post", "actual", "predicted", "pred_low", "pred_high",
                    (F.col("actual") - F.col("predicted")).alias("abs_effect"), (F.col("actual") - F.col("pred_high")).alias("effect_low"),
                    (F.col("actual") - F.col("pred_low")).alias("effect_high"),
                    ratio(F.col("actual") - F.col("predicted"), F.col("predicted")).alias("rel_effect"), "cum_actual",
                    (F.col("predicted") * n).alias("cum_predicted"), (F.col("pred_low") * n).alias("cum_low"),
                    (F.col("pred_high") * n).alias("cum_high"), "p_tail", (1 - F.col("p_tail")).alias("prob_effect"))
