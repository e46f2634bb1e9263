"""Per-series diagnostics (E10, K16, K17, K18) in windows, aggregates and array functions.

Regressions are solved from one cross-product array per series (``linalg``),
recursions are ``aggregate`` over arrays of a few dozen numbers. Nothing here
runs in Python workers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import linalg as LA
from ..sources import schemas as S

# Asymptotic Dickey-Fuller critical values, constant, no trend
# (MacKinnon), for the 1%, 5% and 10% levels.
DF_CRITICAL = {"1%": -3.43, "5%": -2.86, "10%": -2.57}


def dickey_fuller(df: DataFrame, target: str = "weekly_sales", keys=S.KEYS, date: str = "date") -> DataFrame:
    """K16 (lag 0): regress dy_t on y_{t-1} with intercept; t-statistic of the slope.

    Uses ``regr_*`` aggregates: slope = Sxy/Sxx, se = sqrt((Syy - slope*Sxy)/(n-2)/Sxx).
    """
    w = Window.partitionBy(*keys).orderBy(date)
    lagged = df.select(*keys, F.col(target).alias("y"), F.lag(target).over(w).alias("ylag"))
    d = lagged.withColumn("dy", F.col("y") - F.col("ylag"))
    g = d.groupBy(*keys).agg(F.regr_count("dy", "ylag").alias("n"), F.regr_slope("dy", "ylag").alias("slope"),
                             F.regr_sxx("dy", "ylag").alias("sxx"), F.regr_sxy("dy", "ylag").alias("sxy"),
                             F.regr_syy("dy", "ylag").alias("syy"))
    ssr = F.col("syy") - F.col("slope") * F.col("sxy")
    se = F.sqrt(F.try_divide(F.try_divide(ssr, F.col("n") - 2), F.col("sxx")))
    t = F.try_divide(F.col("slope"), se)
    return g.select(*keys, "n", "slope", t.alias("df_stat"), (t < DF_CRITICAL["5%"]).alias("stationary_5pct"))


def autocorrelation(df: DataFrame, max_lag: int = 40, target: str = "weekly_sales", keys=S.KEYS,
                    date: str = "date") -> DataFrame:
    """ACF lags 0..max_lag: sum((x_t - m)(x_{t-k} - m)) / sum((x_t - m)^2), one row per (series, lag)."""
    wk = Window.partitionBy(*keys)
    w = Window.partitionBy(*keys).orderBy(date)
    c = df.select(*keys, date, (F.col(target) - F.avg(target).over(wk)).alias("z"))
    lagged = c.select(*keys, "z", *[F.lag("z", k).over(w).alias(f"l{k}") for k in range(1, max_lag + 1)])
    sums = lagged.groupBy(*keys).agg(F.sum(F.col("z") * F.col("z")).alias("l0"),
                                     *[F.sum(F.col("z") * F.col(f"l{k}")).alias(f"l{k}")
                                       for k in range(1, max_lag + 1)])
    long = sums.withColumn("denom", F.col("l0")).unpivot(
        [*keys, "denom"], [f"l{k}" for k in range(max_lag + 1)], "lag_name", "num")
    return long.select(*keys, F.substring("lag_name", 2, 3).cast("int").alias("lag"),
                       F.try_divide(F.col("num"), F.col("denom")).alias("acf"))


def partial_autocorrelation(acf: DataFrame, keys=S.KEYS) -> DataFrame:
    """Durbin-Levinson on each series' ACF; the recursion is an ``aggregate`` over its max_lag + 1 values.

    From the first lag whose prediction variance is not positive on, the value is NULL.
    """
    g = acf.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("lag", "acf"))), lambda x: x["acf"]).alias("r"))

    def step(acc: Column, k: Column) -> Column:
        back = F.reverse(F.slice(g["r"], 2, k - 1))
        a = F.when(acc["v"] > 0, (g["r"][k] - LA.dot(acc["phi"], back)) / acc["v"])
        return F.struct(a.alias("a"), acc["phi"].alias("phi"), acc["v"].alias("v"), acc["out"].alias("out"))

    def renew(acc: Column) -> Column:
        a = acc["a"]
        phi = F.concat(F.zip_with(acc["phi"], F.reverse(acc["phi"]), lambda x, y: x - a * y), F.array(a))
        return F.struct(F.lit(None).cast("double").alias("a"), phi.alias("phi"), (acc["v"] * (1 - a * a)).alias("v"),
                        F.concat(acc["out"], F.array(a)).alias("out"))

    empty = F.array().cast("array<double>")
    # the start's types must admit the NULLs of later turns
    one = F.concat(empty, F.array(F.lit(1.0)))
    start = F.struct(F.lit(None).cast("double").alias("a"), empty.alias("phi"), F.try_element_at(one, F.lit(1)).alias("v"), one.alias("out"))
    # two steps a lag: the new coefficient, then the arrays that use it, so that it is computed once
    turns = F.sequence(F.lit(2), 2 * F.size("r") - 1)
    run = F.aggregate(turns, start, lambda acc, t: F.when(t % 2 == 0, step(acc, (t / 2).cast("int"))).otherwise(renew(acc)), lambda acc: acc["out"])
    solved = g.select(*keys, F.when(F.size("r") > 1, run).otherwise(one).alias("p"))
    return solved.select(*keys, F.posexplode_outer("p").alias("lag", "pacf"))  # outer: no filter that evaluates the recursion again


def seasonal_decompose(df: DataFrame, period: int = 52, target: str = "weekly_sales", keys=S.KEYS,
                       date: str = "date") -> DataFrame:
    """Additive decomposition: centred 2 x period moving average trend (NULL in the
    first/last period/2 rows), seasonal = centred mean of detrended values by position
    ``(row - 1) % period``, residual = x - trend - seasonal. Series need 2 * period rows."""
    half = period // 2
    w = Window.partitionBy(*keys).orderBy(date)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    rn = F.row_number().over(w)
    inner = F.sum(target).over(w.rowsBetween(-(half - 1), half - 1))
    ends = F.lag(target, half).over(w) + F.lead(target, half).over(w)
    t = df.select(*keys, date, target, rn.alias("rn"), n.alias("n"),
                  ((inner + 0.5 * ends) / period).alias("trend")).filter(F.col("n") >= 2 * period)
    t = t.withColumn("pos", (F.col("rn") - 1) % period).withColumn("detrended", F.col(target) - F.col("trend"))
    idx = t.groupBy(*keys, "pos").agg(F.avg("detrended").alias("_s"))
    idx = idx.withColumn("seasonal", F.col("_s") - F.avg("_s").over(Window.partitionBy(*keys))).drop("_s")
    out = t.join(idx, [*keys, "pos"], "left")
    return out.select(*keys, date, target, "trend", "seasonal",
                      (F.col(target) - F.col("trend") - F.col("seasonal")).alias("resid"))


def _lagged_differences(df: DataFrame, lags: int, target: str, keys, date: str) -> DataFrame:
    """``keys, ylag, d0 .. d<lags>``: the level before and the difference with its lags."""
    w = Window.partitionBy(*keys).orderBy(date)
    ys = [F.col(target).cast("double")] + [F.lag(target, k).over(w).cast("double") for k in range(1, lags + 2)]
    levels = df.select(*keys, *[y.alias(f"y{k}") for k, y in enumerate(ys)])
    return levels.select(*keys, F.col("y1").alias("ylag"), *[(F.col(f"y{k}") - F.col(f"y{k + 1}")).alias(f"d{k}") for k in range(lags + 1)])


def _nested_adf(lags: int) -> tuple[list[Column], Column]:
    """(values whose cross-products are needed, column of one struct per order 0..lags, from the array ``g`` and count ``n``)."""
    values = [F.lit(1.0), F.col("ylag"), *[F.col(f"d{k}") for k in range(1, lags + 1)], F.col("d0")]
    last = len(values) - 1

    def step(acc: Column, k: Column) -> Column:
        m = LA.swept(acc["m"], k, acc["d"])
        return F.struct(m.alias("m"), acc["d"].alias("d"), acc["found"].alias("found"))

    def note(acc: Column, k: Column) -> Column:
        m, used = acc["m"], (k + 1).cast("double")
        rss = m[last][last]
        error = F.sqrt(F.when(F.col("n") > used, rss / (F.col("n") - used)) * -m[1][1])
        order = F.struct((F.col("n") * F.ln(F.when(rss > 0, rss) / F.col("n")) + 2 * used).alias("aic"), (k - 1).cast("int").alias("lags"),
                         F.try_divide(m[1][last], error).alias("adf_stat"))
        return F.struct(m.alias("m"), acc["d"].alias("d"), F.concat(acc["found"], F.array(order)).alias("found"))

    empty = F.array().cast("array<struct<aic:double,lags:int,adf_stat:double>>")
    start = F.struct(F.col("g").alias("m"), LA.diagonal_of(F.col("g")).alias("d"), empty.alias("found"))
    # pivot 0 is the constant; from pivot 1 on each sweep ends a nested regression, noted in the turn after it
    turns = F.sequence(F.lit(1), F.lit(2 * (lags + 2)))
    sweep_first = F.aggregate(turns, start, lambda acc, t: F.when(t % 2 == 1, step(acc, ((t - 1) / 2).cast("int"))).otherwise(note(acc, (t / 2 - 1).cast("int"))),
                              lambda acc: F.filter(acc["found"], lambda o: o["lags"] >= 0))
    return values, sweep_first


def mackinnon_p_value(stat: Column) -> Column:
    """Approximate p-value of a Dickey-Fuller statistic (constant, no trend): MacKinnon's response surface."""
    # MacKinnon (1994), one variable with constant: polynomials below and above -1.61, valid from -18.83 to 2.74.
    small = 2.1659 + stat * 1.4412 + stat * stat * 0.038269
    large = 1.7339 + stat * 0.93202 - stat * stat * 0.12745 - stat * stat * stat * 0.010368
    z = F.when(stat <= -1.61, small).otherwise(large)
    return F.when(stat < -18.83, 0.0).when(stat > 2.74, 1.0).otherwise(normal_cdf(z))


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, to 1e-7."""
    # Abramowitz and Stegun 26.2.17.
    t = 1 / (1 + 0.2316419 * F.abs(z))
    tail = F.exp(-z * z / 2) * 0.3989422804014327 * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.when(z >= 0, 1 - tail).otherwise(tail)


TOO_SHORT = "series too short"


def _adf(df: DataFrame, lags: int, target: str, keys, date: str) -> DataFrame:
    """``keys, n, rows, orders``: the statistics of all orders 0..lags on the rows that have all lags."""
    values, orders = _nested_adf(lags)
    d = _lagged_differences(df, lags, target, keys, date)
    g = d.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("n_all"), LA.gram(values).alias("g"))
    g = g.withColumn("n", F.coalesce(F.col("g")[0][0], F.lit(0.0)))
    return g.select(*keys, F.col("n_all"), F.col("n"), F.when(F.col("n") > lags + 3, orders).alias("orders"))


def adf_test(df: DataFrame, lags: int = 4, target: str = "weekly_sales", keys=S.KEYS, date: str = "date") -> DataFrame:
    """K16 (k lags): augmented Dickey-Fuller statistic per series; NULL with an ``error`` for a series too short or without spread."""
    stat = F.element_at("orders", -1)["adf_stat"]
    out = _adf(df, lags, target, keys, date).select(
        *keys, F.lit(lags).alias("lags"), F.col("n_all").alias("n"), stat.alias("adf_stat"),
        F.when(F.col("orders").isNull(), F.lit(TOO_SHORT)).when(stat.isNull(), F.lit("no unique fit")).alias("error"))
    return out.withColumn("stationary_5pct", F.col("adf_stat") < DF_CRITICAL["5%"])


def adf_auto(df: DataFrame, max_lag: int = 12, target: str = "weekly_sales", keys=S.KEYS, date: str = "date") -> DataFrame:
    """K16 with the lag order chosen: least AIC of the orders 0..max_lag, all on the rows that have ``max_lag`` lags (ties: fewer lags).

    One cross-product array per series is swept once through all nested orders.
    Columns: keys, n (rows used), lags, adf_stat, p_value, stationary_5pct
    (p-value below 0.05), error. A series without a fit keeps its row.
    """
    best = F.array_min(F.filter("orders", lambda o: o["aic"].isNotNull() & o["adf_stat"].isNotNull()))
    chosen = _adf(df, max_lag, target, keys, date).select(*keys, F.col("n").cast("long").alias("n"), F.col("orders").isNull().alias("short"), best.alias("b"))
    p = mackinnon_p_value(F.col("adf_stat"))
    out = chosen.select(*keys, "n", F.col("b.lags").alias("lags"), F.col("b.adf_stat").alias("adf_stat"),
                        F.when(F.col("short"), F.lit(TOO_SHORT)).when(F.col("b").isNull(), F.lit("no unique fit")).alias("error"))
    return out.withColumn("p_value", p).withColumn("stationary_5pct", F.col("p_value") < 0.05)
