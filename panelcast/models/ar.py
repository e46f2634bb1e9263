"""Per-series autoregressive models (K19, K20, K25, E8 inverse).

The reference fits (S)ARIMA per series with a state-space solver. Here the
AR part is re-aimed: difference (d, and D at season s), fit AR(p) by
conditional least squares, forecast recursively and re-integrate; MA terms come
from a two-stage regression on innovations. AR(1), the order grid and the MA
fits are column functions. Higher AR orders are one grouped pandas call per
(series, fold) over at most one series' rows. Failures are returned in an
``error`` column, never raised (K25).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import linalg as LA
from ..sources import schemas as S
from ..operators.grid import reindex_series
from ..operators.prep import ffill
from ..operators.splits import series_fold_bounds


def _difference(y: np.ndarray, d: int, D: int, s: int) -> np.ndarray:
    z = y.copy()
    for _ in range(D):
        z = z[s:] - z[:-s]
    for _ in range(d):
        z = np.diff(z)
    return z


def _ar_fit(z: np.ndarray, p: int, skip: int | None = None):
    """Conditional least squares AR(p) with intercept: (coef, ssr, n_eff).

    The first ``skip`` (at least p) values only serve as lags, so that orders
    compared with one ``skip`` are fitted to the same sample.
    """
    skip = p if skip is None else max(skip, p)
    n = len(z) - skip
    if n <= p + 2:
        raise ValueError("too few observations for AR order")
    X = np.column_stack([np.ones(n)] + [z[skip - j:len(z) - j] for j in range(1, p + 1)])
    Y = z[skip:]
    beta, *_ = np.linalg.lstsq(X, Y, rcond=None)
    r = Y - X @ beta
    return beta, float(r @ r), n


def _integrate(history: np.ndarray, zf: np.ndarray, d: int, D: int, s: int) -> np.ndarray:
    """Invert the differences: rebuild levels from the history and forecast differences."""
    # levels of each differencing stage at the end of history
    stages = [history.astype(float)]
    cur = history.astype(float)
    for _ in range(D):
        cur = cur[s:] - cur[:-s]
        stages.append(cur)
    for _ in range(d):
        cur = np.diff(cur)
        stages.append(cur)
    out = zf.astype(float)
    # undo non-seasonal then seasonal differences, newest stage first
    for k in range(d):
        base = stages[len(stages) - 2 - k]
        out = base[-1] + np.cumsum(out)
    for k in range(D):
        base = stages[D - 1 - k]
        ext = list(base)
        res = []
        for v in out:
            nv = v + ext[-s]
            ext.append(nv)
            res.append(nv)
        out = np.array(res)
    return out


def forecast_ar(y: np.ndarray, steps: int, p: int = 1, d: int = 1, D: int = 1, s: int = 52) -> np.ndarray:
    """AR(p) on the (d, D)-differenced series, recursive forecast, re-integrated."""
    z = _difference(y, d, D, s)
    beta, _, _ = _ar_fit(z, p)
    hist = list(z)
    zf = []
    for _ in range(steps):
        v = beta[0] + sum(beta[j] * hist[-j] for j in range(1, p + 1))
        hist.append(v)
        zf.append(v)
    return _integrate(y, np.array(zf), d, D, s)


def _evaluate(order: tuple[int, int, int, int]):
    p, d, D, s = order

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(date=pd.to_datetime(pdf["date"])).sort_values("date")
        key = {c: pdf[c].iloc[0] for c in ("store", "dept", "fold")}
        tr = pdf[pdf["role"] == "train"]
        va = pdf[pdf["role"] == "val"]
        err, pred = None, np.full(len(va), np.nan)
        try:
            if len(tr) < 30 or len(va) == 0:
                raise ValueError("fold guard: train < 30 rows or empty validation")
            y = tr["y"].to_numpy(dtype=float)
            last = tr["date"].max()
            steps = int((va["date"].max() - last).days // 7)
            fc = forecast_ar(y, steps, p, d, D, s)
            # align by date: forecast step k is last + 7 (k+1) days
            idx = ((va["date"] - last).dt.days // 7 - 1).to_numpy()
            pred = fc[idx]
        except Exception as e:  # noqa: BLE001  K25
            err = str(e)
        out = va[["date", "y", "is_holiday"]].copy()
        for k, v in key.items():
            out[k] = v
        out["y_pred"] = pred
        out["error"] = err
        if len(out) == 0:
            out = pd.DataFrame([{**key, "date": pd.NaT, "y": np.nan, "is_holiday": None,
                                 "y_pred": np.nan, "error": err}])
        return out[["store", "dept", "fold", "date", "y", "is_holiday", "y_pred", "error"]]
    return fn


def fit_groups(df: DataFrame, keys: list[str]):
    """``df`` grouped by ``keys`` for a fit per group.

    A fit costs time by group, not by byte: partitions of a given number are
    not coalesced by their few bytes into one or two long tasks.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).groupBy(*keys)


PRED_SCHEMA = ("store int, dept int, fold int, date date, y double, is_holiday boolean, "
               "y_pred double, error string")


def fold_frame(df: DataFrame, folds: DataFrame | None = None, target: str = "weekly_sales", keys=S.KEYS,
               densify: bool = True, n_splits: int = 3, horizon_weeks: int = 13, min_train: int = 30) -> DataFrame:
    """Rows of each (series, fold) for the grouped fits: train rows (regular weekly and
    forward filled when ``densify``, the reference's ``asfreq`` + ``ffill``) and the
    observed validation rows, for folds passing the B14 guard (``min_train`` observed
    train rows, non-empty validation).

    ``folds`` defaults to ``series_fold_bounds``. The guard is a window count over
    (series, fold), the partitioning the grouped fit needs anyway.
    """
    base = df.select(*keys, "date", target, "is_holiday")
    if densify:
        dense = reindex_series(base, target, keys, fill=None, holiday_from="row")
        dense = ffill(dense, [target], keys, ["date"])
    else:
        dense = base.withColumn("is_filled", F.lit(False))
    if folds is None:
        folds = series_fold_bounds(base, keys, "date", n_splits, horizon_weeks)
    j = dense.join(folds.select(*keys, "fold", "val_start", "val_end"), keys)
    j = j.filter(F.col("date") <= F.col("val_end"))
    j = j.withColumn("role", F.when(F.col("date") < F.col("val_start"), "train").otherwise("val"))
    # validation rows are the observed ones only
    j = j.filter((F.col("role") == "train") | ~F.col("is_filled"))
    w = Window.partitionBy(*keys, "fold")
    obs_train = F.count_if((F.col("role") == "train") & ~F.col("is_filled")).over(w)
    n_val = F.count_if(F.col("role") == "val").over(w)
    j = j.withColumn("_ntr", obs_train).withColumn("_nva", n_val)
    j = j.filter((F.col("_ntr") >= min_train) & (F.col("_nva") > 0))
    return j.select(*keys, "fold", "date", F.col(target).alias("y"), "is_holiday", "role")


def evaluate_ar(frame: DataFrame, order=(1, 1, 1, 52)) -> DataFrame:
    """K20 + K25: per (series, fold) forecasts of the validation rows (``order`` = p, d, D, s)."""
    return fit_groups(frame, ["store", "dept", "fold"]).applyInPandas(_evaluate(order), PRED_SCHEMA)


def evaluate_ar1(frame: DataFrame, seasonal: bool = True, s: int = 52, min_train: int = 30) -> DataFrame:
    """K20 with order (1, 1) in column functions: same rows and schema as ``evaluate_ar`` with (1, 1, ``seasonal``, s).

    The fit is ``regr_slope`` / ``regr_intercept`` of a difference on the one
    before, the forecast a running sum of at most one season of steps. The
    frame has to be weekly in its train rows (``fold_frame`` with ``densify``).
    Windows and the aggregate share the frame's partitioning by (series, fold);
    a group's validation rows travel in one array, bounded by the horizon. A
    fold with too few rows, or a row over one season ahead, has a NULL
    prediction and an ``error``.
    """
    keys = ["store", "dept", "fold"]
    w = Window.partitionBy(*keys).orderBy("day")
    # by date, not by position: validation rows may have gaps
    before = F.first("y").over(w.rangeBetween(-7 * s, -7 * s))
    f = frame.withColumn("day", F.unix_date("date")).withColumn("year_ago", before)
    f = f.withColumn("level", F.col("y") - F.col("year_ago") if seasonal else F.col("y"))
    f = f.withColumn("z", F.col("level") - F.lag("level").over(w))
    f = f.withColumn("z_before", F.lag("z").over(w))
    train, val = F.col("role") == "train", F.col("role") == "val"
    in_train = lambda c: F.when(train, F.col(c))
    n_pairs = F.count_if(train & F.col("z_before").isNotNull())
    g = f.groupBy(*keys).agg(
        F.regr_slope(in_train("z"), in_train("z_before")).alias("slope"),
        F.regr_intercept(in_train("z"), in_train("z_before")).alias("intercept"),
        F.avg(F.when(train & F.col("z_before").isNotNull(), F.col("z"))).alias("mean_z"),
        F.max_by(in_train("level"), in_train("day")).alias("last_level"),
        F.max_by(in_train("z"), in_train("day")).alias("last_z"), F.max(in_train("day")).alias("last_day"),
        F.when(F.count_if(train) < min_train, F.lit("fold guard: train < 30 rows or empty validation"))
        .when(n_pairs <= 3, F.lit("too few observations for AR order")).alias("failed"),
        F.collect_list(F.when(val, F.struct("date", "day", "y", "is_holiday", "year_ago"))).alias("rows"))
    # differences without spread have no slope: their mean is the forecast
    phi, c = F.coalesce("slope", F.lit(0.0)), F.coalesce("intercept", "mean_z")
    e = g.select(*keys, phi.alias("phi"), c.alias("c"), "last_level", "last_z", "last_day", "failed", F.explode("rows").alias("v"))
    return _ar1_forecasts(e, keys, seasonal, s)


def evaluate_ar1_folds(dense: DataFrame, folds: DataFrame, seasonal: bool = True, s: int = 52, min_train: int = 30,
                       target: str = "weekly_sales", keys=S.KEYS) -> DataFrame:
    """``evaluate_ar1`` over all folds of gapless weekly series (``is_filled`` marks filled rows), for the folds that pass the B14 guard.

    Differences look back only, so they are taken once per series, before its
    rows meet its folds; one aggregate per (series, fold) follows, on the
    partitioning of the windows.
    """
    ks = [*keys, "fold"]
    z = _differenced(dense, target, keys, s, seasonal, [1], year_ago=True).withColumn("day", F.unix_date("date"))
    j = z.join(folds.select(*ks, "val_start", "val_end"), list(keys)).filter(F.col("date") <= F.col("val_end"))
    train = F.col("date") < F.col("val_start")
    val = ~train & ~F.col("is_filled")
    pair = train & F.col("z1").isNotNull()
    y, x = F.when(pair, F.col("z0")), F.when(pair, F.col("z1"))
    at = F.when(train, F.col("day"))
    g = j.groupBy(*ks).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.avg(y).alias("mean_z"),
        F.max_by(F.when(train, F.col("level")), at).alias("last_level"), F.max_by(F.when(train, F.col("z0")), at).alias("last_z"), F.max(at).alias("last_day"),
        F.count_if(train & ~F.col("is_filled")).alias("observed"), F.count_if(pair).alias("pairs"),
        F.collect_list(F.when(val, F.struct("date", "day", "y", "is_holiday", "year_ago"))).alias("rows"))
    g = g.filter((F.col("observed") >= min_train) & (F.size("rows") > 0))
    failed = F.when(F.col("pairs") <= 3, F.lit("too few observations for AR order"))
    e = g.select(*ks, F.coalesce("slope", F.lit(0.0)).alias("phi"), F.coalesce("intercept", "mean_z").alias("c"), "last_level", "last_z", "last_day",
                 failed.alias("failed"), F.explode("rows").alias("v"))
    return _ar1_forecasts(e, ks, seasonal, s)


def _ar1_forecasts(e: DataFrame, keys: list[str], seasonal: bool, s: int) -> DataFrame:
    """From one row per validation row with its fold's fit: the running sum of forecast differences on the last level."""
    e = e.withColumn("k", ((F.col("v.day") - F.col("last_day")) / 7).cast("int"))

    def step(acc, _):
        z = F.col("c") + F.col("phi") * acc["z"]
        return F.struct(z.alias("z"), (acc["sum"] + z).alias("sum"))

    run = F.aggregate(F.sequence(F.lit(1), F.col("k")), F.struct(F.col("last_z").alias("z"), F.lit(0.0).alias("sum")), step, lambda a: a["sum"])
    level = F.col("last_level") + run
    error = F.coalesce("failed", F.when(F.lit(bool(seasonal)) & (F.col("k") > s), F.lit("more than one season ahead")))
    return e.select(*keys, "v.date", "v.y", "v.is_holiday",
                    F.when(error.isNull(), level + F.col("v.year_ago") if seasonal else level).alias("y_pred"), error.alias("error"))


def order_grid(df: DataFrame, max_p: int = 3, target: str = "weekly_sales", keys=S.KEYS) -> DataFrame:
    """AIC for every (p <= max_p, d in {0, 1}) per series, in column functions.

    The cross-products of a difference order are swept once through all p, on
    the rows that have ``max_p`` lags. An order that cannot be fitted has a NULL
    AIC and an ``error``.
    """
    w = Window.partitionBy(*keys).orderBy("date")
    ys = [F.col(target).cast("double")] + [F.lag(target, k).over(w).cast("double") for k in range(1, max_p + 2)]
    y = df.select(*keys, *[c.alias(f"y{k}") for k, c in enumerate(ys)])
    level = [F.col(f"y{k}") for k in range(max_p + 1)]
    change = [F.col(f"y{k}") - F.col(f"y{k + 1}") for k in range(max_p + 1)]
    values = [[F.lit(1.0), *z[1:], z[0]] for z in (level, change)]
    sums = y.groupBy(*keys).agg(*[LA.gram(v).alias(f"g{d}") for d, v in enumerate(values)])
    g = sums.select(*keys, F.posexplode(F.array("g0", "g1")).alias("d", "g"))
    last = max_p + 1

    def step(acc, k):
        m = LA.swept(acc["m"], k, acc["d"])
        return F.struct(m.alias("m"), acc["d"].alias("d"), F.concat(acc["rss"], F.array(m[last][last])).alias("rss"))

    start = F.struct(F.col("g").alias("m"), LA.diagonal_of(F.col("g")).alias("d"), F.array().cast("array<double>").alias("rss"))
    rss = F.aggregate(F.sequence(F.lit(0), F.lit(max_p)), start, step, lambda acc: acc["rss"])
    n = F.coalesce(F.col("g")[0][0], F.lit(0.0))
    e = g.select(*keys, "d", n.alias("n"), F.posexplode_outer(rss).alias("p", "ssr"))
    few = F.col("n") <= F.col("p") + 2
    aic = F.col("n") * F.ln(F.greatest("ssr", F.lit(1e-300)) / F.col("n")) + 2 * (F.col("p") + 1)
    error = F.when(few, F.lit("too few observations for AR order")).when(F.col("ssr").isNull(), F.lit("no unique fit"))
    return e.select(*keys, "p", "d", F.when(error.isNull(), aic).alias("aic"), error.alias("error"))


def choose_order(grid: DataFrame, df_test: DataFrame | None = None, keys=S.KEYS) -> DataFrame:
    """Pick d from the unit-root test when given (stationary -> 0), then p by AIC.

    Every series of the grid stays: one without a fit at its d has NULL p, d and AIC and an ``error``.
    """
    fitted = F.col("aic").isNotNull()
    wanted = F.lit(True)
    if df_test is not None:
        grid = grid.join(df_test.select(*keys, F.when(F.col("stationary_5pct"), 0).otherwise(1).alias("_d")), keys, "left")
        wanted = F.col("d") == F.col("_d")
    use = fitted & wanted
    best = F.min(F.when(use, F.struct("aic", "p", "d")))
    out = grid.groupBy(*keys).agg(best.alias("o"), F.min_by("error", F.when(F.coalesce(wanted, F.lit(True)), F.col("p"))).alias("e"))
    return out.select(*keys, "o.p", "o.d", "o.aic", F.when(F.col("o").isNull(), F.coalesce("e", F.lit("no unit-root test"))).alias("error"))


# ---- moving-average terms ------------------------------------------------------

#: Lags of the first stage.
LONG_AR = (1, 2, 3, 4)


def _differenced(df: DataFrame, target: str, keys, s: int, seasonal: bool, lags: list[int], year_ago: bool = False) -> DataFrame:
    """Each series' weekly rows with the level that is summed up again (its seasonal difference), its first difference z0
    and z's lags. Differences look back only, so they are taken once per series, before folds."""
    w = Window.partitionBy(*keys).orderBy("date")
    before = F.lag(target, s).over(w)
    level = (F.col(target) - before if seasonal else F.col(target)).cast("double")
    f = df.select(*keys, "date", F.col(target).alias("y"), "is_holiday", "is_filled", level.alias("level"), *([before.alias("year_ago")] if year_ago else []))
    f = f.withColumn("z0", F.col("level") - F.lag("level").over(w))
    return f.select("*", *[F.lag("z0", k).over(w).alias(f"z{k}") for k in lags])


def arma_fits(dense: DataFrame, folds: DataFrame, seasonal: bool = True, s: int = 52, long_ar: tuple[int, ...] = LONG_AR, min_rows: int = 30,
              target: str = "weekly_sales", keys=S.KEYS) -> DataFrame:
    """Order (1, 1, 1)(0, 1, 1, s), or (1, 1, 1) without ``seasonal``, per (series, fold) by two-stage regression.

    Stage one regresses the difference z on its lags ``long_ar``; its residuals are
    the innovations e. (With ``s`` among these lags they come closer to the true
    ones and the seasonal term to its true size, for ``s`` rows less.) Stage two regresses z on a constant, z's lag, e's lag and,
    if seasonal, e's lag ``s``. An innovation is a linear map of lags of z, so
    both stages come from one array of cross-products per (series, fold), and
    stage two's is a quadratic form of it. No row is read twice.

    ``dense`` has weekly rows without gaps (``is_filled`` marks filled ones). Columns: keys, fold, val_start, val_end, n, phi, theta,
    seasonal_theta, intercept, long (stage one: constant and lags) and error.
    """
    back = [1, s] if seasonal else [1]
    lags = sorted({*long_ar, *back, *[at + k for at in back for k in long_ar]})
    z = _differenced(dense, target, keys, s, seasonal, lags)
    names = ["one", "z0", *[f"z{k}" for k in lags]]
    at = {n: i for i, n in enumerate(names)}
    j = z.join(folds.select(*keys, "fold", "val_start", "val_end"), keys).filter(F.col("date") < F.col("val_start"))
    values = [F.lit(1.0), *[F.col(n) for n in names[1:]]]
    g = j.groupBy(*keys, "fold", "val_start", "val_end").agg(LA.gram(values).alias("g"))

    first = [at["one"], *[at[f"z{k}"] for k in long_ar], at["z0"]]
    order = len(long_ar)
    g1 = F.array(*[F.array(*[F.col("g")[a][b] for b in first]) for a in first])
    m1 = LA.regressed(F.col("g1"), order + 1)
    long_coefs = F.array(*[F.col("m1")[i][order + 1] for i in range(order + 1)])

    def innovation(lag: int) -> Column:
        """e at a lag as a row map of the values: z's lag less the constant and the coefficients of the lags behind it."""
        row = [F.lit(0.0)] * len(names)
        row[at["one"]] = -F.col("long")[0]
        row[at[f"z{lag}"]] = F.lit(1.0)
        for i, k in enumerate(long_ar, 1):
            row[at[f"z{lag + k}"]] = -F.col("long")[i]
        return F.array(*row)

    def unit(name: str) -> Column:
        return F.array(*[F.lit(float(n == name)) for n in names])

    maps = [unit("one"), unit("z1"), innovation(1), *([innovation(s)] if seasonal else []), unit("z0")]
    size = len(maps) - 1
    n = F.coalesce(F.col("g")[0][0], F.lit(0.0))
    head = [*keys, "fold", "val_start", "val_end", "n"]
    f = g.select("*", n.cast("long").alias("n"), g1.alias("g1")).select(*head, "g", m1.alias("m1")).select(*head, "g", long_coefs.alias("long"))
    f = f.select(*head, "g", "long", F.array(*maps).alias("maps")).select(*head, "long", LA.quadratic(F.col("maps"), F.col("g")).alias("g2"))
    f = f.select(*head, "long", LA.regressed(F.col("g2"), size).alias("m2"))
    coef = [F.col("m2")[i][size] for i in range(size)]
    f = f.select(*head, "long", coef[0].alias("intercept"), coef[1].alias("phi"), coef[2].alias("theta"),
                 (coef[3] if seasonal else F.lit(0.0)).alias("seasonal_theta"))
    error = F.when(F.col("n") < min_rows, F.lit("too few observations for the two-stage fit")).when(
        F.col("intercept").isNull() | F.col("phi").isNull() | F.col("theta").isNull() | F.col("seasonal_theta").isNull(), F.lit("no unique fit"))
    keep = lambda c: F.when(F.col("error").isNull(), F.col(c)).alias(c)
    return f.withColumn("error", error).select(*head, keep("intercept"), keep("phi"), keep("theta"), keep("seasonal_theta"), keep("long"), "error")


def evaluate_arma(dense: DataFrame, folds: DataFrame, seasonal: bool = True, s: int = 52, long_ar: tuple[int, ...] = LONG_AR, min_rows: int = 30,
                  target: str = "weekly_sales", keys=S.KEYS) -> DataFrame:
    """K20 + K25: forecasts of the observed validation rows of every (series, fold) by ``arma_fits``; schema as ``evaluate_ar``.

    A fold's last ``s`` innovations come from its last rows, in one bounded
    array; the forecast is an ``aggregate`` over at most ``s`` steps. A fold
    without a fit, and a row over ``s`` steps ahead, has a NULL prediction and
    an ``error``.
    """
    fits = arma_fits(dense, folds, seasonal, s, long_ar, min_rows, target, keys)
    z = _differenced(dense, target, keys, s, seasonal, list(long_ar)).withColumn("day", F.unix_date("date"))
    ks = [*keys, "fold"]
    j = z.join(fits, keys).filter(F.col("date") <= F.col("val_end"))
    j = j.withColumn("last", F.unix_date("val_start"))
    train = F.col("date") < F.col("val_start")
    e = F.col("z0") - F.col("long")[0]
    for i, k in enumerate(long_ar, 1):
        e = e - F.col("long")[i] * F.col(f"z{k}")
    recent = train & (F.col("day") >= F.col("last") - 7 * (s + 1))
    head = ["intercept", "phi", "theta", "seasonal_theta", "error"]
    g = j.groupBy(*ks).agg(
        *[F.first(c).alias(c) for c in head],
        F.max_by(F.when(train, F.col("level")), F.when(train, F.col("day"))).alias("last_level"),
        F.max_by(F.when(train, F.col("z0")), F.when(train, F.col("day"))).alias("last_z"),
        F.max(F.when(train, F.col("day"))).alias("last_day"),
        # days -> innovation and level of the last season
        F.map_from_entries(F.collect_list(F.when(recent, F.struct("day", F.struct(e.alias("e"), "y"))))).alias("past"),
        F.collect_list(F.when(~train & ~F.col("is_filled"), F.struct("date", "day", "y", "is_holiday"))).alias("rows"))
    far = g.select(*ks, *head, "last_level", "last_z", "last_day", "past", F.explode("rows").alias("v"))
    far = far.withColumn("k", ((F.col("v.day") - F.col("last_day")) / 7).cast("int"))

    def shock(day):
        return F.coalesce(F.try_element_at("past", day)["e"], F.lit(0.0))  # a day without one counts as none

    def step(acc, i):
        before = F.when(i == 1, shock(F.col("last_day"))).otherwise(0.0)
        season = F.when(i <= s, shock(F.col("last_day") + 7 * (i - s))).otherwise(0.0)
        nxt = F.col("intercept") + F.col("phi") * acc["z"] + F.col("theta") * before + F.col("seasonal_theta") * season
        return F.struct(nxt.alias("z"), (acc["sum"] + nxt).alias("sum"))

    run = F.aggregate(F.sequence(F.lit(1), F.col("k")), F.struct(F.col("last_z").alias("z"), F.lit(0.0).alias("sum")), step, lambda a: a["sum"])
    level = F.col("last_level") + run
    if seasonal:
        level = level + F.try_element_at("past", F.col("v.day") - 7 * s)["y"]
    error = F.coalesce("error", F.when(F.col("k") > s, F.lit("more than one season ahead")) if seasonal else F.lit(None).cast("string"))
    return far.select(*ks, "v.date", "v.y", "v.is_holiday", F.when(error.isNull(), level).alias("y_pred"), error.alias("error"))
