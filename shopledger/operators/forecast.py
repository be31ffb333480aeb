"""Regression and seasonal forecasts of daily sales series.

Linear models come from mergeable centred moments: Spark computes counts, means and co-moments per key (combined before
the shuffle, and exact for values far from zero), and the systems of a batch of keys are solved together.

The seasonal model and the stationarity test need a series in its order. A series is one row per day and key, so its
length is bounded by the calendar: it is packed into one row per key, once, and a batch of series is worked on as one
matrix, day by day for all of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.functions.clock import date_parts

BASE_YEAR = 1995
# Order (1,1,1) x (1,1,1) with season 12.
SEASON = 12
TERMS = (1, SEASON, SEASON + 1)
LONG_AR = 2 * SEASON + 2
#: Dampings of the first moving average, shares of each refinement, and the bound of innovations that grow without end.
DAMPED, SHARES, CLIP = (1.0, 0.98, 0.95, 0.9, 0.8, 0.5), (0.0, 1.0, 0.5, 0.25, 0.125), 1e100
#: Refinements of the seasonal model, days it needs at least, and the normal quantile of its bounds (fixed value).
STEPS, SHORTEST, NORMAL_95 = 3, 2 * SEASON + 2, 1.959963984540054
DATE = "out_date"


# -- normal equations --------------------------------------------------------


def ols_features(date: str = DATE, base_year: int = BASE_YEAR) -> dict[str, Column]:
    """Intercept, year (from a base year), month, day and weekday."""
    parts = date_parts(date)
    one = {"one": F.lit(1)}
    return one | {"year": parts["year"] - base_year, **{k: parts[k] for k in ("month", "day", "weekday")}}


def cross_sums(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """Sums of all pairwise products of the columns per key, as ``<a>_<b>`` columns.

    Rows with a null in any column are left out.
    """
    names = list(columns)
    rows = df.select(*keys, *[c.cast("double").alias(n) for n, c in columns.items()]).dropna(subset=names)
    sums = [
        F.sum(F.col(a) * F.col(b)).alias(f"{a}_{b}") for i, a in enumerate(names) for b in names[i:]
    ]
    return rows.groupBy(*keys).agg(*sums)


def moments(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """Count ``n``, means and co-moments (sums of products of deviations, upper triangle) of the columns per key.

    They merge across tasks without the loss of digits that sums of squares have. Rows with a null in any column are
    left out.
    """
    names = list(columns)
    rows = df.select(*keys, *[c.cast("double").alias(n) for n, c in columns.items()]).dropna(subset=names)
    pairs = [F.covar_pop(a, b) * F.count(F.lit(1)) for i, a in enumerate(names) for b in names[i:]]
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in names]).alias("mean"), F.array(*pairs).alias("co")
    )


def sweep(m: np.ndarray, k: int, scale: np.ndarray) -> None:
    """Sweep a stack of symmetric matrices on variable k, in place.

    After all predictors are swept, their entries with the target are the coefficients, those among themselves the
    inverse with its sign turned, and the target's own is the squared error. A variable that others explain (what is
    left of it is nothing beside ``scale``) stays out with coefficient 0.
    """
    pivot = m[:, k, k].copy()
    usable = pivot > 1e-11 * scale[:, k]
    inverse = np.where(usable, 1 / np.where(usable, pivot, 1), 0)
    column, row = m[:, :, k].copy(), m[:, k, :].copy()
    m -= column[:, :, None] * row[:, None, :] * inverse[:, None, None]
    m[:, :, k], m[:, k, :] = column * inverse[:, None], row * inverse[:, None]
    m[:, k, k] = -inverse


def swept(m: np.ndarray, predictors: int) -> np.ndarray:
    """The stack swept on its first variables."""
    m = m.copy()
    scale = np.diagonal(m, axis1=1, axis2=2).copy()
    for k in range(predictors):
        sweep(m, k, scale)
    return m


def _key_fields(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    return [df.schema[k] for k in keys]


def solve_regression(sums: DataFrame, keys: Sequence[str], features: Sequence[str], target: str) -> DataFrame:
    """Intercept and slopes, their standard errors and the squared error per row of ``moments`` over features and target."""
    keys, p = list(keys), len(features)
    array = T.ArrayType(T.DoubleType())
    schema = T.StructType(
        _key_fields(sums, keys)
        + [T.StructField("coef", array), T.StructField("stderr", array), T.StructField("sse", T.DoubleType())]
    )
    upper = np.triu_indices(p + 1)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch["n"] > 0]
            if batch.empty:
                continue
            n, mean = batch["n"].to_numpy(float), np.stack(batch["mean"].to_list())
            m = np.zeros((len(batch), p + 1, p + 1))
            m[:, upper[0], upper[1]] = m[:, upper[1], upper[0]] = np.stack(batch["co"].to_list())
            m = swept(m, p)
            slopes, inverse, sse = m[:, :p, p], -m[:, :p, :p], np.maximum(m[:, p, p], 0)
            at_mean = (inverse @ mean[:, :p, None])[..., 0]
            spread = np.column_stack([1 / n + (mean[:, :p] * at_mean).sum(axis=1), np.diagonal(inverse, axis1=1, axis2=2)])
            free = n - p - 1
            variance = np.where(free > 0, sse / np.where(free > 0, free, 1), np.nan)
            coef = np.column_stack([mean[:, p] - (slopes * mean[:, :p]).sum(axis=1), slopes])
            yield batch[keys].assign(coef=coef.tolist(), stderr=np.sqrt(spread * variance[:, None]).tolist(), sse=sse)

    return sums.mapInPandas(solve, schema)


# -- linear model ------------------------------------------------------------


def ols_gram(series: DataFrame, keys: Sequence[str] = (), target: str = "total_sales") -> DataFrame:
    return cross_sums(series, keys, ols_features() | {"y": F.col(target)})


def fit_ols(series: DataFrame, keys: Sequence[str] = (), target: str = "total_sales") -> DataFrame:
    """One linear model on the calendar features per key (or one in all), the intercept first."""
    features = {n: x for n, x in ols_features().items() if n != "one"}
    return solve_regression(moments(series, keys, features | {"y": F.col(target)}), keys, list(features), "y")


def score_ols(frame: DataFrame, model: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add the model's prediction to every row of a frame with dates."""
    if keys:
        joined = frame.join(model.select(*keys, "coef"), list(keys), "left")
    else:
        joined = frame.withColumn("coef", model.select("coef").scalar())
    predicted = F.lit(0.0)
    for i, x in enumerate(ols_features().values()):
        predicted = predicted + F.get("coef", F.lit(i)) * x
    return joined.withColumn("prediction", predicted).drop("coef")


def future_dates(
    history: DataFrame, months: int = 13, step: str = "month", date: str = DATE, keys: DataFrame | None = None
) -> DataFrame:
    """Dates after the last one of the history: month starts or days, with their features.

    With ``keys`` every key row gets all of these dates.
    """
    last = history.agg(F.max(F.to_date(date)).alias("last"))
    rows, day = (last, F.col("last")) if keys is None else (keys, last.scalar())
    end = F.add_months(day, months)
    if step == "month":
        dates = F.sequence(F.trunc(F.add_months(day, 1), "MM"), end, F.make_ym_interval(months=F.lit(1)))
    else:
        dates = F.sequence(F.date_add(day, 1), end, F.make_dt_interval(days=F.lit(1)))
    named = [] if keys is None else keys.columns
    return rows.select(*named, F.explode(dates).alias(date)).withColumns(date_parts(date))


def feature_balance(frame: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sums of a value times each feature per key, in millions.

    A least-squares fit is the one whose predictions have the balance of the
    observed values, so comparing both checks a fit without solving it again.
    """
    sums = [F.sum(F.col(value) * x / 1e6).alias(f"balance_{n}") for n, x in ols_features().items()]
    return frame.groupBy(*keys).agg(*sums)


# -- seasonal model ----------------------------------------------------------


def _lags(df: DataFrame, keys: Sequence[str], column: str, lags: Sequence[int]) -> dict[str, Column]:
    order = Window.partitionBy(*keys).orderBy(DATE)
    return {f"{column}{k}": F.lag(column, k).over(order) for k in lags}


def seasonal_difference(series: DataFrame, keys: Sequence[str], target: str = "total_sales") -> DataFrame:
    """``w``: the series differenced once at lag 1 and once at the season."""
    named = series.withColumn("y", F.col(target).cast("double"))
    lagged = named.withColumns(_lags(named, keys, "y", TERMS))
    w = F.col("y") - F.col("y1") - F.col(f"y{SEASON}") + F.col(f"y{SEASON + 1}")
    return lagged.select(*keys, DATE, "y", w.alias("w"))


def packed(series: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """One row per key: the values in the order of their days as ``y``, and the ``last`` day. Days without a value are left out."""
    points = F.array_sort(F.collect_list(F.when(F.col(target).isNotNull(), F.struct(F.to_date(DATE).alias("d"), F.col(target).cast("double").alias("y")))))
    return series.groupBy(*keys).agg(points.alias("points")).select(
        *keys, F.transform("points", lambda p: p["y"]).alias("y"), F.try_element_at("points", F.lit(-1))["d"].alias("last")
    )


def _stacked(values: Sequence) -> tuple[np.ndarray, np.ndarray]:
    """Series of a batch side by side, all ending in the last column, and their lengths; zeros come before them."""
    size = np.array([len(v) for v in values])
    out = np.zeros((len(values), int(size.max(initial=0))))
    for row, v in zip(out, values):
        row[len(row) - len(v):] = v
    return out, size


def _back(x: np.ndarray, lag: int) -> np.ndarray:
    """The series ``lag`` days earlier; zero before its start."""
    out = np.zeros_like(x)
    out[:, lag:] = x[:, : max(0, x.shape[1] - lag)]
    return out


def _regressed(features: list[np.ndarray], target: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Coefficients without an intercept of each series, over its valid days."""
    x = np.stack([*features, target]) * valid
    return swept(np.einsum("ibt,jbt->bij", x, x), len(features))[:, :-1, -1]


def _filtered(x: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """x less theta times what this filter gave at the lags of the model, day by day for all series at once."""
    out = np.zeros((x.shape[1] + TERMS[-1], len(x)))
    lags = np.array(TERMS)
    for t, now in enumerate(np.ascontiguousarray(x.T), start=TERMS[-1]):
        out[t] = np.clip(now - (theta.T * out[t - lags]).sum(axis=0), -CLIP, CLIP)
    return out[TERMS[-1]:].T


def innovations(w: np.ndarray, coef: np.ndarray) -> np.ndarray:
    """One-day-ahead errors of the model, with nothing known before the start."""
    p = len(TERMS)
    explained = sum(coef[:, [j]] * _back(w, k) for j, k in enumerate(TERMS))
    return _filtered(w - explained, coef[:, p:])


def _least(w: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of several coefficients per series those whose innovations have the least squares, with the sum and the innovations."""
    c, b, p = candidates.shape
    e = innovations(np.tile(w, (c, 1)), candidates.reshape(c * b, p)).reshape(c, b, -1)
    total = (e * e).sum(axis=2)
    best, every = total.argmin(axis=0), np.arange(b)
    return candidates[best, every], total[best, every], e[best, every]


def fit_seasonal(y: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(coefficients, variance of the innovations, w, innovations) of a batch of series, see ``sarima_fit``."""
    place = np.arange(y.shape[1])[None, :] - (y.shape[1] - size)[:, None]  # day of each series, from 0
    usable = place >= SEASON + 1
    w = np.where(usable, y - _back(y, 1) - _back(y, SEASON) + _back(y, SEASON + 1), 0)
    covariance = np.stack([(w * _back(w, k)).sum(axis=1) for k in range(LONG_AR + 1)], axis=1)
    lag = np.abs(np.subtract.outer(np.arange(LONG_AR), np.arange(LONG_AR)))
    system = np.zeros((len(y), LONG_AR + 1, LONG_AR + 1))
    system[:, :-1, :-1] = covariance[:, lag]
    system[:, :-1, -1] = system[:, -1, :-1] = covariance[:, 1:]
    system[:, -1, -1] = covariance[:, 0]
    phi = swept(system, LONG_AR)[:, :-1, -1]
    rough = w - sum(phi[:, [k - 1]] * _back(w, k) for k in range(1, LONG_AR + 1))
    rough = np.where(place >= SEASON + 1 + LONG_AR, rough, 0)
    valid = place >= SEASON + 1 + LONG_AR + TERMS[-1]
    coef = _regressed([*(_back(w, k) for k in TERMS), *(_back(rough, k) for k in TERMS)], w, valid)
    # a moving average that can't be inverted is damped towards one that can
    powers = np.array(DAMPED)[:, None, None] ** np.array([0] * len(TERMS) + list(TERMS))
    best, least, e = _least(w, coef * powers)
    for _ in range(STEPS):
        filtered, further = _filtered(w, best[:, len(TERMS):]), _filtered(e, best[:, len(TERMS):])
        slopes = [*(_back(filtered, k) for k in TERMS), *(_back(further, k) for k in TERMS)]
        best, least, e = _least(w, best + np.array(SHARES)[:, None, None] * _regressed(slopes, e, usable))
    free = size - (SEASON + 1) - 2 * len(TERMS)
    return best, np.where(free > 0, least / np.where(free > 0, free, 1), np.nan), w, e


def _fitted(batch: pd.DataFrame) -> tuple[pd.DataFrame, list]:
    """The rows of a batch whose series are long enough for the model, and their fit."""
    long_ = batch[batch["y"].map(len) >= SHORTEST]
    y, size = _stacked(long_["y"].to_list())
    return long_, [y, *fit_seasonal(y, size)]


def sarima_fit(series: DataFrame, keys: Sequence[str], target: str = "total_sales") -> DataFrame:
    """Coefficients of the lags 1, 12 and 13 of ``w`` and of its innovations per key, the innovations' variance ``sigma2``
    and the number of days ``n``.

    Three stages (Hannan, Rissanen and Kavalieris): a long autoregression gives rough innovations, a regression on them
    first coefficients; then the innovations are computed by their own recursion and the coefficients refined by
    regressing them on their derivatives, ``STEPS`` times. Each time several shares of the change are tried (at first,
    several dampings of the moving average), and the coefficients with the least squares of the innovations are kept.
    Series too short for the first stage are left out.
    """
    keys = list(keys)
    schema = T.StructType(_key_fields(series, keys) + [
        T.StructField("coef", T.ArrayType(T.DoubleType())), T.StructField("sigma2", T.DoubleType()), T.StructField("n", T.LongType())])

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, (_, coef, variance, *_) = _fitted(batch)
            if len(rows):
                yield rows[keys].assign(coef=coef.tolist(), sigma2=variance, n=rows["y"].map(len))

    return packed(series, keys, target).mapInPandas(fit, schema)


def _paths(y: np.ndarray, w: np.ndarray, e: np.ndarray, coef: np.ndarray, horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """Forecasts of a batch, and the sums of squares that make their variances out of the innovations' variance."""
    p, far = len(TERMS), TERMS[-1]
    tails = [np.pad(x, ((0, 0), (max(0, far - x.shape[1]), 0)))[:, -far:].T for x in (y, w, e)]
    y, w, e = (np.concatenate([x, np.zeros((horizon, x.shape[1]))]) for x in tails)
    psi, effect = np.zeros((2, horizon + far, y.shape[1]))
    lags = np.array(TERMS)
    for t in range(far, far + horizon):
        w[t] = (coef[:, :p].T * w[t - lags]).sum(axis=0) + (coef[:, p:].T * e[t - lags]).sum(axis=0)
        y[t] = w[t] + y[t - 1] + y[t - SEASON] - y[t - SEASON - 1]
        # effect of an innovation h days later on w, and on y
        h = t - far
        own = sum(coef[:, p + j] for j, k in enumerate(TERMS) if k == h) if h else np.ones(y.shape[1])
        psi[t] = (coef[:, :p].T * psi[t - lags]).sum(axis=0) + own
        effect[t] = psi[t] + effect[t - 1] + effect[t - SEASON] - effect[t - SEASON - 1]
    return y[far:].T, np.cumsum(effect[far:] ** 2, axis=0).T


def sarima_forecast(
    series: DataFrame, keys: Sequence[str], horizon: int, target: str = "total_sales"
) -> DataFrame:
    """Forecast of the next ``horizon`` days per key, with the bounds (``low``, ``high``) that hold 95 % of the outcomes.

    A series too short for the model stays as one row without date and
    prediction, with the reason.
    """
    keys = list(keys)
    array = T.ArrayType(T.DoubleType())
    schema = T.StructType([*_key_fields(series, keys), T.StructField("last", T.DateType()),
                           T.StructField("path", array), T.StructField("margin", array)])

    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, (y, coef, variance, w, e) = _fitted(batch)
            if len(rows):
                path, squares = _paths(y, w, e, coef, horizon)
                margin = NORMAL_95 * np.sqrt(variance[:, None] * squares)
                yield rows[[*keys, "last"]].assign(path=path.tolist(), margin=margin.tolist())
            short = batch.drop(rows.index)
            if len(short):
                yield short[[*keys, "last"]].assign(path=None, margin=None)

    paths = packed(series, keys, target).mapInPandas(extend, schema)
    reason = F.when(F.col("path").isNull(), "series too short").alias("reason")
    steps = paths.select(*keys, "last", "margin", reason, F.posexplode_outer("path").alias("step", "prediction"))
    margin = F.get("margin", F.col("step"))
    return steps.select(
        *keys, F.date_add("last", F.col("step") + 1).alias(DATE), "prediction",
        (F.col("prediction") - margin).alias("low"), (F.col("prediction") + margin).alias("high"), "reason",
    )


# -- stationarity ------------------------------------------------------------

# Published response surface of the test with a constant, one series,
# critical value = b0 + b1/n + b2/n^2 + b3/n^3.
ADF_CRITICAL = {
    "crit_1": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5": (-2.86154, -2.8903, -4.234, -40.04),
    "crit_10": (-2.56677, -1.5384, -2.809, 0.0),
}
# Published p-value polynomials of the same test, left and right of the split.
ADF_P_SPLIT, ADF_P_RANGE = -1.61, (-18.83, 2.74)
ADF_P_LEFT = (2.1659, 1.4412, 0.038269)
ADF_P_RIGHT = (1.7339, 0.93202, -0.12745, -0.010368)


def adf_p_value(stat: float) -> float:
    low, high = ADF_P_RANGE
    if stat <= low:
        return 0.0
    if stat >= high:
        return 1.0
    terms = ADF_P_LEFT if stat <= ADF_P_SPLIT else ADF_P_RIGHT
    z = sum(c * stat**i for i, c in enumerate(terms))
    return 0.5 * (1 + math.erf(z / math.sqrt(2)))


def adf_statistic(
    series: DataFrame, keys: Sequence[str], target: str = "total_sales", max_lag: int = 12
) -> DataFrame:
    """Augmented Dickey-Fuller statistic per key, with its critical values and p-value.

    The number of lagged differences (0 to ``max_lag``) is the one with the least AIC. All candidates are steps of one
    sweep over the lags: after each, what is left of the level, the difference and their product gives the candidate.
    """
    keys = list(keys)
    schema = T.StructType(
        _key_fields(series, keys)
        + [T.StructField("n_obs", T.LongType()), T.StructField("used_lag", T.IntegerType())]
        + [T.StructField(c, T.DoubleType()) for c in ("statistic", "p_value", *ADF_CRITICAL)]
    )

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            y, size = _stacked(batch["y"].to_list())
            n = np.maximum(size - max_lag - 1, 0)
            valid = np.arange(y.shape[1])[None, :] >= (y.shape[1] - n)[:, None]
            d = y - _back(y, 1)
            x = np.stack([*(_back(d, k) for k in range(1, max_lag + 1)), _back(y, 1), d])
            x = (x - (x * valid).sum(axis=2, keepdims=True) / np.maximum(n, 1)[None, :, None]) * valid
            m = np.einsum("ibt,jbt->bij", x, x)
            scale = np.diagonal(m, axis1=1, axis2=2).copy()
            least, lag, found = np.full(len(y), np.inf), np.full(len(y), -1), np.full(len(y), np.nan)
            for k in range(max_lag + 1):
                level, both, change = m[:, -2, -2], m[:, -2, -1], m[:, -1, -1]
                usable = (n > k + 2) & (level > 1e-11 * scale[:, -2])
                level_, free = np.where(usable, level, 1), np.where(usable, n - k - 2, 1)
                sse = np.maximum(change - both**2 / level_, 1e-13 * scale[:, -1])  # a perfect fit is one up to rounding
                usable &= sse > 0
                sse = np.where(usable, sse, 1)
                aic = np.where(usable, n * np.log(sse / np.maximum(n, 1)) + 2 * (k + 2), np.inf)
                better = aic < least
                statistic = both / level_ / np.sqrt(sse / free / level_)
                least, lag, found = (np.where(better, a, b) for a, b in ((aic, least), (k, lag), (statistic, found)))
                if k < max_lag:
                    sweep(m, k, scale)
            out = batch[keys].assign(
                n_obs=n, used_lag=[None if k < 0 else int(k) for k in lag], statistic=[None if v != v else v for v in found],
                p_value=[None if v != v else adf_p_value(v) for v in found],
            )
            for name, bs in ADF_CRITICAL.items():
                out[name] = [None if k < 0 else sum(b / c**i for i, b in enumerate(bs)) for k, c in zip(lag, n)]
            yield out

    return packed(series, keys, target).mapInPandas(solve, schema)


# -- evaluation --------------------------------------------------------------


def seasonal_naive(series: DataFrame, keys: Sequence[str], days: int = 365, target: str = "total_sales") -> DataFrame:
    """The value of the same key ``days`` earlier as prediction."""
    return series.select(*keys, F.date_add(DATE, days).alias(DATE), F.col(target).alias("prediction"))


def align(
    actual: DataFrame, predicted: DataFrame, keys: Sequence[str], target: str = "total_sales", extra: Sequence[str] = ()
) -> DataFrame:
    """Actual beside prediction on key and date; rows with either missing are dropped. ``extra``: more columns of the predictions."""
    on = [*keys, DATE]
    both = actual.select(*on, F.col(target).alias("actual")).join(predicted.select(*extra, *on, "prediction"), on)
    return both.dropna(subset=["actual", "prediction"])


def error_metrics(aligned: DataFrame, keys: Sequence[str] = (), expected: DataFrame | None = None) -> DataFrame:
    """Row count, mean squared and mean absolute error; no overlap at all is an error.

    ``expected`` holds the keys that have to overlap; one of them without any row is an error too.
    """
    gap = F.col("actual") - F.col("prediction")
    out = aligned.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(gap * gap).alias("mse"), F.avg(F.abs(gap)).alias("mae")
    )
    if keys and expected is not None:
        out = expected.select(*keys).distinct().join(out, list(keys), "left").fillna(0, ["n_rows"])
    empty = F.raise_error(F.lit("no overlapping data to evaluate"))
    return out.withColumn("n_rows", F.when(F.col("n_rows") > 0, F.col("n_rows")).otherwise(empty.cast("bigint")))


def rolling_origin(
    series: DataFrame, keys: Sequence[str], measures: Sequence[str], origins: Sequence[str], days: int,
    forecast: Callable[[DataFrame, DataFrame, str], DataFrame],
) -> DataFrame:
    """Errors per key, measure and origin of forecasts made again and again from all days before an origin.

    ``forecast(history, ahead, measure)`` gives the predictions for the keys and days of ``ahead`` (the ``days`` days
    from the origin on). A key with days ahead but no prediction is an error.
    """
    found = None
    for origin in origins:
        start = F.to_date(F.lit(origin))
        ahead = series.filter((F.col(DATE) >= start) & (F.col(DATE) < F.date_add(start, days)))
        for measure in measures:
            predicted = forecast(series.filter(F.col(DATE) < start), ahead.select(*keys, DATE), measure)
            errors = error_metrics(align(ahead, predicted, keys, measure), keys, ahead)
            errors = errors.select(*keys, F.lit(measure).alias("measure"), start.alias("origin"), "n_rows", "mse", "mae")
            found = errors if found is None else found.unionByName(errors)
    return found


def forecast_quality(predicted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Duplicate dates and missing predictions of a forecast, per key."""
    dates = predicted.groupBy(*keys, DATE).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction").isNull()).alias("n_null")
    )
    return dates.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_dates"),
        F.count_if(F.col("n") > 1).alias("duplicate_dates"),
        F.sum("n_null").alias("missing_predictions"),
    )


def actual_vs_forecast(
    actual: DataFrame, predicted: DataFrame, keys: Sequence[str], target: str = "total_sales"
) -> DataFrame:
    """Both series under one another, told apart by ``kind``."""
    on = [*keys, DATE]
    return actual.select(*on, F.col(target).alias("value"), F.lit("actual").alias("kind")).unionByName(
        predicted.select(*on, F.col("prediction").alias("value"), F.lit("forecast").alias("kind"))
    )
