"""Registered queries of the sales roll-ups and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.operators import forecast as fc
from shopledger.operators import sales as sa
from shopledger.plans.adapters import SPLIT_DATE, Inputs, ctes
from shopledger.plans.queries_clock import rounded

HORIZON = 30
#: First days that are forecast in turn from all days before them.
ORIGINS = ["1997-07-01", "1998-07-01", "1999-07-01"]


def dense(i: Inputs) -> DataFrame:
    # Days, categories and sums of the sales come from one small table, written once per query.
    return i.stored("dense", lambda: sa.dense_by_category(i.sales_daily))


def train(i: Inputs) -> DataFrame:
    return dense(i).filter(F.col("out_date") < F.lit(SPLIT_DATE))


def test(i: Inputs) -> DataFrame:
    return dense(i).filter(F.col("out_date") >= F.lit(SPLIT_DATE))


def naive(i: Inputs) -> DataFrame:
    return fc.seasonal_naive(dense(i), ["sales"])


def ols_gram(i: Inputs) -> DataFrame:
    sums = fc.ols_gram(train(i), ["sales"])
    # The squared target is of the order 1e13; it is reported in millions.
    return sums.select(
        "sales", *[F.round(F.col(c) / (1e6 if c == "y_y" else 1.0), 2).alias(c) for c in sums.columns if c != "sales"]
    )


def coefficients(model: DataFrame, *keys: str) -> DataFrame:
    """The fit of each key as columns, the squared error in millions."""
    return model.select(
        *keys, *[F.round(F.col("coef")[k], 3).alias(f"coef_{n}") for k, n in enumerate(fc.ols_features())],
        *[F.round(F.col("stderr")[k], 3).alias(f"stderr_{n}") for k, n in enumerate(fc.ols_features())],
        F.round(F.col("sse") / 1e6, 0).alias("sse_millions"),
    )


def seasonal_fit(i: Inputs) -> DataFrame:
    """Coefficients and innovation variance of the seasonal model per category."""
    names = [f"{kind}_{k}" for kind in ("ar", "ma") for k in fc.TERMS]
    return fc.sarima_fit(train(i), ["sales"]).select(
        "sales", "n", *[F.round(F.col("coef")[k], 5).alias(n) for k, n in enumerate(names)],
        F.round(F.col("sigma2") / 1e6, 2).alias("variance_millions"),
    )


def seasonal_forecast(i: Inputs) -> DataFrame:
    """The seasonal model of the train days on the first test days, by category."""
    return fc.sarima_forecast(train(i), ["sales"], HORIZON)


def model_forecasts(i: Inputs) -> DataFrame:
    """Predictions of both models, by category and model."""
    linear = fc.score_ols(test(i).select("sales", "out_date"), fc.fit_ols(train(i), ["sales"]), ["sales"])
    seasonal = seasonal_forecast(i).filter("reason is null")
    columns = ["sales", "out_date", "prediction"]
    return linear.select(F.lit("linear").alias("model"), *columns).unionByName(
        seasonal.select(F.lit("seasonal").alias("model"), *columns))


def rolling_errors(i: Inputs) -> DataFrame:
    """Errors of the linear model over three origins, for every measure."""
    series = i.stored("measures", lambda: sa.dense_by_category(i.sales_daily, sa.MEASURES))
    return fc.rolling_origin(
        series, ["sales"], sa.MEASURES, ORIGINS, 90,
        lambda history, ahead, measure: fc.score_ols(ahead, fc.fit_ols(history, ["sales"], measure), ["sales"]),
    )


def ols_forecast(i: Inputs) -> DataFrame:
    """The models per category on the test days and on the months after the last day."""
    model = fc.fit_ols(train(i), ["sales"])
    after = fc.future_dates(i.sales_daily, keys=i.sales_daily.select("sales").distinct())
    frame = test(i).select("sales", "out_date").unionByName(after.select("sales", "out_date"))
    return rounded(fc.score_ols(frame, model, ["sales"]), "prediction", digits=2)


def ols_balance(i: Inputs) -> DataFrame:
    rows = i.stored("train", lambda: train(i))
    fitted = fc.score_ols(rows, fc.fit_ols(rows, ["sales"]), ["sales"])
    return rounded(
        fc.feature_balance(fitted, ["sales"], "prediction"), *[f"balance_{n}" for n in fc.ols_features()], digits=3
    )


def actual_vs_forecast(i: Inputs) -> DataFrame:
    return rounded(fc.actual_vs_forecast(dense(i), naive(i), ["sales"]), "value", digits=2)


QUERIES = {
    "time_features": lambda i: sa.with_time_features(i.sales_daily.select("out_date", "product_id", "total_sales")),
    "sales_daily_total": lambda i: rounded(sa.daily_total(i.sales_daily), "total_sales", digits=2),
    "sales_dense": lambda i: rounded(dense(i), "total_sales", digits=2),
    "sales_measures_dense": lambda i: rounded(
        sa.dense_by_category(i.sales_daily, sa.MEASURES), *sa.MEASURES, digits=4
    ),
    "sales_year_weekday": lambda i: rounded(sa.by_year_weekday(i.sales_daily), "total_sales", digits=2),
    "sales_year_month": lambda i: rounded(sa.by_year_month(i.sales_daily), "total_sales", digits=2),
    "sales_category_month": lambda i: rounded(sa.by_category_month(i.sales_daily), "total_sales", digits=2),
    "sales_by_dimension": lambda i: rounded(sa.by_dimension(i.sales_daily), "total_millions", digits=6),
    "train_test_split": lambda i: rounded(sa.time_split(dense(i), SPLIT_DATE), "total_sales", digits=2),
    "year_split": lambda i: rounded(sa.year_split(dense(i), 1999), "total_sales", digits=2),
    "future_dates": lambda i: fc.future_dates(i.sales_daily),
    "seasonal_difference": lambda i: rounded(
        fc.seasonal_difference(dense(i), ["sales"]).select("sales", "out_date", "w"), "w", digits=2
    ),
    "ols_gram": ols_gram,
    "ols_total": lambda i: coefficients(fc.fit_ols(sa.daily_total(i.sales_daily).filter(F.col("out_date") < F.lit(SPLIT_DATE)))),
    "ols_by_category": lambda i: coefficients(fc.fit_ols(train(i), ["sales"]), "sales"),
    "ols_balance": ols_balance,
    "ols_forecast": ols_forecast,
    "sarima_fit": seasonal_fit,
    "sarima_by_series": lambda i: rounded(seasonal_forecast(i), "prediction", "low", "high", digits=0),
    "adf_statistic": lambda i: rounded(fc.adf_statistic(train(i), ["sales"]), "statistic", "p_value", *fc.ADF_CRITICAL, digits=5),
    "model_align": lambda i: rounded(fc.align(test(i), model_forecasts(i), ["sales"], extra=["model"]), "actual", "prediction", digits=0),
    "model_metrics": lambda i: rounded(
        fc.error_metrics(fc.align(test(i), model_forecasts(i), ["sales"], extra=["model"]), ["model", "sales"],
                         model_forecasts(i)).withColumns({"mse": F.col("mse") / 1e6, "mae": F.col("mae")}), "mse", "mae", digits=0),
    "model_quality": lambda i: fc.forecast_quality(model_forecasts(i), ["model", "sales"]),
    "model_vs_actual": lambda i: rounded(fc.actual_vs_forecast(
        dense(i).withColumn("model", F.lit("history")), model_forecasts(i), ["model", "sales"]), "value", digits=0),
    "rolling_errors": lambda i: rounded(rolling_errors(i).withColumn("mse", F.col("mse") / 1e6), "mse", "mae", digits=2),
    "forecast_align": lambda i: rounded(
        fc.align(test(i), naive(i), ["sales"]), "actual", "prediction", digits=2
    ),
    "forecast_metrics": lambda i: rounded(
        fc.error_metrics(fc.align(test(i), naive(i), ["sales"]), ["sales"]), "mse", "mae", digits=2
    ),
    "forecast_quality": lambda i: fc.forecast_quality(naive(i), ["sales"]),
    "actual_vs_forecast": actual_vs_forecast,
}

_DENSE = """daily AS (SELECT sales, CAST(out_date AS DATE) AS out_date, sum(out_count_total) AS out_count_total,
  sum(total_sales) AS total_sales, sum(total_sales_local_price) AS total_sales_local_price FROM sales_daily
  WHERE sales IS NOT NULL AND out_date IS NOT NULL GROUP BY 1,2),
dense AS (SELECT c.sales, d.out_date, coalesce(out_count_total, 0) AS out_count_total,
  coalesce(total_sales, 0) AS total_sales, coalesce(total_sales_local_price, 0) AS total_sales_local_price
  FROM (SELECT DISTINCT sales FROM daily) c CROSS JOIN (SELECT DISTINCT out_date FROM daily) d
  LEFT JOIN daily USING (sales, out_date))"""
_W = f"WITH {ctes('sales_daily')}"
_WD = f"{_W},\n{_DENSE}\n"
_SPLIT = "DATE '2000-01-01'"
_DAY = "CAST(out_date AS DATE)"
_NAMES = "['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']"
_PARTS = """CAST(year({0}) AS INT) AS year, CAST(month({0}) AS INT) AS month, CAST(day({0}) AS INT) AS day,
  CAST(isodow({0})-1 AS INT) AS weekday"""
_NAIVE = "naive AS (SELECT sales, CAST(out_date + INTERVAL 365 DAY AS DATE) AS out_date, total_sales AS prediction FROM dense)"
_ALIGNED = f"""{_WD}, {_NAIVE}, aligned AS (SELECT d.sales, d.out_date, d.total_sales AS actual, n.prediction
  FROM dense d JOIN naive n USING (sales, out_date) WHERE d.out_date >= {_SPLIT})"""
_X = {
    "one": "1", "year": "(year(out_date)-1995)", "month": "month(out_date)", "day": "day(out_date)",
    "weekday": "(isodow(out_date)-1)", "y": "total_sales",
}
_GRAM = ", ".join(
    f"round(CAST(sum({_X[a]}*{_X[b]}) AS DOUBLE){'/1e6' if a == b == 'y' else ''}, 2) AS {a}_{b}"
    for n, a in enumerate(_X) for b in list(_X)[n:]
)
_BALANCE = ", ".join(f"round(sum(total_sales*{x}/1e6), 3) AS balance_{n}" for n, x in _X.items() if n != "y")
_W_DIFF = "(PARTITION BY sales ORDER BY out_date)"


_FEATURES = ["year", "month", "day", "weekday"]


def _sweeps(source: str, out: str, steps: str, carried: str = "") -> str:
    """Sweeps the matrices ``m`` of a table on their first ``steps`` variables, one after the other."""
    return f"""{out}_steps AS (SELECT sales, 0 AS k, m{carried} FROM {source}
UNION ALL SELECT sales, k+1, list_transform(range(1, len(m)+1), lambda i: list_transform(range(1, len(m)+1), lambda j:
  CASE WHEN i=k+1 AND j=k+1 THEN -1/m[k+1][k+1] WHEN i=k+1 THEN m[i][j]/m[k+1][k+1] WHEN j=k+1 THEN m[i][j]/m[k+1][k+1]
  ELSE m[i][j]-m[i][k+1]*m[k+1][j]/m[k+1][k+1] END)){carried} FROM {out}_steps WHERE k < {steps}),
{out} AS (SELECT * FROM {out}_steps WHERE k = {steps})"""


def _co(names: list[str], centred: bool = True) -> str:
    """The matrix of co-moments (or of products) of columns, as an aggregate."""
    cell = "covar_pop({0}, {1})*count(*)" if centred else "sum({0}*{1})"
    return "[" + ", ".join("[" + ", ".join(cell.format(a, b) for b in names) + "]" for a in names) + "]"


def _ols(source: str, target: str = "total_sales", name: str = "fit") -> str:
    """The linear fit per ``sales`` of a table, by elimination: n, the coefficients (intercept first), their errors, sse."""
    x = ", ".join(f"CAST({_X[f]} AS DOUBLE) AS {f}" for f in _FEATURES)
    p = len(_FEATURES)
    at_mean = "+".join(f"mean[{a}]*mean[{b}]*-m[{a}][{b}]" for a in range(1, p + 1) for b in range(1, p + 1))
    return f"""{name}_x AS (SELECT sales, {x}, CAST({target} AS DOUBLE) AS y FROM {source}),
{name}_m AS (SELECT sales, count(*) AS n, [{', '.join(f'avg({f})' for f in [*_FEATURES, 'y'])}] AS mean, {_co([*_FEATURES, 'y'])} AS m
  FROM {name}_x GROUP BY sales),
{_sweeps(f'{name}_m', f'{name}_s', str(p), ', n, mean')},
{name} AS (SELECT sales, n, m[{p + 1}][{p + 1}] AS sse,
  [mean[{p + 1}]-{'-'.join(f'mean[{k}]*m[{k}][{p + 1}]' for k in range(1, p + 1))}, {', '.join(f'm[{k}][{p + 1}]' for k in range(1, p + 1))}] AS coef,
  [sqrt((1.0/n+{at_mean})*sse/(n-{p + 1})), {', '.join(f'sqrt(-m[{k}][{k}]*sse/(n-{p + 1}))' for k in range(1, p + 1))}] AS stderr FROM {name}_s)"""


_SCORE = "coef[1]+" + "+".join(f"coef[{k}]*{_X[f]}" for k, f in enumerate(_FEATURES, 2))
_FIT = ", ".join(f"round({kind}[{k}], 3) AS {kind}_{f}" for kind in ("coef", "stderr") for k, f in enumerate(["one", *_FEATURES], 1))
_TRAIN = f"train AS (SELECT * FROM dense WHERE out_date < {_SPLIT})"
_LAGS = fc.TERMS


def _lagged(column: str, lags, default: str = "") -> str:
    return ", ".join(f"lag({column}, {k}{default}) OVER w AS {column}{k}" for k in lags)


def _step(n: int) -> str:
    """Innovations of the candidates ``cand{n}`` (sales, j, c) and the best of them, ``best{n}``; from its derivatives the next."""
    zero = f"list_transform(range({_LAGS[-1]}), lambda i: 0.0::DOUBLE)"
    ar = "+".join(f"r.c[{j}]*r.w{k}" for j, k in enumerate(_LAGS, 1))
    ma = lambda s, c="c": "+".join(f"{c}[{j}]*{s}[{k}]" for j, k in enumerate(_LAGS, 4))
    clip = lambda x: f"greatest(least({x}, {fc.CLIP}), -{fc.CLIP})"
    names = [f"{x}{k}" for x in ("p", "q") for k in _LAGS]
    lists = ", ".join(f"{x}s[{k}] AS {x}{k}" for x in ("p", "q") for k in _LAGS)
    change = "[" + ", ".join(f"m[{j}][7]" for j in range(1, 7)) + "]"
    further = f"""m{n} AS (SELECT v.sales, {_co([*names, 'e'], False)} AS m FROM walk{n} v JOIN best{n} b ON b.sales=v.sales AND b.j=v.j WHERE t > 0 GROUP BY v.sales),
{_sweeps(f'm{n}', f's{n}', '6')},
cand{n + 1} AS (SELECT sales, share AS j, list_transform(range(1, 7), lambda i: c[i]+share*{change}[i]) AS c FROM s{n} JOIN best{n} USING (sales),
  (SELECT unnest({list(fc.SHARES)}::DOUBLE[]) AS share))"""
    return f"""rows{n} AS (SELECT d.*, j, c FROM lagged d JOIN cand{n} USING (sales)),
walk{n} AS (SELECT sales, j, 0 AS t, {zero} AS es, {zero} AS ps, {zero} AS qs, NULL::DOUBLE AS e, {', '.join(f'0.0::DOUBLE AS {x}' for x in names)} FROM cand{n}
UNION ALL SELECT sales, j, t, list_prepend(e, es[:12]), list_prepend({clip(f"w-({ma('ps')})")}, ps[:12]), list_prepend({clip(f"e-({ma('qs')})")}, qs[:12]), e, {', '.join(names)}
  FROM (SELECT r.sales, r.j, r.t, r.w, r.c, es, ps, qs, {clip(f"r.w-({ar})-({ma('es', 'r.c')})")} AS e, {lists}
    FROM walk{n} v JOIN rows{n} r ON r.sales=v.sales AND r.j=v.j AND r.t=v.t+1)),
total{n} AS (SELECT sales, j, sum(e*e) AS total FROM walk{n} WHERE t > 0 GROUP BY ALL),
best{n} AS (SELECT sales, j, c, total FROM cand{n} JOIN (SELECT sales, arg_min(j, total) AS j, min(total) AS total FROM total{n} GROUP BY sales) USING (sales, j))""" + (
        f",\n{further}" if n < fc.STEPS else "")


_FIRST = fc.SEASON + 1
_SARIMA = f"""{_TRAIN},
y AS (SELECT sales, out_date, total_sales AS y, row_number() OVER w AS day, total_sales-lag(total_sales, 1) OVER w-lag(total_sales, 12) OVER w
  +lag(total_sales, 13) OVER w AS w FROM train WINDOW w AS (PARTITION BY sales ORDER BY out_date)),
w AS (SELECT sales, day-{_FIRST} AS t, w, {_lagged('w', range(1, fc.LONG_AR + 1), ', 0')} FROM y WHERE day > {_FIRST} WINDOW w AS (PARTITION BY sales ORDER BY day)),
lagged AS (SELECT sales, t, w, {', '.join(f'w{k}' for k in _LAGS)} FROM w),
cov AS (SELECT sales, [{', '.join(['sum(w*w)', *(f'sum(w*w{k})' for k in range(1, fc.LONG_AR + 1))])}] AS g FROM w GROUP BY sales),
toep AS (SELECT sales, list_transform(range({fc.LONG_AR + 1}), lambda i: list_transform(range({fc.LONG_AR + 1}), lambda j:
  CASE WHEN i={fc.LONG_AR} AND j={fc.LONG_AR} THEN g[1] WHEN i={fc.LONG_AR} THEN g[j+2] WHEN j={fc.LONG_AR} THEN g[i+2] ELSE g[abs(i-j)+1] END)) AS m FROM cov),
{_sweeps('toep', 'long_ar', str(fc.LONG_AR))},
rough AS (SELECT sales, t, w, {', '.join(f'w{k}' for k in _LAGS)}, CASE WHEN t > {fc.LONG_AR} THEN w-({'+'.join(f'm[{k}][{fc.LONG_AR + 1}]*w{k}' for k in range(1, fc.LONG_AR + 1))})
  ELSE 0 END AS r FROM w JOIN long_ar USING (sales)),
second AS (SELECT *, {_lagged('r', _LAGS)} FROM rough WINDOW w AS (PARTITION BY sales ORDER BY t)),
second_m AS (SELECT sales, {_co([*(f'w{k}' for k in _LAGS), *(f'r{k}' for k in _LAGS), 'w'], False)} AS m FROM second WHERE t > {fc.LONG_AR + _LAGS[-1]} GROUP BY sales),
{_sweeps('second_m', 'second_s', '6')},
cand0 AS (SELECT sales, damped AS j, [{', '.join(f'm[{j}][7]' for j in range(1, 4))}, {', '.join(f'm[{j}][7]*power(damped, {k})' for j, k in enumerate(_LAGS, 4))}] AS c
  FROM second_s, (SELECT unnest({list(fc.DAMPED)}::DOUBLE[]) AS damped)),
{', '.join(_step(n) for n in range(fc.STEPS + 1))},
fitted AS (SELECT sales, c, j, n, total/(n-{_FIRST}-{2 * len(_LAGS)}) AS sigma2 FROM best{fc.STEPS} JOIN (SELECT sales, count(*) AS n FROM train GROUP BY 1) USING (sales)),
tails AS (SELECT y.sales, list(y ORDER BY day DESC) AS ys, list(w ORDER BY day DESC) AS ws, list(e ORDER BY day DESC) AS es, max(out_date) AS last
  FROM y JOIN fitted USING (sales) JOIN walk{fc.STEPS} v ON v.sales=y.sales AND v.t=y.day-{_FIRST} AND v.j=fitted.j
  WHERE day > n-{_FIRST} GROUP BY y.sales),
ahead AS (SELECT sales, 0 AS h, ys, ws, es, list_transform(range({_FIRST}), lambda i: 0.0::DOUBLE) AS psi,
  list_transform(range({_FIRST}), lambda i: 0.0::DOUBLE) AS effect, 0.0::DOUBLE AS squares FROM tails
UNION ALL SELECT sales, h, list_prepend(nw+ys[1]+ys[12]-ys[13], ys[:12]), list_prepend(nw, ws[:12]), list_prepend(0.0, es[:12]),
  list_prepend(np, psi[:12]), list_prepend(np+effect[1]+effect[12]-effect[13], effect[:12]), squares+(np+effect[1]+effect[12]-effect[13])**2
  FROM (SELECT a.sales, h+1 AS h, ys, ws, es, psi, effect, squares, {'+'.join(f'c[{j}]*ws[{k}]+c[{j + 3}]*es[{k}]' for j, k in enumerate(_LAGS, 1))} AS nw,
    {'+'.join(f'c[{j}]*psi[{k}]' for j, k in enumerate(_LAGS, 1))}+CASE h WHEN 0 THEN 1 {' '.join(f'WHEN {k} THEN c[{j}]' for j, k in enumerate(_LAGS, 4))} ELSE 0 END AS np
    FROM ahead a JOIN fitted USING (sales) WHERE h < {HORIZON})),
seasonal AS (SELECT sales, CAST(last + CAST(h AS INT) AS DATE) AS out_date, ahead.ys[1] AS prediction, {fc.NORMAL_95}*sqrt(sigma2*squares) AS margin
  FROM ahead JOIN tails USING (sales) JOIN fitted USING (sales) WHERE h > 0)"""
_WR = _WD.replace("WITH ", "WITH RECURSIVE ", 1)
_MODELS = f"""{_WR}, {_SARIMA}, {_ols('train')},
forecasts AS (SELECT 'linear' AS model, sales, out_date, {_SCORE} AS prediction FROM dense JOIN fit USING (sales) WHERE out_date >= {_SPLIT}
  UNION ALL SELECT 'seasonal', sales, out_date, prediction FROM seasonal),
pairs AS (SELECT model, sales, out_date, total_sales AS actual, prediction FROM dense JOIN forecasts USING (sales, out_date) WHERE out_date >= {_SPLIT})"""


def _adf(max_lag: int = 12) -> str:
    names = [*(f"d{k}" for k in range(1, max_lag + 1)), "y1", "d"]
    a, b = max_lag + 1, max_lag + 2
    crit = ", ".join(f"round({'+'.join(f'({v})/power(n, {i})' for i, v in enumerate(vs))}, 5) AS {c}" for c, vs in fc.ADF_CRITICAL.items())
    z = lambda terms: "+".join(f"({v})*power(statistic, {i})" for i, v in enumerate(terms))
    low, high = fc.ADF_P_RANGE
    return f"""{_WR}, {_TRAIN},
d AS (SELECT sales, out_date, lag(total_sales) OVER w AS y1, total_sales-lag(total_sales) OVER w AS d FROM train WINDOW w AS (PARTITION BY sales ORDER BY out_date)),
x AS (SELECT *, {_lagged('d', range(1, max_lag + 1))} FROM d WINDOW w AS (PARTITION BY sales ORDER BY out_date)),
co AS (SELECT sales, count(*) AS n, {_co(names)} AS m FROM x WHERE d{max_lag} IS NOT NULL GROUP BY sales),
{_sweeps('co', 'co_s', str(max_lag), ', n')},
tried AS (SELECT sales, n, k, m[{b}][{b}]-m[{a}][{b}]**2/m[{a}][{a}] AS sse, m[{a}][{b}]/m[{a}][{a}]/sqrt(sse/(n-k-2)/m[{a}][{a}]) AS statistic,
  n*ln(sse/n)+2*(k+2) AS aic FROM co_s_steps),
chosen AS (SELECT sales, n, arg_min(k, aic) AS k, arg_min(statistic, aic) AS statistic FROM tried GROUP BY sales, n),
scored AS (SELECT *, CASE WHEN statistic <= {fc.ADF_P_SPLIT} THEN {z(fc.ADF_P_LEFT)} ELSE {z(fc.ADF_P_RIGHT)} END AS z FROM chosen)
SELECT sales, n AS n_obs, CAST(k AS INT) AS used_lag, round(statistic, 5) AS statistic, round(CASE WHEN statistic <= {low} OR z < -5 THEN 0
  WHEN statistic >= {high} OR z > 5 THEN 1 ELSE 0.5+list_sum(list_transform(range(0, 100), lambda i:
  power(-1, i)*exp((2*i+1)*ln(abs(z)/sqrt(2.0))-lgamma(i+1))/(2*i+1)))*sign(z)/sqrt(pi()) END, 5) AS p_value, {crit} FROM scored"""


def _rolling() -> str:
    """Each origin's fit of each measure, scored on the 90 days behind it."""
    parts, out = [], []
    for k, origin in enumerate(ORIGINS):
        for m in sa.MEASURES:
            name = f"f{k}_{m}"
            parts.append(f"{name}_h AS (SELECT * FROM dense WHERE out_date < DATE '{origin}'), {_ols(f'{name}_h', m, name)}")
            out.append(f"""SELECT sales, '{m}' AS measure, DATE '{origin}' AS origin, {m} AS actual, {_SCORE} AS prediction FROM dense JOIN {name} USING (sales)
  WHERE out_date >= DATE '{origin}' AND out_date < DATE '{origin}' + INTERVAL 90 DAY""")
    return f"""{_WR}, {', '.join(parts)}, pairs AS ({' UNION ALL '.join(out)})
SELECT sales, measure, origin, count(*) AS n_rows, round(avg((actual-prediction)**2)/1e6, 2) AS mse, round(avg(abs(actual-prediction)), 2) AS mae
FROM pairs GROUP BY 1, 2, 3"""


def _dimension(name: str, value: str) -> str:
    return f"""SELECT '{name}' AS dimension, CAST({value} AS VARCHAR) AS value, round(sum(total_sales)/1e6, 6) AS total_millions
  FROM sales_daily GROUP BY 2"""


ORACLES = {
    "time_features": f"{_W} SELECT out_date, product_id, total_sales, {_PARTS.format('out_date')} FROM sales_daily",
    "sales_daily_total": f"""{_W} SELECT {_DAY} AS out_date, round(sum(total_sales), 2) AS total_sales FROM sales_daily GROUP BY 1""",
    "sales_dense": f"{_WD} SELECT sales, out_date, round(total_sales, 2) AS total_sales FROM dense",
    "sales_measures_dense": f"""{_WD} SELECT sales, out_date, round(out_count_total, 4) AS out_count_total,
  round(total_sales, 4) AS total_sales, round(total_sales_local_price, 4) AS total_sales_local_price FROM dense""",
    "sales_year_weekday": f"""{_W} SELECT CAST(year(out_date) AS INT) AS year, CAST(isodow(out_date)-1 AS INT) AS weekday,
  {_NAMES}[isodow(out_date)] AS weekday_name, round(sum(total_sales), 2) AS total_sales FROM sales_daily GROUP BY 1,2,3""",
    "sales_year_month": f"""{_W} SELECT CAST(year(out_date) AS INT) AS year, CAST(month(out_date) AS INT) AS month,
  round(sum(total_sales), 2) AS total_sales FROM sales_daily GROUP BY 1,2""",
    "sales_category_month": f"""{_W} SELECT sales, CAST(date_trunc('month', out_date) AS DATE) AS month_start,
  round(sum(total_sales), 2) AS total_sales FROM sales_daily GROUP BY 1,2""",
    "sales_by_dimension": f"{_W} " + " UNION ALL ".join(
        _dimension(n, v) for n, v in {
            "year": "year(out_date)", "month": "month(out_date)", "day": "day(out_date)",
            "weekday": "isodow(out_date)-1", "sales": "sales",
        }.items()
    ),
    "train_test_split": f"""{_WD} SELECT sales, out_date, round(total_sales, 2) AS total_sales,
  CASE WHEN out_date < {_SPLIT} THEN 'train' ELSE 'test' END AS part FROM dense""",
    "year_split": f"""{_WD} SELECT sales, out_date, round(total_sales, 2) AS total_sales,
  CASE WHEN year(out_date)<=1999 THEN 'train' ELSE 'test' END AS part FROM dense WHERE year(out_date)<=2000""",
    "future_dates": f"""{_W}, last AS (SELECT CAST(max(out_date) AS DATE) AS d FROM sales_daily),
dates AS (SELECT CAST(unnest(generate_series(date_trunc('month', d + INTERVAL 1 MONTH), d + INTERVAL 13 MONTH,
  INTERVAL 1 MONTH)) AS DATE) AS out_date FROM last)
SELECT out_date, {_PARTS.format('out_date')} FROM dates""",
    "seasonal_difference": f"""{_WD} SELECT sales, out_date, round(total_sales-lag(total_sales, 1) OVER w
  -lag(total_sales, 12) OVER w+lag(total_sales, 13) OVER w, 2) AS w FROM dense WINDOW w AS {_W_DIFF}""",
    "ols_gram": f"{_WD} SELECT sales, {_GRAM} FROM dense WHERE out_date < {_SPLIT} GROUP BY 1",
    "ols_balance": f"{_WD} SELECT sales, {_BALANCE} FROM dense WHERE out_date < {_SPLIT} GROUP BY 1",
    "ols_total": f"""{_WR}, total AS (SELECT 'all' AS sales, CAST(out_date AS DATE) AS out_date, sum(total_sales) AS total_sales FROM sales_daily
  WHERE out_date IS NOT NULL AND out_date < {_SPLIT} GROUP BY 2), {_ols('total')}
SELECT {_FIT}, round(sse/1e6, 0) AS sse_millions FROM fit""",
    "ols_by_category": f"{_WR}, {_TRAIN}, {_ols('train')} SELECT sales, {_FIT}, round(sse/1e6, 0) AS sse_millions FROM fit",
    "ols_forecast": f"""{_WR}, {_TRAIN}, {_ols('train')}, last AS (SELECT CAST(max(out_date) AS DATE) AS d FROM sales_daily),
days AS (SELECT DISTINCT out_date FROM dense WHERE out_date >= {_SPLIT}
  UNION ALL SELECT CAST(unnest(generate_series(date_trunc('month', d + INTERVAL 1 MONTH), d + INTERVAL 13 MONTH, INTERVAL 1 MONTH)) AS DATE) FROM last)
SELECT sales, out_date, round({_SCORE}, 2) AS prediction FROM days CROSS JOIN fit""",
    "sarima_fit": f"""{_WR}, {_SARIMA} SELECT sales, n, {', '.join(f'round(c[{j}], 5) AS {kind}_{k}' for kind, at in (('ar', 1), ('ma', 4)) for j, k in enumerate(_LAGS, at))},
  round(sigma2/1e6, 2) AS variance_millions FROM fitted""",
    "sarima_by_series": f"""{_WR}, {_SARIMA} SELECT sales, out_date, round(prediction, 0) AS prediction, round(prediction-margin, 0) AS low,
  round(prediction+margin, 0) AS high, CAST(NULL AS VARCHAR) AS reason FROM seasonal""",
    "adf_statistic": _adf(),
    "model_align": f"{_MODELS} SELECT model, sales, out_date, round(actual, 0) AS actual, round(prediction, 0) AS prediction FROM pairs",
    "model_metrics": f"""{_MODELS} SELECT model, sales, count(*) AS n_rows, round(avg((actual-prediction)**2)/1e6, 0) AS mse,
  round(avg(abs(actual-prediction)), 0) AS mae FROM pairs GROUP BY 1, 2""",
    "model_quality": f"""{_MODELS} SELECT model, sales, count(DISTINCT out_date) AS n_dates, count(*)-count(DISTINCT out_date) AS duplicate_dates,
  count(*) FILTER (prediction IS NULL) AS missing_predictions FROM forecasts GROUP BY 1, 2""",
    "model_vs_actual": f"""{_MODELS} SELECT 'history' AS model, sales, out_date, round(total_sales, 0) AS value, 'actual' AS kind FROM dense
  UNION ALL SELECT model, sales, out_date, round(prediction, 0), 'forecast' FROM forecasts""",
    "rolling_errors": _rolling(),
    "forecast_align": f"""{_ALIGNED} SELECT sales, out_date, round(actual, 2) AS actual,
  round(prediction, 2) AS prediction FROM aligned""",
    "forecast_metrics": f"""{_ALIGNED} SELECT sales, count(*) AS n_rows, round(avg((actual-prediction)*(actual-prediction)), 2)
  AS mse, round(avg(abs(actual-prediction)), 2) AS mae FROM aligned GROUP BY 1""",
    "actual_vs_forecast": f"""{_WD}, {_NAIVE} SELECT sales, out_date, round(total_sales, 2) AS value, 'actual' AS kind
  FROM dense UNION ALL SELECT sales, out_date, round(prediction, 2), 'forecast' FROM naive""",
    "forecast_quality": f"""{_WD}, {_NAIVE} SELECT sales, count(DISTINCT out_date) AS n_dates,
  count(*)-count(DISTINCT out_date) AS duplicate_dates, count(*) FILTER (prediction IS NULL) AS missing_predictions
  FROM naive GROUP BY 1""",
}
