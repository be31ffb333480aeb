import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shopledger.operators import forecast as fc
from shopledger.operators import sales as sa

START = dt.date(2020, 1, 1)


def frame(spark, series):
    rows = [(k, START + dt.timedelta(days=i), float(v)) for k, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "sales string, out_date date, total_sales double").repartition(4)


def features(n):
    days = pd.date_range(START, periods=n)
    return np.column_stack([np.ones(n), days.year - fc.BASE_YEAR, days.month, days.day, days.weekday])


def test_ols_equals_least_squares(spark):
    rnd = np.random.default_rng(1)
    x = features(800)
    series = {"a": x @ [5, 2, -1, 0.5, 3] + rnd.normal(size=800), "b": rnd.normal(size=800) * 1e6}
    df = frame(spark, series)
    model = {r.sales: r for r in fc.fit_ols(df, ["sales"]).collect()}
    for k, y in series.items():
        want, sse, *_ = np.linalg.lstsq(x, y, rcond=None)
        assert np.allclose(model[k].coef, want, rtol=1e-6, atol=1e-6 * np.abs(want).max())
        assert np.isclose(model[k].sse, sse[0], rtol=1e-6)
        spread = np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * sse[0] / (800 - 5))
        assert np.allclose(model[k].stderr, spread, rtol=1e-5)
    scored = fc.score_ols(df, fc.fit_ols(df, ["sales"]), ["sales"]).filter("sales = 'a'").orderBy("out_date")
    got = [r.prediction for r in scored.collect()]
    assert np.allclose(got, x @ np.linalg.lstsq(x, series["a"], rcond=None)[0])
    total = fc.score_ols(df, fc.fit_ols(df)).select(F.avg("prediction"), F.avg("total_sales")).first()
    assert np.isclose(total[0], total[1])


def test_seasonal_model_recovers_its_coefficients(spark):
    rnd = np.random.default_rng(7)
    n, phi, seasonal, theta = 4000, 0.5, 0.3, -0.4
    e = rnd.normal(size=n)
    w = np.zeros(n)
    for t in range(13, n):
        w[t] = phi * w[t - 1] + seasonal * w[t - 12] - phi * seasonal * w[t - 13] + e[t] + theta * e[t - 1]
    y = np.zeros(n)
    for t in range(n):
        y[t] = w[t] + (y[t - 1] if t >= 1 else 0) + (y[t - 12] if t >= 12 else 0) - (y[t - 13] if t >= 13 else 0)
    df = frame(spark, {"a": y})
    coef = fc.sarima_fit(df, ["sales"]).first().coef
    assert np.allclose(coef[:3], [phi, seasonal, -phi * seasonal], atol=0.12)
    assert abs(coef[3] - theta) < 0.15
    path = fc.sarima_forecast(df, ["sales"], 5).orderBy("out_date").collect()
    assert [r.out_date for r in path] == [START + dt.timedelta(days=n + i) for i in range(5)]
    best = phi * w[-1] + seasonal * w[-12] - phi * seasonal * w[-13] + theta * e[-1] + y[-1] + y[-12] - y[-13]
    assert abs(path[0].prediction - best) < 1.0  # within one standard deviation of the noise


def test_forecast_continues_a_seasonal_line_exactly(spark):
    season = np.array([3.0, -1, 4, 1, -5, 9, 2, -6, 5, 3, -5, 8])
    y = np.array([2.0 * t + season[t % 12] for t in range(240)])
    path = fc.sarima_forecast(frame(spark, {"a": y, "b": -y}), ["sales"], 24).orderBy("sales", "out_date").collect()
    want = np.array([2.0 * t + season[t % 12] for t in range(240, 264)])
    assert np.allclose([r.prediction for r in path], np.concatenate([want, -want]))


def test_adf_equals_the_regression(spark):
    rnd = np.random.default_rng(3)
    walk, noise = np.cumsum(rnd.normal(size=400)), rnd.normal(size=400)
    got = {r.sales: r for r in fc.adf_statistic(frame(spark, {"walk": walk, "noise": noise}), ["sales"], max_lag=4).collect()}
    for name, y in (("walk", walk), ("noise", noise)):
        d, best = np.diff(y), None
        target = d[4:]
        for k in range(5):
            x = np.column_stack([np.ones(len(target)), y[4:-1]] + [d[4 - j:-j] for j in range(1, k + 1)])
            coef, sse, *_ = np.linalg.lstsq(x, target, rcond=None)
            aic = len(target) * np.log(sse[0] / len(target)) + 2 * x.shape[1]
            stat = coef[1] / np.sqrt(np.linalg.inv(x.T @ x)[1, 1] * sse[0] / (len(target) - x.shape[1]))
            if best is None or aic < best[0]:
                best = (aic, k, stat)
        assert got[name].used_lag == best[1] and np.isclose(got[name].statistic, best[2], rtol=1e-6)
    assert got["walk"].p_value > 0.05 > got["noise"].p_value
    assert abs(fc.adf_p_value(-2.86154) - 0.05) < 0.002 and fc.adf_p_value(-30) == 0 and fc.adf_p_value(5) == 1


def test_dense_rollup_fills_every_day(spark):
    rows = [(dt.datetime(2024, 1, 1), "a", 1.0), (dt.datetime(2024, 1, 1), "a", 2.0), (dt.datetime(2024, 1, 3), "b", None), (dt.datetime(2024, 1, 4), None, 9.0)]
    df = spark.createDataFrame(rows, "out_date timestamp_ntz, sales string, total_sales double")
    got = {(r.sales, r.out_date.day): r.total_sales for r in sa.dense_by_category(df).collect()}
    assert got == {(c, d): (3.0 if (c, d) == ("a", 1) else 0.0) for c in "ab" for d in (1, 3, 4)}


def test_no_overlap_is_an_error(spark):
    a = frame(spark, {"x": [1.0]})
    b = a.select("sales", F.date_add("out_date", 9).alias("out_date"), F.lit(1.0).alias("prediction"))
    with pytest.raises(PySparkException, match="no overlapping data"):
        fc.error_metrics(fc.align(a, b, ["sales"])).collect()


def test_quality(spark):
    p = spark.createDataFrame(
        [("a", START, 1.0), ("a", START, None), ("a", START + dt.timedelta(days=1), 2.0)],
        "sales string, out_date date, prediction double",
    )
    row = fc.forecast_quality(p, ["sales"]).first()
    assert (row.n_dates, row.duplicate_dates, row.missing_predictions) == (2, 1, 1)


def test_short_series_are_reported(spark):
    rng = np.random.default_rng(2)
    df = frame(spark, {"long": rng.normal(size=400).cumsum(), "short": np.arange(10.0), "mid": np.arange(20.0)})
    rows = fc.sarima_forecast(df, ["sales"], 5).collect()
    by_key = {k: [r for r in rows if r.sales == k] for k in ("long", "short", "mid")}
    assert len(by_key["long"]) == 5 and all(r.reason is None for r in by_key["long"])
    assert [(r.out_date, r.prediction, r.reason) for r in by_key["short"]] == [(None, None, "series too short")]
    stats = {r.sales: r for r in fc.adf_statistic(df, ["sales"]).collect()}
    assert stats["long"].statistic is not None and stats.get("short") is None or stats["short"].statistic is None


def test_a_key_without_overlap_is_an_error(spark):
    a = frame(spark, {"x": np.arange(5.0), "y": np.arange(5.0)})
    predicted = a.filter("sales = 'x'").withColumnRenamed("total_sales", "prediction")
    aligned = fc.align(a, predicted, ["sales"])
    assert fc.error_metrics(aligned, ["sales"], predicted).count() == 1
    with pytest.raises(Exception, match="no overlapping data"):
        fc.error_metrics(aligned, ["sales"], a).collect()


def simulated(rnd, n=2500, phi=0.5, seasonal=0.3, theta=-0.4):
    e = rnd.normal(size=n)
    w, y = np.zeros(n), np.zeros(n)
    for t in range(n):
        past = lambda x, k: x[t - k] if t >= k else 0.0
        w[t] = phi * past(w, 1) + seasonal * past(w, 12) - phi * seasonal * past(w, 13) + e[t] + theta * past(e, 1)
        y[t] = w[t] + past(y, 1) + past(y, 12) - past(y, 13)
    return y, np.array([phi, seasonal, -phi * seasonal, theta, 0, 0])


def test_refined_coefficients_are_closer_than_two_stages(spark, monkeypatch):
    rnd = np.random.default_rng(11)
    made = [simulated(rnd) for _ in range(20)]
    y, size = fc._stacked([y for y, _ in made])
    want = np.stack([c for _, c in made])
    refined = fc.fit_seasonal(y, size)
    monkeypatch.setattr(fc, "STEPS", 0)
    rough = fc.fit_seasonal(y, size)
    gap = lambda fit: np.sqrt(((fit[0] - want) ** 2).mean())
    assert gap(refined) < 0.9 * gap(rough)
    assert (refined[1] <= rough[1] * (1 + 1e-12)).all() and np.allclose(refined[1], 1, atol=0.15)


def test_series_of_a_batch_do_not_touch_each_other():
    rnd = np.random.default_rng(5)
    series = [simulated(rnd, n)[0] for n in (900, 400, 60)]
    together = fc.fit_seasonal(*fc._stacked(series))
    for k, y in enumerate(series):
        alone = fc.fit_seasonal(*fc._stacked([y]))
        assert np.allclose(together[0][k], alone[0][0]) and np.isclose(together[1][k], alone[1][0])


def test_bounds_hold_about_95_percent(spark):
    rnd = np.random.default_rng(9)
    made = {f"s{k}": simulated(rnd, 1000)[0] for k in range(60)}
    path = fc.sarima_forecast(frame(spark, {k: y[:-10] for k, y in made.items()}), ["sales"], 10).collect()
    inside = [r.low <= made[r.sales][-10 + (r.out_date - START).days - 990] <= r.high for r in path]
    assert len(inside) == 600 and 0.9 < np.mean(inside) < 0.99
    width = {h: np.mean([r.high - r.low for r in path if (r.out_date - START).days - 990 == h]) for h in (0, 9)}
    assert width[9] > width[0] > 3


def test_a_shifted_series_keeps_its_slopes(spark):
    rnd = np.random.default_rng(4)
    y = features(900) @ [5, 2, -1, 0.5, 3] + rnd.normal(size=900)
    df = frame(spark, {"near": y, "far": y + 1e9})
    model = {r.sales: r for r in fc.fit_ols(df, ["sales"]).collect()}
    assert np.allclose(model["far"].coef[1:], model["near"].coef[1:], rtol=1e-5)
    assert np.isclose(model["far"].coef[0] - model["near"].coef[0], 1e9, rtol=1e-9)
    assert np.isclose(model["far"].sse, model["near"].sse, rtol=1e-5)


def test_moments_do_not_depend_on_the_partitions(spark):
    rnd = np.random.default_rng(8)
    df = frame(spark, {"a": rnd.normal(size=700) + 1e6})
    fits = [fc.fit_ols(df.repartition(n), ["sales"]).first() for n in (1, 16)]
    assert np.allclose(fits[0].coef, fits[1].coef, rtol=1e-9) and np.isclose(fits[0].sse, fits[1].sse, rtol=1e-9)


def test_a_constant_feature_gets_no_weight(spark):
    y = np.arange(60.0)  # within one year
    model = fc.fit_ols(frame(spark, {"a": y, "one": [3.0]}), ["sales"])
    rows = {r.sales: r for r in model.collect()}
    assert rows["a"].coef[1] == 0 and rows["one"].coef == [3.0, 0, 0, 0, 0] and rows["one"].stderr[0] is None


def test_rolling_origins(spark):
    df = frame(spark, {"a": np.arange(100.0), "b": np.arange(100.0) * 2})
    last = lambda history, ahead, m: ahead.join(
        history.groupBy("sales").agg(F.max_by(m, "out_date").alias("prediction")), "sales")
    origins = ["2020-02-01", "2020-03-01"]
    got = {(r.sales, str(r.origin)): (r.n_rows, r.mae) for r in fc.rolling_origin(df, ["sales"], ["total_sales"], origins, 3, last).collect()}
    assert got == {("a", o): (3, 2.0) for o in origins} | {("b", o): (3, 4.0) for o in origins}
    with pytest.raises(Exception, match="no overlapping data"):
        fc.rolling_origin(df, ["sales"], ["total_sales"], origins, 3, lambda *a: last(*a).filter("sales = 'a'")).collect()
