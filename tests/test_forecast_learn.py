"""Grouped ADF against a direct numpy implementation; forecast shape; forest."""
import math

import numpy as np
import pandas as pd
import pytest

from tidepanel.operators import forecast as FC


def _adf_numpy(x):
    """Dickey-Fuller with constant, AIC lag choice on a common sample, refit."""
    n = len(x)
    L = max(0, min(int(math.ceil(12.0 * (n / 100.0) ** 0.25)), n // 2 - 2))
    dx = np.diff(x)

    def design(p, start):
        rows, ys = [], []
        for t in range(start, n):          # t indexes x; dx[t-1] = x[t]-x[t-1]
            rows.append([1.0, x[t - 1]] + [dx[t - 1 - j] for j in range(1, p + 1)])
            ys.append(dx[t - 1])
        return np.array(rows), np.array(ys)

    best, ic = 0, math.inf
    for p in range(L + 1):
        X, y = design(p, L + 1)
        b = np.linalg.lstsq(X, y, rcond=None)[0]
        ssr = ((y - X @ b) ** 2).sum()
        m = len(y)
        aic = m * (math.log(2 * math.pi) + math.log(ssr / m) + 1) + 2 * X.shape[1]
        if aic < ic - 1e-12:
            best, ic = p, aic
    X, y = design(best, best + 1)
    b = np.linalg.lstsq(X, y, rcond=None)[0]
    u = y - X @ b
    s2 = (u @ u) / (len(y) - X.shape[1])
    se = math.sqrt(s2 * np.linalg.inv(X.T @ X)[1, 1])
    return b[1] / se, best


def test_adf_matches_numpy(spark):
    rng = np.random.default_rng(11)
    walk = np.cumsum(rng.normal(size=90))
    ar = np.zeros(70)
    for t in range(1, 70):
        ar[t] = 0.3 * ar[t - 1] + rng.normal()
    rows = [("walk", i, float(v)) for i, v in enumerate(walk)] + [("ar", i, float(v)) for i, v in enumerate(ar)]
    df = spark.createDataFrame(rows, "series string, date int, y double")
    got = {r.series: r for r in FC.adf_test(df, "series", "date", "y").collect()}
    for name, x in (("walk", walk), ("ar", ar)):
        stat, lag = _adf_numpy(x)
        assert got[name].used_lag == lag
        assert got[name].adf_stat == pytest.approx(stat, rel=1e-8)
    assert got["ar"].pvalue < 0.05 < got["walk"].pvalue


def test_grouped_forecast_and_naive(spark):
    rng = np.random.default_rng(2)
    rows = []
    for s in ("a", "b"):
        x = 0.0
        for t in range(80):
            x = 0.5 * x + rng.normal()
            rows.append((s, t, float(x)))
    df = spark.createDataFrame(rows, "series string, date int, y double")
    fc = FC.grouped_forecast(df, "series", "date", "y", 12).toPandas()
    assert len(fc) == 24 and set(fc.series) == {"a", "b"}
    assert np.allclose(fc.upper - fc.forecast, fc.forecast - fc.lower)
    assert (fc.upper > fc.lower).all()
    nv = FC.naive_forecast(df, "series", "date", "y", 12).toPandas()
    pdf = pd.DataFrame(rows, columns=["series", "date", "y"])
    for s, g in pdf.groupby("series"):
        assert (nv[nv.series == s].naive == g.sort_values("date").y.iloc[-13]).all()


def test_forest_importance_sums_to_one(spark):
    from tidepanel.operators.learn import feature_importance, forest_regression
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(size=(300, 3)), columns=["a", "b", "c"])
    pdf["y"] = 2 * pdf.a + pdf.b ** 2 + rng.normal(size=300) * 0.1
    model = forest_regression(spark.createDataFrame(pdf), "y", ["a", "b", "c"], numTrees=20)
    imp = feature_importance(model, ["a", "b", "c"])
    assert sum(v for _, v in imp) == pytest.approx(1.0) and imp[0][0] == "a"


def _wavy(rng, n, kind):
    e = rng.normal(size=n)
    if kind == "ar":
        x = np.zeros(n)
        for i in range(2, n):
            x[i] = 0.6 * x[i - 1] - 0.3 * x[i - 2] + e[i]
        return 50 + x
    if kind == "walk":
        return 1000 + np.cumsum(e)
    if kind == "ma":
        return e + 0.5 * np.concatenate([[0], e[:-1]])
    if kind == "twice":
        return np.cumsum(np.cumsum(e))
    return np.full(n, 7.0)


def _series_frame(spark, series):
    rows = [(s, i, float(v)) for s, x in series.items() for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "series string, date int, y double").repartition(3)


@pytest.mark.parametrize("slice_rows", [64, 16_384])
def test_sliced_adf_and_forecast_equal_the_whole_array(spark, slice_rows):
    """Slices of 64 values (several rounds of merging for the long series) against least squares on the whole array."""
    import series_reference as ref
    rng = np.random.default_rng(4)
    series = {f"{k}{n}": _wavy(rng, n, k) for k in ("ar", "walk", "ma", "twice") for n in (40, 64, 65, 130, 700)}
    series |= {"long": _wavy(rng, 5000, "ar"), "const": _wavy(rng, 90, "const"), "short": np.array([1.0, 2.0, 4.0]), "four": np.array([1.0, 3.0, 2.0, 5.0])}
    df = _series_frame(spark, series)
    got = {r["series"]: r for r in FC.adf_test(df, "series", "date", "y", slice_rows=slice_rows).collect()}
    assert set(got) == set(series)
    for name, x in series.items():
        want = ref.adf(x)
        if want is None:
            assert got[name]["adf_stat"] is None, name
        else:
            assert (got[name]["used_lag"], got[name]["nobs"]) == want[1:3], name
            assert got[name]["adf_stat"] == pytest.approx(want[0], rel=1e-8) and got[name]["ic_best"] == pytest.approx(want[3], rel=1e-9), name
    pred = FC.grouped_forecast(df, "series", "date", "y", 12, slice_rows=slice_rows).toPandas()
    assert len(pred) == sum(min(12, len(x)) for x in series.values())
    for name, x in series.items():
        one = pred[pred.series == name].sort_values("date")
        want = ref.forecast(x[:-12], 12, 4, 4, 2, 8) if len(x) > 12 else None
        if want is None:
            assert one.forecast.isna().all() and (len(x) > 12) == one.naive.notna().all(), name
            continue
        assert (one.p.iat[0], one.d.iat[0], one.q.iat[0]) == want[:3], name
        assert np.allclose(one.forecast, want[4], rtol=1e-7, atol=1e-7) and np.allclose((one.upper - one.lower) / 2, want[5], rtol=1e-6), name
        assert (one.naive == x[-13]).all() and np.allclose(one.actual, x[-12:])


def test_adf_of_a_million_points(spark):
    """One series over many tasks equals the whole array's test."""
    import series_reference as ref
    from pyspark.sql import functions as F
    n = 1_000_000
    x = _wavy(np.random.default_rng(8), n, "ar")
    df = spark.createDataFrame(pd.DataFrame({"date": np.arange(n), "y": x})).withColumn("series", F.lit("one"))
    slices = FC._slices(FC._ranked_values(df, "series", "date", "y"), 0, FC.SLICE)
    assert slices.agg(F.max(F.size("y"))).first()[0] < FC.SLICE + 200 and slices.count() == -(-n // FC.SLICE)
    got = FC.adf_test(df, "series", "date", "y", max_lag=6).first()
    want = ref.adf(x, 6)
    assert (got["used_lag"], got["nobs"]) == want[1:3]
    assert got["adf_stat"] == pytest.approx(want[0], rel=1e-9) and got["ic_best"] == pytest.approx(want[3], rel=1e-9)


def test_series_all_too_short_and_none(spark):
    df = _series_frame(spark, {f"s{i}": np.arange(float(i + 1)) for i in range(20)})
    pred = FC.grouped_forecast(df, "series", "date", "y", 12).toPandas()
    assert len(pred) == sum(min(12, i + 1) for i in range(20)) and pred.forecast.isna().all() and pred.p.isna().all()
    none = df.limit(0)
    assert FC.grouped_forecast(none, "series", "date", "y").count() == 0 and FC.adf_test(none, "series", "date", "y").count() == 0
