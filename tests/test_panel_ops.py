"""Joins, windows and series operators on small fixtures (FIXTURES.md edge rows)."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.operators import joins as J
from tidepanel.operators import series as SE
from tidepanel.operators import windows as W
from tidepanel.operators.aggregates import corr_matrix, entity_profile, time_quantile_cut


def d(s):
    return dt.date.fromisoformat(s)


def test_balanced_drops_month_missing_for_one_entity(spark):
    rows = [("a", d("2020-01-31"), "m", 1.0), ("a", d("2020-02-29"), "m", 2.0),
            ("b", d("2020-01-31"), "m", 3.0)]
    df = spark.createDataFrame(rows, "entity string, date date, metric string, value double")
    out = J.balanced_semi_join(df)
    assert sorted(str(r.date) for r in out.collect()) == ["2020-01-31", "2020-01-31"]


def test_scaffold_zero_fills_quiet_year(spark):
    years = spark.createDataFrame([(2000,), (2001,)], "year int")
    obs = spark.createDataFrame([(2000, "count", 3.0)], "year int, metric string, value double")
    out = J.scaffold_left_join(obs, years, ["count", "cost"])
    got = sorted((r.year, r.metric, r.value) for r in out.collect())
    assert got == [(2000, "cost", 0.0), (2000, "count", 3.0), (2001, "cost", 0.0), (2001, "count", 0.0)]


def test_event_window_tie_takes_later_and_empty_event_skipped(spark):
    series = spark.createDataFrame([(d("2020-01-31"), 100.0), (d("2020-03-31"), 110.0), (d("2020-04-30"), 121.0)],
                                   "date date, value double")
    # 2020-03-01 is 30 days after 01-31 and 30 days before 03-31: a tie
    events = spark.createDataFrame([("tie", d("2020-03-01")), ("far", d("2030-01-01"))], "event string, event_date date")
    es = SE.event_study(series, events, "value")
    got = {(r.event, str(r.date)): (r.normalized, r.rel_month, str(r.base_date)) for r in es.collect()}
    assert set(e for e, _ in got) == {"tie"}                          # no rows near 2030: skipped
    assert got[("tie", "2020-03-31")][2] == "2020-03-31"               # the tie takes the later date
    assert got[("tie", "2020-03-31")][0] == pytest.approx(100.0)
    assert got[("tie", "2020-01-31")][0] == pytest.approx(100.0 / 1.1)
    # -30 days / 30.44 -> -1; 60 days / 30.44 = 1.97 -> 2
    assert got[("tie", "2020-01-31")][1] == -1 and got[("tie", "2020-04-30")][1] == 2


def test_pct_change_pads_and_zero_prev(spark):
    rows = [("a", 1, 1.0), ("a", 2, None), ("a", 3, 2.0), ("a", 4, 4.0), ("b", 1, 0.0), ("b", 2, 5.0)]
    df = spark.createDataFrame(rows, "entity string, date int, x double")
    out = {(r.entity, r.date): r.g for r in W.pct_change(df, "x", "g").collect()}
    assert [out[("a", i)] for i in range(1, 5)] == [None, 0.0, 1.0, 1.0]
    assert out[("b", 2)] is None


def test_ffill_limit_three(spark):
    vals = [1.0, None, None, None, None, 2.0]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(vals)], "entity string, date int, x double")
    out = [r.x for r in W.ffill_limit(df, "x", 3).orderBy("date").collect()]
    assert out == [1.0, 1.0, 1.0, 1.0, None, 2.0]


def test_centered_ma_matches_convolution(spark):
    x = np.arange(30, dtype=float) ** 1.5
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(x)], "entity string, date int, x double")
    got = [r.t for r in W.centered_ma(df, "x", "t").orderBy("date").collect()]
    w = np.r_[0.5, np.ones(11), 0.5] / 12
    want = np.convolve(x, w, mode="valid")
    assert all(v is None for v in got[:6] + got[-6:])
    assert np.allclose(got[6:-6], want)


def test_relative_month_half_even(spark):
    df = spark.createDataFrame([(d("2020-01-01"), d("2020-01-01"))], "date date, event_date date")
    # 76.1 days / 30.44 = 2.5 -> 2 (half-even)
    df = df.withColumn("date", F.date_add("event_date", 76))
    assert df.select(W.relative_month("date", "event_date")).first()[0] == 2


def test_regular_series_gap_3_filled_gap_4_dropped(spark):
    months = ["2020-01-31", "2020-02-29", "2020-06-30", "2020-07-31", "2020-12-31"]
    vals = [1.0, 2.0, 3.0, 4.0, 5.0]
    df = spark.createDataFrame([("a", d(m), v) for m, v in zip(months, vals)], "entity string, date date, v double")
    out = {str(r.date): r.v for r in SE.regular_series(df, "v").collect()}
    assert out["2020-03-01"] == 2.0 and out["2020-05-01"] == 2.0          # 3-month gap filled
    assert out["2020-10-01"] == 4.0 and "2020-11-01" not in out            # 4th month stays empty
    assert len(out) == 12 - 1


def test_seasonal_decompose_adds_back_and_skips_short(spark):
    rng = np.random.default_rng(3)
    rows = []
    for e, n in (("short", 23), ("long", 24), ("longer", 40)):
        for t in range(n):
            rows.append((e, t, float(10 + 0.1 * t + np.sin(2 * np.pi * t / 12) + rng.normal() * 0.1)))
    df = spark.createDataFrame(rows, "entity string, date int, v double")
    out = SE.seasonal_decompose(df, "v").toPandas()
    assert set(out.entity) == {"long", "longer"}
    full = out.dropna(subset=["trend"])
    assert np.allclose(full.observed, full.trend + full.seasonal + full.resid)
    per = out.groupby(["entity", "phase"]).seasonal.first().groupby("entity").sum()
    assert np.allclose(per.values, 0.0, atol=1e-12)


def test_constant_column_corr_is_null_and_std_n1_null(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("a", 2.0, 5.0), ("b", 3.0, 1.0)], "entity string, x double, c double")
    r = {(x.col_a, x.col_b): x.r for x in corr_matrix(df, ["x", "c"]).collect()}
    assert r[("c", "x")] == pytest.approx(-0.8660254, rel=1e-6)
    assert corr_matrix(df.where("entity = 'a'"), ["x", "c"]).where("col_a = 'c' and col_b = 'x'").first().r is None
    prof = {p.entity: p for p in entity_profile(df, ["x"]).collect()}
    assert prof["b"].x_std is None


def test_date_quantile(spark):
    df = spark.createDataFrame([(d("2020-01-01"),), (d("2020-02-01"),), (d("2020-03-01"),)], "date date")
    us = time_quantile_cut(df, "date", 0.8).first().cut_us
    got = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us)
    assert got == dt.datetime(2020, 2, 18, 9, 36)
