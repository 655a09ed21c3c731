"""Cases that earlier versions got wrong: long and short series, hot ranks, out-of-range points, duplicate cells."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from test_forecast_learn import _adf_numpy
from tidepanel.operators import aggregates as A
from tidepanel.operators import forecast as FC
from tidepanel.operators import linear as L
from tidepanel.operators import reshape as R
from tidepanel.operators.joins import range_join_window
from tidepanel.operators.quantile import global_rank, quantile_table
from tidepanel.plans.inputs import padded
from tidepanel.sources.nested import explode_events


def _series(spark, sizes, shift=0.0):
    rng = np.random.default_rng(5)
    data = {f"s{n}": np.cumsum(rng.normal(size=n)) + shift for n in sizes}
    rows = [(k, i, float(v)) for k, x in data.items() for i, v in enumerate(x)]
    return data, spark.createDataFrame(rows, "series string, date int, y double")


def test_adf_at_every_length_and_level(spark):
    sizes = (3, 20, 101, 170, 316)
    data, df = _series(spark, sizes)
    got = {r.series: r for r in FC.adf_test(df, "series", "date", "y").collect()}
    assert set(got) == set(data) and got["s3"].adf_stat is None
    for n in sizes[1:]:
        stat, lag = _adf_numpy(data[f"s{n}"])
        assert got[f"s{n}"].used_lag == lag and got[f"s{n}"].adf_stat == pytest.approx(stat, rel=1e-8)
    _, high = _series(spark, sizes, 3e5)
    for r in FC.adf_test(high, "series", "date", "y").collect():
        assert r.adf_stat == (None if r.series == "s3" else pytest.approx(got[r.series].adf_stat, rel=1e-6))


def test_short_series_keep_their_rows(spark):
    _, df = _series(spark, (3, 10, 20, 90, 316))
    fc = FC.grouped_forecast(df, "series", "date", "y", 12).toPandas()
    assert fc.groupby("series").size().to_dict() == {"s3": 3, "s10": 10, "s20": 12, "s90": 12, "s316": 12}
    assert fc[fc.series.isin(["s3", "s10", "s20"])].forecast.isna().all() and fc[fc.series.isin(["s90", "s316"])].forecast.notna().all()
    nv = FC.naive_forecast(df, "series", "date", "y", 12).toPandas()
    assert len(nv) == len(fc) and nv[nv.series == "s10"].naive.isna().all() and nv[nv.series == "s20"].naive.notna().all()
    sc = {r.series: r for r in FC.forecast_scores(df, "series", "date", "y", 12).collect()}
    one = fc[fc.series == "s90"]
    assert sc["s90"].rmse_model == pytest.approx(float(np.sqrt(((one.actual - one.forecast) ** 2).mean())))
    sst = ((one.actual - one.actual.mean()) ** 2).sum()
    assert sc["s90"].r2_naive == pytest.approx(1 - ((one.actual - one.naive) ** 2).sum() / sst) and sc["s3"].rmse_model is None


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ranks_do_not_depend_on_exchange_reuse(spark, reuse):
    old, parts = spark.conf.get("spark.sql.exchange.reuse"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = spark.range(40_000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 10_007).cast("double").alias("v"))
        ranks = global_rank(df, ["g"], "v").groupBy("g").agg(F.count_distinct("_rank").alias("n"), F.max("_n").alias("m")).collect()
        assert all(r.n == r.m for r in ranks)
        want = {r.g: list(r.q) for r in df.groupBy("g").agg(F.percentile("v", F.array(F.lit(0.01), F.lit(0.5), F.lit(0.99))).alias("q")).collect()}
        got = {r.g: [r.q01, r.q50, r.q99] for r in quantile_table(df, ["g"], "v", [0.01, 0.5, 0.99]).collect()}
        assert all(got[g] == pytest.approx(want[g]) for g in want)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_closest_distance_of_in_range_points(spark):
    rows = [("A", 1, "N", 1990, 5.0, False), ("A", 2, "N", 1997, 50.0, True), ("B", 1, "M", 1980, 3.0, False)]
    df = spark.createDataFrame(rows, "storm string, o int, name string, yr int, dist double, ok boolean") \
        .withColumns({"w": F.lit(1), "p": F.lit(1), "l": F.lit(True)})
    got = {r.storm: r.closest_distance for r in A.storm_summary(df, "storm", "o", "name", "yr", "w", "p", "l", "dist", "ok").collect()}
    assert got == {"A": 50.0, "B": None}


def test_year_of_short_dates(spark):
    docs = spark.createDataFrame([('{"data":[{"name":"a","begDate":199903},{"name":"b","begDate":19990301},{"name":"c","begDate":199}]}',)], "j string")
    assert {r.name: r.year for r in explode_events(docs, "j").collect()} == {"a": 1999, "b": 1999, "c": None}


def test_panel_shape_counts_periods(spark):
    rows = [(e, d, m, 1.0) for e in "ab" for d in (1, 2) for m in "xyz"] + [("c", 3, "x", 1.0), ("c", 1, "x", 1.0)]
    r = A.panel_shape(spark.createDataFrame(rows, "entity string, date int, metric string, value double")).first()
    assert (r.min_obs_entity, r.max_obs_entity, r.balanced, r.complete, r.n_periods) == (2, 2, True, False, 3)


def test_long_keys_stay_whole(spark):
    df = spark.createDataFrame([(5,), (123456789,), (1234567891,)], "k long")
    assert [r[0] for r in df.select(padded(F.col("k"))).collect()] == ["00000005", "123456789", "1234567891"]


def _panel(n_e=8, n_t=12, seed=3):
    rng = np.random.default_rng(seed)
    return [(f"e{i}", t, float(rng.normal()), float(rng.normal() + i + t)) for i in range(n_e) for t in range(n_t) if rng.random() > 0.1]


def test_fe_with_repeated_cells(spark):
    rows = _panel()
    rows += [(e, t, x + 0.5, y - 0.3) for e, t, x, y in rows[:9]]
    fit = L.fe_twoway(spark.createDataFrame(rows, "entity string, date int, x double, y double"), "y", ["x"])
    ents, times = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    m = np.array([[r[2], *[r[0] == e for e in ents], *[r[1] == t for t in times[1:]]] for r in rows], float)
    want = np.linalg.lstsq(m, np.array([r[3] for r in rows]), rcond=None)[0][0]
    assert fit.coef[0] == pytest.approx(want, rel=1e-8)


def test_fe_says_when_it_cannot(spark):
    df = spark.createDataFrame(_panel(), "entity string, date int, x double, y double")
    with pytest.raises(ValueError):
        L.fe_twoway(df, "y", ["x"], max_periods=5)
    with pytest.raises(RuntimeError):
        L.fe_twoway(df, "y", ["x"], method="alternating", alt_max_iter=1, alt_tol=1e-14)


def test_window_join_bounds_and_rank(spark):
    s = spark.sql("SELECT explode(sequence(DATE '1995-01-31', DATE '2001-12-31', interval 1 month)) AS date")
    ev = spark.sql("SELECT * FROM VALUES ('a', DATE '1999-02-15'), ('b', DATE '2010-01-01') t(event, event_date)")
    got = range_join_window(s, ev).agg(F.min("date"), F.max("date"), F.count("*"), F.count_distinct("event")).first()
    want = s.crossJoin(ev).where("date between add_months(event_date, -24) and add_months(event_date, 24)").agg(
        F.min("date"), F.max("date"), F.count("*"), F.count_distinct("event")).first()
    assert tuple(got) == tuple(want)
    df = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 5.0), ("z", None)], "e string, m double")
    assert {r.e: r["rank"] for r in R.rank_by_measure(df, "m", "e").collect()} == {"c": 1, "a": 2, "b": 3, "z": None}


def test_sorted_csv_and_alias(spark, tmp_path):
    from tidepanel.sources.long import read_typed_long
    from tidepanel.sources.sinks import sink_long
    df = spark.sql("SELECT concat('e', id % 7) AS entity, DATE '2000-01-31' AS date, 'm' AS metric, cast(id AS double) AS value FROM range(200)")
    sink_long(df, f"{tmp_path}/a", "csv", sort_by=["entity", "value"], alias=f"{tmp_path}/b")
    for name in "ab":
        back = [(r.entity, r.value) for r in read_typed_long(spark, f"{tmp_path}/{name}").collect()]
        assert sorted(back) == sorted((r.entity, r.value) for r in df.collect())
        import glob
        rows = [line.split(",") for f in sorted(glob.glob(f"{tmp_path}/{name}/part-*")) for line in open(f).read().splitlines()[1:]]
        assert [(r[0], float(r[3])) for r in rows] == sorted(back)


def test_audit_counts_duplicates_and_clips(spark):
    from tidepanel.operators import clean as C
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0), ("b", 1, None)], "entity string, date int, value double")
    got = C.cleaning_audit({"raw": df, "w": df.withColumn("clipped", F.col("value") > 1.5)}, ["value"], ["entity", "date"], "clipped").collect()
    assert [(r.stage, r.n_rows, r.value_missing, r.n_duplicates, r.n_clipped) for r in got] == [("raw", 3, 1, 1, 0), ("w", 3, 1, 1, 1)]
