"""Remaining FIXTURES.md edge rows: storms, event names, fits, name+year joins."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidepanel.functions.scalar import normalize_event_name, short_name, slug
from tidepanel.operators import aggregates as A
from tidepanel.operators import joins as J


def test_storm_distance_uses_in_range_points_only(spark):
    # storm S1: close point in 1999 (out of range) only -> not qualifying
    # storm S2: far point in 1999, close point in 2000 -> qualifies; summary over all points
    rows = [("S1", "A", "19990901", "0000", 1999, 10.0, 50, 990, False),
            ("S1", "A", "20000901", "0000", 2000, 500.0, 60, 980, False),
            ("S2", "B", "19990901", "0000", 1999, 700.0, 90, 950, True),
            ("S2", "B2", "20000902", "0000", 2000, 30.04, 40, 1000, False)]
    pts = spark.createDataFrame(rows, "storm_id string, storm_name string, date string, time string, yr int, "
                                      "dist double, max_wind int, min_pressure int, landfall boolean")
    pts = pts.withColumn("in_range", F.col("yr").between(2000, 2025))
    q = A.min_distance_qualify(pts, "storm_id", "dist", 60.0, "in_range")
    assert {r.storm_id for r in q.collect()} == {"S2"} and q.count() == 2
    s = A.storm_summary(q.withColumn("o", F.struct("date", "time")), "storm_id", "o", "storm_name", "yr",
                        "max_wind", "min_pressure", "landfall", "dist").first()
    assert (s.storm_name, s.year, s.max_wind, s.min_pressure, s.has_landfall, s.closest_distance) == \
        ("B", 1999, 90, 950, True, 30.0)


def test_storm_points_are_not_sorted_to_qualify(spark):
    pts = spark.range(1000).selectExpr("concat('S', id % 50) storm_id", "id date", "cast(id % 50 as double) dist", "id % 3 = 0 in_range")
    pts = pts.union(spark.createDataFrame([(None, 1, 1.0, True), ("T", 2, None, True)], pts.schema))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        q = A.min_distance_qualify(pts, "storm_id", "dist", 9.0, "in_range")
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "Sort " not in plan
        assert sorted({r.storm_id for r in q.collect()}) == sorted(f"S{i}" for i in range(10)) and q.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_event_name_normalisation(spark):
    df = spark.createDataFrame([("Hurricane X (May 2001)",), ("Tropical Storm Y",), (" plain name ",),
                                ("Tropical Cyclone Z",)], "n string")
    got = [r[0] for r in df.select(normalize_event_name("n")).collect()]
    assert got == ["X", "Y", "PLAIN NAME", "Z"]
    m = spark.createDataFrame([("Miami-Fort Lauderdale, FL",)], "n string")
    assert m.select(short_name("n"), slug("n")).first() == ("Miami", "miami-fort_lauderdale,_fl")


def test_linear_fit_constant_x_is_null(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0), ("b", 1.0, 1.0), ("b", 2.0, 3.0)],
                               "g string, x double, y double")
    fits = {r.g: r for r in A.linear_fit(df, "y", "x", ["g"]).collect()}
    assert fits["a"].slope is None and fits["b"].slope == pytest.approx(2.0)
    grid = A.fit_line_grid(A.linear_fit(df, "y", "x", ["g"]), 100, ["g"])
    assert grid.where("g = 'a'").count() == 0 and grid.where("g = 'b'").count() == 100


def test_join_name_year_duplicates_multiply(spark):
    storms = spark.createDataFrame([("AL1", " ivan ", 2004), ("AL2", "IVAN", 2004), ("AL3", "IVAN", 2005)],
                                   "storm_id string, storm_name string, year int")
    events = spark.createDataFrame([("IVAN", 2004, 1.0), ("Ivan", 2004, 2.0)], "key string, year int, cost double")
    out = J.join_name_year(storms, events, "storm_name", "key", "year", ["cost"])
    assert out.count() == 4 and {r.storm_id for r in out.collect()} == {"AL1", "AL2"}


def test_left_join_zero_and_median_split_tie(spark):
    years = spark.createDataFrame([(2000,), (2001,)], "year int")
    cost = spark.createDataFrame([(2000, 5.0, 2)], "year int, cost double, deaths int")
    out = {r.year: (r.cost, r.deaths) for r in J.left_join_zero(years, cost, ["year"], ["cost", "deaths"]).collect()}
    assert out == {2000: (5.0, 2), 2001: (0.0, 0)}
    # entity medians a=2, b=2, c=2, d=9, e=1 -> cutoff 2; ties at the cutoff go high
    panel = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0), ("c", 2.0), ("d", 9.0), ("e", 1.0)],
                                  "e string, v double")
    g = {r.e: r.group for r in A.grouped_median_split(panel, "e", "v").collect()}
    assert g == {"a": "high", "b": "high", "c": "high", "d": "high", "e": "low"}
