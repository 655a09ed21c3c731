"""Cleaning, quantiles and the semantics ledger."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepanel.operators import clean as C
from tidepanel.operators.quantile import quantile_table


def test_quantiles_worked_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    q = quantile_table(df, [], "v", [0.01, 0.5, 0.99], ["a", "b", "c"]).first()
    assert q.a == pytest.approx(1.03) and q.b == pytest.approx(2.5) and q.c == pytest.approx(9.79)


def test_quantiles_hot_group_match_pandas(spark):
    rng = np.random.default_rng(7)
    g = np.where(rng.random(6000) < 0.6, "hot", rng.choice(["a", "b", "c"], 6000))
    v = rng.normal(size=6000).round(3)
    pdf = pd.DataFrame({"g": g, "v": v})
    df = spark.createDataFrame(pdf).repartition(7)
    probs = [0.01, 0.25, 0.5, 0.9, 0.99]
    got = {r.g: r for r in quantile_table(df, ["g"], "v", probs, ["p1", "p25", "p50", "p90", "p99"]).collect()}
    for key, grp in pdf.groupby("g"):
        want = grp.v.quantile(probs).values
        have = [got[key][c] for c in ["p1", "p25", "p50", "p90", "p99"]]
        assert np.allclose(have, want, rtol=0, atol=1e-12)
        assert got[key].n == len(grp)


def test_winsorize_small_group_untouched(spark):
    rows = [("few", float(i)) for i in range(9)] + [("many", float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "metric string, value double")
    out = C.winsorize(df, flag="clipped")
    few = [r.value for r in out.where("metric = 'few'").collect()]
    assert sorted(few) == [float(i) for i in range(9)]
    many = pd.Series(range(100), dtype=float)
    lo, hi = many.quantile(0.01), many.quantile(0.99)
    vals = sorted(r.value for r in out.where("metric = 'many'").collect())
    assert vals[0] == pytest.approx(lo) and vals[-1] == pytest.approx(hi)
    assert out.where("clipped").count() == 2


def test_dedupe_keep_first_is_fixpoint(spark):
    rows = [(1, 1, 5.0, "b"), (1, 1, 3.0, "a"), (1, 2, 9.0, "c"), (2, 1, 1.0, "z")]
    df = spark.createDataFrame(rows, "k1 int, k2 int, o double, x string")
    once = C.dedupe_keep_first(df, ["k1", "k2"], ["o"])
    assert sorted(tuple(r) for r in once.collect()) == [(1, 1, 3.0, "a"), (1, 2, 9.0, "c"), (2, 1, 1.0, "z")]
    twice = C.dedupe_keep_first(once, ["k1", "k2"], ["o"])
    assert sorted(tuple(r) for r in twice.collect()) == sorted(tuple(r) for r in once.collect())


def test_null_drop_and_key_check(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), (None, 2.0)], "entity string, value double")
    kept = C.drop_null_measure(df)
    assert kept.count() == 2 and C.drop_null_measure(kept).count() == 2
    with pytest.raises(ValueError):
        C.key_not_null_check(df, ["entity"])


def test_exclude_window_both_ends(spark):
    df = spark.createDataFrame([("2020-02-29",), ("2020-03-01",), ("2020-05-31",), ("2020-06-01",)], "d string") \
        .withColumn("d", F.to_date("d"))
    out = sorted(str(r.d) for r in C.exclude_window(df, "d", "2020-03-01", "2020-05-31").collect())
    assert out == ["2020-02-29", "2020-06-01"]


def test_threshold_tie_goes_high(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", 3.0)], "e string, v double")
    got = {r.e: r.category for r in C.threshold_category(df, "v").collect()}
    assert got == {"a": "Resilient", "b": "Sensitive", "c": "Sensitive", "d": "Sensitive"}


def test_sentinels_and_tolerant_cast(spark):
    from tidepanel.functions.scalar import sentinel_int, tolerant_double
    df = spark.createDataFrame([("-99",), ("-999",), ("",), ("x",), ("35",)], "s string")
    assert [r[0] for r in df.select(sentinel_int("s")).collect()] == [None, None, None, None, 35]
    assert [r[0] for r in df.select(tolerant_double("s")).collect()] == [-99.0, -999.0, None, None, 35.0]


def test_selection_of_awkward_values(spark):
    """Heavy tails, ties, infinities, huge ranges, null and NaN values, null keys, a hot group, groups of any size."""
    rng = np.random.default_rng(17)
    groups = {
        "hot": rng.normal(size=60_000), "heavy": np.exp(rng.normal(size=20_000) * 40), "ties": rng.integers(0, 3, 9000).astype(float),
        "wide": np.concatenate([rng.normal(size=5000) * 1e-300, [1.7e308, -1.7e308]]), "inf": np.concatenate([np.full(1500, np.inf), rng.normal(size=3000), [-np.inf] * 900]),
        "one": np.array([4.5]), "const": np.full(3000, -2.0), None: rng.normal(size=2500), "big": 1e15 + rng.integers(0, 7, 4000), "two": np.array([1.0, 2.0]),
    } | {f"g{i}": rng.normal(size=i + 1) for i in range(40)}
    pdf = pd.concat([pd.DataFrame({"g": [g] * len(v), "v": v}) for g, v in groups.items()], ignore_index=True)
    extra = [("hot", None), ("none", None), ("two", float("nan"))]
    df = spark.createDataFrame([*pdf.itertuples(index=False, name=None), *extra], "g string, v double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.613, 0.99, 1.0]
    got = {r["g"]: r for r in quantile_table(df, ["g"], "v", probs, list("pqrstuv")).collect()}
    assert set(got) == set(groups)
    for g, v in groups.items():
        v = np.sort(v)
        assert got[g]["n"] == len(v)
        for p, name in zip(probs, "pqrstuv"):
            h = p * (len(v) - 1)
            lo, hi = v[int(np.floor(h))], v[int(np.ceil(h))]
            want = lo if lo == hi else lo + (hi - lo) * (h - np.floor(h))
            assert got[g][name] == pytest.approx(want, rel=1e-12, abs=0), (g, p)
    whole = quantile_table(df, [], "v", [0.5], ["m"]).first()
    assert whole["m"] == pytest.approx(np.median(pdf.v)) and whole["n"] == len(pdf)
    assert quantile_table(df.limit(0), ["g"], "v", [0.5]).count() == 0


def test_selection_shuffles_counts_only(spark, tmp_path):
    """Over a million rows in two groups, every exchange is of at most buckets and picked rows."""
    path = str(tmp_path / "t")
    spark.range(1_000_000).selectExpr("id % 2 as g", "pmod(xxhash64(id), 1000003) * 0.5 as v").write.parquet(path)
    q = quantile_table(spark.read.parquet(path), ["g"], "v", [0.25, 0.5])
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan
    want = spark.read.parquet(path).groupBy("g").agg(F.percentile("v", F.lit(0.25)), F.percentile("v", F.lit(0.5)))
    assert sorted((r["g"], r["q25"], r["q50"]) for r in q.collect()) == sorted(map(tuple, want.collect()))
