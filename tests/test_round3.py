"""Bitmap counts, published tables, model tables, single-pass audit, wide scans of mixed headers, as-of lookup."""
import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepanel.operators import aggregates as A
from tidepanel.operators import linear as L
from tidepanel.sources import sinks as SK


def _long(spark, kind="date"):
    rng = np.random.default_rng(3)
    rows = []
    for e in [None, *"abcdefgh"]:
        for m in ("x", "y", None):
            for k in rng.choice(400, rng.integers(1, 90), replace=False):
                d = dt.date(1969, 6, 1) + dt.timedelta(days=int(k)) if kind == "date" else int(k) - 100 if kind == "int" else f"p{k}"
                rows += [(e, d, m, 1.0)] * int(rng.integers(1, 3))
    rows += [("a", None, "x", 1.0)]
    return spark.createDataFrame(rows, f"entity string, date {kind}, metric string, value double"), pd.DataFrame(rows, columns=["e", "d", "m", "v"])


@pytest.mark.parametrize("kind", ["date", "int", "string"])
def test_bitmap_counts_equal_distinct_counts(spark, kind):
    df, pdf = _long(spark, kind)
    got = A.panel_counts(df).first().asDict()
    per = pdf.groupby("e", dropna=False)["d"].nunique()
    per_m = pdf.groupby(["e", "m"], dropna=False).size()
    assert got == {
        "n_entities": pdf.e.nunique(), "n_periods": pdf.d.nunique(), "n_variables": pdf.m.nunique(), "n_obs": len(pdf), "n_cells": int(per.sum()),
        "min_obs_entity": per.min(), "max_obs_entity": per.max(), "min_obs_entity_metric": per_m.min(), "max_obs_entity_metric": per_m.max(),
        "time_min": pdf.d.dropna().min(), "time_max": pdf.d.dropna().max()}


def test_panel_type_is_equal_periods_per_entity(spark):
    """Equally many periods per entity is balanced, also where they are not the same ones."""
    rows = [("a", 1, "m"), ("a", 2, "m"), ("b", 2, "m"), ("b", 3, "m")]
    df = spark.createDataFrame(rows, "entity string, date int, metric string")
    got = SK.dataset_metadata(df).first()
    assert got["panel_type"] == "balanced" and got["n_cells"] == 4 < got["n_entities"] * got["n_periods"]
    assert SK.dataset_metadata(df.where("not (entity = 'a' and date = 1)")).first()["panel_type"] == "unbalanced"
    none = SK.dataset_metadata(df.limit(0)).first()
    assert (none["n_entities"], none["n_obs"], none["n_cells"]) == (0, 0, 0)


def test_published_names_appear_together(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    df = spark.createDataFrame([("b", 2, 1.5), ("a", 3, None), ("a", 1, 2.5)], "entity string, date int, value double")
    SK.publish_long(df, root, "master", "old_name", ["entity", "date"])
    want = [("a", 1, 2.5), ("a", 3, None), ("b", 2, 1.5)]

    def rows(name):
        return [tuple(r)[:3] for r in SK.read_published(spark, root, name).orderBy("_file", "_place").collect()]
    assert rows("master") == rows("old_name") == want
    # a publication that fails at its alias is never seen
    real = SK.sink_long

    def broken(*a, alias=None, **kw):
        real(*a, **kw)
        raise OSError("lost")
    monkeypatch.setattr(SK, "sink_long", broken)
    with pytest.raises(OSError):
        SK.publish_long(df.limit(1), root, "master", "old_name", ["entity", "date"])
    monkeypatch.undo()
    assert rows("master") == rows("old_name") == want
    SK.publish_long(df.where("date = 2"), root, "master", "old_name", ["entity", "date"])
    assert rows("master") == rows("old_name") == [("b", 2, 1.5)]
    with pytest.raises(FileNotFoundError):
        SK.read_published(spark, root, "other")


def test_models_side_by_side(spark):
    rows = [("m1", "x", 1.0, 0.1, 0.001), ("m1", "z", -1.0, 0.2, 0.2), ("m1", "N", 50.0, None, None), ("m2", "x", 1.1, 0.3, 0.04), ("m2", "N", 40.0, None, None)]
    t = L.models_side_by_side(spark.createDataFrame(rows, "model string, variable string, coef double, se double, pvalue double"), ["m1", "m2"], ["x", "z", "N"])
    assert t.columns == ["variable", *[f"{m}_{c}" for m in ("m1", "m2") for c in ("coef", "se", "pvalue", "stars")]]
    got = {r["variable"]: r for r in t.collect()}
    assert [r["variable"] for r in t.collect()] == ["x", "z", "N"]
    assert got["x"]["m1_coef"] == 1.0 and got["x"]["m2_stars"] == "**" and got["z"]["m2_coef"] is None and got["N"]["m2_coef"] == 40.0


def test_breusch_pagan_of_four_regressors(spark):
    from tidepanel.functions.tails import chi2_sf, f_sf
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 4))
    y = x @ [1, 2, 0.5, -1] + rng.normal(size=500) * np.exp(x[:, 0] * 0.4)
    df = spark.createDataFrame(pd.DataFrame(np.column_stack([x, y]), columns=["a", "b", "c", "d", "y"]))
    got = L.breusch_pagan(df, "y", ["a", "b", "c", "d"])
    z = np.column_stack([np.ones(500), x])
    u2 = (y - z @ np.linalg.lstsq(z, y, rcond=None)[0]) ** 2
    r2 = 1 - ((u2 - z @ np.linalg.lstsq(z, u2, rcond=None)[0]) ** 2).sum() / ((u2 - u2.mean()) ** 2).sum()
    f = r2 / 4 / ((1 - r2) / 495)
    assert got["lm"] == pytest.approx(500 * r2) and got["f"] == pytest.approx(f)
    assert got["lm_pvalue"] == pytest.approx(chi2_sf(500 * r2, 4))
    assert got["f_pvalue"] == pytest.approx(f_sf(f, 4, 495)) and got["f_pvalue"] < 1e-3


def test_audit_observes_the_passes_that_clean(spark):
    """Duplicates with and without values, keep-first by ingest order (not by value), clips; the same counts as the staged audit."""
    from tidepanel.operators import clean as C
    rng = np.random.default_rng(12)
    rows = [(f"e{rng.integers(5)}", int(rng.integers(8)), rng.choice(["x", "y"]).item(), i, None if rng.random() < .3 else float(rng.normal())) for i in range(400)]
    df = spark.createDataFrame(rows, "entity string, date int, metric string, line int, value double").repartition(4)
    keys = ["entity", "date", "metric"]
    clean, audit = C.audited_clean(df, keys, ["line"])
    kept = C.drop_null_measure(df)
    dedup = C.dedupe_keep_first(kept, keys, ["line"])
    win = C.winsorize(dedup, flag="clipped")
    want = C.cleaning_audit({"raw": df, "non_null": kept, "deduped": dedup, "winsorized": win}, ["value"], keys, "clipped")
    assert [tuple(r) for r in audit.collect()] == [tuple(r) for r in want.select(*audit.columns).collect()]
    assert sorted(map(tuple, clean.select(*win.columns).collect())) == sorted(map(tuple, win.collect()))
    firsts = {}
    for e, d, m, line, v in rows:
        if v is not None:
            firsts.setdefault((e, d, m), line)
    assert {(r["entity"], r["date"], r["metric"]): r["line"] for r in clean.collect()} == firsts
    none, empty = C.audited_clean(df.limit(0), keys, ["line"])
    assert none.count() == 0 and [r["n_rows"] for r in empty.collect()] == [0] * 4


def test_wide_files_of_different_headers_in_one_scan(spark, tmp_path):
    """Files with other columns, in another order, quoted cells, a byte order mark, carriage returns, short lines; last line wins."""
    from tidepanel.sources.wide import read_wide_files
    for metric, files in {
        "price": {"a.csv": '﻿RegionID,RegionName,StateName,2000-01-31,2000-02-29\r\n1,"Tampa, FL",FL,1.5,2\r\n2,"Say ""x""",FL,,3\r\n3,Reno,NV,9,9\r\n4, ,FL,1,1\r\n',
                  "b.csv": "StateName,2000-03-31,RegionName,notes\nFL,7,\"Tampa, FL\",1999\nFL,abc,Miami,1\nFL,5\nFL,8,\"Tampa, FL\",2\n"},
        "rent": {"c.csv": "RegionName,StateName,2000-01-31\nMiami,FL,-4.25e1\n", "empty.csv": "", "head.csv": "RegionName,StateName,2001-01-31\n"}}.items():
        (tmp_path / f"metric={metric}").mkdir()
        for name, text in files.items():
            (tmp_path / f"metric={metric}" / name).write_bytes(text.encode())
    got = read_wide_files(spark, str(tmp_path), filters={"StateName": "FL"}).collect()
    d = dt.date
    assert sorted(map(tuple, (r[:4] for r in got))) == sorted([
        ("Tampa, FL", d(2000, 1, 31), "price", 1.5), ("Tampa, FL", d(2000, 2, 29), "price", 2.0), ('Say "x"', d(2000, 2, 29), "price", 3.0),
        ("Tampa, FL", d(2000, 3, 31), "price", 8.0), ("Miami", d(2000, 1, 31), "rent", -42.5)])


def test_asof_of_100000_events(spark):
    """Many events, one group with most of them, against numpy; a tie takes the later date."""
    from tidepanel.operators.joins import asof_merge
    rng = np.random.default_rng(9)
    base = np.datetime64("1990-01-01")
    groups = np.array(["hot"] * 8 + ["a", "b", "none"])
    ev = pd.DataFrame({"event": np.arange(100_000), "g": rng.choice(groups, 100_000), "event_date": (base + rng.integers(0, 9000, 100_000)).astype("datetime64[D]").astype(object)})
    points = {g: np.unique(rng.integers(100, 8900, 700)) for g in ("hot", "a", "b", "other")}
    se = pd.DataFrame([(g, (base + p).astype(object), float(p)) for g, ps in points.items() for p in ps.tolist()], columns=["g", "date", "value"])
    se = pd.concat([se, pd.DataFrame([("hot", None, 1.0), ("a", dt.date(1990, 1, 2), None)], columns=se.columns)])
    series = spark.createDataFrame([tuple(None if v != v else v for v in r) for r in se.itertuples(index=False, name=None)], "g string, date date, value double")
    got = asof_merge(spark.createDataFrame(ev, "event long, g string, event_date date").repartition(8), series, ["g"]).toPandas().sort_values("event")
    assert len(got) == 100_000
    t = (ev.event_date.to_numpy().astype("datetime64[D]") - base).astype(int)
    for g, ps in points.items():
        mine = np.flatnonzero(ev.g.to_numpy() == g)
        if not len(mine):
            continue
        i = np.searchsorted(ps, t[mine])
        lo, hi = ps[np.maximum(i - 1, 0)], ps[np.minimum(i, len(ps) - 1)]
        want = np.where(np.abs(t[mine] - lo) < np.abs(hi - t[mine]), lo, hi)
        assert (got.base_value.to_numpy()[mine] == want).all()
    assert got[got.g == "none"].base_value.isna().all()
    far = asof_merge(spark.createDataFrame([(1, "a", dt.date(2030, 1, 1)), (2, None, dt.date(1990, 1, 1))], "event int, g string, event_date date"), series, ["g"], max_days=30)
    assert [tuple(r)[3:] for r in far.collect()] == [(None, None)] * 2
    one = asof_merge(spark.createDataFrame([(1, dt.date(2000, 1, 3))], "event int, event_date date"),
                     spark.createDataFrame([(dt.date(2000, 1, 1), 1.0), (dt.date(2000, 1, 5), 2.0)], "date date, value double")).first()
    assert one["base_date"] == dt.date(2000, 1, 5)
