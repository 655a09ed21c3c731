"""Models against dense numpy solves and published identities."""
import numpy as np
import pandas as pd
import pytest

from tidepanel.functions.tails import adf_pvalue, chi2_sf, f_sf, t_sf2
from tidepanel.operators import linear as L


def _panel(seed=1, ne=10, nt=14, drop=0.25):
    rng = np.random.default_rng(seed)
    rows = []
    for e in range(ne):
        for t in range(nt):
            if rng.random() < drop:
                continue
            x1, x2 = rng.normal(), rng.normal()
            rows.append((f"e{e}", t, float(x1), float(x2), float(0.5 * x1 - 0.3 * x2 + 0.2 * e + 0.3 * np.cos(t) + rng.normal() * 0.4)))
    return pd.DataFrame(rows, columns=["entity", "date", "x1", "x2", "y"])


def test_fe_twoway_matches_dummy_regression(spark):
    pdf = _panel()
    res = L.fe_twoway(spark.createDataFrame(pdf), "y", ["x1", "x2"])
    E = pd.get_dummies(pdf.entity).astype(float).values
    T = pd.get_dummies(pdf.date, drop_first=True).astype(float).values
    X = np.column_stack([pdf[["x1", "x2"]].values, E, T])
    b = np.linalg.lstsq(X, pdf.y.values, rcond=None)[0]
    u = pdf.y.values - X @ b
    df = len(pdf) - X.shape[1]
    XtXi = np.linalg.pinv(X.T @ X)
    se = np.sqrt(np.diag(XtXi) * (u @ u) / df)
    assert np.allclose(res.coef, b[:2], atol=1e-10)
    assert np.allclose(res.se, se[:2], atol=1e-10)
    assert res.df_resid == df
    ents = pdf.entity.str[1:].astype(int).values
    S = np.zeros((ents.max() + 1, X.shape[1]))
    np.add.at(S, ents, X * u[:, None])
    V = XtXi @ (S.T @ S) @ XtXi * len(pdf) / df
    assert np.allclose(res.se_clustered, np.sqrt(np.diag(V))[:2], atol=1e-10)


def test_absorbed_regressor_is_null(spark):
    pdf = _panel(seed=2, drop=0.0)
    pdf["common"] = pdf.date * 0.37          # same for every entity in a period: absorbed
    res = L.fe_twoway(spark.createDataFrame(pdf), "y", ["x1", "common"])
    assert np.isnan(res.coef[1]) and "common" in res.absorbed and np.isfinite(res.coef[0])


def test_pooled_ols_vif_bp_against_numpy(spark):
    pdf = _panel(seed=3, drop=0.0)
    df = spark.createDataFrame(pdf)
    fit = L.pooled_ols(df, "y", ["x1", "x2"])
    X = np.column_stack([np.ones(len(pdf)), pdf.x1, pdf.x2])
    b = np.linalg.lstsq(X, pdf.y, rcond=None)[0]
    u = pdf.y - X @ b
    se = np.sqrt(np.diag(np.linalg.inv(X.T @ X)) * (u @ u) / (len(pdf) - 3))
    assert np.allclose(fit.coef, b) and np.allclose(fit.se, se)
    G = X[:, 1:].T @ X[:, 1:]
    vif = {n: v for n, v in L.vif(df, ["x1", "x2"])}
    inv = np.linalg.inv(G)
    assert vif["x1"] == pytest.approx(G[0, 0] * inv[0, 0]) and vif["x2"] == pytest.approx(G[1, 1] * inv[1, 1])
    bp = L.breusch_pagan(df, "y", ["x1", "x2"])
    u2 = u ** 2
    ba = np.linalg.lstsq(X, u2, rcond=None)[0]
    r2 = 1 - ((u2 - X @ ba) ** 2).sum() / ((u2 - u2.mean()) ** 2).sum()
    assert bp["lm"] == pytest.approx(len(pdf) * r2)
    assert bp["f"] == pytest.approx((r2 / 2) / ((1 - r2) / (len(pdf) - 3)))


def test_published_identities():
    # Breusch-Pagan F from LM (n=2012, k=4) and the t p-values of the table
    lm, n, k = 415.64545241250335, 2012, 4
    r2 = lm / n
    assert (r2 / k) / ((1 - r2) / (n - k - 1)) == pytest.approx(130.641470632665, rel=1e-12)
    assert t_sf2(4.5266566e-05 / 1.800456e-05, 1893) == pytest.approx(0.012014, abs=5e-7)
    assert t_sf2(4.527090e-05 / 1.786775e-05, 1833) == pytest.approx(0.011370, abs=5e-7)
    assert chi2_sf(415.645452, 4) == pytest.approx(1.1575e-88, rel=1e-3)
    assert f_sf(130.641471, 4, 2007) == pytest.approx(2.9399e-99, rel=1e-3)
    assert adf_pvalue(-1.547315) == pytest.approx(0.509989, abs=5e-7)


def test_qq_points(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame(pd.DataFrame({"resid": rng.normal(size=500)}))
    qq = L.qq_points(df).toPandas().sort_values("rank")
    assert len(qq) == 500 and qq["sample"].is_monotonic_increasing and qq["theoretical"].is_monotonic_increasing
    from statistics import NormalDist
    n = 500
    i = np.arange(1, n + 1)
    pos = (i - 0.3175) / (n + 0.365)
    pos[0], pos[-1] = 1 - 0.5 ** (1 / n), 0.5 ** (1 / n)
    want = [NormalDist().inv_cdf(p) for p in pos]
    assert np.allclose(qq["theoretical"], want, atol=1e-8)


def test_fe_alternating_projections_match_exact(spark):
    pdf = _panel(seed=9, ne=8, nt=12, drop=0.2)
    df = spark.createDataFrame(pdf)
    exact = L.fe_twoway(df, "y", ["x1", "x2"])
    alt = L.fe_twoway(df, "y", ["x1", "x2"], method="alternating", alt_tol=1e-12)
    assert np.allclose(alt.coef, exact.coef, atol=1e-8)
    assert np.allclose(alt.se, exact.se, atol=1e-8)
    assert np.allclose(alt.se_clustered, exact.se_clustered, atol=1e-8)
    assert alt.df_resid == exact.df_resid


def test_stacked_specs_equal_separate_fits(spark):
    pdf = _panel(seed=12, ne=9, nt=11, drop=0.15)
    a = pdf.assign(spec="all")
    sub = pdf[pdf.date != 4].assign(spec="no4")
    low = pdf[pdf.entity.isin(["e1", "e2", "e3", "e5"])].assign(spec="some")
    stacked = spark.createDataFrame(pd.concat([a, sub, low], ignore_index=True))
    fits = L.fe_twoway_specs(stacked, "y", ["x1", "x2"], "spec")
    for name, part in (("all", a), ("no4", sub), ("some", low)):
        one = L.fe_twoway(spark.createDataFrame(part.drop(columns="spec")), "y", ["x1", "x2"])
        f = fits[name]
        assert np.allclose(f.coef, one.coef, atol=1e-10) and np.allclose(f.se, one.se, atol=1e-10)
        assert np.allclose(f.se_clustered, one.se_clustered, atol=1e-10)
        assert (f.nobs, f.df_resid, f.n_entities, f.n_periods) == (one.nobs, one.df_resid, one.n_entities, one.n_periods)


def test_fe_of_5000_periods(spark, monkeypatch):
    """An unbalanced panel over 5,000 periods against a dense solve; what reaches the driver is vectors over the periods."""
    rng = np.random.default_rng(21)
    ne, nt, per = 400, 5000, 60
    e = np.repeat(np.arange(ne), per)
    t = np.concatenate([rng.choice(nt, per, replace=False) for _ in range(ne)])
    x = rng.normal(size=(len(e), 2)) + 0.3 * np.sin(t / 50)[:, None] + 0.1 * (e % 7)[:, None]
    y = 0.5 * x[:, 0] - 0.3 * x[:, 1] + np.cos(t / 30) + 0.2 * e + rng.normal(size=len(e))
    pdf = pd.DataFrame({"entity": e, "date": t, "x1": x[:, 0], "x2": x[:, 1], "y": y})
    passes = []
    real = L._gram_times
    monkeypatch.setattr(L, "_gram_times", lambda lists, p: passes.append(p.shape) or real(lists, p))
    res = L.fe_twoway(spark.createDataFrame(pdf), "y", ["x1", "x2"])
    periods, tt = np.unique(t, return_inverse=True)
    z = np.column_stack([y, x])
    z = z - (np.array([np.bincount(e, c) for c in z.T]) / per).T[e]
    c = np.zeros((ne, len(periods)))
    c[e, tt] = 1.0
    gram = np.diag(c.sum(0)) - c.T @ c / per
    gamma = np.linalg.solve(gram + 1.0 / len(periods), np.array([np.bincount(tt, col) for col in z.T]).T)
    r = z - (gamma[tt] - (np.array([np.bincount(e, g) for g in gamma[tt].T]) / per).T[e])
    beta = np.linalg.solve(r[:, 1:].T @ r[:, 1:], r[:, 1:].T @ r[:, 0])
    u = r[:, 0] - r[:, 1:] @ beta
    se = np.sqrt(np.diag(np.linalg.inv(r[:, 1:].T @ r[:, 1:])) * (u @ u) / (len(y) - 2 - (ne + len(periods) - 1)))
    assert res.n_periods == len(periods) > 4900
    assert np.allclose(res.coef, beta, atol=1e-9) and np.allclose(res.se, se, atol=1e-9)
    assert 1 < len(passes) < 100 and set(passes) == {(len(periods), 3)}
