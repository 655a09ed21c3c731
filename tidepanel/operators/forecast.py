"""Grouped time-series tests and forecasts over many series at once.

* ``adf_test`` (M12): augmented Dickey-Fuller with a constant, lag chosen by
  AIC on a common sample, then refitted with the chosen lag.
* ``grouped_forecast`` (M13): ARIMA(p, d, q) by Hannan-Rissanen two-stage
  regression; d from ADF (difference until the unit root is rejected),
  (p, q) by AIC; mean and 95% band from psi-weights.
* ``naive_forecast`` (M14), ``forecast_eval`` and ``forecast_scores`` (M15).

A series of any length is cut into slices of at most SLICE values in date
order, each with a halo of the values before it that its lags reach.  A slice
gives the Gram of its rows of the regression (lags, and the left side); the
Grams of a series are added up in groups of MERGE slices, round by round, and
only the regressor-sized solves run per series.  All lag orders come from one
factor of the Gram.  No series is ever one array.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tails import adf_pvalue
from .quantile import global_rank

Z95 = 1.959963984540054
#: Values of a slice (the halo of ceil(12 (n/100)^1/4) + 3 values is shorter for any n up to 10^14), and slices added up by a task.
SLICE, MERGE = 16_384, 64
#: A column keeps this share of its length, at least, beside those before it; else they explain it.
DEPENDENT = 1e-11


def _most_lags(n: int, max_lag: int | None = None) -> int:
    """Up to ceil(12 (n/100)^1/4) lags, at most half the series."""
    most = max(0, min(math.ceil(12.0 * (max(n, 0) / 100.0) ** 0.25), n // 2 - 2))
    return most if max_lag is None else min(most, max_lag)


def _slices(ranked: DataFrame, skip: int, slice_rows: int, reach: int = 16) -> DataFrame:
    """(s, b, n, mean, lo, y): the first ``n`` = rows - ``skip`` values of each series in slices ``b``; ``y`` starts with the
    halo (``reach`` values at least), at rank ``lo``; ``mean`` is the series'."""
    from ..session import cut_lineage
    t = ranked.select("s", F.col("_rank").alias("r"), (F.col("_n") - skip).alias("n"), "y").where(F.col("r") < F.col("n"))
    halo = F.greatest(F.ceil(12 * F.pow(F.col("n") / 100, F.lit(0.25))) + 3, F.lit(reach))
    own = F.floor(F.col("r") / slice_rows)
    also = (F.col("r") % slice_rows >= slice_rows - halo) & ((own + 1) * slice_rows < F.col("n"))
    cut = (t.withColumn("b", F.explode(F.when(also, F.array(own, own + 1)).otherwise(F.array(own))))
           .groupBy("s", "b", "n").agg(F.sort_array(F.collect_list(F.struct("r", "y"))).alias("v"))
           .select("s", "b", "n", F.col("v")[0]["r"].alias("lo"), F.transform("v", lambda v: v["y"]).alias("y")))
    mean = t.groupBy(F.col("s").alias("_s")).agg(F.avg("y").alias("mean"))
    return cut_lineage(cut.join(mean, F.col("s").eqNullSafe(F.col("_s"))).drop("_s"), "slices")


def _merged(parts: DataFrame, slice_rows: int) -> DataFrame:
    """One row a series of ``parts`` (s, b, n, grams, edge): ``grams`` added up, ``edge`` the one that is there."""
    slices = -(-(parts.agg(F.max("n")).first()[0] or 0) // slice_rows)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        edge = next((e for e in pdf["edge"] if e is not None and len(e)), [])
        out = pdf.iloc[:1].copy()
        out["grams"] = [[np.sum(np.stack(g), axis=0) for g in zip(*pdf["grams"], strict=True)]]
        out["edge"] = [edge]
        return out

    schema = parts.schema
    while slices > 1:
        parts = parts.withColumn("b", F.floor(F.col("b") / MERGE)).groupBy("s", "b").applyInPandas(add, schema)
        slices = -(-slices // MERGE)
    return parts


def _lags(x: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Columns x(t-1) .. x(t-n) at the places ``at``."""
    return x[at[:, None] - np.arange(1, n + 1)[None, :]]


def _gram(*columns: np.ndarray) -> np.ndarray:
    """Products of a constant and all columns, summed over the rows."""
    z = np.column_stack([np.ones(len(columns[-1])), *columns])
    return z.T @ z


class _Level:
    """A slice's values of the ``d``-fold difference: ``x``, the places of its own values ``own``, and the rank ``lo`` of the first."""

    def __init__(self, y: np.ndarray, lo: int, start: int, d: int, mean: float):
        self.x = np.diff(y, n=d) if d else y - mean
        self.lo = lo  # x[i] is value lo + i of the difference
        self.own = np.arange(max(start - d - lo, 0), len(self.x))

    def adf(self, most: int) -> np.ndarray:
        """Gram of 1, x(t-1), dx(t-1) .. dx(t-most), dx(t), over t that have all of them."""
        at = self.own[self.own + self.lo >= most + 1]
        dx = np.diff(self.x)
        return _gram(self.x[at - 1], _lags(dx, at - 1, most), dx[at - 1])

    def ar(self, order: int) -> np.ndarray:
        """Gram of 1, x(t-1) .. x(t-order), x(t)."""
        at = self.own[self.own + self.lo >= order]
        return _gram(_lags(self.x, at, order), self.x[at])

    def innovations(self, beta: np.ndarray) -> np.ndarray:
        """What the autoregression ``beta`` (constant first) leaves of x; NaN where its lags are not at hand."""
        order = len(beta) - 1
        e = np.full(len(self.x), np.nan)
        at = np.arange(order, len(self.x))
        if len(at):
            e[at] = self.x[at] - beta[0] - _lags(self.x, at, order) @ beta[1:]
        return e


def _factor(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower factor of the Gram scaled to a unit diagonal, and the scale; a column that those before it explain has a zero pivot."""
    scale = np.sqrt(np.diag(gram))
    scale[scale == 0] = 1.0
    a = gram / scale[:, None] / scale[None, :]
    low = np.zeros_like(a)
    for j in range(len(a)):
        c = a[j:, j] - low[j:, :j] @ low[j, :j]
        if c[0] > DEPENDENT:
            low[j:, j] = c / math.sqrt(c[0])
    return low, scale


def _regress(gram: np.ndarray, columns: list[int]) -> tuple[np.ndarray, float]:
    """Coefficients of ``columns`` for the last one, and the sum of squared residuals."""
    yy = gram[-1, -1]
    if not columns:
        return np.zeros(0), float(yy)
    scale = np.sqrt(np.diag(gram)[columns])
    scale[scale == 0] = 1.0
    a = gram[np.ix_(columns, columns)] / scale[:, None] / scale[None, :]
    b = gram[columns, -1] / scale
    beta = np.linalg.lstsq(a, b, rcond=DEPENDENT)[0]
    return beta / scale, float(max(yy - beta @ b, 0.0))


def _adf_stat(gram: np.ndarray, n: int, most: int, first: np.ndarray):
    """(stat, used lag, nobs, AIC), or None if the series is too short or constant.

    ``gram``: 1, x(t-1), lags 1 to ``most`` and dx(t) on the sample all lags have; ``first``: the values x(0) .. x(most).
    """
    if n < 4:
        return None
    nobs = n - 1 - most
    low, scale = _factor(gram)
    ssr = scale[-1] ** 2 * (1.0 - np.cumsum(low[-1, :-1] ** 2))
    best, ic = 0, math.inf
    for p in range(most + 1):
        aic = nobs * (math.log(2 * math.pi) + math.log(max(ssr[1 + p], 1e-300) / nobs) + 1) + 2 * (2 + p)
        if aic < ic - 1e-12:
            best, ic = p, aic
    keep = [*range(2 + best), len(gram) - 1]
    g = gram[np.ix_(keep, keep)]
    at = np.arange(best + 1, most + 1)  # the rows that fewer lags add at the start
    if len(at):
        dx = np.diff(first)
        g = g + _gram(first[at - 1], _lags(dx, at - 1, best), dx[at - 1])
    free = n - 1 - best - (2 + best)
    if free <= 0:
        return None
    beta, left = _regress(g, list(range(2 + best)))
    scale = np.sqrt(np.diag(g)[:-1])
    scale[scale == 0] = 1.0
    var = left / free * np.linalg.pinv(g[:-1, :-1] / scale[:, None] / scale[None, :], rcond=DEPENDENT, hermitian=True)[1, 1] / scale[1] ** 2
    if not var > 0:
        return None
    return float(beta[1] / math.sqrt(var)), best, n - 1 - best, float(ic)


def _frame(columns: dict) -> pd.DataFrame:
    """Columns of any values, lists among them, also where there is no row."""
    return pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in columns.items()})


_PARTS = "b long, n long, mean double, grams array<array<double>>, edge array<double>"


def _square(flat) -> np.ndarray:
    flat = np.asarray(flat, dtype=np.float64)
    k = math.isqrt(len(flat))
    return flat.reshape(k, k)


def _unit_root_parts(slices: DataFrame, levels: int, max_lag: int | None, ar_order: int, slice_rows: int) -> DataFrame:
    """Per series: for each difference its ADF Gram and (``ar_order`` > 0) its autoregression's; ``edge``: the first values."""
    def run(batches):
        for pdf in batches:
            out = {c: [] for c in ("s", "b", "n", "mean", "grams", "edge")}
            for row in pdf.itertuples(index=False):
                y, grams = np.asarray(row.y), []
                for d in range(levels):
                    level = _Level(y, row.lo, row.b * slice_rows, d, row.mean)
                    grams.append(level.adf(_most_lags(row.n - d, max_lag)).ravel())
                    if ar_order:
                        grams.append(level.ar(ar_order).ravel())
                edge = y[:_most_lags(row.n) + levels + 1] if row.b == 0 else []
                for c, v in zip(out, (row.s, row.b, row.n, row.mean, grams, edge), strict=True):
                    out[c].append(v)
            yield _frame(out)

    kind = slices.schema["s"].dataType.simpleString()
    return _merged(slices.mapInPandas(run, f"s {kind}, {_PARTS}"), slice_rows)


def _ranked_values(df: DataFrame, series: str, date: str, value: str) -> DataFrame:
    """(s, t, y) with ``_rank`` by date and ``_n`` per series; rows without a value or a date take no part, ties go by value."""
    from ..session import ship_package
    ship_package(df.sparkSession)
    src = df.select(F.col(series).alias("s"), F.col(date).alias("t"), F.col(value).cast("double").alias("y"))
    return global_rank(src.where(F.col("y").isNotNull()), ["s"], "t")


def adf_test(df: DataFrame, series: str, date: str, value: str, max_lag: int | None = None, slice_rows: int = SLICE) -> DataFrame:
    """Per series: adf_stat, pvalue, used_lag, nobs, ic_best (AIC).

    The test does not depend on the level, so the series is centred first.  A
    series that is too short for the test, or constant, keeps its row with
    nulls.
    """
    parts = _unit_root_parts(_slices(_ranked_values(df, series, date, value), 0, slice_rows), 1, max_lag, 0, slice_rows)

    def test(batches):
        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False):
                most = _most_lags(row.n, max_lag)
                got = _adf_stat(_square(row.grams[0]), row.n, most, np.asarray(row.edge)[:most + 1] - row.mean)
                stat, lag, nobs, ic = got or (None, None, None, None)
                rows.append((row.s, stat, None if stat is None else adf_pvalue(stat), lag, nobs, ic))
            out = pd.DataFrame(rows, columns=["s", "adf_stat", "pvalue", "used_lag", "nobs", "ic_best"])
            yield out.astype({"adf_stat": "float64", "pvalue": "float64", "ic_best": "float64", "used_lag": "Int32", "nobs": "Int64"})

    kind = parts.schema["s"].dataType.simpleString()
    out = parts.mapInPandas(test, f"s {kind}, adf_stat double, pvalue double, used_lag int, nobs long, ic_best double")
    nulls = [F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in ("adf_stat", "pvalue", "ic_best")]
    return out.select(F.col("s").alias(series), *nulls[:2], "used_lag", F.col("nobs").cast("int").alias("nobs"), nulls[2])


def split_holdout(df: DataFrame, series: str, date: str, holdout: int = 12) -> DataFrame:
    """Add ``is_test``: the last ``holdout`` rows of each series."""
    w = Window.partitionBy(series).orderBy(F.desc(date))
    return df.withColumn("is_test", F.row_number().over(w) <= holdout)


def naive_forecast(df: DataFrame, series: str, date: str, value: str, holdout: int = 12) -> DataFrame:
    """Last training value repeated over the holdout (max_by, no sort).

    A series no longer than the holdout has no training value: its rows stay
    with a null forecast."""
    s = split_holdout(df.where(F.col(value).isNotNull()), series, date, holdout)
    last = (s.where(~F.col("is_test")).groupBy(series)
            .agg(F.max_by(F.col(value), F.col(date)).alias("naive")))
    return (s.where(F.col("is_test")).join(last, [series], "left")
            .select(series, date, F.col(value).alias("actual"), "naive"))


def forecast_eval(pred: DataFrame, actual: str, forecast: str, by=()) -> DataFrame:
    """RMSE and R^2 (1 - SSE/SST) of a forecast column."""
    g = pred.groupBy(*by) if by else pred.groupBy()
    a = F.when(F.col(forecast).isNotNull(), F.col(actual))
    e = F.col(actual) - F.col(forecast)
    sst = F.sum(a * a) - F.sum(a) * F.sum(a) / F.count(a)
    return g.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.try_divide(sst - F.sum(e * e), sst).alias("r2"), F.count(F.lit(1)).alias("n"))


def r2_score(pred: DataFrame, actual: str, forecast: str) -> DataFrame:
    """R^2 on a test set: 1 - SSE / SST, SST around the test mean."""
    m = pred.agg(F.avg(actual).alias("_m"))
    from .joins import attach_scalar
    j = attach_scalar(pred, m)
    e = F.col(actual) - F.col(forecast)
    return j.agg((1 - F.sum(e * e) / F.sum(F.pow(F.col(actual) - F.col("_m"), 2))).alias("r2"),
                 F.sqrt(F.avg(e * e)).alias("rmse"), F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# Hannan-Rissanen ARIMA per series
# ---------------------------------------------------------------------------
def _psi_weights(phi, theta, d, h):
    """psi-weights of ARIMA(p, d, q) up to horizon h (integration folded in)."""
    ar = np.array([1.0] + [-x for x in phi])
    for _ in range(d):
        ar = np.convolve(ar, [1.0, -1.0])
    ma = np.array([1.0] + list(theta))
    psi = np.zeros(h)
    for j in range(h):
        v = ma[j] if j < len(ma) else 0.0
        for i in range(1, min(j, len(ar) - 1) + 1):
            v -= ar[i] * psi[j - i]
        psi[j] = v
    return psi


def _difference_and_ar(row, max_d: int, ar_order: int):
    """(d, autoregression of the d-fold difference, constant first), or None if the series is too short."""
    first, tests = np.asarray(row.edge), []
    for d in range(max_d + 1):
        n, most = row.n - d, _most_lags(row.n - d)
        x = np.diff(first, n=d) if d else first - row.mean
        got = _adf_stat(_square(row.grams[2 * d]), n, most, x[:most + 1])
        tests.append(got is not None and adf_pvalue(got[0]) < 0.05)
    d = tests.index(True) if True in tests else max_d
    if row.n - d <= 2 * ar_order + 2:
        return None
    return d, _regress(_square(row.grams[2 * d + 1]), list(range(1 + ar_order)))[0]


def _orders(gram: np.ndarray, m: int, const: bool, max_p: int, max_q: int):
    """(p, q, c, phi, theta, sigma2, aic) of the least AIC, by regressions on lags of the values and the innovations."""
    best = None
    for p in range(max_p + 1):
        for q in range(max_q + 1):
            idx = ([0] if const else []) + list(range(1, 1 + p)) + list(range(1 + max_p, 1 + max_p + q))
            if m <= len(idx) + 1:
                continue
            beta, ssr = _regress(gram, idx)
            aic = m * math.log(max(ssr, 1e-300) / m) + 2 * (len(idx) + 1)
            if best is None or aic < best[6] - 1e-12:
                coef = dict(zip(idx, beta, strict=True))
                best = (p, q, coef.get(0, 0.0), [coef[j] for j in range(1, 1 + p)], [coef[1 + max_p + j] for j in range(q)], ssr / m, aic)
    return best


def _extrapolated(fit, d: int, beta: np.ndarray, last: np.ndarray, mean: float, h: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and half width of the 95 % band for the h steps after the values ``last``."""
    p, q, c, phi, theta, sigma2, _ = fit
    level = _Level(last, 0, 0, d, mean)
    w, e = list(level.x), list(np.nan_to_num(level.innovations(beta)))
    for _ in range(h):
        w.append(c + sum(phi[i] * w[-1 - i] for i in range(p)) + sum(theta[j] * e[-1 - j] for j in range(q)))
        e.append(0.0)
    out = np.array(w[len(level.x):]) + (mean if d == 0 else 0.0)
    for i in range(d - 1, -1, -1):  # integrate from the last observed value of each level
        out = np.cumsum(out) + (np.diff(last, n=i) if i else last)[-1]
    return out, Z95 * np.sqrt(sigma2 * np.cumsum(_psi_weights(phi, theta, d, h) ** 2))


def _order_parts(slices: DataFrame, max_p: int, max_q: int, ar_order: int, max_d: int, slice_rows: int) -> DataFrame:
    """Per series (with ``d`` and ``beta``): Gram of 1, lags of the values, lags of the innovations, the value; ``edge``: the last values."""
    reach = ar_order + max_q + max_d + max(max_p, 1)

    def run(batches):
        for pdf in batches:
            out = {c: [] for c in ("s", "b", "n", "mean", "grams", "edge", "d", "beta")}
            for row in pdf.itertuples(index=False):
                y, beta = np.asarray(row.y), np.asarray(row.beta)
                level = _Level(y, row.lo, row.b * slice_rows, row.d, row.mean)
                at = level.own[level.own + level.lo >= ar_order + max_q]
                e = level.innovations(beta)
                gram = _gram(_lags(level.x, at, max_p), _lags(e, at, max_q), level.x[at])
                edge = y[-reach:] if row.lo + len(y) == row.n else []
                for c, v in zip(out, (row.s, row.b, row.n, row.mean, [gram.ravel()], edge, row.d, row.beta), strict=True):
                    out[c].append(v)
            yield _frame(out)

    kind = slices.schema["s"].dataType.simpleString()
    return _merged(slices.mapInPandas(run, f"s {kind}, {_PARTS}, d int, beta array<double>"), slice_rows)


def grouped_forecast(df: DataFrame, series: str, date: str, value: str, holdout: int = 12,
                     max_p: int = 4, max_q: int = 4, max_d: int = 2, ar_order: int = 8, slice_rows: int = SLICE) -> DataFrame:
    """Per series, order search and a forecast of the last ``holdout`` values, beside the naive one.

    Differences are taken until ADF rejects a unit root (p < 0.05), at most
    ``max_d``; a long autoregression gives the innovations, a regression on
    lags of both serves every order, and AIC picks one; the band comes from
    psi-weights.  A series too short for the search keeps its rows, with null
    forecasts (and a null naive value if it is no longer than the holdout).
    """
    ranked = _ranked_values(df, series, date, value)
    slices = _slices(ranked, holdout, slice_rows, max(16, ar_order + max_q + max_d + max_p))
    kind = slices.schema["s"].dataType.simpleString()

    def difference(batches):
        for pdf in batches:
            got = [(row.s, *(_difference_and_ar(row, max_d, ar_order) or (None, None))) for row in pdf.itertuples(index=False)]
            got = [g for g in got if g[1] is not None]
            yield _frame({c: [g[k] for g in got] for k, c in enumerate(("_s", "d", "beta"))})

    first = _unit_root_parts(slices, max_d + 1, None, ar_order, slice_rows)
    order = first.mapInPandas(difference, f"_s {kind}, d int, beta array<double>")
    parts = _order_parts(slices.join(order, F.col("s").eqNullSafe(F.col("_s"))).drop("_s"), max_p, max_q, ar_order, max_d, slice_rows)

    def forecast(batches):
        for pdf in batches:
            out = {c: [] for c in ("_s", "p", "d", "q", "aic", "mean", "half")}
            for row in pdf.itertuples(index=False):
                fit = _orders(_square(row.grams[0]), row.n - row.d - ar_order - max_q, row.d == 0, max_p, max_q)
                if fit is not None:
                    mean, half = _extrapolated(fit, row.d, np.asarray(row.beta), np.asarray(row.edge), row.mean, holdout)
                    for c, v in zip(out, (row.s, fit[0], row.d, fit[1], fit[6], mean, half), strict=True):
                        out[c].append(v)
            yield _frame(out)

    fitted = parts.mapInPandas(forecast, f"_s {kind}, p int, d int, q int, aic double, mean array<double>, half array<double>")
    n_train = F.greatest(F.col("_n") - holdout, F.lit(0))
    test = ranked.where(F.col("_rank") >= n_train).select("s", "t", "y", (F.col("_rank") - n_train).cast("int").alias("step"))
    last = ranked.where(F.col("_rank") == F.col("_n") - holdout - 1).select(F.col("s").alias("_ls"), F.col("y").alias("naive"))
    rows = (test.join(last, F.col("s").eqNullSafe(F.col("_ls")), "left")
            .join(fitted, F.col("s").eqNullSafe(F.col("_s")), "left"))
    mean, half = F.col("mean")[F.col("step")], F.col("half")[F.col("step")]
    return rows.select(F.col("s").alias(series), F.col("t").alias(date), F.col("y").alias("actual"), mean.alias("forecast"), (mean - half).alias("lower"),
                       (mean + half).alias("upper"), "naive", "p", "d", "q", "aic")


def forecast_scores(df: DataFrame, series: str, date: str, value: str, holdout: int = 12) -> DataFrame:
    """Per series RMSE and R^2 of the model and of the naive forecast over the holdout."""
    pred = grouped_forecast(df, series, date, value, holdout)
    model = forecast_eval(pred, "actual", "forecast", [series]).select(series, F.col("rmse").alias("rmse_model"), F.col("r2").alias("r2_model"), "n")
    naive = forecast_eval(pred, "actual", "naive", [series]).select(series, F.col("rmse").alias("rmse_naive"), F.col("r2").alias("r2_naive"))
    return model.join(naive, [series])
