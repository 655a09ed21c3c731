"""ADF and Hannan-Rissanen forecasts on one whole array, by least squares: what the sliced operators are held against."""
import math

import numpy as np

from tidepanel.functions.tails import adf_pvalue
from tidepanel.operators.forecast import Z95


def ols(x: np.ndarray, y: np.ndarray):
    """Least squares: coefficients, sum of squared residuals, (X'X)^+."""
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    u = y - x @ beta
    return beta, float(u @ u), np.linalg.pinv(x.T @ x)


def lags(x: np.ndarray, n: int) -> np.ndarray:
    """Columns x(t-1) .. x(t-n), NaN where they reach before the start."""
    out = np.full((len(x), n), np.nan)
    for j in range(1, min(n, len(x) - 1) + 1):
        out[j:, j - 1] = x[:-j]
    return out


def adf(x: np.ndarray, max_lag: int | None = None):
    """(stat, used lag, nobs, AIC), or None if the series is too short or constant.

    Up to ceil(12 (n/100)^1/4) lags, at most half the series.  The test does
    not depend on the level, so the series is centred first.
    """
    n = len(x)
    most = max(0, min(math.ceil(12.0 * (n / 100.0) ** 0.25), n // 2 - 2))
    if max_lag is not None:
        most = min(most, max_lag)
    if n < 4:
        return None
    x = x - x.mean()
    dx = np.diff(x)
    full = np.column_stack([np.ones(n - 1), x[:-1], lags(dx, most)])
    best, ic = 0, math.inf
    nobs = n - 1 - most
    for p in range(most + 1):
        _, ssr, _ = ols(full[most:, :2 + p], dx[most:])
        aic = nobs * (math.log(2 * math.pi) + math.log(max(ssr, 1e-300) / nobs) + 1) + 2 * (2 + p)
        if aic < ic - 1e-12:
            best, ic = p, aic
    beta, ssr, inv = ols(full[best:, :2 + best], dx[best:])
    free = n - 1 - best - (2 + best)
    var = ssr / free * inv[1, 1] if free > 0 else 0.0
    if not var > 0:
        return None
    return float(beta[1] / math.sqrt(var)), best, n - 1 - best, float(ic)


def psi_weights(phi, theta, d, h):
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


def arma(w: np.ndarray, const: bool, max_p: int, max_q: int, ar_order: int):
    """(p, q, c, phi, theta, sigma2, aic, innovations) by two regressions, or None if the series is too short.

    A long autoregression gives the innovations; a regression on lags of both
    then serves every order, and AIC picks one.
    """
    if len(w) <= 2 * ar_order + 2:
        return None
    wl = lags(w, max(ar_order, max_p))
    one = np.ones((len(w), 1))
    e = np.full(len(w), np.nan)
    design = np.hstack([one, wl[:, :ar_order]])[ar_order:]
    beta, _, _ = ols(design, w[ar_order:])
    e[ar_order:] = w[ar_order:] - design @ beta
    start = ar_order + max_q
    full, y = np.hstack([one, wl[:, :max_p], lags(e, max_q)])[start:], w[start:]
    m, best = len(y), None
    for p in range(max_p + 1):
        for q in range(max_q + 1):
            idx = ([0] if const else []) + list(range(1, 1 + p)) + list(range(1 + max_p, 1 + max_p + q))
            if m <= len(idx) + 1:
                continue
            beta, ssr = (ols(full[:, idx], y)[:2] if idx else (np.zeros(0), float(y @ y)))
            aic = m * math.log(max(ssr, 1e-300) / m) + 2 * (len(idx) + 1)
            if best is None or aic < best[6] - 1e-12:
                coef = dict(zip(idx, beta))
                best = (p, q, coef.get(0, 0.0), [coef[j] for j in range(1, 1 + p)],
                        [coef[1 + max_p + j] for j in range(q)], ssr / m, aic)
    return None if best is None else (*best, np.nan_to_num(e))


def forecast(y: np.ndarray, h: int, max_p: int, max_q: int, max_d: int, ar_order: int):
    """(p, d, q, aic, mean, half width of the 95 % band) for h steps after y, or None if y is too short."""
    levels = [np.diff(y, n=d) for d in range(max_d + 1)]
    tests = [adf(x) for x in levels]
    d = next((i for i, t in enumerate(tests) if t is not None and adf_pvalue(t[0]) < 0.05), max_d)
    fit = arma(levels[d], d == 0, max_p, max_q, ar_order)
    if fit is None:
        return None
    p, q, c, phi, theta, sigma2, aic, e = fit
    w, e = list(levels[d]), list(e)
    for _ in range(h):
        w.append(c + sum(phi[i] * w[-1 - i] for i in range(p)) + sum(theta[j] * e[-1 - j] for j in range(q)))
        e.append(0.0)
    mean = np.array(w[len(levels[d]):])
    for i in range(d - 1, -1, -1):  # integrate from the last observed value of each level
        mean = np.cumsum(mean) + levels[i][-1]
    return p, d, q, float(aic), mean, Z95 * np.sqrt(sigma2 * np.cumsum(psi_weights(phi, theta, d, h) ** 2))
