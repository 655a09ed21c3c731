"""Linear models from Gram aggregates: two-way fixed effects with unadjusted
and entity-clustered errors, pooled OLS, Breusch-Pagan, VIF, residuals and
Q-Q points.

Every pass over rows is a Spark aggregate; only k x k matrices (regressors)
and vectors over the periods reach the driver.

Two-way fixed effects, exact on unbalanced panels (Frisch-Waugh):
  1. subtract entity means (window over the entity's panel cells);
  2. D'z for every column is a ``groupBy(period).sum``;
  3. the time dummies after entity demeaning have the Gram
     A = D'D - sum_i c_i c_i' / n_i  (c_i = the entity's period indicators),
     which is never formed: A p is one pass over the entities' period lists
     (p at the entity's periods, less their mean, summed by period);
  4. A gamma = D'z by conjugate gradients, preconditioned with the periods'
     counts, all columns and specs in the same passes;
  5. residualise: z - (gamma_t - mean of gamma over the entity's periods);
  6. one Gram aggregate of the residualised columns -> beta and sums of
     squares; one grouped aggregate of scores -> clustered covariance.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.tails import chi2_sf, f_sf, t_sf2
from .joins import domain_values

ABSORBED_TOL = 1e-9
#: Vectors over the periods (and specs) that the driver may hold: 8 bytes each a column.
MAX_PERIODS = 1_000_000
CG_TOL, CG_MAX_ITER = 1e-12, 1000


def gram(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """Sum of products of every column pair, in one aggregate."""
    cols = list(cols)
    k = len(cols)
    aggs = [F.expr(f"sum(`{cols[i]}` * `{cols[j]}`) AS g{i}_{j}") for i in range(k) for j in range(i, k)]
    row = df.agg(*aggs).first()
    g = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            v = row[f"g{i}_{j}"]
            g[i, j] = g[j, i] = 0.0 if v is None else float(v)
    return g


def _grams_by(df: DataFrame, cols: Sequence[str], by: str, entity: str | None = None) -> dict:
    """Per value of ``by``: Gram of ``cols`` (and the row and entity counts),
    all groups in one aggregate."""
    k = len(cols)
    aggs = [F.expr(f"sum(`{cols[i]}` * `{cols[j]}`) AS g{i}_{j}") for i in range(k) for j in range(i, k)]
    extra = [F.count(F.lit(1)).alias("_n")] + ([F.count_distinct(entity).alias("_ne")] if entity else [])
    out = {}
    for row in df.groupBy(by).agg(*extra, *aggs).collect():
        g = np.zeros((k, k))
        for i in range(k):
            for j in range(i, k):
                v = row[f"g{i}_{j}"]
                g[i, j] = g[j, i] = 0.0 if v is None else float(v)
        out[row[by]] = (g, int(row["_n"]), int(row["_ne"]) if entity else None)
    return out


def _gram_times(lists: DataFrame, p: np.ndarray) -> np.ndarray:
    """A p for the period Gram A of ``lists`` (a row an entity: ``at``, its periods) and vectors ``p`` (periods x columns).

    Tasks hand on a row for each period they met, with the sums of their entities.
    """
    n, k = p.shape

    def run(batches):
        acc, met = np.zeros((n, k)), np.zeros(n, bool)
        for b in batches:
            at = b.column(0)
            idx, cuts = at.flatten().to_numpy(), at.offsets.to_numpy()
            cuts = cuts - cuts[0]
            size = np.diff(cuts)
            v = p[idx]
            v -= np.repeat(np.add.reduceat(v, cuts[:-1]) / size[:, None], size, axis=0)
            for j in range(k):
                acc[:, j] += np.bincount(idx, v[:, j], n)
            met[idx] = True
        t = np.flatnonzero(met)
        yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int32)), *(pa.array(acc[t, j]) for j in range(k))],
                                         names=["t", *(f"v{j}" for j in range(k))])

    cols = [f"v{j}" for j in range(k)]
    sums = (lists.mapInArrow(run, "t int, " + ", ".join(f"{c} double" for c in cols))
            .groupBy("t").agg(*[F.sum(c).alias(c) for c in cols]))
    out = np.zeros((n, k))
    for row in sums.collect():  # at most a row a period and spec
        out[row["t"]] = row[1:]
    return out


def _period_effects(lists: DataFrame, counts: np.ndarray, dz: np.ndarray, tol: float = CG_TOL, max_iter: int = CG_MAX_ITER) -> np.ndarray:
    """gamma with A gamma = D'z, for every spec and column: ``counts`` (specs x periods), ``dz`` (specs x periods x columns).

    A is singular by each connected part's constant, which the residuals do not
    see; right-hand sides of demeaned columns lie in its range.
    """
    specs, nt, k = dz.shape
    weight = np.where(counts > 0, 1.0 / np.maximum(counts, 1), 0.0)[:, :, None]
    x, r = np.zeros_like(dz), dz.copy()
    z = weight * r
    p, rz = z, (r * z).sum(1)
    goal = tol * tol * rz
    for _ in range(max_iter):
        if (rz <= goal).all():
            return x
        ap = _gram_times(lists, p.reshape(specs * nt, k)).reshape(dz.shape)
        pap = (p * ap).sum(1)
        alpha = np.where((rz > goal) & (pap > 0), rz / np.where(pap > 0, pap, 1.0), 0.0)
        x += alpha[:, None, :] * p
        r -= alpha[:, None, :] * ap
        z = weight * r
        new = (r * z).sum(1)
        p = z + np.where(rz > 0, new / np.where(rz > 0, rz, 1.0), 0.0)[:, None, :] * p
        rz = np.where(rz > goal, new, rz)
    raise RuntimeError(f"period effects did not settle to {tol} in {max_iter} passes")


@dataclass
class FitResult:
    names: list
    coef: np.ndarray
    se: np.ndarray
    se_clustered: np.ndarray | None
    nobs: int
    df_resid: int
    n_entities: int
    n_periods: int
    ssr: float
    r2: float
    r2_within: float
    r2_within_adj: float
    absorbed: list = field(default_factory=list)
    frame: DataFrame | None = None   # residualised rows (lazy)

    @property
    def tstat(self):
        return self.coef / self.se

    @property
    def pvalue(self):
        return np.array([t_sf2(t, self.df_resid) for t in self.tstat])

    @property
    def pvalue_clustered(self):
        if self.se_clustered is None:
            return None
        return np.array([t_sf2(c / s, self.df_resid) for c, s in zip(self.coef, self.se_clustered)])

    def table(self, spark, model: str = "model") -> DataFrame:
        rows = []
        pc = self.pvalue_clustered
        for j, n in enumerate(self.names):
            f = (lambda v: None if v is None or not np.isfinite(v) else float(v))
            rows.append((model, n, f(self.coef[j]), f(self.se[j]), f(self.pvalue[j]),
                         f(None if self.se_clustered is None else self.se_clustered[j]),
                         f(None if pc is None else pc[j]), int(self.nobs), int(self.df_resid)))
        schema = ("model string, variable string, coef double, se double, pvalue double, "
                  "se_clustered double, pvalue_clustered double, nobs long, df_resid long")
        return spark.createDataFrame(rows, schema)


def _residualize_exact(b: DataFrame, entity: str, cols, nt: int, we):
    """Exact removal of time effects from entity-demeaned columns ``_e_*``,
    for every spec at once."""
    from ..session import cut_lineage, ship_package
    spark = b.sparkSession
    ship_package(spark)
    kk = len(cols)
    sums = b.groupBy("_spec", "_t").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"_e_{c}").alias(c) for c in cols]).collect()
    specs = sorted({row["_spec"] for row in sums}, key=lambda v: (v is not None, v))
    place = {v: i for i, v in enumerate(specs)}
    counts, dz = np.zeros((len(specs), nt)), np.zeros((len(specs), nt, kk))
    for row in sums:  # a row a period and spec
        i = place[row["_spec"]]
        counts[i, row["_t"]] = row["n"]
        dz[i, row["_t"]] = [row[c] for c in cols]
    number = spark.createDataFrame([(v, i) for v, i in place.items()], "_spec string, _i int")
    at = b.groupBy("_spec", entity).agg(F.collect_list("_t").alias("at"))
    lists = cut_lineage(at.join(number, at["_spec"].eqNullSafe(number["_spec"]))
                        .select(F.expr(f"transform(at, t -> cast(_i * {nt} + t as int))").alias("at")), "periods")
    gamma = _period_effects(lists, counts, dz)
    rows = [(v, t, *map(float, gamma[i, t])) for v, i in place.items() for t in np.flatnonzero(counts[i]).tolist()]
    gdf = spark.createDataFrame(rows, "_spec string, _t int, " + ", ".join(f"_g_{c} double" for c in cols))
    r = b.join(gdf, ["_spec", "_t"])
    return r.withColumns({f"_r_{c}": F.col(f"_e_{c}") - (F.col(f"_g_{c}") - F.avg(f"_g_{c}").over(we)) for c in cols})


def _residualize_alternating(b: DataFrame, time: str, cols, we, tol: float = 1e-10,
                             max_iter: int = 500, cut_every: int = 5):
    """Alternating projections (Guimaraes-Portugal / Gaure): subtract period
    means (a ``groupBy(spec, period)`` joined back — never a window over a
    whole period) and entity means (a window over the entity's cells) until
    the largest period mean is below ``tol``; lineage is cut every few sweeps."""
    from ..session import cut_lineage
    cur = b.withColumns({f"_r_{c}": F.col(f"_e_{c}") for c in cols})
    for it in range(max_iter):
        tm = cur.groupBy("_spec", time).agg(*[F.avg(f"_r_{c}").alias(f"_m_{c}") for c in cols])
        cur = (cur.join(tm, ["_spec", time])
               .withColumns({f"_r_{c}": F.col(f"_r_{c}") - F.col(f"_m_{c}") for c in cols})
               .drop(*[f"_m_{c}" for c in cols]))
        cur = cur.withColumns({f"_r_{c}": F.col(f"_r_{c}") - F.avg(f"_r_{c}").over(we) for c in cols})
        if (it + 1) % cut_every == 0:
            cur = cut_lineage(cur)
            means = cur.groupBy("_spec", time).agg(*[F.abs(F.avg(f"_r_{c}")).alias(c) for c in cols])
            worst = means.agg(F.max(F.greatest(*[F.col(c) for c in cols]) if len(cols) > 1
                                    else F.col(cols[0]))).first()[0]
            if worst is None or worst < tol:
                return cur
    raise RuntimeError(f"the period means did not fall below {tol} in {max_iter} sweeps")


def fe_twoway_specs(df: DataFrame, y: str, xs: Sequence[str], spec: str | None = None,
                    entity: str = "entity", time: str = "date", cluster: bool = True,
                    cluster_scale: str = "n_over_df", max_periods: int = MAX_PERIODS,
                    materialize: bool = True, alt_tol: float = 1e-10, alt_max_iter: int = 500,
                    method: str = "exact") -> dict:
    """M1-M4 (and M10): y on xs with entity and time effects, complete cases,
    for every value of the ``spec`` column at once.

    Rows carry the spec they belong to (a sweep stacks its subsamples); every
    pass — demeaning, period sums, the period Gram, the Gram, cluster scores —
    groups by spec as well, so a whole robustness sweep shares one set of
    jobs.  ``method="exact"`` solves for the time effects by conjugate gradients
    (vectors over at most ``max_periods`` periods on the driver, never their
    Gram); ``"alternating"`` projects
    until all period means are below ``alt_tol`` and raises if they do not
    get there.  Returns {spec value: FitResult}.
    """
    from ..session import cut_lineage
    spark = df.sparkSession
    xs = list(xs)
    cols = [y] + xs
    kk = len(cols)
    sp = F.col(spec).cast("string") if spec else F.lit("all")
    base = df.select(sp.alias("_spec"), entity, time, *cols).dropna(subset=cols)
    we = Window.partitionBy("_spec", entity)
    if method not in ("exact", "alternating"):
        raise ValueError("method is exact or alternating")
    if method == "exact":
        times = domain_values(base, time, max_periods)
        tmap = spark.createDataFrame([(t, i) for i, t in enumerate(times)],
                                     T.StructType([T.StructField(time, base.schema[time].dataType),
                                                   T.StructField("_t", T.IntegerType())]))
        b = (base.join(tmap, [time])
             .withColumns({f"_e_{c}": F.col(c) - F.avg(c).over(we) for c in cols}))
        if materialize:
            b = cut_lineage(b)
        r = _residualize_exact(b, entity, cols, len(times), we)
    else:
        b = base.withColumns({f"_e_{c}": F.col(c) - F.avg(c).over(we) for c in cols})
        if materialize:
            b = cut_lineage(b)
        r = _residualize_alternating(b, time, cols, we, tol=alt_tol, max_iter=alt_max_iter)
    rcols = [f"_r_{c}" for c in cols]
    ecols = [f"_e_{c}" for c in cols]
    # one aggregate: both Grams, rows, entities and periods of every spec
    grams = _grams_by(r, rcols + ecols, "_spec", entity)
    n_per = {row["_spec"]: int(row["nt"]) for row in
             b.groupBy("_spec").agg(F.count_distinct(time).alias("nt")).collect()}
    fits: dict = {}
    beta_rows = []
    for s_val, (G, n, n_ent) in grams.items():
        Gr, Ge = G[:kk, :kk], G[kk:, kk:]
        # absorbed regressors: nothing left after removing the effects
        keep = [j for j in range(1, kk) if Gr[j, j] > ABSORBED_TOL * max(Ge[j, j], 1e-300)]
        A = Gr[np.ix_(keep, keep)]
        bvec = Gr[np.ix_(keep, [0])].ravel()
        beta_k = np.linalg.solve(A, bvec) if keep else np.zeros(0)
        fits[s_val] = (G, n, n_ent, keep, A, bvec, beta_k)
        full = np.zeros(kk - 1)
        for pos, j in enumerate(keep):
            full[j - 1] = beta_k[pos]
        beta_rows.append((s_val, *[float(v) for v in full]))
    bdf = spark.createDataFrame(beta_rows, "_spec string, " + ", ".join(f"_b{j} double" for j in range(1, kk)))
    r = r.join(F.broadcast(bdf), ["_spec"])
    u = F.col(rcols[0])
    fitted = F.lit(0.0)
    for j in range(1, kk):
        u = u - F.col(f"_b{j}") * F.col(rcols[j])
        fitted = fitted + F.col(f"_b{j}") * F.col(cols[j])
    r = r.withColumn("_u", u)
    scores_by = {}
    if cluster:
        scores = r.groupBy("_spec", entity).agg(*[F.sum(F.col(rcols[j]) * F.col("_u")).alias(f"_s{j}")
                                                  for j in range(1, kk)])
        scores_by = {k: v[0] for k, v in _grams_by(scores, [f"_s{j}" for j in range(1, kk)], "_spec").items()}
    frame_all = r.select("_spec", entity, time, *cols, F.col("_u").alias("resid"), fitted.alias("fitted"))
    out = {}
    for s_val, (G, n, n_ent, keep, A, bvec, beta_k) in fits.items():
        Gr, Ge = G[:kk, :kk], G[kk:, kk:]
        nt = n_per[s_val]
        ssr = float(Gr[0, 0] - 2 * beta_k @ bvec + beta_k @ A @ beta_k)
        k_eff = len(keep)
        df_resid = n - k_eff - (n_ent + nt - 1)
        s2 = ssr / df_resid
        ainv = np.linalg.inv(A) if keep else np.zeros((0, 0))
        se_k = np.sqrt(np.diag(ainv) * s2)
        coef = np.full(len(xs), np.nan)
        se = np.full(len(xs), np.nan)
        for pos, j in enumerate(keep):
            coef[j - 1], se[j - 1] = beta_k[pos], se_k[pos]
        # within R^2: beta applied to entity-demeaned data (time effects left in)
        Ae = Ge[np.ix_(keep, keep)]
        be = Ge[np.ix_(keep, [0])].ravel()
        ssr_w = float(Ge[0, 0] - 2 * beta_k @ be + beta_k @ Ae @ beta_k)
        r2_w = 1.0 - ssr_w / Ge[0, 0] if Ge[0, 0] > 0 else float("nan")
        r2_w_adj = 1.0 - (1.0 - r2_w) * (n - 1) / (n - k_eff - 1)
        r2 = 1.0 - ssr / Gr[0, 0] if Gr[0, 0] > 0 else float("nan")
        se_c = None
        if cluster and keep:
            sel = [j - 1 for j in keep]
            B = scores_by[s_val][np.ix_(sel, sel)]
            scale = n / df_resid if cluster_scale == "n_over_df" else 1.0
            V = ainv @ B @ ainv * scale
            se_c = np.full(len(xs), np.nan)
            for pos, j in enumerate(keep):
                se_c[j - 1] = np.sqrt(V[pos, pos])
        absorbed = [cols[j] for j in range(1, kk) if j not in keep]
        frame = frame_all.where(F.col("_spec") == F.lit(s_val)).drop("_spec")
        out[s_val] = FitResult(xs, coef, se, se_c, n, df_resid, n_ent, nt, ssr, r2, r2_w, r2_w_adj,
                               absorbed, frame)
    return out


def fe_twoway(df: DataFrame, y: str, xs: Sequence[str], entity: str = "entity", time: str = "date",
              cluster: bool = True, cluster_scale: str = "n_over_df",
              max_periods: int = MAX_PERIODS, materialize: bool = True,
              alt_tol: float = 1e-10, alt_max_iter: int = 500, method: str = "exact") -> FitResult:
    """M1-M4: one fit (the single-spec case of ``fe_twoway_specs``)."""
    return fe_twoway_specs(df, y, xs, None, entity, time, cluster, cluster_scale, max_periods,
                           materialize, alt_tol, alt_max_iter, method)["all"]


@dataclass
class OLSResult:
    names: list
    coef: np.ndarray
    se: np.ndarray
    nobs: int
    r2: float
    ssr: float

    @property
    def pvalue(self):
        return np.array([t_sf2(c / s, self.nobs - len(self.names)) for c, s in zip(self.coef, self.se)])


def pooled_ols(df: DataFrame, y: str, xs: Sequence[str], const: bool = True) -> OLSResult:
    """M5: OLS (with a constant by default): one pass for the means, one
    Gram aggregate of the centred columns (better conditioned than raw)."""
    xs = list(xs)
    d = df.select(*[F.col(c).cast("double").alias(c) for c in xs], F.col(y).cast("double").alias("_y")).dropna()
    cols = xs + ["_y"]
    if const:
        means = d.agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(c) for c in cols]).first()
        n = int(means["_n"])
        mu = np.array([means[c] for c in cols])
        d = d.select(*[(F.col(c) - F.lit(float(m))).alias(c) for c, m in zip(cols, mu)])
    G = gram(d, cols)
    if not const:
        n = d.count()
    k = len(xs)
    A, b, yy = G[:k, :k], G[:k, k], G[k, k]
    beta = np.linalg.solve(A, b)
    ssr = float(yy - 2 * beta @ b + beta @ A @ beta)
    p = k + (1 if const else 0)
    s2 = ssr / (n - p)
    ainv = np.linalg.inv(A)
    if const:
        xbar = mu[:k]
        c0 = mu[k] - beta @ xbar
        var_c0 = s2 / n + xbar @ ainv @ xbar * s2
        coef = np.concatenate([[c0], beta])
        se = np.concatenate([[np.sqrt(var_c0)], np.sqrt(np.diag(ainv) * s2)])
        names = ["const"] + xs
        tss = yy
    else:
        coef, se, names, tss = beta, np.sqrt(np.diag(ainv) * s2), xs, yy
    return OLSResult(names, coef, se, n, 1.0 - ssr / tss, ssr)


def models_side_by_side(table: DataFrame, models: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """A long table (model, variable, coef, se, pvalue) with the models beside each other: a row per variable, in the
    order given, and ``<model>_coef``, ``_se``, ``_pvalue``, ``_stars`` (null where a model has no such value)."""
    from ..functions.scalar import sig_stars
    cells = (table.withColumn("stars", sig_stars("pvalue")).groupBy("variable").pivot("model", list(models))
             .agg(*[F.first(c).alias(c) for c in ("coef", "se", "pvalue", "stars")]))
    order = F.array_position(F.array(*[F.lit(v) for v in variables]), F.col("variable"))
    return cells.orderBy(order)


def residual_column(y: str, names: Sequence[str], coef) -> "F.Column":
    u = F.col(y)
    for n, c in zip(names, coef):
        u = u - (F.lit(float(c)) if n == "const" else F.lit(float(c)) * F.col(n))
    return u


def breusch_pagan(df: DataFrame, y: str, xs: Sequence[str]) -> dict:
    """M6: LM = n R^2 of u^2 on [1, X]; F = (R^2/k)/((1-R^2)/(n-k-1))."""
    xs = list(xs)
    fit = pooled_ols(df, y, xs)
    d = df.select(*xs, y).dropna().withColumn("_u2", F.pow(residual_column(y, fit.names, fit.coef), 2))
    aux = pooled_ols(d, "_u2", xs)
    n, k = aux.nobs, len(xs)
    lm = n * aux.r2
    fstat = (aux.r2 / k) / ((1.0 - aux.r2) / (n - k - 1))
    return {"lm": lm, "lm_pvalue": chi2_sf(lm, k), "f": fstat, "f_pvalue": f_sf(fstat, k, n - k - 1), "nobs": n}


def vif(df: DataFrame, xs: Sequence[str]) -> list:
    """M7: variance inflation, uncentered (no constant): G_jj * inv(G)_jj."""
    xs = list(xs)
    G = gram(df.select(*xs).dropna(), xs)
    inv = np.linalg.inv(G)
    return [(x, float(G[j, j] * inv[j, j])) for j, x in enumerate(xs)]


def qq_points(resid: DataFrame, value: str = "resid") -> DataFrame:
    """M9: ordered residuals against normal order-statistic medians.

    Global ranks come from the range-partitioned rank (no single-task sort);
    positions (i - 0.3175)/(n + 0.365) with the two end points
    1 - 0.5^(1/n) and 0.5^(1/n); the inverse normal is an Acklam rational
    approximation written as column arithmetic (JVM side).
    """
    from .quantile import global_rank
    rk = global_rank(resid.select(F.col(value).alias("_v")), [], "_v")
    i = F.col("_rank") + 1
    n = F.col("_n")
    p = (F.when(i == 1, 1 - F.pow(F.lit(0.5), 1.0 / n))
         .when(i == n, F.pow(F.lit(0.5), 1.0 / n))
         .otherwise((i - 0.3175) / (n + 0.365)))
    return rk.select(F.col("_rank").alias("rank"), F.col("_v").alias("sample"), norm_ppf_col(p).alias("theoretical"))


# Coefficients of Acklam's rational approximation to the
# inverse normal CDF (relative error below 1.15e-9).
_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771972e+01, -1.328068155288572e+01)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
      3.754408661907416e+00)


def _horner(coefs, x):
    out = F.lit(coefs[0])
    for c in coefs[1:]:
        out = out * x + F.lit(c)
    return out


def norm_ppf_col(p):
    lo = 0.02425
    q_low = F.sqrt(-2 * F.log(p))
    q_high = F.sqrt(-2 * F.log(1 - p))
    q = p - 0.5
    rr = q * q
    low = _horner(_C, q_low) / (_horner(_D, q_low) * q_low + 1)
    high = -_horner(_C, q_high) / (_horner(_D, q_high) * q_high + 1)
    mid = _horner(_A, rr) * q / (_horner(_B, rr) * rr + 1)
    return F.when(p < lo, low).when(p > 1 - lo, high).otherwise(mid)
