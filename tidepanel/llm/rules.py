"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees are grown on statistics of labelled texts; every path
from a root to a node is a rule, a conjunction of threshold conditions.  A
lasso logistic regression over the rules keeps few of them, and these are
compiled into one Spark column, so scoring a corpus is a projection: no join,
no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, bucket_of, column, together

#: Labelled rows the model is fitted on, at most: those with the smallest hash of their id.
MAX_TRAINING_ROWS = 20_000


def _per(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _hits(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


#: The statistics a rule may look at; all come from the text alone.
FEATURES = ("log_chars", "log_words", "word_length", "distinct", "repeated", "upper", "digits", "symbols",
            "exclaims", "bars", "ends", "commas", "lines")


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``_q_<name>`` for each of FEATURES; a null text counts as empty, and all ratios of an empty text are 0."""
    t = F.col("_q_text")
    words = F.col("_q_words")
    df = docs.withColumn("_q_text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    df = df.withColumn("_q_words", F.filter(F.split(t, r"\s+"), lambda w: w != ""))
    chars, n = F.length(t).cast("double"), F.size(words).cast("double")
    df = df.select(
        "*", chars.alias("_q_n"), n.alias("_q_w"), F.size(F.array_distinct(words)).cast("double").alias("_q_u"),
        _hits(t, r"(?<!\S)(\S++)\s++(?=\1(?!\S))").alias("_q_r"), _hits(t, r"\p{Lu}").alias("_q_cap"),
        _hits(t, r"\p{N}").alias("_q_num"), _hits(t, r"[^\p{L}\p{M}\p{N}\s.,;:'’()\-]").alias("_q_sym"),
        _hits(t, "!").alias("_q_exc"), _hits(t, r"\|").alias("_q_bar"), _hits(t, r"[.?!](?!\S)").alias("_q_end"),
        _hits(t, ",").alias("_q_com"), _hits(t, r"\n").alias("_q_lin"))
    c = lambda k: F.col(f"_q_{k}")
    made = {"log_chars": F.log1p(c("n")), "log_words": F.log1p(c("w")), "word_length": _per(c("n"), c("w")),
            "distinct": _per(c("u"), c("w")), "repeated": _per(c("r"), c("w")), "upper": _per(c("cap"), c("n")),
            "digits": _per(c("num"), c("n")), "symbols": _per(c("sym"), c("n")), "exclaims": _per(c("exc"), c("w")),
            "bars": _per(c("bar"), c("w")), "ends": _per(c("end"), c("w")), "commas": _per(c("com"), c("w")),
            "lines": _per(c("lin"), c("w"))}
    return df.select(*[F.col(f"`{x}`") for x in docs.columns], *[made[f].alias(f"_q_{f}") for f in FEATURES])


Condition = tuple[int, float, bool]  # feature, threshold, whether the value lies above it


@dataclass(frozen=True)
class RuleModel:
    """Logistic model over rules: ``rules[i]`` holds -> ``weights[i]`` is added to ``bias``."""

    bias: float
    rules: tuple[tuple[Condition, ...], ...]
    weights: tuple[float, ...]

    def column(self) -> Column:
        """Probability of label 1 as one expression over the ``_q_`` columns."""
        total = F.lit(float(self.bias))
        for rule, w in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for f, cut, above in rule:
                x = F.col(f"_q_{FEATURES[f]}")
                holds = holds & ((x > cut) if above else (x <= cut))
            total = total + F.when(holds, F.lit(float(w))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def grow_paths(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, bins: int = 32, rate: float = 0.3,
               min_rows: int = 20, seed: int = 5) -> list[tuple[Condition, ...]]:
    """Root-to-node paths of gradient-boosted trees, each grown on a random half of the rows."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    code = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(cuts, x.T, strict=True)])  # value <= cut[b] <=> code <= b
    score = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    paths: list[tuple[Condition, ...]] = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        half = rng.random(len(y)) < 0.5
        leaves = [(half, np.ones(len(y), bool), ())]
        for level in range(depth + 1):
            nxt = []
            for fit, rows, path in leaves:
                best = None
                if level < depth and fit.sum() >= 2 * min_rows:
                    gg, hh = g[fit], h[fit]
                    base = gg.sum() ** 2 / (hh.sum() + 1)
                    for f, edges in enumerate(cuts):
                        k = code[f, fit]
                        sg, sh, n = (np.cumsum(np.bincount(k, w, len(edges) + 1))[:-1] for w in (gg, hh, None))
                        ok = (n >= min_rows) & (n <= len(gg) - min_rows)
                        if ok.any():
                            gain = np.where(ok, sg ** 2 / (sh + 1) + (gg.sum() - sg) ** 2 / (hh.sum() - sh + 1) - base, -1)
                            b = int(gain.argmax())
                            if gain[b] > 1e-3 and (best is None or gain[b] > best[0]):
                                best = (gain[b], f, b)
                if best is None:
                    score[rows] += rate * g[fit].sum() / (h[fit].sum() + 1) if fit.any() else 0.0
                    continue
                _, f, b = best
                for above in (False, True):
                    side = (code[f] > b) == above
                    way = (*path, (f, float(cuts[f][b]), above))
                    paths.append(way)
                    nxt.append((fit & side, rows & side, way))
            leaves = nxt
    return list(dict.fromkeys(paths))


def holds(rule: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, cut, above in rule:
        out &= (x[:, f] > cut) == above
    return out


def lasso_logistic(m: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Bias and weights of the L1-penalised logistic loss, by accelerated proximal gradient steps."""
    step = 4.0 / (np.linalg.norm(m, 2) ** 2 / len(y) + 1)
    w = np.zeros(m.shape[1], m.dtype)
    b, v, vb, t = 0.0, w, 0.0, 1.0
    for _ in range(rounds):
        r = 1 / (1 + np.exp(-(m @ v + vb))) - y
        nw = v - step * (m.T @ r) / len(y)
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * penalty, 0)
        nb = vb - step * r.mean()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return float(b), w


def fit_rules(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> RuleModel:
    """Rules and weights from features ``x`` (columns as FEATURES) and labels 0/1; one class alone gives no rules."""
    ones = float(y.sum())
    prior = np.log((ones + 1) / (len(y) - ones + 1))
    if len(y) < 10 or ones in (0.0, float(len(y))):
        return RuleModel(float(prior), (), ())
    rules = grow_paths(x, y)
    if not rules:
        return RuleModel(float(prior), (), ())
    m = np.stack([holds(r, x) for r in rules], 1).astype(np.float32)
    share = m.mean(0)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-4)).astype(np.float32)
    bias, w = lasso_logistic((m - share) / spread, y.astype(np.float32), penalty)
    w = w / spread
    bias -= float((w * share).sum())
    kept = np.flatnonzero(np.abs(w) > 1e-4)
    return RuleModel(bias, tuple(rules[i] for i in kept), tuple(float(w[i]) for i in kept))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                max_rows: int = MAX_TRAINING_ROWS, folds: int = 4, held_fold: int = 2) -> RuleModel:
    """Fit on labelled rows outside the held-out fold (crc32 of the id modulo ``folds``).

    Only ``max_rows`` labelled ids, those of smallest hash, are used; with
    contradicting labels of one id the smaller counts.  Their texts are found
    by a join that broadcasts these ids alone.
    """
    known = (labels.select(F.col(id_col).alias("_q_id"), F.col(label_col).alias("_q_y")).filter("_q_id is not null and _q_y is not null")
             .filter(bucket_of("_q_id", folds) != held_fold).groupBy("_q_id").agg(F.min("_q_y").alias("_q_y"))
             .orderBy(F.xxhash64("_q_id"), "_q_id").limit(max_rows))
    rows = docs.select(F.col(id_col).alias("_q_id"), F.col(text_col).alias("_q_t")).join(F.broadcast(known), "_q_id")
    got = with_features(rows, "_q_t").select("_q_id", "_q_y", *[f"_q_{f}" for f in FEATURES]).toPandas()
    got = got.sort_values(list(got.columns))
    return fit_rules(got[[f"_q_{f}" for f in FEATURES]].to_numpy(np.float64), (got["_q_y"] > 0).to_numpy(np.float64))


def score_quality(docs: DataFrame, model: RuleModel, text_col: str = "text", threshold: float = 0.7,
                  score_col: str = "score", class_col: str = "predicted") -> DataFrame:
    """``docs`` with the probability of label 1 and whether it reaches ``threshold`` (1 or 0).

    The score passes through a one-element ``explode``: a later filter on it
    is then not pushed below, where every rule would compute its statistics
    anew.

    Null and empty texts have a score like any other; repeated rows are each
    scored; an empty table gives no rows; other columns stay as they are,
    whatever their names, but one called ``score_col`` or ``class_col`` gives way.
    """
    docs = docs.select(*[column(c) for c in docs.columns if c not in (score_col, class_col)])
    plain, names = apart(docs, text_col)
    scored = with_features(plain, text_col).select(*names, F.explode(F.array(model.column())).alias("_q_score"))
    return together(scored, names, docs, F.col("_q_score").alias(score_col), (F.col("_q_score") >= threshold).cast("int").alias(class_col))
