"""Learning: distributed random forest against OLS on a time split.

The forest is MLlib's (trees are grown in parallel from binned feature
statistics; no single-machine library).  Spark caps depth at 30 and bins
continuous features, so scores are close to, not equal to, a single-machine
forest with the same settings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregates import time_quantile_split
from .forecast import r2_score
from .linear import pooled_ols

# Fixed settings of the forest (as in the reference).
FOREST = {"numTrees": 400, "minInstancesPerNode": 5, "featureSubsetStrategy": "all", "seed": 42,
          "maxDepth": 30, "subsamplingRate": 1.0, "bootstrap": True}
# Engine settings (not semantics): node statistics per task stay well under an
# executor's share, and cached node ids avoid re-walking trees.
ENGINE = {"maxMemoryInMB": 256, "cacheNodeIds": True, "checkpointInterval": 10}


def forest_regression(train: DataFrame, y: str, features: Sequence[str], **overrides):
    """Fit the forest; returns the fitted model."""
    features = list(features)
    vec = VectorAssembler(inputCols=features, outputCol="_features").transform(train)
    params = {**FOREST, **ENGINE, **overrides}
    rf = RandomForestRegressor(featuresCol="_features", labelCol=y, predictionCol="_pred", **params)
    return rf.fit(vec)


def feature_importance(model, features: Sequence[str]) -> list:
    """Importance per feature, descending, summing to 1."""
    imp = model.featureImportances.toArray()
    return sorted(((f, float(v)) for f, v in zip(features, imp)), key=lambda t: -t[1])


def time_split(frame: DataFrame, y: str, features: Sequence[str], date: str = "date", p: float = 0.8):
    """(train, test): complete rows split at the p-quantile of their dates."""
    d = frame.select(date, y, *features).dropna()
    split = time_quantile_split(d, date, p)
    return split.where(F.col("split") == "train"), split.where(F.col("split") == "test")


def ml_compare(frame: DataFrame, y: str, features: Sequence[str], date: str = "date",
               p: float = 0.8, model=None, **forest_overrides):
    """OLS vs forest on one time split (train <= 0.8 date quantile).

    ``model``: an already fitted forest for the same split (skips refitting).
    Returns (metrics rows, importances, forest model)."""
    features = list(features)
    train, test = time_split(frame, y, features, date, p)
    ols = pooled_ols(train, y, features)
    pred = F.lit(float(ols.coef[0]))
    for n, c in zip(ols.names[1:], ols.coef[1:]):
        pred = pred + F.lit(float(c)) * F.col(n)
    ols_scores = r2_score(test.withColumn("_pred", pred), y, "_pred").first()
    if model is None:
        model = forest_regression(train, y, features, **forest_overrides)
    vec = VectorAssembler(inputCols=features, outputCol="_features").transform(test)
    rf_scores = r2_score(model.transform(vec), y, "_pred").first()
    n_train = train.count()
    rows = [("ols", float(ols_scores["r2"]), float(ols_scores["rmse"]), n_train, int(ols_scores["n"])),
            ("random_forest", float(rf_scores["r2"]), float(rf_scores["rmse"]), n_train, int(rf_scores["n"]))]
    return rows, feature_importance(model, features), model
