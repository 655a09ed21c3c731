"""Composite panel plans shared by several queries: the cleaned and
balanced long panel with the yearly shock expanded onto it, and its wide
model frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import winsorize
from ..operators.joins import balanced_semi_join, expand_period, scaffold_left_join
from ..operators.reshape import pivot_first, union_all_long, unpivot_long
from .inputs import ORDER_METRICS, SHOCK_METRICS, order_panel_long, shock_by_year


def shock_annual_long(spark: SparkSession, sf_dir: str, years: DataFrame) -> DataFrame:
    """(year, metric, value) for every panel year x shock metric, 0 when quiet."""
    s_long = unpivot_long(shock_by_year(spark, sf_dir), ["year"], list(SHOCK_METRICS))
    return scaffold_left_join(s_long, years, list(SHOCK_METRICS))


def exposure_rows(panel_long: DataFrame, annual_long: DataFrame) -> DataFrame:
    """Expand yearly values onto every (entity, date) of the panel."""
    keys = panel_long.select("entity", "date").distinct()
    return expand_period(keys, annual_long).select("entity", "date", "metric", "value")


def enriched_long(spark: SparkSession, sf_dir: str, entity: str = "segment",
                  balance: bool = True) -> DataFrame:
    """Order panel -> winsorize per metric -> balance dates -> + shock rows."""
    long = winsorize(order_panel_long(spark, sf_dir, entity))
    if balance:
        long = balanced_semi_join(long)
    years = long.select(F.year("date").alias("year")).distinct()
    annual = shock_annual_long(spark, sf_dir, years)
    return union_all_long(long, exposure_rows(long, annual))


def enriched_wide(spark: SparkSession, sf_dir: str, entity: str = "segment",
                  balance: bool = True) -> DataFrame:
    from .materialize import materialized
    return materialized(spark, ("enriched_wide", sf_dir, entity, balance),
                        lambda: _enriched_wide(spark, sf_dir, entity, balance))


def _enriched_wide(spark: SparkSession, sf_dir: str, entity: str, balance: bool) -> DataFrame:
    return pivot_first(enriched_long(spark, sf_dir, entity, balance), ["entity", "date"],
                       list(ORDER_METRICS) + list(SHOCK_METRICS))


def model_frame(spark: SparkSession, sf_dir: str, entity: str = "nation") -> DataFrame:
    """Model features on the enriched panel (one window spec, one sort):

    price_growth = diff of ln(avg_price) (outcome); ext_growth = diff of
    ln(avg_extprice); count_growth = pct change of order_count (padded);
    qty_log = ln(avg_qty); shock_total_l{1,2,3} = yearly shock lagged by
    rows; drv_l{k} = shock_total_l{k} x qty_log (the driver).
    """
    from .materialize import materialized
    return materialized(spark, ("model_frame", sf_dir, entity), lambda: _model_frame(spark, sf_dir, entity))


def _model_frame(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    from ..functions.scalar import safe_ln
    from ..operators.windows import entity_window, pad_forward, pct_change_col
    w = entity_window()
    wide = enriched_wide(spark, sf_dir, entity).withColumn("_cnt_pad", pad_forward("order_count", w))
    lp, le, lq = safe_ln("avg_price"), safe_ln("avg_extprice"), safe_ln("avg_qty")
    feats = {
        "price_growth": lp - F.lag(lp, 1).over(w),
        "ext_growth": le - F.lag(le, 1).over(w),
        "count_growth": pct_change_col("_cnt_pad", w),
        "qty_log": lq,
    }
    for k in (1, 2, 3):
        feats[f"shock_total_l{k}"] = F.lag("shock_total", k).over(w)
        feats[f"drv_l{k}"] = F.lag("shock_total", k).over(w) * lq
    return wide.withColumns(feats).drop("_cnt_pad")


MODEL_Y = "price_growth"
MODEL_CONTROLS = ("qty_log", "ext_growth", "count_growth")
