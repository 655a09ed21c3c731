"""Time-series analytics over many series at once: regular calendar,
seasonal decomposition, event study, lagged cross-correlation and
volatility segmentation.  Each runs as grouped DataFrame work over all
entities, never as a loop over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import safe_corr
from .clean import dedupe_keep_first, threshold_category
from .joins import nearest_asof, range_join_window
from .windows import (centered_ma, entity_window, ffill_limit, normalize_to_base, pct_change,
                      relative_month)


def regular_series(df: DataFrame, value: str, entity: str = "entity", date: str = "date",
                   limit: int = 3, freq_start: bool = True) -> DataFrame:
    """Month-normalise, keep the first row per month, fill the monthly
    calendar between each entity's first and last month, forward-fill up to
    ``limit`` gaps and drop what stays empty.

    The calendar is a per-entity ``sequence`` (bounded by its month span)
    left-joined to the observed months.
    """
    norm = F.trunc(F.col(date), "month") if freq_start else F.last_day(F.col(date))
    m = (df.where(F.col(value).isNotNull())
         .select(F.col(entity).alias("_e"), norm.alias("_m"), F.col(date).alias("_d"), F.col(value).alias("_v")))
    first = dedupe_keep_first(m, ["_e", "_m"], ["_d"]).select("_e", "_m", "_v")
    span = first.groupBy("_e").agg(F.min("_m").alias("_a"), F.max("_m").alias("_b"))
    cal = span.select("_e", F.explode(F.sequence(F.trunc("_a", "month"), F.trunc("_b", "month"),
                                                 F.expr("INTERVAL 1 MONTH"))).alias("_m0"))
    cal = cal.withColumn("_m", F.col("_m0") if freq_start else F.last_day("_m0")).drop("_m0")
    full = cal.join(first, ["_e", "_m"], "left")
    filled = ffill_limit(full, "_v", limit, entity="_e", date="_m")
    return (filled.where(F.col("_v").isNotNull())
            .select(F.col("_e").alias(entity), F.col("_m").alias(date), F.col("_v").alias(value)))


def seasonal_decompose(series: DataFrame, value: str, entity: str = "entity", date: str = "date",
                       period: int = 12, min_points: int = 24) -> DataFrame:
    """Additive decomposition of every series with >= min_points rows.

    trend = 2x12 centered mean (NULL near the ends); seasonal = mean of the
    detrended values per phase (row mod period), centred to zero mean over
    the phases; resid = value - trend - seasonal.
    """
    w = entity_window(entity, date)
    s = (series.where(F.col(value).isNotNull())
         .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(entity)))
         .where(F.col("_n") >= min_points)
         .withColumn("phase", F.pmod(F.row_number().over(w) - 1, F.lit(period)).cast("int")))
    s = centered_ma(s, value, "trend", period, entity, date)
    s = s.withColumn("_detr", F.col(value) - F.col("trend"))
    # phase means and their mean, as windows on the entity partitioning already
    # in place ((entity, phase) windows need no new shuffle): the sum over rows
    # of pm / rows-in-phase is the sum of the phase means
    by_phase = Window.partitionBy(entity, "phase")
    by_entity = Window.partitionBy(entity)
    s = (s.withColumn("_pm", F.avg("_detr").over(by_phase))
         .withColumn("_w", F.col("_pm") / F.count(F.lit(1)).over(by_phase)))
    n_phases = F.least(F.col("_n"), F.lit(period))
    s = s.withColumn("seasonal", F.col("_pm") - F.sum("_w").over(by_entity) / n_phases)
    return s.select(entity, date, "phase", F.col(value).alias("observed"), "trend", "seasonal",
                    (F.col(value) - F.col("trend") - F.col("seasonal")).alias("resid"))


def event_study(series: DataFrame, events: DataFrame, value: str, date: str = "date",
                months: int = 24) -> DataFrame:
    """Rows within +-months of each event (J8), normalised to the value at
    the nearest date (J9, W9) and placed on a relative-month axis (W10).

    ``series`` is one row per date (e.g. the cross-entity mean); ``events``
    is (event, event_date).
    """
    win = range_join_window(series.select(date, value), events, date, "event_date", months)
    base = nearest_asof(win, value, "event", date, "event_date")
    j = normalize_to_base(win.join(F.broadcast(base), ["event"]), value, "base_value")
    return j.select("event", "event_date", date, value, "base_date", "base_value", "normalized",
                    relative_month(date, "event_date").alias("rel_month"))


def cross_correlation(panel: DataFrame, driver: str, target: str, max_lag: int = 12,
                      entity: str = "entity", date: str = "date", scale: float = 100.0) -> DataFrame:
    """Per entity corr(driver, pct-change of target led by k rows),
    k = 0..max_lag, then the mean over entities (NULLs skipped)."""
    rows = panel.where(F.col(target).isNotNull())
    rows = pct_change(rows, target, "_pct", entity, date, pad=False)
    w = entity_window(entity, date)
    rows = rows.withColumn("_pct", F.col("_pct") * F.lit(scale))
    rows = rows.withColumns({f"_f{k}": F.lead("_pct", k).over(w) for k in range(max_lag + 1)})
    per = rows.groupBy(entity).agg(*[safe_corr(driver, f"_f{k}").alias(f"_r{k}") for k in range(max_lag + 1)])
    st = per.select(entity, F.explode(F.array(*[
        F.struct(F.lit(k).alias("lag"), F.col(f"_r{k}").alias("r")) for k in range(max_lag + 1)])).alias("s"))
    st = st.select(entity, "s.lag", "s.r")
    return st.groupBy("lag").agg(F.avg("r").alias("mean_corr"), F.count("r").alias("n_entities"))


def segmentation(panel: DataFrame, target: str, exposure: str, entity: str = "entity",
                 date: str = "date", scale: float = 100.0) -> DataFrame:
    """Per entity volatility (sample std of pct-change x 100), mean
    exposure, and Sensitive/Resilient by the median volatility."""
    rows = panel.where(F.col(target).isNotNull())
    rows = pct_change(rows, target, "_pct", entity, date, pad=False)
    per = rows.groupBy(entity).agg((F.stddev_samp("_pct") * F.lit(scale)).alias("volatility"),
                                   F.avg(exposure).alias("avg_exposure"))
    return threshold_category(per, "volatility", "category")
