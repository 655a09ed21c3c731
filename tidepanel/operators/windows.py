"""Window features over panel cells: lags, leads, growth, fills, moving means.

All windows are ``partitionBy(entity).orderBy(date)`` with row frames,
applied to the *panel* (one row per entity and period), so a window
partition holds at most the number of periods of one entity — bounded by
the calendar, not by the raw row count.  They share one window spec, so
Spark plans one exchange and one sort for every feature of a frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import safe_ln


def entity_window(entity: str = "entity", date: str = "date"):
    return Window.partitionBy(entity).orderBy(date)


def log_diff(df: DataFrame, col: str, out: str, entity: str = "entity", date: str = "date") -> DataFrame:
    """ln(x) - lag(ln(x)) by row within entity."""
    w = entity_window(entity, date)
    lx = safe_ln(col)
    return df.withColumn(out, lx - F.lag(lx, 1).over(w))


def pct_change_col(col: str, w) -> Column:
    """W3 column without padding: x / previous row - 1 (previous 0 -> NULL).
    Pad first (``pad_forward``) for pandas' default behaviour."""
    x = F.col(col)
    prev = F.lag(x, 1).over(w)
    return F.try_divide(x, F.when(prev != 0, prev)) - F.lit(1.0)


def pad_forward(col: str, w) -> Column:
    """Last non-null value so far (unlimited forward fill)."""
    return F.last(F.col(col), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def pct_change(df: DataFrame, col: str, out: str, entity: str = "entity", date: str = "date",
               pad: bool = True) -> DataFrame:
    """Percent change per entity by row; previous value 0 gives NULL."""
    w = entity_window(entity, date)
    if not pad:
        return df.withColumn(out, pct_change_col(col, w))
    padded = df.withColumn("_pad", pad_forward(col, w))
    return padded.withColumn(out, pct_change_col("_pad", w)).drop("_pad")


def lag_features(df: DataFrame, col: str, lags: Sequence[int], prefix: str | None = None,
                 entity: str = "entity", date: str = "date") -> DataFrame:
    """Lag k of a column for each k, by row."""
    w = entity_window(entity, date)
    p = prefix or col
    return df.withColumns({f"{p}_l{k}": F.lag(col, k).over(w) for k in lags})


def lead_features(df: DataFrame, col: str, leads: Sequence[int], prefix: str | None = None,
                  entity: str = "entity", date: str = "date") -> DataFrame:
    """Value k rows ahead for each k."""
    w = entity_window(entity, date)
    p = prefix or col
    return df.withColumns({f"{p}_f{k}": F.lead(col, k).over(w) for k in leads})


def interaction_feature(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Product of two columns."""
    return df.withColumn(out, F.col(a) * F.col(b))


def ffill_limit(df: DataFrame, col: str, limit: int = 3, entity: str = "entity",
                date: str = "date", out: str | None = None) -> DataFrame:
    """Forward fill at most ``limit`` consecutive gaps (by row).

    The last non-null value and its row number are carried with
    ``last(ignorenulls)``; a gap is filled while it is <= limit rows away.
    """
    w = entity_window(entity, date)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    rn = F.row_number().over(w)
    tmp = (df.withColumn("_rn", rn)
           .withColumn("_last", F.last(F.col(col), ignorenulls=True).over(upto))
           .withColumn("_last_rn", F.last(F.when(F.col(col).isNotNull(), F.col("_rn")), ignorenulls=True).over(upto)))
    filled = F.when(F.col(col).isNotNull(), F.col(col)).when(
        (F.col("_rn") - F.col("_last_rn")) <= limit, F.col("_last"))
    return tmp.withColumn(out or col, filled).drop("_rn", "_last", "_last_rn")


def centered_ma(df: DataFrame, col: str, out: str, period: int = 12, entity: str = "entity",
                date: str = "date") -> DataFrame:
    """2 x period centered moving average (weights 1/2, 1 ... 1, 1/2 over
    ``period``); NULL within period/2 rows of either end."""
    h = period // 2
    w = entity_window(entity, date)
    frame = w.rowsBetween(-h, h)
    x = F.col(col)
    full = F.count(x).over(frame) == (2 * h + 1)
    ends = F.lag(x, h).over(w) + F.lead(x, h).over(w)
    ma = (F.sum(x).over(frame) - ends * 0.5) / F.lit(float(period))
    return df.withColumn(out, F.when(full, ma))


def normalize_to_base(df: DataFrame, value: str, base: str, out: str = "normalized") -> DataFrame:
    """Value / base x 100."""
    return df.withColumn(out, F.try_divide(F.col(value), F.col(base)) * F.lit(100.0))


def relative_month(date_col, event_col) -> Column:
    """round(days / 30.44) half-even, as an integer."""
    days = F.datediff(F.col(date_col), F.col(event_col))
    return F.bround(days / F.lit(30.44), 0).cast("int")
