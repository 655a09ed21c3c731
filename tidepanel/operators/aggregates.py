"""Aggregations: annual roll-ups, storm summary, panel shape, profiles,
correlations, fits and quantile splits.

Every aggregate here is a single ``groupBy().agg`` with map-side partial
aggregation (sums, counts, min/max, min_by/max_by, co-moments), so a hot
key is combined before the shuffle.  Quantiles use the range-partitioned
exact operator in ``quantile.py``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import safe_corr, safe_intercept, safe_slope
from .quantile import quantile_table


def annual_exposure(points: DataFrame, year: str, measures: dict) -> DataFrame:
    """A1: per year count plus max/min of named measures.

    ``measures`` maps output name -> (function name, column).
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for name, (fn, col) in measures.items():
        aggs.append(getattr(F, fn)(F.col(col)).alias(name))
    return points.groupBy(year).agg(*aggs)


def annual_sum(df: DataFrame, year: str, cols: dict) -> DataFrame:
    """A2: per year sums (output name -> column)."""
    return df.groupBy(year).agg(*[F.sum(F.col(c)).alias(n) for n, c in cols.items()])


def storm_summary(points: DataFrame, storm: str, order: str, name: str, year: str,
                  wind: str, pressure: str, landfall: str, distance: str,
                  in_range: str | None = None) -> DataFrame:
    """A3: per storm first name/year, max wind, min pressure, any landfall,
    min distance (of the in-range points) rounded to 1 decimal (half-even)."""
    near = F.col(distance) if in_range is None else F.when(F.col(in_range), F.col(distance))
    return points.groupBy(storm).agg(
        F.min_by(F.col(name), F.col(order)).alias("storm_name"),
        F.min_by(F.col(year), F.col(order)).alias("year"),
        F.max(wind).alias("max_wind"),
        F.min(pressure).alias("min_pressure"),
        F.bool_or(F.col(landfall)).alias("has_landfall"),
        F.bround(F.min(near), 1).alias("closest_distance"))


def min_distance_qualify(points: DataFrame, storm: str, distance: str, max_distance: float,
                         in_range: str | None = None) -> DataFrame:
    """A4: storms with any (in-range) point within ``max_distance``; semi-join
    the result back to keep *all* points of a qualifying storm.

    Each task holds its share of the qualifying storms as a hash table, so the
    points move once and are not sorted."""
    d = F.col(distance) if in_range is None else F.when(F.col(in_range), F.col(distance))
    q = points.groupBy(storm).agg(F.min(d).alias("_min_d")).where(F.col("_min_d") <= max_distance)
    return points.join(q.select(storm).hint("shuffle_hash"), [storm], "left_semi")


def period_bitmaps(long: DataFrame, entity: str, date: str, metric: str) -> DataFrame:
    """(entity, metric, word, bits, c, lo, hi): the periods of each entity and metric as bits of 64-day words, and its rows.

    Bits are or-ed by tasks before the shuffle, and again over groups by
    whoever asks, so no distinct count expands the rows.  Dates and integers
    share words; other period types are a word each.
    """
    kind = long.schema[date].dataType.typeName()
    if kind in ("date", "integer", "long", "short", "byte"):
        day = F.unix_date(date) if kind == "date" else F.col(date).cast("long")
        word, bits = F.floor(day / 64), F.expr("bit_or(shiftleft(1L, cast(pmod(_day, 64) as int)))")
    else:
        day, word, bits = F.col(date), F.col(date), F.expr("bit_or(if(_day is null, null, 1L))")
    return (long.select(F.col(entity).alias("_e"), F.col(metric).alias("_m"), day.alias("_day"), word.alias("_w"), F.col(date).alias("_d"))
            .groupBy("_e", "_m", "_w").agg(bits.alias("bits"), F.count(F.lit(1)).alias("c"), F.min("_d").alias("lo"), F.max("_d").alias("hi")))


def panel_counts(long: DataFrame, entity: str = "entity", date: str = "date", metric: str = "metric") -> DataFrame:
    """One row: entities, periods, variables, rows, cells (entity x period), min/max periods per entity and rows per entity x
    metric, first and last period.  Nulls are no entity, period or variable."""
    from .joins import attach_scalar
    w = period_bitmaps(long, entity, date, metric)
    per_metric = w.groupBy("_e", "_m").agg(F.sum("c").alias("c"))
    per_entity = (w.groupBy("_e", "_w").agg(F.expr("bit_or(bits)").alias("bits"))
                  .groupBy("_e").agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).alias("p")))
    periods = w.groupBy("_w").agg(F.expr("bit_or(bits)").alias("bits")).agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).alias("n_periods"))
    variables = w.groupBy("_m").agg(F.sum("c").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).agg(
        F.count("_m").alias("n_variables"), F.coalesce(F.sum("c"), F.lit(0)).alias("n_obs"), F.min("lo").alias("time_min"), F.max("hi").alias("time_max"))
    entities = per_entity.agg(F.count("_e").alias("n_entities"), F.min("p").alias("min_obs_entity"), F.max("p").alias("max_obs_entity"),
                              F.coalesce(F.sum("p"), F.lit(0)).alias("n_cells"))
    cells = per_metric.agg(F.min("c").alias("min_obs_entity_metric"), F.max("c").alias("max_obs_entity_metric"))
    out = entities
    for one in (periods, variables, cells):
        out = attach_scalar(out, one)
    return out


def panel_shape(long: DataFrame, entity: str = "entity", date: str = "date",
                metric: str = "metric") -> DataFrame:
    """One row: entities, periods, rows, min/max periods per entity and
    rows per entity x metric, whether all entities have equally many periods
    (``balanced``) and whether each has every period (``complete``)."""
    n = panel_counts(long, entity, date, metric)
    return n.select("n_entities", "n_periods", "n_obs", "min_obs_entity", "max_obs_entity", "min_obs_entity_metric", "max_obs_entity_metric",
                    (F.col("min_obs_entity") == F.col("max_obs_entity")).alias("balanced"),
                    (F.col("min_obs_entity") == F.col("n_periods")).alias("complete"))


def metric_profile(long: DataFrame, metric: str = "metric", value: str = "value") -> DataFrame:
    """Per metric mean, sample std, min, max, missing n and %."""
    v = F.col(value)
    n = F.count(F.lit(1))
    return long.groupBy(metric).agg(
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
        F.sum(v.isNull().cast("long")).alias("n_missing"),
        (F.sum(v.isNull().cast("long")) * 100.0 / n).alias("missing_pct"))


def describe_columns(wide: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column count, mean, std, min, 25/50/75%, max, missing %.

    Columns are unpivoted (NULLs kept) so one grouped pass serves all of
    them; quartiles come from the exact range-partitioned operator.
    """
    long = wide.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot([], list(cols), "column", "v")
    v = F.col("v")
    stats = long.groupBy("column").agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
        (F.sum(v.isNull().cast("long")) * 100.0 / F.count(F.lit(1))).alias("missing_pct"))
    q = quantile_table(long, ["column"], "v", [0.25, 0.5, 0.75], ["p25", "p50", "p75"], with_count=False)
    return stats.join(q, ["column"], "left")


def entity_profile(wide: DataFrame, cols: Sequence[str], entity: str = "entity",
                   decimals: int = 1) -> DataFrame:
    """Per entity mean/std/min/max of the columns, rounded half-even."""
    aggs = []
    for c in cols:
        aggs += [F.bround(F.avg(c), decimals).alias(f"{c}_mean"),
                 F.bround(F.stddev_samp(c), decimals).alias(f"{c}_std"),
                 F.bround(F.min(c), decimals).alias(f"{c}_min"),
                 F.bround(F.max(c), decimals).alias(f"{c}_max")]
    return wide.groupBy(entity).agg(*aggs)


def period_mean(df: DataFrame, period: Sequence, cols: Sequence[str],
                decimals: int | None = None) -> DataFrame:
    """A10: mean of columns by year or date (the cross-entity average)."""
    aggs = []
    for c in cols:
        m = F.avg(c)
        aggs.append((F.bround(m, decimals) if decimals is not None else m).alias(f"{c}_mean"))
    return df.groupBy(*period).agg(*aggs)


def missing_pct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row, missing % per column."""
    return df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100.0).alias(f"{c}_missing_pct") for c in cols])


def grouped_median_split(df: DataFrame, entity: str, value: str) -> DataFrame:
    """Median per entity, then the median of those medians as cutoff.

    Returns (entity, entity_median, cutoff, group) with group high/low
    (``>=`` cutoff goes high).
    """
    from .joins import attach_scalar
    med = quantile_table(df, [entity], value, [0.5], ["entity_median"], with_count=False)
    cut = quantile_table(med, [], "entity_median", [0.5], ["cutoff"], with_count=False)
    out = attach_scalar(med, cut)
    return out.withColumn("group", F.when(F.col("entity_median") >= F.col("cutoff"), F.lit("high"))
                          .otherwise(F.lit("low")))


def corr_matrix(wide: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson r for every pair (lower triangle with
    the diagonal) in one aggregate, stacked to (col_a, col_b, r)."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[: i + 1]]
    one = wide.agg(*[safe_corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)]))
    return one.select(stacked.alias("s")).select("s.*")


def pairwise_corr(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Pearson r of two columns (optionally per group)."""
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(safe_corr(a, b).alias("r"), F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).alias("n"))


def linear_fit(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares slope/intercept per group; NULL without x variance."""
    g = df.groupBy(*by) if by else df.groupBy()
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    return g.agg(safe_slope(y, x).alias("slope"), safe_intercept(y, x).alias("intercept"),
                 F.min(F.when(both, F.col(x))).alias("x_min"), F.max(F.when(both, F.col(x))).alias("x_max"))


def fit_line_grid(fits: DataFrame, points: int = 100, by: Sequence[str] = ()) -> DataFrame:
    """Fitted y at ``points`` equally spaced x from min to max per group."""
    i = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")
    g = fits.where(F.col("slope").isNotNull()).select(*by, "slope", "intercept", "x_min", "x_max", i)
    step = (F.col("x_max") - F.col("x_min")) / F.lit(points - 1)
    x = F.col("x_min") + F.col("i") * step
    return g.select(*by, "i", x.alias("x"), (F.col("intercept") + F.col("slope") * x).alias("y_fit"))


def time_range_total(df: DataFrame, date: str, measure: str) -> DataFrame:
    """Min and max time and the grand total of a measure."""
    return df.agg(F.min(date).alias("time_min"), F.max(date).alias("time_max"),
                  F.sum(measure).alias("total"))


def _date_micros(date: str):
    # micros since epoch of a DATE at midnight, independent of the session zone
    return F.unix_date(F.to_date(F.col(date))).cast("double") * F.lit(86_400_000_000.0)


def time_quantile_cut(df: DataFrame, date: str, p: float = 0.8) -> DataFrame:
    """Interpolated p-quantile of row dates (one row, ``cut_us`` = epoch
    microseconds; pandas quantile of datetimes interpolates the same way)."""
    micros = df.select(_date_micros(date).alias("_us"))
    return quantile_table(micros, [], "_us", [p], ["cut_us"], with_count=False)


def time_quantile_split(df: DataFrame, date: str, p: float = 0.8) -> DataFrame:
    """Add ``split`` = train (date <= cut) or test (date > cut)."""
    from .joins import attach_scalar
    cut = time_quantile_cut(df, date, p)
    j = attach_scalar(df, cut)
    return j.withColumn("split", F.when(_date_micros(date) <= F.col("cut_us"), F.lit("train"))
                        .otherwise(F.lit("test"))).drop("cut_us")
