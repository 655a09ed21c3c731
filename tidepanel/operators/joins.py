"""Joins: equi, left + zero fill, scaffolds, period expansion, semi joins,
the event range join and the nearest-date lookup.

Broadcasts: a side is broadcast only after its row count is checked
(``broadcast_if_small``) or when it is built from a bounded domain (a
calendar of years, a list of events).  Anything else is left to adaptive
execution, which converts a sort-merge join to a broadcast only when the
measured shuffle size is under the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import upper_trim


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast hint only when the table has at most ``max_rows`` rows.

    The check is a bounded ``limit(max_rows + 1).count()``; above the bound
    the plain frame is returned and the planner picks a shuffle join.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def join_name_year(left: DataFrame, right: DataFrame, left_name: str, right_name: str,
                   year: str = "year", right_cols: Sequence[str] | None = None) -> DataFrame:
    """Inner join on (upper/trim name, year); duplicates multiply.

    The right side is projected first; keys are normalised with F3.
    """
    rcols = list(right_cols) if right_cols is not None else [c for c in right.columns if c not in (right_name, year)]
    r = right.select(upper_trim(right_name).alias("_name_key"), F.col(year).alias("_year_key"), *rcols)
    l = left.withColumn("_name_key", upper_trim(left_name)).withColumn("_year_key", F.col(year))
    return l.join(r, ["_name_key", "_year_key"], "inner").drop("_name_key", "_year_key")


def left_join_zero(left: DataFrame, right: DataFrame, on: Sequence[str],
                   fill_cols: Sequence[str]) -> DataFrame:
    """J2 + P12: left join, then unmatched measures become 0."""
    out = left.join(right, list(on), "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(out.schema[c].dataType)) for c in fill_cols})


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate (a cutoff, a median, a
    count) to every row.

    The aggregate is a scalar subquery: it stays lazy, no row is collected
    while the plan is built, and no join is planned.  An empty aggregate
    gives nulls; more than one row fails when the query runs.
    """
    one = one_row.select(F.struct(*[F.col(c) for c in one_row.columns]).alias("one")).scalar()
    return (df.withColumn("_scalar", one)
            .withColumns({c: F.col("_scalar")[c] for c in one_row.columns}).drop("_scalar"))


def domain_values(df: DataFrame, col: str, max_values: int = 10_000) -> list:
    """Distinct values of a small key domain (metric names, event labels).

    Fails instead of pulling an unbounded column to the driver.
    """
    vals = [r[0] for r in df.select(col).distinct().limit(max_values + 1).collect()]
    if len(vals) > max_values:
        raise ValueError(f"{col} has more than {max_values} distinct values")
    return sorted(v for v in vals if v is not None)


def cross_scaffold(years: DataFrame, names: Sequence[str], year: str = "year",
                   name: str = "metric") -> DataFrame:
    """Every (year, name) pair of two small domains.

    The names are a literal list (a schema-level domain), so the grid is an
    ``explode`` over the distinct years, not a join.
    """
    return (years.select(year).distinct()
            .withColumn(name, F.explode(F.array(*[F.lit(n) for n in names]))))


def scaffold_left_join(observed: DataFrame, years: DataFrame, names: Sequence[str],
                       year: str = "year", name: str = "metric", value: str = "value") -> DataFrame:
    """Complete (year x name) grid left-joined to observed values, NULL -> 0."""
    grid = cross_scaffold(years, names, year, name)
    out = grid.join(observed.select(year, name, value), [year, name], "left")
    return out.withColumn(value, F.coalesce(F.col(value), F.lit(0.0)))


def expand_period(panel: DataFrame, annual: DataFrame, date: str = "date",
                  year: str = "year") -> DataFrame:
    """Attach each year's values to every (entity, date) of that year.

    The annual table has one row per year and metric; it is broadcast if a
    count finds it small, so that the large panel is not shuffled.
    """
    a = broadcast_if_small(annual.withColumnRenamed(year, "_yr"), 100_000)
    return panel.join(a, F.year(F.col(date)) == F.col("_yr"), "inner").drop("_yr")


def balanced_dates(long: DataFrame, entity: str = "entity", date: str = "date") -> DataFrame:
    """A5: dates whose distinct-entity count equals the number of entities."""
    n_ent = long.select(entity).distinct().agg(F.count(F.lit(1)).alias("_n"))
    per_date = long.select(date, entity).distinct().groupBy(date).agg(F.count(F.lit(1)).alias("_n"))
    # equi-join on the count against the one-row total: no cross product
    return per_date.join(F.broadcast(n_ent), "_n").select(date)


def balanced_semi_join(long: DataFrame, entity: str = "entity", date: str = "date") -> DataFrame:
    """Keep only rows whose date is shared by all entities."""
    return long.join(balanced_dates(long, entity, date), [date], "left_semi")


def subsample_semi_join(df: DataFrame, groups: DataFrame, entity: str = "entity") -> DataFrame:
    """Keep rows whose entity is in the group table."""
    return df.join(groups.select(entity), [entity], "left_semi")


def range_join_window(series: DataFrame, events: DataFrame, date: str = "date",
                      event_date: str = "event_date", months: int = 24) -> DataFrame:
    """Rows within +-months calendar months of each event, ends included.

    Each event is expanded to the months of its window and met by month, so
    this is an equi-join; the exact bounds are then checked by day.  An event
    without rows in its window contributes no rows.
    """
    lo, hi = F.add_months(F.col(event_date), -months), F.add_months(F.col(event_date), months)
    e = events.withColumn("_month", F.explode(F.sequence(F.trunc(lo, "month"), F.trunc(hi, "month"), F.expr("interval 1 month"))))
    s = series.withColumn("_month", F.trunc(F.col(date), "month"))
    e = broadcast_if_small(e, 100_000)
    return s.join(e, "_month").where(F.col(date).between(lo, hi)).drop("_month")


def nearest_asof(windowed: DataFrame, value: str, event: str = "event",
                 date: str = "date", event_date: str = "event_date") -> DataFrame:
    """Per event, the value at the date nearest the event; a tie takes
    the later date.  One partial aggregate per event (``min_by`` on a struct
    key), so no group is sorted."""
    dist = F.abs(F.datediff(F.col(date), F.col(event_date)))
    key = F.struct(dist.alias("d"), (-F.unix_date(F.col(date))).alias("neg"))
    return (windowed.groupBy(event)
            .agg(F.min_by(F.col(value), key).alias("base_value"),
                 F.min_by(F.col(date), key).alias("base_date")))


def asof_merge(events: DataFrame, series: DataFrame, by: Sequence[str] = (), event_date: str = "event_date", date: str = "date",
               value: str = "value", max_days: int | None = None) -> DataFrame:
    """J9 for many events: each event with the value of its ``by`` group at the date nearest to it (``base_value``, ``base_date``).

    Events and dates are sorted together by sampled ranges, so a group that
    holds most of the rows is cut over many tasks; within a range an event
    takes the last date up to it and the first one from it on, and beyond the
    range's ends the edges carried over from the other ranges of its group.
    A tie takes the later date; of repeated dates the largest value counts.
    An event without a date in reach (``max_days``, if given) keeps its row
    with nulls.  Rows of ``series`` without a value take no part.
    """
    from ..session import cut_lineage
    by = list(by)
    point = F.struct(F.col(date).alias("date"), F.col(value).alias("value"))
    marks = (series.where(F.col(value).isNotNull() & F.col(date).isNotNull())
             .groupBy(*by, date).agg(F.max(value).alias(value))
             .select(*by, F.col(date).alias("_t"), F.lit(0).alias("_kind"), point.alias("_point"), F.lit(None).alias("_event")))
    asked = events.select(*by, F.col(event_date).alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast(marks.schema["_point"].dataType).alias("_point"),
                          F.struct(*[F.col(c) for c in events.columns]).alias("_event"))
    both = marks.withColumn("_event", F.lit(None).cast(asked.schema["_event"].dataType)).unionByName(asked)
    order = [*by, "_t", "_kind"]
    dealt = cut_lineage(both.repartitionByRange(*order).sortWithinPartitions(*order)
                        .withColumn("_place", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_place", 33)), "asof")
    edges = (dealt.groupBy(*by, "_range").agg(F.max("_point").alias("_last"), F.min("_point").alias("_first")))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # a row a range
    # what follows is what comes before in the opposite order: a frame to the group's end would be read anew for every row
    ranges, ranges_back = (group.orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in ("_range", F.desc("_range")))
    carried = edges.select(*[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], F.col("_range").alias("_r"),
                           F.last("_last", ignorenulls=True).over(ranges).alias("_from"),
                           F.last("_first", ignorenulls=True).over(ranges_back).alias("_upto"))
    here, here_back = (Window.partitionBy(*by, "_range").orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in ("_place", F.desc("_place")))
    near = (dealt.withColumn("_before", F.last("_point", ignorenulls=True).over(here))
            .withColumn("_after", F.last("_point", ignorenulls=True).over(here_back))
            .where("_kind = 1"))
    on = reduce(lambda a, b: a & b, [F.col("_range") == F.col("_r"), *[F.col(c).eqNullSafe(F.col(f"_by_{i}")) for i, c in enumerate(by)]])
    near = near.join(carried, on).select("_event", "_t", F.coalesce("_before", "_from").alias("p"), F.coalesce("_after", "_upto").alias("q"))
    back, ahead = F.datediff("_t", F.col("p.date")), F.datediff(F.col("q.date"), "_t")
    pick = F.when(F.col("q").isNull() | (back < ahead), F.col("p")).otherwise(F.col("q"))
    out = near.withColumn("b", pick)
    if max_days is not None:
        out = out.withColumn("b", F.when(F.abs(F.datediff("_t", F.col("b.date"))) <= max_days, F.col("b")))
    return out.select("_event.*", F.col("b.value").alias("base_value"), F.col("b.date").alias("base_date"))
