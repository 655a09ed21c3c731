"""Reshaping and set operators: pivot, unpivot, union, distinct, order, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_long(df: DataFrame, ids: Sequence[str], values: Sequence[str],
                 metric: str = "metric", value: str = "value",
                 drop_nulls: bool = False, cast: str = "double") -> DataFrame:
    """Wide -> long (melt).  ``DataFrame.unpivot`` keeps NULL cells;
    ``drop_nulls`` filters them (what SQL ``UNPIVOT`` does by default)."""
    cols = [F.col(c).cast(cast).alias(c) for c in values]
    out = df.select(*ids, *cols).unpivot(list(ids), list(values), metric, value)
    return out.where(F.col(value).isNotNull()) if drop_nulls else out


def pivot_first(long: DataFrame, keys: Sequence[str], metrics: Sequence[str],
                metric: str = "metric", value: str = "value") -> DataFrame:
    """Long -> wide, first non-null value per key and metric.

    The metric list is explicit so Spark plans no extra job to find it;
    metrics absent from the data come out as all-NULL columns.
    """
    return (long.where(F.col(metric).isin(*metrics))
            .groupBy(*keys).pivot(metric, list(metrics))
            .agg(F.first(value, ignorenulls=True)))


def union_all_long(*frames: DataFrame) -> DataFrame:
    """Stack long tables by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key combinations (partial aggregation before the shuffle)."""
    return df.select(*keys).distinct()


def sort_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """O1: total order for output (range-partitioned sort)."""
    return df.orderBy(*keys)


def head_n(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """O2: first n rows under a total order (a top-n, not a full sort)."""
    return df.orderBy(*keys).limit(n)


def topk_by_count(df: DataFrame, entity: str, value: str, k: int = 3) -> DataFrame:
    """O3: k entities with most non-null values; ties go alphabetically."""
    counts = df.groupBy(entity).agg(F.count(value).alias("n_obs"))
    return counts.orderBy(F.desc("n_obs"), F.asc(entity)).limit(k)


def rank_by_measure(df: DataFrame, measure: str, entity: str, descending: bool = True) -> DataFrame:
    """``df`` with its rank by a measure (from 1; ties go alphabetically).

    The rank comes from the range-partitioned global rank, so no task sorts
    all entities.  Rows without a measure have a null rank.
    """
    from .quantile import global_rank
    rest = [c for c in df.columns if c != entity]
    keyed = df.select((-F.col(measure) if descending else F.col(measure)).alias("_by"), entity, *rest)
    ranked = global_rank(keyed, [], "_by").select((F.col("_rank") + 1).alias("rank"), *df.columns)
    return ranked.unionByName(df.where(F.col(measure).isNull()).select(F.lit(None).cast("long").alias("rank"), *df.columns))
