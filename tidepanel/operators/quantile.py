"""Exact linear-interpolated quantiles per group by selection, and global ranks.

The built-in exact ``percentile`` keeps every distinct value of a group in
one aggregation buffer, so a group holding a third of the rows lands in one
task.  ``quantile_table`` instead counts values in BUCKETS buckets per group,
an aggregate that tasks combine before the shuffle, and looks again only into
the buckets in which a wanted rank lies, between the least and the largest
value there, until those hold one value or at most GATHER rows, which are
picked out.  Values are neither sorted nor written; what is shuffled does not
grow with the rows of a group.  The frame is read once a pass (three or four,
mostly), so hand over a written table where its plan is dear.  The
interpolation equals pandas ``quantile``, DuckDB ``quantile_cont`` and Spark
``percentile``.

``global_rank`` ranks every row, by a range-partitioned sort: a hot group is
cut across many partitions by the sampled bounds, each partition reports
(partition, group, count, first index), and a row's rank is its partition's
offset plus its position.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_IDX_BITS = 33  # monotonically_increasing_id = partition << 33 | row index


def global_rank(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows of ``df`` (NULL values dropped) with ``_rank`` (0-based position
    of the value within its group) and ``_n`` (group size), computed from a
    range-partitioned sort: no group is sorted in one task."""
    keys = list(keys)
    base = df.where(F.col(value).isNotNull())
    # a total order inside each partition (ties broken by every other column)
    # makes the positions, and so the ranks, independent of fetch order
    rest = [c for c in base.columns if c not in keys and c != value]
    ordered = (base.repartitionByRange(*keys, value)
               .sortWithinPartitions(*keys, value, *rest)
               .withColumn("_mid", F.monotonically_increasing_id())
               .withColumn("_pid", F.shiftright("_mid", _IDX_BITS))
               .withColumn("_idx", F.col("_mid").bitwiseAND((1 << _IDX_BITS) - 1)))
    # both readings below must see the same partition ids: written once
    ordered = cut_lineage(ordered, "ranks")
    runs = (ordered.groupBy("_pid", *keys)
            .agg(F.count(F.lit(1)).alias("_c"), F.min("_idx").alias("_i0")))
    by_group = Window.partitionBy(*keys)
    runs = (runs
            .withColumn("_off", F.coalesce(F.sum("_c").over(
                by_group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("_n", F.sum("_c").over(by_group)))
    o, r = ordered.alias("o"), runs.alias("r")
    on = [F.col("o._pid") == F.col("r._pid")] + [F.col(f"o.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    cols = [F.col(f"o.{c}").alias(c) for c in base.columns]
    return (o.join(r, reduce(lambda a, b: a & b, on))
            .select(*cols, (F.col("r._off") + F.col("o._idx") - F.col("r._i0")).alias("_rank"),
                    F.col("r._n").alias("_n")))


#: Buckets of a pass, and rows of an interval that are picked out at once.
BUCKETS, GATHER = 1024, 1000
_TOP = 1.7976931348623157e308


def _bucket(v, lo, hi, logs: bool):
    """Bucket of ``v`` between ``lo`` and ``hi``: never falls as ``v`` grows, and parts at least the two ends."""
    def place(x):  # halves, so that no difference overflows
        x = F.greatest(F.least(x, F.lit(_TOP)), F.lit(-_TOP)) * 0.5
        return F.signum(x) * F.log1p(F.abs(x)) if logs else x
    width = place(hi) - place(lo)
    part = F.least(F.floor((place(v) - place(lo)) / F.when(width > 0, width) * BUCKETS), F.lit(BUCKETS).cast("long"))
    return F.when(v == hi, F.lit(BUCKETS + 1).cast("long")).otherwise(F.coalesce(part, F.lit(0).cast("long")))


def _inside(base: DataFrame, keys: Sequence[str], intervals: DataFrame) -> DataFrame:
    """Rows of ``base`` beside the interval of their group that holds them."""
    i = intervals.select(*[F.col(k).alias(f"_{n}_key") for n, k in enumerate(keys)], "n", "lo", "hi", "below", "ranks")
    on = [F.col(k).eqNullSafe(F.col(f"_{n}_key")) for n, k in enumerate(keys)]
    return base.join(i, reduce(lambda a, b: a & b, [*on, F.col("_v").between(F.col("lo"), F.col("hi"))]))


def _picked(base: DataFrame, keys: Sequence[str], intervals: DataFrame) -> DataFrame:
    """(keys, n, rank, v) of the wanted ranks in intervals of one value, or of at most GATHER rows."""
    one = intervals.where("lo = hi").select(*keys, "n", F.explode("ranks").alias("rank"), F.col("lo").alias("v"))
    some = (_inside(base, keys, intervals.where(f"lo < hi and cnt <= {GATHER}"))
            .groupBy(*keys, "n", "lo", "below", "ranks").agg(F.sort_array(F.collect_list("_v")).alias("vs"))
            .select(*keys, "n", F.explode(F.expr("transform(ranks, r -> named_struct('rank', r, 'v', vs[cast(r - below as int)]))")).alias("x"))
            .select(*keys, "n", "x.rank", "x.v"))
    return one.unionByName(some)


def _narrowed(base: DataFrame, keys: Sequence[str], intervals: DataFrame, logs: bool) -> DataFrame:
    """The buckets of too large intervals in which a wanted rank lies, as intervals."""
    rows = _inside(base, keys, intervals.where(f"lo < hi and cnt > {GATHER}"))
    counts = (rows.groupBy(*keys, "n", F.col("lo").alias("_from"), "below", "ranks", _bucket(F.col("_v"), F.col("lo"), F.col("hi"), logs).alias("_b"))
              .agg(F.count(F.lit(1)).alias("cnt"), F.min("_v").alias("lo"), F.max("_v").alias("hi")))
    upto = F.sum("cnt").over(Window.partitionBy(*keys, "_from").orderBy("_b"))
    return (counts.withColumn("below", F.col("below") + upto - F.col("cnt"))
            .withColumn("ranks", F.expr("filter(ranks, r -> r >= below and r < below + cnt)"))
            .where(F.size("ranks") > 0).select(*keys, "n", "lo", "hi", "below", "cnt", "ranks"))


def quantile_table(df: DataFrame, keys: Sequence[str], value: str,
                   probs: Sequence[float], names: Sequence[str] | None = None,
                   with_count: bool = True) -> DataFrame:
    """One row per group: ``keys..., [n], <name_p>...`` exact quantiles.

    NULL and NaN values are ignored.  A group with no values has no row.
    """
    names = list(names) if names else [f"q{int(round(p * 100)):02d}" for p in probs]
    by = [f"_k{i}" for i in range(len(keys))] or ["_all"]
    groups = [F.col(k).alias(b) for k, b in zip(keys, by)] if keys else [F.lit(0).alias("_all")]
    base = df.select(*groups, F.col(value).cast("double").alias("_v")).where("_v is not null and not isnan(_v)")

    def at(p: float):  # position of a quantile among n values
        return F.lit(float(p)) * (F.col("n") - 1)

    ranks = F.array_distinct(F.array(*[r for p in probs for r in (F.floor(at(p)), F.ceil(at(p)))]))
    intervals = cut_lineage(
        base.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        .select(*by, "n", "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("cnt"), ranks.alias("ranks")), "intervals")
    found, logs = _picked(base, by, intervals), False
    while intervals.where(f"lo < hi and cnt > {GATHER}").limit(1).count():
        intervals = cut_lineage(_narrowed(base, by, intervals, logs), "intervals")
        found, logs = found.unionByName(_picked(base, by, intervals)), not logs
    g = found.groupBy(*by).agg(F.max("n").alias("n"), *[
        F.max(F.when(F.col("rank") == end(at(p)), F.col("v"))).alias(f"_{side}{i}")
        for i, p in enumerate(probs) for side, end in (("lo", F.floor), ("hi", F.ceil))])
    outs = []
    for i, (p, nm) in enumerate(zip(probs, names)):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        frac = at(p) - F.floor(at(p))
        outs.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * frac).alias(nm))
    return g.select(*[F.col(b).alias(k) for k, b in zip(keys, by)], *(["n"] if with_count else []), *outs)


def group_median(df: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    return quantile_table(df, keys, value, [0.5], [name], with_count=False)


def scalar_quantile(df: DataFrame, value: str, p: float, name: str = "q") -> DataFrame:
    """One-row table holding the p-quantile of a whole column."""
    return quantile_table(df, [], value, [p], [name], with_count=False)
