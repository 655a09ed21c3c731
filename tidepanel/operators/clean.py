"""Cleaning: filters, tolerant parsing, null handling, winsorizing, dedupe
and the audit counts that replace the reference's console printing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.scalar import tolerant_double
from .quantile import quantile_table


def filter_equality_and(df: DataFrame, equals: Mapping[str, object]) -> DataFrame:
    """AND of column == value tests (pushed into the parquet scan)."""
    cond = F.lit(True)
    for c, v in equals.items():
        cond = cond & (F.col(c) == F.lit(v))
    return df.where(cond)


def drop_empty_key(df: DataFrame, key: str) -> DataFrame:
    """Drop rows whose key is NULL or blank."""
    return df.where(F.col(key).isNotNull() & (F.trim(F.col(key)) != ""))


def tolerant_cast(df: DataFrame, col: str, drop: bool = True) -> DataFrame:
    """Text -> double where it parses; otherwise NULL (and dropped)."""
    out = df.withColumn(col, tolerant_double(col))
    return out.where(F.col(col).isNotNull()) if drop else out


def parse_date_coerce(df: DataFrame, col: str, fmt: str | None = None) -> DataFrame:
    """Unparseable dates become NULL and the row is dropped."""
    parsed = F.try_to_date(F.col(col).cast("string"), fmt) if fmt else \
        F.coalesce(F.try_to_date(F.col(col).cast("string")), F.to_date(F.try_to_timestamp(F.col(col).cast("string"))))
    return df.withColumn(col, parsed).dropna(subset=[col])


def drop_null_measure(df: DataFrame, value: str = "value") -> DataFrame:
    """Drop rows with a NULL measure."""
    return df.dropna(subset=[value])


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any listed column."""
    return df.dropna(subset=list(cols))


def filter_year_range(df: DataFrame, date: str, lo: int, hi: int) -> DataFrame:
    """Keep years lo..hi inclusive."""
    return df.where(F.year(F.col(date)).between(lo, hi))


def exclude_window(df: DataFrame, date: str, start: str, end: str) -> DataFrame:
    """P10: remove an inclusive date window."""
    return df.where(~F.col(date).between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def project_rename_drop(df: DataFrame, keep: Sequence[str] | None = None,
                        rename: Mapping[str, str] | None = None,
                        drop: Sequence[str] = ()) -> DataFrame:
    """Select, rename by a label map, drop."""
    out = df.select(*keep) if keep else df
    if rename:
        out = out.withColumnsRenamed(dict(rename))
    return out.drop(*drop) if drop else out


def zero_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL measure -> 0."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in cols})


def winsor_bounds(long: DataFrame, group: str = "metric", value: str = "value",
                  lower: float = 0.01, upper: float = 0.99, min_count: int = 10) -> DataFrame:
    """Per-group clip bounds; groups with fewer than ``min_count`` values get none."""
    q = quantile_table(long, [group], value, [lower, upper], ["_lo", "_hi"])
    return q.where(F.col("n") >= min_count).select(group, "_lo", "_hi")


def winsorize(long: DataFrame, group: str = "metric", value: str = "value",
              lower: float = 0.01, upper: float = 0.99, min_count: int = 10,
              flag: str | None = None) -> DataFrame:
    """Clip each group to its exact interpolated [lower, upper] quantiles.

    The bounds table has one row per group; the join back is left to the
    planner (broadcast when small, as it is for a list of metrics).
    """
    b = winsor_bounds(long, group, value, lower, upper, min_count)
    j = long.join(b, [group], "left")
    v = F.col(value)
    clipped = F.when(F.col("_lo").isNull() | v.isNull(), v).otherwise(
        F.least(F.greatest(v, F.col("_lo")), F.col("_hi")))
    out = j.withColumn("_clip", (clipped != v)).withColumn(value, clipped)
    if flag:
        out = out.withColumn(flag, F.coalesce(F.col("_clip"), F.lit(False)))
    return out.drop("_lo", "_hi", "_clip")


def clip_counts(long: DataFrame, group: str = "metric", value: str = "value", **kw) -> DataFrame:
    """Report of P13: rows clipped per group."""
    w = winsorize(long, group, value, flag="_was_clipped", **kw)
    return w.groupBy(group).agg(F.sum(F.col("_was_clipped").cast("long")).alias("n_clipped"),
                                F.count(F.lit(1)).alias("n_rows"))


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first under ``order``.

    Written as a ``min`` over a struct led by the order columns: a partial
    aggregate runs before the shuffle, so of a key that holds a third of the
    rows each task sends one (a ``row_number`` window would gather them all).
    Spark sorts by key for it.  Name an order column that says what came
    first; the other columns only break its ties.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order)
    tail = [c for c in rest if c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in tail]).alias("_first")
    g = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return g.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest])


def key_not_null_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raise when any key is NULL; return the frame unchanged otherwise."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    bad = df.where(cond).limit(1).count()
    if bad:
        raise ValueError(f"NULL found in key columns {list(keys)}")
    return df


def cleaning_audit(stages: Mapping[str, DataFrame], cols: Sequence[str], keys: Sequence[str] = (),
                   clipped: str | None = None) -> DataFrame:
    """One row per stage: rows, missing count and % per column, and with
    ``keys`` the rows beyond the first of their key (``n_duplicates``), with
    ``clipped`` the rows that flag marks (``n_clipped``; 0 before it exists).

    Each stage is one aggregate; the stages are unioned (small output).
    """
    rows = None
    for name, df in stages.items():
        aggs = [F.count(F.lit(1)).alias("n_rows")]
        for c in cols:
            miss = F.sum(F.col(c).isNull().cast("long"))
            aggs += [miss.alias(f"{c}_missing"),
                     F.try_divide(miss * 100.0, F.count(F.lit(1))).alias(f"{c}_missing_pct")]
        if keys:
            aggs.append((F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).alias("n_duplicates"))
        if clipped:
            flag = F.sum(F.col(clipped).cast("long")) if clipped in df.columns else F.lit(0).cast("long")
            aggs.append(F.coalesce(flag, F.lit(0)).alias("n_clipped"))
        r = df.agg(*aggs).select(F.lit(name).alias("stage"), "*")
        rows = r if rows is None else rows.unionByName(r)
    return rows


def audited_clean(raw: DataFrame, keys: Sequence[str], order: Sequence[str], group: str = "metric", value: str = "value",
                  **winsor) -> tuple[DataFrame, DataFrame]:
    """Drop null measures, keep the first row per key, winsorize: (cleaned table, audit of the four stages, as ``cleaning_audit``).

    Counts are observed on the passes that clean.  One aggregate per key gives
    both the first row and how often the key occurs, with and without a value,
    so duplicates of every stage are sums over it; the rows it keeps are
    written, and the clipped ones once more.  ``order`` says what came first
    (the order of ingest); other columns break its ties.
    """
    from ..session import cut_lineage
    spark = raw.sparkSession
    n, null = F.count(F.lit(1)), F.sum(F.col(value).isNull().cast("long"))
    seen, copies, out = Observation(), Observation(), Observation()
    rest = [c for c in raw.columns if c not in keys and c not in order]
    packed = F.struct(*order, *rest)
    first = (raw.observe(seen, n.alias("n"), null.alias("null"))
             .groupBy(*keys).agg(n.alias("_all"), F.count(value).alias("_some"), F.min(F.when(F.col(value).isNotNull(), packed)).alias("_first"))
             .observe(copies, n.alias("keys"), F.sum("_some").alias("rows"), F.sum(F.greatest(F.col("_some") - 1, F.lit(0))).alias("again"),
                      F.sum((F.col("_some") > 0).cast("long")).alias("kept")))
    deduped = cut_lineage(first.where("_some > 0").select(*keys, *[F.col(f"_first.{c}").alias(c) for c in raw.columns if c not in keys])
                          .select(*raw.columns), "deduped")
    clipped = winsorize(deduped, group, value, flag="clipped", **winsor)
    clean = cut_lineage(clipped.observe(out, n.alias("n"), null.alias("null"), F.sum(F.col("clipped").cast("long")).alias("clipped")), "winsorized")
    a, b, c = ({k: v or 0 for k, v in x.get.items()} for x in (seen, copies, out))
    rows = [("raw", a["n"], a["null"], a["n"] - b["keys"], 0), ("non_null", b["rows"], 0, b["again"], 0),
            ("deduped", b["kept"], 0, 0, 0), ("winsorized", c["n"], c["null"], 0, c["clipped"])]
    audit = spark.createDataFrame(rows, f"stage string, n_rows long, {value}_missing long, n_duplicates long, n_clipped long")
    return clean, audit.select("stage", "n_rows", f"{value}_missing", F.try_divide(F.col(f"{value}_missing") * 100.0, F.col("n_rows")).alias(f"{value}_missing_pct"),
                               "n_duplicates", "n_clipped")


def threshold_category(df: DataFrame, col: str, out: str = "category",
                       high: str = "Sensitive", low: str = "Resilient") -> DataFrame:
    """``>= median`` of the column -> high label, else low."""
    from .joins import attach_scalar
    from .quantile import quantile_table as qt
    med = qt(df, [], col, [0.5], ["_median"], with_count=False)
    j = attach_scalar(df, med)
    return j.withColumn(out, F.when(F.col(col) >= F.col("_median"), F.lit(high))
                        .otherwise(F.lit(low))).drop("_median")
