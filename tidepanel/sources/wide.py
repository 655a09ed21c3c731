"""Wide time matrices (one column per date) -> long panel rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import tolerant_double

# Fixed metadata columns of a wide time-matrix file.
WIDE_META = ("RegionID", "SizeRank", "RegionName", "RegionType", "StateName")


def wide_to_long(wide: DataFrame, metric: str | None = None, entity_col: str = "RegionName",
                 meta: Sequence[str] = WIDE_META, line_col: str | None = None,
                 filters: Mapping[str, str] | None = None, metric_col: str | None = None) -> DataFrame:
    """Unpivot every non-metadata column (a date header) into long rows.

    The metric label is either a constant (one file per metric) or a column
    (``metric_col``: many files read at once, label from the file name).

    * ``filters``: equality tests on metadata applied *before* the unpivot;
    * blank entity names are dropped; cells that do not parse as numbers
      are dropped (P3); headers that are not dates are ignored;
    * when ``line_col`` is given and an entity repeats, the last line wins
      per date (``max_by`` — a partial aggregate, no sort).
    """
    present_meta = [c for c in wide.columns if c in set(meta) or c in (line_col, metric_col)]
    date_cols = [c for c in wide.columns if c not in present_meta]
    w = wide
    for k, v in (filters or {}).items():
        w = w.where(F.col(k) == F.lit(v))
    w = w.where(F.col(entity_col).isNotNull() & (F.trim(F.col(entity_col)) != ""))
    ids = [entity_col] + ([line_col] if line_col else []) + ([metric_col] if metric_col else [])
    cells = w.select(*ids, *[F.col(f"`{c}`").cast("string").alias(c) for c in date_cols]) \
        .unpivot(ids, date_cols, "_hdr", "_txt")
    long = (cells.select(F.col(entity_col).alias("entity"),
                         F.try_to_date(F.col("_hdr"), "yyyy-MM-dd").alias("date"),
                         (F.col(metric_col) if metric_col else F.lit(metric)).alias("metric"),
                         tolerant_double("_txt").alias("value"),
                         *([F.col(line_col).alias("_line")] if line_col else []))
            .where(F.col("date").isNotNull() & F.col("value").isNotNull()))
    if line_col:
        long = (long.groupBy("entity", "date", "metric")
                .agg(F.max_by("value", "_line").alias("value")))
    return long


def read_wide_dates(spark: SparkSession, files: Mapping[str, str], **kw) -> DataFrame:
    """Read one wide CSV per metric (``{metric: path}``) into one long table.

    Every cell is read as text; a missing file is skipped with a warning
    (the metric is absent), as the reference does.  The line order for
    "last row wins" comes from the file split and the row position in it.
    """
    import warnings

    from pyspark.errors import AnalysisException

    out = None
    for metric, path in files.items():
        try:
            df = (spark.read.option("header", True).option("inferSchema", False).csv(path)
                  .withColumn("_line", F.struct(F.col("_metadata.file_block_start"),
                                                F.monotonically_increasing_id())))
            df.schema  # resolve now so a missing path is reported here
        except AnalysisException:
            warnings.warn(f"wide file for {metric} not found: {path}; skipped")
            continue
        part = wide_to_long(df, metric, line_col="_line", **kw)
        out = part if out is None else out.unionByName(part)
    return out


#: A comma outside quotes.
_CELL_SPLIT = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def csv_cells(line) -> F.Column:
    """Cells of a CSV line: quotes around a cell go, doubled ones inside become one."""
    cell = F.transform(F.split(line, _CELL_SPLIT, -1), lambda c: F.trim(c))
    quoted = lambda c: c.startswith('"') & c.endswith('"') & (F.length(c) >= 2)
    return F.transform(cell, lambda c: F.when(quoted(c), F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))


def read_wide_files(spark: SparkSession, path, metric=None, entity_col: str = "RegionName", meta: Sequence[str] = WIDE_META,
                    filters: Mapping[str, str] | None = None) -> DataFrame:
    """All wide CSV files under ``path`` (a path or a list) in one text scan, whatever columns each has.

    A file's header is its first line: headers are one row a file, joined back
    by file, and a cell finds its date by its place in its own file's header.
    ``metric``: a Column of ``_path`` (the file's path), by default what stands
    behind ``metric=`` in it.  As in ``wide_to_long``: filters apply to metadata
    cells, blank entities, headers that are no dates and cells that are no
    numbers are dropped, and the last line of an entity wins per date and metric
    (of several files, that of the last path).
    A cell holds no line break.
    """
    label = F.regexp_extract("_path", "metric=([^/]+)", 1) if metric is None else metric
    lines = spark.read.text(path).select(
        F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_path"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("_at"))
    heads = lines.groupBy(F.col("_path").alias("_file")).agg(F.min("_at").alias("_first"), F.min_by(F.regexp_replace("_line", "^\ufeff|\r$", ""), "_at").alias("_head"))
    heads = heads.select("_file", "_first", csv_cells(F.col("_head")).alias("_head"))
    rows = (lines.join(heads, F.col("_path") == F.col("_file")).where(F.col("_at") != F.col("_first"))
            .withColumn("_cells", csv_cells(F.regexp_replace("_line", "\r$", ""))))

    def named(c: str) -> F.Column:
        return F.try_element_at("_cells", F.nullif(F.array_position("_head", c), F.lit(0)).cast("int"))
    for k, v in (filters or {}).items():
        rows = rows.where(named(k) == F.lit(v))
    keep = ~F.col("x._head").isin(*meta, entity_col)
    cells = (rows.select(named(entity_col).alias("entity"), label.alias("metric"), F.struct("_path", "_at").alias("_at"), F.explode(F.arrays_zip("_head", "_cells")).alias("x"))
             .where(F.col("entity").isNotNull() & (F.trim("entity") != "") & keep)
             .select("entity", F.try_to_date(F.col("x._head"), "yyyy-MM-dd").alias("date"), "metric", tolerant_double("x._cells").alias("value"), "_at")
             .where(F.col("date").isNotNull() & F.col("value").isNotNull()))
    return cells.groupBy("entity", "date", "metric").agg(F.max_by("value", "_at").alias("value"))
