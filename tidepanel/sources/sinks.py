"""Write the long table and result tables; dataset metadata and a
measured column dictionary."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.aggregates import panel_counts


def sink_long(long: DataFrame, path: str, fmt: str = "parquet",
              partition_by: Sequence[str] = ("metric",), sort_by: Sequence[str] = (),
              alias: str | None = None) -> None:
    """Write the long table, partitioned by metric (parquet) or as a CSV
    folder with a header.

    ``sort_by`` gives the files a total order (part names in order, rows in
    order within them) by a range shuffle.  ``alias`` is a second folder that
    gets the same rows; it is copied from what was written, not computed anew.
    """
    def write(df: DataFrame, to: str) -> None:
        df = df.orderBy(*sort_by) if sort_by else df
        if fmt == "parquet":
            df.write.mode("overwrite").partitionBy(*partition_by).parquet(to)
        else:
            df.write.mode("overwrite").option("header", True).csv(to)

    write(long, path)
    if alias:
        read = long.sparkSession.read.schema(long.schema)
        back = read.parquet(path) if fmt == "parquet" else read.option("header", True).csv(path)
        write(back.select(*long.columns), alias)


def publish_long(long: DataFrame, root: str, name: str, alias: str, sort_by: Sequence[str]) -> str:
    """S6 as a checked result: the long table as sorted CSV under two names, which appear together or not at all.

    Each publication is a folder of its own, sorted by a range shuffle; the
    alias is copied from what was written.  The commit is one small file
    appended to the manifest, after both are whole: readers
    (``read_published``) see the last publication that was committed, and a
    job that fails or is retried leaves at most a folder that no manifest row
    names.  Returns the version.
    """
    spark = long.sparkSession
    version = uuid.uuid4().hex
    folder = f"{root}/versions/{version}"
    sink_long(long, f"{folder}/{name}", "csv", sort_by=sort_by, alias=f"{folder}/{alias}")
    row = [(version, [name, alias], long.schema.json(), time.time_ns())]
    (spark.createDataFrame(row, "version string, names array<string>, schema string, published long").coalesce(1)
     .write.mode("append").json(f"{root}/manifest"))
    return version


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of the last committed publication that has ``name``, with ``_file`` and ``_place`` (where a row stands in it)."""
    rows = spark.read.schema("version string, names array<string>, schema string, published long").json(f"{root}/manifest")
    last = rows.where(F.array_contains("names", name)).orderBy(F.desc("published"), "version").first()
    if last is None:
        raise FileNotFoundError(f"nothing published as {name} under {root}")
    schema = T.StructType.fromJson(json.loads(last["schema"]))
    files = spark.read.schema(schema).option("header", True).csv(f"{root}/versions/{last['version']}/{name}")
    return files.select("*", F.col("_metadata.file_name").alias("_file"),
                        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("_place"))


def dataset_metadata(long: DataFrame, entity: str = "entity", date: str = "date",
                     metric: str = "metric") -> DataFrame:
    """One row describing the panel, from period bitmaps.

    ``panel_type``: balanced if all entities have equally many periods (not
    necessarily the same, nor all; that would be ``n_cells`` = ``n_entities`` x ``n_periods``).
    """
    n = panel_counts(long, entity, date, metric)
    return n.select("n_entities", "n_periods", "n_obs", "time_min", "time_max", "n_variables", "n_cells", F.when(
        F.col("min_obs_entity") == F.col("max_obs_entity"), F.lit("balanced")).otherwise(F.lit("unbalanced")).alias("panel_type"))


def column_dictionary(df: DataFrame, dataset: str, keys: Sequence[str] = (),
                      approx_distinct: bool = False, rsd: float = 0.01) -> DataFrame:
    """Per column dataset, name, type, role and measured null %,
    distinct count, min and max (numbers only) — one aggregate pass.

    Exact distinct counts expand every row once per column in the shuffle;
    ``approx_distinct`` switches to HyperLogLog sketches (partial aggregates,
    fixed size) for very wide or very large tables."""
    fields = df.schema.fields
    numeric = {f.name for f in fields if f.dataType.typeName() in
               ("double", "float", "integer", "long", "short", "decimal")}
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(fields):
        c = F.col(f.name)
        aggs += [F.sum(c.isNull().cast("long")).alias(f"_null{i}"),
                 (F.approx_count_distinct(c, rsd) if approx_distinct else F.count_distinct(c)).alias(f"_nd{i}")]
        if f.name in numeric:
            aggs += [F.min(c).cast("double").alias(f"_min{i}"), F.max(c).cast("double").alias(f"_max{i}")]
    one = df.agg(*aggs)
    rows = []
    for i, f in enumerate(fields):
        role = "key" if f.name in keys else ("measure" if f.name in numeric else "attribute")
        rows.append(F.struct(
            F.lit(dataset).alias("dataset"), F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"), F.lit(role).alias("role"),
            (F.col(f"_null{i}") * 100.0 / F.col("_n")).alias("null_pct"),
            F.col(f"_nd{i}").alias("n_distinct"),
            (F.col(f"_min{i}") if f.name in numeric else F.lit(None).cast("double")).alias("min"),
            (F.col(f"_max{i}") if f.name in numeric else F.lit(None).cast("double")).alias("max")))
    return one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
