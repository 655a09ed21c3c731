"""S3: JSON documents holding an array of event records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("begDate", T.LongType()),
        T.StructField("endDate", T.LongType()),
        T.StructField("adjCost", T.DoubleType()),
        T.StructField("deaths", T.IntegerType()),
    ])))
])


def explode_events(docs: DataFrame, doc_col: str | None = None) -> DataFrame:
    """Explode ``data[]``; a missing cost or death count becomes 0; the year
    is the first four digits of the begin date (NULL when it has fewer)."""
    src = docs.select(F.from_json(F.col(doc_col), EVENT_SCHEMA).alias("_d")) if doc_col else \
        docs.select(F.struct("data").alias("_d"))
    ev = src.select(F.explode("_d.data").alias("e")).select("e.*")
    beg = F.col("begDate").cast("string")
    return ev.select(
        F.col("name"),
        F.when(F.length(beg) >= 4, F.substring(beg, 1, 4).cast("int")).alias("year"),
        beg.alias("begin_date"), F.col("endDate").cast("string").alias("end_date"),
        F.coalesce(F.col("adjCost"), F.lit(0.0)).alias("cost"),
        F.coalesce(F.col("deaths"), F.lit(0)).alias("deaths"))


def read_nested_json(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Read JSON documents with a fixed schema (no inference): one per file,
    over many lines, or one on each line (files of these can be split)."""
    docs = spark.read.schema(EVENT_SCHEMA).option("multiLine", not one_per_line).json(path)
    return explode_events(docs)
