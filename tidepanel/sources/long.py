"""Typed long rows and the schema contract."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG_SCHEMA = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def typed_long(text: DataFrame, entity: str = "entity", date: str = "date",
               metric: str = "metric", value: str = "value") -> DataFrame:
    """Text long rows -> typed (entity, date, metric, value); bad dates or
    numbers become NULL (ANSI-safe ``try_`` casts)."""
    return text.select(F.col(entity).cast("string").alias("entity"),
                       F.try_to_date(F.col(date).cast("string")).alias("date"),
                       F.col(metric).cast("string").alias("metric"),
                       F.col(value).cast("string").try_cast("double").alias("value"))


def read_typed_long(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    if fmt == "parquet":
        return spark.read.schema(LONG_SCHEMA).parquet(path)
    text = spark.read.option("header", True).csv(path)
    return typed_long(text)


class ContractError(ValueError):
    pass


def schema_contract(df: DataFrame, required: Sequence[str], optional: Sequence[str] = (),
                    name: str = "input") -> DataFrame:
    """Raise when required columns are missing; keep required + the optional
    columns that are present (checked on the schema, before any action)."""
    cols = set(df.columns)
    missing = [c for c in required if c not in cols]
    if missing:
        raise ContractError(f"{name}: missing required columns {missing}")
    absent = [c for c in optional if c not in cols]
    if absent:
        warnings.warn(f"{name}: optional columns not present: {absent}")
    return df.select(*required, *[c for c in optional if c in cols])
