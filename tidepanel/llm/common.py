"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path, ship_package  # noqa: F401  (re-exported)


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def column(name: str) -> Column:
    """The column of that very name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def apart(docs: DataFrame, *used: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with plain names for all columns but ``used``, so that none clashes with an operator's own; and the names in order."""
    names = [c if c in used else f"col{i}_" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), names


def together(df: DataFrame, names: list[str], docs: DataFrame, *more: str | Column) -> DataFrame:
    """The columns of ``docs`` under their own names again, and ``more``."""
    return df.select(*[column(n).alias(c) for n, c in zip(names, docs.columns, strict=True)], *more)


def bucket_of(col: str, modulus: int) -> Column:
    """crc32 of the decimal text of an id, modulo ``modulus`` (null id: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch], text_col: int, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each slice holds about ``max_bytes`` of text.

    Spark cuts its batches by rows; a batch of very long texts would
    otherwise set the memory of a worker.  A single text is never cut.
    What earlier tasks of the worker left unused in Arrow's pool goes back first.
    """
    pa.default_memory_pool().release_unused()
    for b in batches:
        lens = pa.compute.fill_null(pa.compute.binary_length(b.column(text_col)), 0).to_pylist()
        start = size = 0
        for i, n in enumerate(lens):
            if size and size + n > max_bytes:
                yield b.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < b.num_rows:
            yield b.slice(start)


import pyarrow.compute  # noqa: E402,F401  (pa.compute is loaded on import)
