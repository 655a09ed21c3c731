"""Derived panels are built once per session and read by every analysis.

A panel (cells = entity x period) is far smaller than the raw tables it is
aggregated from, and every analysis branch reads it several times (ranks,
balancing, joins back).  Without this, each branch would repeat the raw
joins and aggregates.  Each panel is checkpointed reliably into the shared
``spark.checkpoint.dir`` (survives executor loss, cuts lineage) and memoised
per application, key and listing of the input files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import cut_lineage, session_key

_MEMO: dict = {}


def _listing(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the tables in a folder, as the file system has them now."""
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        found = []
        for f in fs.listStatus(path):
            parts = fs.listStatus(f.getPath()) if f.isDirectory() else [f]
            found += [(p.getPath().toString(), p.getLen(), p.getModificationTime()) for p in parts]
        return tuple(sorted(found))
    except AttributeError:  # no JVM at hand (a remote session): the path alone
        return ()


def materialized(spark: SparkSession, key: tuple, build: Callable[[], DataFrame]) -> DataFrame:
    """``key`` is a name, the folder it is built from, and further parts."""
    k = (session_key(spark), *key, _listing(spark, key[1]))
    df = _MEMO.get(k)
    if df is None:
        df = cut_lineage(build())
        _MEMO[k] = df
    return df
