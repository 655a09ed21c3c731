"""header/detail text (a header line names the records below it).

A header line starts with a basin prefix and a number (``AL092004, NAME,
34,``); detail lines (>= 8 comma fields, 8-digit date first) belong to the
nearest header above them in the same file.

Carry-forward without one task per file: lines carry ``(file, block,
pos)`` where ``block`` is the file split (or any coarse, ordered cut of the
position).  Inside a block the last header is a window over that block
only; the header in force at a block's start is the last header of the
preceding blocks, found on a table with one row per (file, block).

Lines straight from ``read_lines`` come block by block and in order, so
there the scan's own tasks carry the header on (``in_order``): no line is
shuffled or sorted.  Lines in any other order are windowed by block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import sentinel_int, signed_lat, signed_lon
from ..session import cut_lineage, ship_package

# Fixed values of the format.
HEADER_LINE = r"^\s*(AL|EP|CP)[0-9][^,]*,[^,]*,"  # prefix and number, at least three fields
DETAIL_MIN_FIELDS = 8


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """(file, block, pos, line) for text files; pos follows the file order."""
    df = spark.read.text(paths)
    return df.select(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("pos"),
                     F.col("value").alias("line"))


def headers_before(t: DataFrame, file: str, block: str, pos: str) -> DataFrame:
    """(file, block, _hdr_prev): the header in force where a block starts, from lines with ``_is_hdr`` and ``_hdr``.

    One aggregate lists every block with its last header (NULL when none):
    a small table, one row per block.
    """
    blocks = (t.groupBy(file, block)
              .agg(F.max(F.when(F.col("_is_hdr"), F.struct(F.col(pos).alias("p"), F.col("_hdr").alias("h"))))
                   .alias("_end")))
    prior = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(file, block, F.last(F.col("_end.h"), ignorenulls=True).over(prior).alias("_hdr_prev"))


def fill_headers(file: str, block: str, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function: the fields ``names`` of header lines go to the lines after them in the block.

    ``_found`` tells whether a header came before in the block.  Holds one
    batch and the header in force.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held = None, None  # block of the last line, its header's fields
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            keys = [b.column(file), b.column(block)]
            starts = np.zeros(n, bool)
            starts[0] = seen != tuple(k[0].as_py() for k in keys)
            for k in keys:
                code = k.dictionary_encode(null_encoding="encode").indices.to_numpy()
                starts[1:] |= code[1:] != code[:-1]
            head = pc.fill_null(b.column("_is_hdr"), False).to_numpy(zero_copy_only=False)
            # the last header or start of a block up to each line; 0 is the header held from the batch before
            source = np.maximum.accumulate(np.where(head | starts, np.arange(1, n + 1), 0))
            found = np.concatenate([[held is not None], head])[source]
            at = pa.array(source)
            out = {c: b.column(c) for c in b.schema.names}
            for c in names:
                first = pa.array([held[c] if held else None], out[c].type)
                out[c] = pa.concat_arrays([first, out[c]]).take(at)
            out["_found"] = pa.array(found)
            seen = tuple(k[n - 1].as_py() for k in keys)
            held = {c: out[c][n - 1].as_py() for c in names} if found[-1] else None
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))
    return run


def block_ends(file: str, block: str, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function: of ``fill_headers``' lines, the last of each block."""
    fill = fill_headers(file, block, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = None  # the last line so far
        for b in fill(batches):
            keys = [b.column(file), b.column(block)]
            if end is not None and any(end.column(c)[0].as_py() != k[0].as_py() for c, k in zip((file, block), keys)):
                yield end
            last = np.zeros(b.num_rows - 1, bool)
            for k in keys:
                code = k.dictionary_encode(null_encoding="encode").indices.to_numpy()
                last |= code[1:] != code[:-1]
            if last.any():
                yield b.take(pa.array(np.flatnonzero(last)))
            end = b.slice(b.num_rows - 1, 1)
        if end is not None:
            yield end
    return run


def carry_in_order(lines: DataFrame, is_header, header_cols: dict, file: str, block: str) -> DataFrame:
    """``carry_forward`` for lines as ``read_lines`` gives them: each block whole in one task, in order."""
    from ..operators.joins import broadcast_if_small
    spark = lines.sparkSession
    names = list(header_cols)
    t = lines.select("*", is_header.alias("_is_hdr"), *[F.when(is_header, c).alias(n) for n, c in header_cols.items()])
    ship_package(spark)

    def in_tasks(df: DataFrame, run) -> DataFrame:
        return df.mapInArrow(run(file, block, names), T.StructType([*df.schema.fields, T.StructField("_found", T.BooleanType())]))

    # blocks that begin below an earlier header; files of one block have none
    prior = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    ends = in_tasks(t.select(file, block, "_is_hdr", *names), block_ends)
    ends = ends.select(file, block, F.last(F.when(F.col("_found"), F.struct(*names)), ignorenulls=True).over(prior).alias("_hdr_prev"))
    prev = cut_lineage(ends.where(F.col("_hdr_prev").isNotNull()), "headers-before")
    t = in_tasks(t, fill_headers)
    t = t.join(broadcast_if_small(prev), [file, block], "left")
    return t.select(*lines.columns, "_is_hdr",
                    *[F.when(F.col("_found"), F.col(n)).otherwise(F.col(f"_hdr_prev.{n}")).alias(n) for n in names])


def carry_forward(lines: DataFrame, is_header, header_cols: dict, file: str = "file",
                  block: str = "block", pos: str = "pos", in_order: bool = False) -> DataFrame:
    """Attach to every line the header fields in force at that line.

    ``in_order``: the lines come straight from ``read_lines`` (no shuffle or
    sort since), so no line needs to move.
    """
    if in_order:
        return carry_in_order(lines, is_header, header_cols, file, block)
    hdr = F.when(is_header, F.struct(*[c.alias(n) for n, c in header_cols.items()]))
    t = lines.withColumn("_hdr", hdr).withColumn("_is_hdr", is_header)
    in_block = Window.partitionBy(file, block).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("_hdr_in", F.last("_hdr", ignorenulls=True).over(in_block))
    t = t.join(headers_before(t, file, block, pos), [file, block], "left")
    t = t.withColumn("_h", F.coalesce("_hdr_in", "_hdr_prev"))
    return t.select("*", *[F.col(f"_h.{n}").alias(n) for n in header_cols]).drop(
        "_hdr", "_hdr_in", "_hdr_prev", "_h")


def parse_header_detail(lines: DataFrame, file: str = "file", block: str = "block",
                        pos: str = "pos", line: str = "line", in_order: bool = False) -> DataFrame:
    """Track points: storm_id, storm_name, date, time, record_id, status,
    lat, lon, max_wind, min_pressure (types as in the reference).
    ``in_order`` as in ``carry_forward``."""
    is_header = F.col(line).rlike(HEADER_LINE)
    field = lambda i: F.trim(F.split_part(F.col(line), F.lit(","), F.lit(i)))
    # lines and header fields are carried; details are split after it
    t = carry_forward(lines, is_header, {"storm_id": field(1), "storm_name": field(2)}, file, block, pos, in_order)
    t = t.where(~F.col("_is_hdr") & F.col("storm_id").isNotNull()).withColumn("_p", F.transform(F.split(F.col(line), ","), lambda x: F.trim(x)))
    p = lambda i: F.get("_p", F.lit(i))  # noqa: E731  (null beyond the last field)
    detail = (F.size("_p") >= DETAIL_MIN_FIELDS) & p(0).rlike(r"^[0-9]{8}$")
    out = t.where(detail).select(
        "storm_id", "storm_name",
        p(0).alias("date"), p(1).alias("time"), p(2).alias("record_id"), p(3).alias("status"),
        signed_lat(p(4)).alias("lat"), signed_lon(p(5)).alias("lon"),
        sentinel_int(p(6)).alias("max_wind"), sentinel_int(p(7)).alias("min_pressure"))
    return out.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
