"""Incremental ingest of wide time-matrix files (S1 -> S6 as a stream).

The reference has no streaming operator; this runs the *same* wide-to-long
cleaning and the long-table sink incrementally with Structured Streaming,
for deployments where new monthly files keep arriving.  Each micro-batch is
written to its own ``epoch=<id>`` folder in overwrite mode, so a retried
batch replaces its own output (idempotent); the source offsets live in the
checkpoint location on the shared file system.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.wide import WIDE_META, wide_to_long


def wide_schema(dates: Sequence[str], meta: Sequence[str] = WIDE_META) -> T.StructType:
    """All-text schema of a wide file (streams need the schema up front)."""
    return T.StructType([T.StructField(c, T.StringType()) for c in list(meta) + list(dates)])


def stream_wide_ingest(spark: SparkSession, source_dir: str, metric: str, schema: T.StructType,
                       sink_path: str, checkpoint_location: str,
                       filters: Mapping[str, str] | None = None,
                       available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream: new CSV files in ``source_dir`` -> long rows appended
    to ``sink_path`` (parquet, partitioned by epoch and metric)."""
    reader = spark.readStream.schema(schema).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.csv(source_dir)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        # line order inside the batch: later lines win for a repeated entity
        lined = batch.withColumn("_line", F.monotonically_increasing_id())
        long = wide_to_long(lined, metric, line_col="_line", filters=filters)
        (long.write.mode("overwrite").partitionBy("metric")
         .parquet(f"{sink_path}/epoch={epoch_id}"))

    w = (src.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
