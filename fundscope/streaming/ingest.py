"""Staged records as a file stream: each micro-batch replaces its slices, so a replayed batch changes nothing.

The checkpoint takes the place of a staging file rewritten after every item.  Windowed counts over event time are an
extension; late rows beyond the watermark are dropped by Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def replace_batches(spark: SparkSession, source: str, schema: str, target: str, slice_columns: Sequence[str], checkpoint: str) -> StreamingQuery:
    """Stream Parquet files from ``source`` into ``target``, partitioned by the slice columns.

    Overwriting only the partitions that a batch has rows for is idempotent, and atomic per partition folder.
    """

    def write(batch: DataFrame, _: int) -> None:
        batch.repartition(*slice_columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*slice_columns).parquet(target)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, by: Sequence[str], width: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """(window start, by, n, total): tumbling or sliding counts of event time; works on batch frames too."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    out = stream.withWatermark(time, late) if stream.isStreaming else stream
    return out.groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")).select(F.col("w.start").alias("start"), *by, "n", "total")


def sessions(stream: DataFrame, time: str, by: Sequence[str], gap: str, late: str = "10 minutes") -> DataFrame:
    out = stream.withWatermark(time, late) if stream.isStreaming else stream
    return out.groupBy(F.session_window(time, gap).alias("s"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("s.start").alias("start"), F.col("s.end").alias("end"), *by, "n")
