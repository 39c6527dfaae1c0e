"""Incremental ingest: new files once, latest record per key, counts over event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def new_files(spark: SparkSession, path: str, schema: StructType, kind: str = "json") -> DataFrame:
    """A stream of the files that appear under ``path``."""
    return spark.readStream.schema(schema).format(kind).load(path)


def append_new(stream: DataFrame, path: str, checkpoint: str, key: Sequence[str] = (), within: str = "", time: str = "") -> StreamingQuery:
    """Append what is new and stop; with a key and a time column, repetitions within the watermark are dropped."""
    if key:
        stream = stream.withWatermark(time, within).dropDuplicatesWithinWatermark(list(key))
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, by: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per window of event time, batch or stream; what comes later than ``late`` no longer counts in a stream."""
    source = events.withWatermark(time, late) if events.isStreaming else events
    return source.groupBy(F.window(time, window).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")
