"""Daily ``event_rate`` over an event folder, kept current by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from batchkit.operators.business import event_rate


def daily_event_rate_stream(spark: SparkSession, source_dir: str, schema, numerator: str, denominator: str,
                            ts: str = "ts", event: str = "event_type", watermark: str = "1 day",
                            max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of ``(day, r)``: the same ``event_rate`` aggregate per
    calendar day, over parquet files arriving in ``source_dir``.

    A one-day tumbling window on ``ts`` with a watermark bounds the state: a day's
    counters are dropped once the watermark passes the end of the day.  The two
    ``count_if`` counters are the only state per day.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.parquet(source_dir).withColumn("_ts", F.col(ts).cast("timestamp"))
    return (events.withWatermark("_ts", watermark)
            .groupBy(F.window("_ts", "1 day").alias("w"))
            .agg(event_rate(event, numerator, denominator).alias("r"))
            .select(F.date_format(F.col("w.start"), "yyyy-MM-dd").alias("dt"), "r"))


def start(df: DataFrame, checkpoint_dir: str, sink_table: str, mode: str = "update") -> StreamingQuery:
    """Run ``df`` into a memory table (tests, notebooks) with its own checkpoint folder,
    which must be shared storage on a cluster so a restarted query resumes.  The memory
    sink holds its rows on the driver: for anything large use :func:`start_files`."""
    return (df.writeStream.outputMode(mode).format("memory").queryName(sink_table)
            .option("checkpointLocation", checkpoint_dir).start())


def start_files(df: DataFrame, checkpoint_dir: str, path: str) -> StreamingQuery:
    """Append finished days as parquet files under ``path`` (each once, by the sink's log);
    a day is written when the watermark has passed it, nothing is held on the driver."""
    return (df.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint_dir).start())
