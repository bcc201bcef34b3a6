"""Structured Streaming: landed crawl files through the batch plan, and windows over event streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.pipeline import Engine
from ..sources import jsonl


def watch(engine: Engine, directory: str, ctx: jsonl.Context, checkpoint: str, ref_time: str | None = None, once: bool = True, files_per_trigger: int = 100) -> StreamingQuery:
    """New content files below a directory go through ingest and cleaning, a micro-batch at a time.

    Files are read by ranges of lines, as in batch: a large one has many tasks, no file is a row, and ids are the same.

    The same items are ignored by key and the same decisions made once, so a batch that is replayed after a failure
    changes nothing. Age is judged by the cleaning plan and recorded there; a watermark would drop rows without a trace.
    """
    spark = engine.spark
    lines = jsonl.with_place(spark.readStream.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", "*content*.jsonl").option("maxFilesPerTrigger", files_per_trigger).load(directory))

    def step(batch: DataFrame, batch_id: int) -> None:
        good, _ = jsonl.split_errors(jsonl.map_items(jsonl.parsed(jsonl.numbered(batch)), ctx))
        engine.store.append_new("raw_items", good)
        engine.process(ref_time or spark.sql("select date_format(current_timestamp(), 'yyyy-MM-dd HH:mm:ss')").first()[0], f"stream-{batch_id}")

    w = lines.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")).start()


def event_stream(spark: SparkSession, directory: str, schema, pattern: str = "events*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(directory)


def _marked(events: DataFrame, late: str) -> DataFrame:
    """A stream with a watermark (which zoneless times can't have: they are taken as the session's); a table as it is."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events


def heat_windows(events: DataFrame, size: str = "1 hour", late: str = "72 hours") -> DataFrame:
    """Events and value per type and window; works on streams (bounded state by the watermark) and on tables."""
    e = _marked(events, late)
    return e.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "72 hours") -> DataFrame:
    """Sessions of each user: events not further apart than the gap; on streams and on tables."""
    e = _marked(events, late)
    return e.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")
