"""Continuous ingest of arriving PDF files, and running counters."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.tokens import Counter
from ..plans.ingest import ingest_pdf
from ..sinks import files

SOURCE = "path string, modificationTime timestamp, length long, content binary"


def arriving(spark: SparkSession, folder: str) -> DataFrame:
    df = spark.readStream.format("binaryFile").schema(SOURCE).option("pathGlobFilter", "*.pdf").load(folder)
    return df.select(F.regexp_extract("path", r"([^/]+)\.pdf$", 1).alias("document_id"), "content", "length")


def start(spark: SparkSession, folder: str, root: str, tenant_id: str, checkpoint: str, counter: Counter | None = None, available_now: bool = False) -> StreamingQuery:
    """Ingest each batch of new files into the tables under ``root``; a repeated batch replaces its own documents."""

    def batch(df: DataFrame, _: int) -> None:
        if df.isEmpty():
            return
        began, done = time.monotonic(), ingest_pdf(df, counter)
        try:
            done.pages.count()  # the whole of reading and scoring, which the tables then share
            files.save(done, root, tenant_id, df.select("document_id", "content"), (time.monotonic() - began) * 1000)
        finally:
            done.release()

    writer = arriving(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()


def outcome_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events and mean value by type in windows of event time; state is dropped once the watermark has passed."""
    df = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean_value"))
    return df.select(F.col("window.start").alias("from_ts"), "event_type", "n", "mean_value")
