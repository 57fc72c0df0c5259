"""Incremental ingestion and event metrics with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..storage import scratch_path, table


def incremental_ingest(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, key: str = "sha256") -> None:
    """Take the files that arrived in ``source`` since the last run and add rows with new content to ``target``.

    The file source's checkpoint names each file once; a micro-batch is written to a folder of its own number, so that
    a batch run again after a failure overwrites itself and repeats nothing. Content seen before is an anti-join.
    """
    stream = spark.readStream.schema(schema).parquet(source)

    def add(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn(key, F.sha2(F.coalesce("text", F.lit("")), 256)).withColumn("document_id", tx.document_id(key))
        fresh = rows.groupBy(key, "document_id").agg(F.min("doc_id").alias("doc_id"))
        others = [p for p in _batches(spark, target) if p != f"batch={number}"]
        if others:
            seen = spark.read.parquet(*[f"{target}/{p}" for p in others]).select(key)
            fresh = fresh.join(seen, key, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _batches(spark: SparkSession, target: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(path) if f.getPath().getName().startswith("batch=")] if fs.exists(path) else []


def ingested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final state of ingesting the documents table as a stream: (document_id, doc_id, sha256)."""
    home = scratch_path(spark, "ingest")
    source = table(spark, sf_dir, "documents").select("doc_id", "text")
    source.repartition(4).write.parquet(f"{home}/arrivals")
    incremental_ingest(spark, f"{home}/arrivals", source.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", "), f"{home}/files", f"{home}/checkpoint")
    return spark.read.parquet(f"{home}/files").select("document_id", "doc_id", "sha256")


def windowed_events(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums per tumbling window and type; on a stream, rows later than ``late`` are dropped."""
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    grouped = events.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return grouped.select(F.col("window.start").alias("start"), "event_type", "n", "total")
