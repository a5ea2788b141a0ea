"""Incremental intake: new files of sightings, each key once, appended to a table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestone.operators.joins import pending
from lodestone.sources.jsonl import classify, root_kind


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of (file, line, kind) over the JSON-lines files that arrive in a folder."""
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(folder)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.lit(0).cast("bigint").alias("line_no"), F.col("value").alias("line")).where(F.trim("line") != "").withColumn("kind", root_kind(F.col("line")))


def keep_new(spark: SparkSession, folder: str, table: str, checkpoint: str, key) -> StreamingQuery:
    """Append the sightings whose key the table does not hold, batch by batch, until the folder is read.

    ``key`` makes the key column from a classified row. A batch that is run again after a
    failure finds its keys in the table and adds nothing.
    """

    def batch(rows: DataFrame, number: int) -> None:
        kept = classify(rows).where("skip_reason is null").drop("skip_reason", "line_no", "repairs").withColumn("key", key)
        kept = kept.withColumn("batch", F.lit(number)).withColumn("at", F.xxhash64("file", "name", "listing_url", "website"))
        try:
            done = spark.read.parquet(table).select("key")
        except AnalysisException as e:  # the first batch finds no table; any other error is one
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            done = kept.select("key").where("false")
        pending(kept, done, "key", "at").write.mode("append").parquet(table)

    return stream_lines(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """(window, event_type, n): counts per window of event time, late rows up to a watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"))
