"""Incremental ingest and running profiles with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracewright.functions.contract import CONTRACT
from tracewright.functions.signatures import with_behaviour
from tracewright.sources.readers import parse_events


def xml_lines(spark: SparkSession, path: str) -> DataFrame:
    """A stream of contract records from files with one event's XML a line."""
    lines = spark.readStream.format("text").load(path)
    return parse_events(lines.select(F.col("_metadata.file_path").alias("src"), F.col("value").alias("xml")), "xml")


def json_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(CONTRACT).json(path)


def append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to a Parquet table and stop; the checkpoint resumes where the last run ended."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def kept_profile(profile: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Bring a running profile up to date and write it whole to a Parquet table; nothing of it passes the driver."""
    write = lambda table, batch: table.write.mode("overwrite").parquet(path)
    return profile.writeStream.foreachBatch(write).outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_profile(stream: DataFrame, by: str = "signature") -> DataFrame:
    """Counts by signature over all that has arrived; the state holds one number a signature."""
    return with_behaviour(stream).groupBy(by).agg(F.count("*").alias("n"))
