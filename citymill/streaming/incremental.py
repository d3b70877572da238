"""Mesh folders as a stream: files that arrive are measured once, across restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import obj


def arriving_lines(spark: SparkSession, path: str, files_at_once: int = 1000) -> DataFrame:
    """path, line_no, value of mesh files as they arrive below a folder."""
    files = spark.readStream.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.obj").option("maxFilesPerTrigger", files_at_once).load(path)
    return files.select(F.input_file_name().alias("path"), "value").select("path", F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "value"))


def measure(lines: DataFrame, threshold: float, out: str, checkpoint: str) -> StreamingQuery:
    """Appends the outcome of each file to a table at out. The checkpoint knows what is done, and each
    batch is written to a folder of its own number, so a batch that is tried again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        obj.mesh_outcomes(batch, threshold).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts and sums of events (ts, event_type, value) in windows of event time; later ones than `late` are dropped."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks take no time without a zone
    return timed.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
