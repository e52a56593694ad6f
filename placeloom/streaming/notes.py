"""Visitor notes as a stream of appended files: validated once, kept once, counted by window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from placeloom.sources.sinks import clean_review

NOTES = "note_id string, poi_id string, author string, rating string, text string, date timestamp"


def read_notes(spark: SparkSession, path: str, files: int = 200) -> DataFrame:
    """Notes as they arrive (JSON lines), ``files`` files a batch."""
    return spark.readStream.schema(NOTES).option("maxFilesPerTrigger", files).json(path)


def accepted(notes: DataFrame, late: str = "7 days") -> DataFrame:
    """Valid notes; one that is sent again within ``late`` counts once, state older than that is dropped."""
    once = notes.withWatermark("date", late).dropDuplicatesWithinWatermark(["note_id"])
    return clean_review(once)


def daily(notes: DataFrame, late: str = "7 days") -> DataFrame:
    """Stars and number of notes of each place and day, final once the watermark has passed."""
    n = notes.withWatermark("date", late)
    return n.groupBy(F.window("date", "1 day").alias("day"), "poi_id").agg(F.count("*").alias("n"), F.avg(F.col("rating").try_cast("int")).alias("mean"))


def append_notes(notes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends all that is there and ends; begins again where it stopped."""
    return notes.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
