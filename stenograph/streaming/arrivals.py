"""Arriving turns as a stream: windowed word counts with late data, and imports that survive restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.text import count_words


def arriving(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder, as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def words_by_window(turns: DataFrame, at: str = "opened_at", width: str = "1 day", late: str = "2 days") -> DataFrame:
    """(start, country, turns, words) by event time; rows later than ``late`` are left out, those without a time too."""
    timed = turns.where(F.col(at).isNotNull()).withColumn("_words", count_words("text")).withWatermark(at, late)
    g = timed.groupBy(F.window(at, width).alias("w"), "country").agg(F.count("*").alias("turns"), F.sum("_words").alias("words"))
    return g.select(F.col("w.start").alias("start"), "country", "turns", "words")


def append_once(turns: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append arriving turns to a table partitioned by country; a batch is written under its own number, so a
    batch that is run again after a failure replaces itself instead of doubling."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "country").parquet(target)

    return turns.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
