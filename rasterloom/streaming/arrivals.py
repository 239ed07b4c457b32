"""An extension: tiles or features that arrive as Parquet files, loaded by a stream into the job log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

ARRIVALS = "job_id string, workflow_id string, tile_id string, features long, loaded_at timestamp"


def arrivals(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(ARRIVALS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def counts_by_hour(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Features by job and hour of arrival; hours close once the watermark has passed them."""
    return stream.withWatermark("loaded_at", delay).groupBy(F.window("loaded_at", "1 hour"), "job_id").agg(F.sum("features").alias("features"))


def load_jobs(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Appends a log row for each job of a batch. The batch number is the row's seq, so a batch that is run again
    writes rows that the job table counts once."""
    def write(batch: DataFrame, number: int) -> None:
        rows = batch.filter(F.col("job_id").isNotNull()).groupBy("job_id").agg(
            F.max_by("workflow_id", F.when(F.col("workflow_id").isNotNull(), F.col("loaded_at"))).alias("workflow_id"),
            F.sum("features").alias("feature_count"), F.max("loaded_at").alias("loaded_at"),
        )
        rows.withColumn("seq", F.lit(number).cast("long")).write.mode("append").parquet(f"{folder}/job_log")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
