"""Incremental ingest: candidates that keep arriving are registered once and cleaned as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.functions.urls import any_canonical_url
from attesta.operators.silver import clean


def new_candidates(arriving: DataFrame, late: str = "1 hour") -> DataFrame:
    """The first arrival of each canonical URL within the watermark. ``arriving``: a stream of url, seen_at (timestamp) and more."""
    rows = arriving.withColumn("canonical_url", any_canonical_url(F.col("url"))).where("canonical_url is not null")
    return rows.withWatermark("seen_at", late).dropDuplicatesWithinWatermark(["canonical_url"])


def arrivals_by_domain(arriving: DataFrame, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Arrivals of each host in each window; late rows count until the watermark passes."""
    host = F.lower(F.parse_url("url", F.lit("HOST")))
    return arriving.withWatermark("seen_at", late).groupBy(F.window("seen_at", window), host.alias("domain")).agg(F.count(F.lit(1)).alias("arrivals"))


def clean_into(arriving: DataFrame, path: str, checkpoint: str, least_words: int = 30):
    """Clean each micro-batch into a Parquet folder; the batch's number is a partition, so a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        clean(batch, least_words).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return arriving.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def stream_of(spark: SparkSession, path: str, schema: str, files_at_once: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)
