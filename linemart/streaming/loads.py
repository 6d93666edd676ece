"""Loads that arrive as files, upserted batch by batch, corrections included."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from linemart.sources.tables import latest_of_each, upsert_summary

ARRIVED = ["_arrived", "_file", "_block", "_row"]


def upsert_available(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, key: list[str], partitions: list[str]) -> None:
    """Upserts all files that arrived since the last call; the checkpoint makes each count once.

    A month and its correction may arrive between two calls and so share a batch: of several rows of one key that of the
    latest file counts (by its time, then its name), and within a file the last row.
    """
    stream = spark.readStream.schema(schema).parquet(source)
    told = stream.select("*", F.col("_metadata.file_modification_time").alias("_arrived"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.col("_metadata.row_index").alias("_row"))
    put = lambda df, _: upsert_summary(df.sparkSession, target, latest_of_each(df, key, ARRIVED), key, partitions)
    told.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
