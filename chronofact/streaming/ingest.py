"""Streams: archives' rows as they land, and counts per day with a watermark.

The published capability is batch; these entry points feed the same operators from a stream. A micro-batch is written to
partitions of its own number, replaced as a whole, so a batch that is run again after a failure leaves the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_facts(spark: SparkSession, folder: str, schema, max_files: int | None = None) -> DataFrame:
    """Parquet files of facts as they arrive in a folder."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def write_batch(path: str, df: DataFrame, batch: int) -> None:
    """Rows of a micro-batch under its number, by quarter; running the batch again replaces exactly them."""
    df.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "quarter").parquet(path)


def keep_batches(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Feed a stream into a table partitioned by batch and quarter; once=True takes what is there and ends."""
    writer = stream.writeStream.foreachBatch(lambda df, n: write_batch(path, df, n)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """What the stream has brought so far, without the batch numbers; a filter on quarter prunes folders."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def reports_per_day(stream: DataFrame, delay: str = "30 days") -> DataFrame:
    """Reports and null values per filing day and form, as a stream with a watermark on the day."""
    day = stream.withColumn("ts", F.col("knowledge_date").cast("timestamp"))
    return day.withWatermark("ts", delay).groupBy(F.window("ts", "1 day"), "form").agg(F.count(F.lit(1)).alias("n_facts"), F.count_if(F.col("value").isNull()).alias("n_null")).select(F.col("window.start").cast("date").alias("day"), "form", "n_facts", "n_null")
