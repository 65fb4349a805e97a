"""Message streams: a topic, or a folder of text files with one message per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    **options: str,
) -> DataFrame:
    """Messages of a topic. Needs Spark's Kafka package on the class path.

    ``starting_offsets`` counts for the first start only; after that the checkpoint decides.
    Pass ``maxOffsetsPerTrigger`` to bound a micro-batch and ``minPartitions`` to read a topic
    with more tasks than it has partitions.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
    )


def file_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Messages from text files, each line one message, in the ``value`` column as above."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def table_stream(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Parquet files under a folder or a glob pattern as a stream of typed rows."""
    return spark.readStream.schema(ddl).parquet(path)
