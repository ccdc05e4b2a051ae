"""Message sources. The broker source needs Spark's Kafka connector on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def topic_options(
    servers: str, topic: str, starting_offsets: str = "earliest", fail_on_data_loss: bool = False, **more: str
) -> dict[str, str]:
    """Reader options of a topic."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        **more,
    }


def read_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Stream of (key, value, timestamp) with text keys and values."""
    source = spark.readStream.format("kafka").options(**topic_options(servers, topic, **options)).load()
    return message_text(source)


def message_text(messages: DataFrame) -> DataFrame:
    """Binary keys and values as text."""
    return messages.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp",
    )


def read_files_as_topic(
    spark: SparkSession, path: str, schema: T.StructType, *, file_format: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Files of a folder (or a path pattern) as a stream."""
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def stream_table(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stored parquet table as a stream, whether it is one file or a folder of files."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    # A pattern, as the file stream takes a plain path for a folder.
    return read_files_as_topic(spark, f"{folder}/{name}.parque[t]", schema, files_per_trigger=files_per_trigger)
