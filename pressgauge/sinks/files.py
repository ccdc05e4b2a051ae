"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressgauge.session import fresh_dir


def write_lines(df: DataFrame, path: str, column: str) -> None:
    """One line of text per row."""
    df.select(column).write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per line, null fields included."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """CSV, without header by default."""
    df.write.mode("overwrite").option("header", header).option("escape", '"').csv(path)


def write_day(df: DataFrame, path: str, day: str | Column) -> None:
    """Replace the rows of one day, or of the days given by a column, in a table partitioned by day."""
    value = F.lit(day) if isinstance(day, str) else day
    (
        df.withColumn("day", value.cast("date")).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    )


def append(df: DataFrame, path: str, file_format: str = "parquet", **options: str) -> None:
    """Append to a table in any writer format on the classpath."""
    df.write.mode("append").format(file_format).options(**options).save(path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    Used where a result is read several times: later reads prune columns, and lost executors cost
    no recomputation.
    """
    spark: SparkSession = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
