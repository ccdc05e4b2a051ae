"""Batch sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from pressgauge import schemas


def read_headlines(spark: SparkSession, path: str, arrays: bool = True) -> DataFrame:
    """Headline documents stored as one JSON array per file, or else as one object per line."""
    return spark.read.schema(schemas.HEADLINE).option("multiLine", arrays).json(path)


def read_tweets(spark: SparkSession, path: str) -> DataFrame:
    """Raw tweets, one JSON object per line."""
    return spark.read.schema(schemas.TWEET).json(path)


def read_lines(spark: SparkSession, path: str, name: str = "line") -> DataFrame:
    """Lines of text files, without their line feeds."""
    return spark.read.text(path).select(F.col("value").alias(name))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = False, multi_line: bool = True) -> DataFrame:
    """CSV with the given column names and types; quoted fields may hold line feeds and quotes.

    Without ``multi_line`` a record is one line, and large files are split over tasks: choose it wherever no
    field can hold a line feed.
    """
    return (
        spark.read.schema(schema).option("header", header)
        .option("multiLine", multi_line).option("escape", '"').csv(path)
    )


def read_claims(spark: SparkSession, path: str) -> DataFrame:
    """Ground truth: page address and boolean label, with a header line; addresses hold no line feeds."""
    return read_csv(spark, path, schemas.CLAIM, header=True, multi_line=False)


def read_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Article files: the first line is the address, each further line a sentence."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt")
    lines = F.split(F.regexp_replace("value", r"\n$", ""), "\n")
    return files.select(
        F.get(lines, F.lit(0)).alias("url"),
        F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))).alias("sentences"),
    )


def read_ranked_lines(spark: SparkSession, path: str) -> DataFrame:
    """(rank, line) of ranked word files; the rank is the line number, from 1, and goes on from file to file by path.

    Files are read in splits, by as many tasks: a first pass counts the lines of each split, their prefix sums
    over files and offsets are the ranks before it, and the second pass adds each line's place in its
    split. What one task orders is one row per split.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        # Rising by one from line to line inside a split, as one task reads it without a break.
        F.monotonically_increasing_id().alias("at"),
    )
    splits = lines.groupBy("file", "start").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    before = splits.select("file", "start", "first", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    placed = lines.join(before, ["file", "start"])
    return placed.select((F.col("before") + F.col("at") - F.col("first") + 1).alias("rank"), "line")


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Pretrained word vectors stored as parquet."""
    return spark.read.schema(schemas.VECTOR).parquet(path)


def read_day(spark: SparkSession, path: str, day: str, schema: T.StructType | None = None) -> DataFrame:
    """One day of a table partitioned by ``day``; other days are not listed or read."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    one = reader.option("basePath", path).parquet(f"{path}/day={day}")
    return one.where(F.col("day") == F.lit(day).cast("date")).drop("day")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored parquet table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
