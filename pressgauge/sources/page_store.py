"""Stored pages bucketed by address, so that a lookup reads only the buckets it asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

BUCKET = "url_bucket"


class PageStore:
    """A Parquet table of pages in one partition folder per bucket of the hashed address.

    ``buckets`` must stay the same while the table lives; it is kept in the column itself.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int, url: str = "url") -> None:
        self.spark, self.path, self.buckets, self.url = spark, path, buckets, url
        self._schema: T.StructType | None = None

    def bucket(self, url: Column) -> Column:
        """The bucket of an address."""
        return F.pmod(F.xxhash64(url), F.lit(self.buckets)).cast("int")

    def add(self, pages: DataFrame) -> None:
        """Append pages; each bucket is sorted by address, so that its files can skip row groups."""
        rows = pages.withColumn(BUCKET, self.bucket(F.col(self.url)))
        rows = rows.repartition(BUCKET).sortWithinPartitions(BUCKET, self.url)
        rows.write.mode("append").partitionBy(BUCKET).parquet(self.path)

    def wanted(self, rows: DataFrame, url: str) -> DataFrame:
        """The pages in the buckets of these rows' addresses; all other folders are pruned.

        What comes to the driver are bucket numbers, at most ``buckets`` of them.
        """
        if self._schema is None:
            self._schema = self.spark.read.parquet(self.path).schema
        numbers = rows.select(self.bucket(F.col(url)).alias(BUCKET)).distinct().collect()
        found = self.spark.read.schema(self._schema).parquet(self.path)
        return found.where(F.col(BUCKET).isin([r[0] for r in numbers if r[0] is not None])).drop(BUCKET)
