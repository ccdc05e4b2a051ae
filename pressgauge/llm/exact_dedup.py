"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest. New rows are reduced to one row per
digest before any shuffle of keys, matched by a sort-merge anti-join that reads the index without
shuffling it, and only unknown digests are appended. A group of copies of any size is one row there.

Edge cases: null text counts as empty; a null id is never chosen unless the group has no other;
repeated rows with the same id are one document and are kept or dropped together; an empty table
appends nothing and gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressgauge.llm.common import SPACES, free_name, join_unique, text_or_empty
from pressgauge.session import fresh_dir
from pressgauge.sinks.files import stored


def normalised(text: str | Column) -> Column:
    """The text with each run of white space replaced by one space."""
    return F.regexp_replace(text_or_empty(text), SPACES, " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest): SHA-256 of the normalised text in UTF-8."""
    return docs.select(F.col(id_col).alias("doc_id"), F.sha2(normalised(text_col), 256).alias("digest"))


class DigestIndex:
    """The persistent table (digest, keep_id), one row per digest ever seen.

    The files stay at ``path``; opening it in a later session declares the table again. The bucket count is
    kept beside the files and used again, whatever count a later session asks for. One writer appends at
    a time.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int, id_type: str = "bigint") -> None:
        self.spark, self.buckets = spark, self._kept_buckets(spark, path, buckets)
        self.name = f"digest_index_{uuid.uuid4().hex}"
        where = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {self.name} (digest STRING, keep_id {id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{where}'"
        )

    @staticmethod
    def _kept_buckets(spark: SparkSession, path: str, buckets: int) -> int:
        """The count the index at ``path`` was begun with; a new index keeps ``buckets``."""
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        fs = hadoop(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        note = f"{path}/_buckets"
        if fs.exists(hadoop(note)):
            return int(spark.read.text(note).first()[0])
        if fs.exists(hadoop(path)) and any(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(hadoop(path))):
            raise ValueError(f"{path} holds files but no bucket count")
        spark.createDataFrame([(str(buckets),)], "value string").coalesce(1).write.text(note)
        return buckets

    def rows(self) -> DataFrame:
        """All entries; the scan is already partitioned by digest."""
        return self.spark.table(self.name)

    def unseen(self, heads: DataFrame) -> DataFrame:
        """The heads (one row per digest) whose digest the index lacks, by sort-merge anti-join."""
        return heads.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, heads: DataFrame) -> None:
        """Add new entries, each bucket written by one task."""
        new = heads.select("digest", "keep_id").repartition(self.buckets, "digest")
        new.write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def close(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def register(index: DigestIndex, hashed: DataFrame) -> DataFrame:
    """Append the unknown digests of one batch of (doc_id, digest), and return one row per row of it.

    Result: doc_id, digest, keep_id (the smallest id of the batch in which the digest came first),
    group_size (rows of this batch with the digest), kept. ``hashed`` should be a stored table.
    """
    heads = stored(
        hashed.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "heads"
    )
    index.append(index.unseen(heads))
    known = stored(heads.drop("keep_id").join(index.rows(), "digest"), "known")
    out = join_unique(hashed, known, "digest", "group_size", hashed.count())
    return out.select("doc_id", "digest", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", index_path: str | None = None) -> DataFrame:
    """doc_id, digest, keep_id, group_size, kept for every document, against the index at ``index_path``.

    Without a path the index starts empty in a new shared folder.
    """
    spark = docs.sparkSession
    path = index_path or fresh_dir(spark, "digests")
    hashed = stored(digests(docs, id_col, text_col), "hashed")
    index = DigestIndex(spark, path, int(spark.conf.get("spark.sql.shuffle.partitions")), hashed.schema["doc_id"].dataType.simpleString())
    try:
        return register(index, hashed)
    finally:
        index.close()


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the later copies, all columns unchanged."""
    own = F.when(F.col(id_col).isNull(), F.sha2(normalised(text_col), 256)).otherwise(F.lit(""))
    found = deduplicate(docs, id_col, text_col).where(~F.col("kept"))
    none = F.col("doc_id").isNull()
    dropped = found.select(F.col("doc_id").alias("dropped_id"), F.when(none, F.col("digest")).otherwise(F.lit("")).alias("dropped_row")).distinct()
    row = free_name(docs, "row_")
    same = F.col(id_col).eqNullSafe(F.col("dropped_id")) & (F.col(row) == F.col("dropped_row"))
    return docs.withColumn(row, own).join(dropped, same, "left_anti").drop(row)
