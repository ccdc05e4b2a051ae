"""The document table: one record per ``news_id``, upserted batch by batch by one or more writers.

Every batch writes only its own rows and the names of its fields. It becomes visible by one rename, and
a batch already visible is not written again, so a replay changes nothing and no reader misses it.
Reading takes, per key and field, the newest value among the rows whose writer has that field, in one
aggregation with map-side combine. :func:`compact` folds the batches into a new folder when there are many.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_FIELDS = T.StructField("_fields", T.ArrayType(T.StringType()))
_MODIFIED = T.StructField("lastModified", T.TimestampType())


def upsert(
    delta: DataFrame, path: str, batch_id: int, modified: Column | None = None, writer: str = "main"
) -> None:
    """Write one batch of documents; idempotent per writer and batch id."""
    stamped = delta.withColumn("lastModified", modified if modified is not None else F.current_timestamp())
    _publish(stamped, delta.columns, path, f"writer={writer}/batch_id={batch_id}")


def _publish(rows: DataFrame, fields: Sequence[str], path: str, folder: str) -> None:
    """Write to a folder that readers skip, then rename it."""
    spark = rows.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    target = hadoop(f"{path}/{folder}")
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if fs.exists(target):
        return
    staged = f"{path}/_staged/{uuid.uuid4().hex}"
    rows.withColumn("_fields", F.array(*[F.lit(c) for c in fields])).write.parquet(staged)
    fs.mkdirs(target.getParent())
    if not fs.rename(hadoop(staged), target):
        raise OSError(f"cannot rename {staged} to {path}/{folder}")


def read_documents(
    spark: SparkSession, path: str, keys: Sequence[str] = ("news_id",), order: Sequence[str] = (),
    schema: T.StructType | None = None,
) -> DataFrame:
    """Current documents: per key and field the value newest by ``order``, then by ``lastModified``, then by batch.

    A null that a writer wrote counts as a value; a field that it does not have does not. Give the
    ``schema`` of all fields where there are many batches, else every file's schema is read.
    """
    if schema is not None:
        known = [f for f in schema.fields if f.name not in (_FIELDS.name, _MODIFIED.name)]
        reader = spark.read.schema(T.StructType([*known, _MODIFIED, _FIELDS]))
    else:
        reader = spark.read.option("mergeSchema", True)
    rows = reader.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    version = F.struct(*order, "lastModified", "batch_id", F.col("writer").cast("string").alias("writer"))
    fields = [c for c in rows.columns if c not in (*keys, "lastModified", "_fields", "batch_id", "writer")]
    newest = [F.max_by(c, F.when(F.array_contains("_fields", c), version)).alias(c) for c in fields]
    return rows.groupBy(*keys).agg(*newest, F.max("lastModified").alias("lastModified"))


def compact(
    spark: SparkSession, source: str, target: str, keys: Sequence[str] = ("news_id",), order: Sequence[str] = ()
) -> None:
    """Write the current documents of ``source`` as one batch of the new folder ``target``.

    Later batches then go to ``target``; their ids continue above the folded ones.
    """
    last = spark.read.parquet(source).agg(F.max("batch_id")).first()[0]
    current = read_documents(spark, source, keys, order)
    _publish(current, [c for c in current.columns if c != "lastModified"], target, f"writer=compact/batch_id={last}")


def fold(spark: SparkSession, path: str, most: int, keys: Sequence[str] = ("news_id",), order: Sequence[str] = ()) -> bool:
    """Fold each writer's batches, once it has more than ``most`` of them; readers see the same documents throughout.

    Per key and set of fields the newest row is kept as it is, so ``read_documents`` with the same ``order`` gives what
    it gave before. A writer's last batch stays apart, as a stream may send it again. The folded rows become
    visible by one rename before the old folders go. Call it between batches; returns whether anything was folded.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    done = False
    for status in fs.listStatus(hadoop(path)):
        writer = status.getPath().getName()
        if not writer.startswith("writer="):
            continue
        found = [s.getPath().getName() for s in fs.listStatus(status.getPath())]
        batches = sorted(int(name.removeprefix("batch_id=")) for name in found if name.startswith("batch_id="))
        old = batches[:-1]
        if len(batches) <= most or len(old) < 2:
            continue
        rows = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*[f"{path}/{writer}/batch_id={b}" for b in old])
        version = F.struct(*order, "lastModified", F.col("batch_id").cast("bigint"))
        columns = [c for c in rows.columns if c not in ("batch_id", "writer")]
        newest = rows.groupBy(*keys, F.col("_fields").alias("_set")).agg(F.max_by(F.struct(*columns), version).alias("_row"))
        staged = f"{path}/_staged/{uuid.uuid4().hex}"
        newest.select("_row.*").write.parquet(staged)
        # Negative, so that a later batch wins a tie; lower than every fold before.
        target = hadoop(f"{path}/{writer}/batch_id={min(0, old[0]) - 1}")
        if not fs.rename(hadoop(staged), target):
            raise OSError(f"cannot rename {staged} to {target}")
        for batch in old:
            fs.delete(hadoop(f"{path}/{writer}/batch_id={batch}"), True)
        done = True
    return done


def merge(social: DataFrame, articles: DataFrame, time: str = "date") -> DataFrame:
    """Social and article documents as one record per ``news_id`` and part.

    Articles belong to part 0. Both sides may lack the other; all shared fields come from the side later
    by ``time``, from the article side if the times are equal or not given.
    """
    left = social if "part" in social.columns else social.withColumn("part", F.lit(0).cast("bigint"))
    right = articles.withColumn("part", F.lit(0).cast("bigint"))
    keys = ("news_id", "part")
    joined = left.withColumn("_s", F.lit(True)).alias("s").join(right.withColumn("_a", F.lit(True)).alias("a"), list(keys), "full_outer")
    return joined.select(*keys, *merged_fields(left.columns, right.columns, keys, time))


def merged_fields(social: Sequence[str], articles: Sequence[str], keys: Sequence[str], time: str) -> list[Column]:
    """The fields of joined sides ``s`` and ``a``, whose rows are marked by ``_s`` and ``_a``.

    Shared fields come from the side later by ``time``, from the article side if times are equal or not given.
    """
    shared = [c for c in articles if c in social and c not in keys]
    own = [F.col(f"s.{c}") for c in social if c not in (*keys, *shared)]
    other = [F.col(f"a.{c}") for c in articles if c not in (*keys, *shared)]
    later = F.lit(True)
    if time in shared:
        later = F.coalesce(F.col(f"a.{time}") >= F.col(f"s.{time}"), F.col(f"s.{time}").isNull())
    from_article = F.col("_a").isNotNull() & (F.col("_s").isNull() | later)
    return [*own, *other, *[F.when(from_article, F.col(f"a.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in shared]]


def with_date(docs: DataFrame, date: Column | None = None) -> DataFrame:
    """Documents stamped with their ingestion day."""
    return docs.withColumn("date", date if date is not None else F.current_date())


def known_ids(delta: DataFrame, documents: DataFrame) -> DataFrame:
    """The batch rows whose ``news_id`` is already stored."""
    return delta.join(documents.select("news_id").distinct(), "news_id", "left_semi")
