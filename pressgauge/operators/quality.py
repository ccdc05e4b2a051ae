"""Data checks as one report per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F


def report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One job over the table: rows (check, value) for named aggregate expressions."""
    names = list(checks)
    row = df.agg(*[checks[n].cast("bigint").alias(n) for n in names])
    pairs = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("value")) for n in names])
    return row.select(F.inline(pairs))


def violations(condition: Column) -> Column:
    """How many rows break a condition; null counts as broken."""
    return F.count_if(~F.coalesce(condition, F.lit(False)))


def label_checks(labels: DataFrame, key: str, label: str) -> DataFrame:
    """Row count, distinct keys and labels outside 0 and 1."""
    return report(labels, {
        "label_rows": F.count(F.lit(1)),
        "label_keys": F.count_distinct(key),
        "label_not_binary": violations(F.col(label).isin(0, 1)),
    })


def vocabulary_checks(vocab: DataFrame, size: int) -> DataFrame:
    """Word count, largest index and indexes outside 1..size."""
    return report(vocab, {
        "vocabulary_rows": F.count(F.lit(1)),
        "vocabulary_max_idx": F.max("idx"),
        "vocabulary_idx_out_of_range": violations(F.col("idx").between(1, size)),
    })


def link_checks(pages: DataFrame, url: str = "url") -> DataFrame:
    """Row count and rows whose address is no link."""
    return report(pages, {
        "link_rows": F.count(F.lit(1)),
        "link_without_http": violations(F.contains(F.col(url), F.lit("http"))),
    })


def with_link(df: DataFrame, url: str = "url") -> tuple[DataFrame, DataFrame]:
    """Rows whose address holds ``http``, and the quarantined others."""
    good = F.coalesce(F.contains(F.col(url), F.lit("http")), F.lit(False))
    return df.where(good), df.where(~good)


def union_reports(*reports: DataFrame) -> DataFrame:
    """Several reports as one table."""
    return reduce(DataFrame.unionByName, reports)


def write_observed(df: DataFrame, path: str, checks: dict[str, Column], keys: dict[str, str] | None = None) -> DataFrame:
    """Write a table and return the report of ``checks`` gathered by the same job.

    ``keys`` names counts of different values, each of one column: the first row of a value is marked
    behind a shuffle by it, as metrics of a running job cannot count distinct values. A null is no value.
    """
    marks = {}
    frame = df
    for i, (name, key) in enumerate((keys or {}).items()):
        first = F.row_number().over(Window.partitionBy(key).orderBy(F.lit(0))) == 1
        frame = frame.withColumn(f"_first{i}", first & F.col(key).isNotNull())
        marks[name] = F.count_if(F.col(f"_first{i}"))
    measures = {**checks, **marks}
    seen = Observation()
    observed = frame.observe(seen, *[F.coalesce(column.cast("bigint"), F.lit(0)).alias(name) for name, column in measures.items()])
    observed.drop(*[f"_first{i}" for i in range(len(marks))]).write.parquet(path)
    return df.sparkSession.createDataFrame([(name, seen.get[name]) for name in measures], "check string, value bigint")
