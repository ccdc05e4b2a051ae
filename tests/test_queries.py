import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as driver
from conftest import SMALL
from pressgauge.plans.catalog import ORACLES, QUERIES, ROWS_ONLY

TABLES = "documents pages conversations labels embeddings events benchmark".split()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return None if math.isnan(value) else round(float(value), 9) + 0.0
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_same_rows_as_sql(spark, sql, name):
    df = driver.queries()[name](spark, SMALL)
    found = df.collect()
    cursor = sql.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert found and normal(df.columns, found) == normal(columns, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_classifier_queries_give_rows(spark, name):
    assert driver.queries()[name](spark, SMALL).count() > 0


def plan(spark, name):
    return driver.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "weighted_sentiment", "sentence_sentiment", "lemma_filter", "adjective_filter", "keyword_search", "tweet_flatten",
    "seed_table", "article_extract", "doc_index_matrix", "record_decode", "thread_rollup",
])
def test_main_path_stays_in_the_jvm_without_cross_joins(spark, name):
    text = plan(spark, name)
    assert "EvalPython" not in text and "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize("name", ["weighted_sentiment", "lemma_filter", "doc_index_matrix", "keyword_search"])
def test_dictionaries_are_broadcast(spark, name):
    assert "BroadcastHashJoin" in plan(spark, name)


def test_scan_reads_only_what_is_used(spark):
    text = plan(spark, "vocabulary_topk")
    assert "ReadSchema: struct<text:string,lang:string>" in text and "EqualTo(lang,en)" in text


def test_hot_keys_are_salted_where_the_table_is_not_broadcast(spark):
    text = plan(spark, "skewed_lookup")
    assert "_salt" in text and "NestedLoop" not in text


def test_classifier_judges_every_document(spark):
    assert driver.queries()["credibility_score"](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert sorted(r.fold for r in driver.queries()["credibility_train"](spark, SMALL).collect()) == [0, 1, 2, 3, 4]


def test_words_are_shuffled_once(spark):
    assert plan(spark, "doc_index_matrix").count("Exchange hashpartitioning(doc_id") == 1
