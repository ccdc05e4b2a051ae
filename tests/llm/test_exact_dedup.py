import hashlib
import re

import pytest

from pressgauge.llm import exact_dedup
from pressgauge.session import fresh_dir


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        groups.setdefault(hashlib.sha256(norm.encode()).hexdigest(), []).append(doc_id)
    return sorted(
        ((d, min((x for x in ids if x is not None), default=None), len(ids), key) for key, ids in groups.items() for d in ids),
        key=str,
    )


def test_against_brute_force(odd_documents):
    got = exact_dedup.deduplicate(odd_documents).collect()
    expected = brute([(r.doc_id, r.text) for r in odd_documents.collect()])
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.digest) for r in got), key=str) == expected
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_empty_table(no_documents):
    assert exact_dedup.deduplicate(no_documents).count() == 0


def test_index_persists_between_batches(spark):
    path = fresh_dir(spark, "digests-test")
    first = spark.createDataFrame([(5, "a b"), (9, "c")], "doc_id long, text string")
    second = spark.createDataFrame([(1, "a  b"), (2, "new"), (3, "new")], "doc_id long, text string")
    assert all(r.kept for r in exact_dedup.deduplicate(first, index_path=path).collect())
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.deduplicate(second, index_path=path).collect()}
    assert got == {1: (5, False), 2: (2, True), 3: (2, False)}


def test_hot_group_and_extra_columns(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}", i) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep_id long")
    kept = exact_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted([0] + [i for i in range(600) if i % 3])


def test_anti_join_reads_the_index_without_shuffling_it(spark):
    index = exact_dedup.DigestIndex(spark, fresh_dir(spark, "digests-plan"), 8)
    heads = spark.createDataFrame([("a", 1)], "digest string, keep_id long")
    index.append(heads)
    plan = index.unseen(heads)._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert index.unseen(heads).count() == 0


def test_copies_without_id_follow_the_decision(spark):
    rows = [(2, "a b", 0), (None, "a  b", 1), (None, "alone", 2), (1, "a\tb", 3), (None, "a b", 4), (1, "a\tb", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_ long")
    kept = exact_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.row_ for r in kept.collect()) == [2, 3, 5]


def test_an_index_keeps_its_buckets_whatever_the_session_asks_for(spark):
    path = fresh_dir(spark, "digests-reopened")
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string")
    before = len(spark.catalog.listTables())
    assert all(r.kept for r in exact_dedup.deduplicate(rows.where("doc_id < 35"), index_path=path).collect())
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "3")
    again = session.createDataFrame([(100 + i, f"text {i}") for i in range(40)], "doc_id long, text string")
    found = exact_dedup.deduplicate(again, index_path=path).collect()
    assert sorted(r.doc_id for r in found if r.kept) == [135, 136, 137, 138, 139]
    assert len(spark.catalog.listTables()) == before


def test_files_without_a_bucket_count_are_refused(spark):
    path = fresh_dir(spark, "digests-foreign")
    spark.createDataFrame([("a", 1)], "digest string, keep_id long").write.parquet(path)
    with pytest.raises(ValueError, match="bucket"):
        exact_dedup.DigestIndex(spark, path, 4)
