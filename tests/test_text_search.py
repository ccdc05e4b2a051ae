"""Substring search, longest phrases, line ranks, observed reports and attention training."""

import os
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from pressgauge.operators import attention_training, phrases, pooling, quality, substrings
from pressgauge.sources import files as source


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 40))) for _ in range(200)] + ["", "A%b_C", "x" * 3000, "Straße 日本語テキスト"]
    words = ["".join(rng.choice("abcdÉ ") for _ in range(rng.randint(1, 6))) for _ in range(60)] + ["", "%b_", "zzz", "xxxxx", "日本", "本", "ß", "AB"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, None)]
    expected = {(i, w) for i, t in rows for w in words if t is not None and w and w.lower() in t.lower()}
    return spark.createDataFrame(rows, "id long, text string"), spark.createDataFrame([(w,) for w in words] + [(None,)], "keyword string"), expected


@pytest.mark.parametrize("small", [True, False, None])
def test_substrings_equal_brute_force(spark, corpus, small):
    texts, words, expected = corpus
    found = substrings.search_substrings(texts, words, ["id"], small=small)
    assert {tuple(r) for r in found.collect()} == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_keywords_stand_under_their_rarest_gram(spark):
    texts = spark.createDataFrame([(0, "abcx"), (1, "abcd"), (2, "abcy")], "id long, text string")
    words = spark.createDataFrame([("abcd",), ("ab",), ("none",)], "keyword string")
    rows = substrings.gram_index(texts, words, text="text", small=True).collect()
    assert {(r.gram, r.needle) for r in rows} == {("bcd", "abcd"), ("ab", "ab")}
    assert substrings.search_substrings(texts, words.where("false"), ["id"]).collect() == []


def greedy(text, table):
    words, at, out = text.split(), 0, []
    while at < len(words):
        n = max((n for n in range(1, 6) if " ".join(words[at:at + n]) in table and at + n <= len(words)), default=0)
        if n:
            out.append((at, n, " ".join(words[at:at + n])))
        at += max(n, 1)
    return out


@pytest.mark.parametrize("small", [True, False])
def test_longest_phrases_equal_a_scan(spark, small):
    rng = random.Random(4)
    words = "ab cd ef gh".split()
    table = {" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 2, 3, 4]))) for _ in range(12)} - {"gh"}
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 15))) for _ in range(80)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "id long, title string")
    gazetteer = spark.createDataFrame([(p.upper(), "ORG") for p in table] + [("gh", "DATE"), ("", "ORG"), (None, "ORG")], "phrase string, ent_type string")
    found = phrases.entity_spans(df, gazetteer, ["id"], types=["ORG"], small=small)
    assert sorted(tuple(r) for r in found.collect()) == sorted((i, *m) for i, t in enumerate(texts) for m in greedy(t, table))


def test_no_phrases_give_no_matches(spark):
    df = spark.createDataFrame([(1, "ab cd")], "id long, title string")
    assert phrases.entity_spans(df, spark.createDataFrame([], "phrase string, ent_type string"), ["id"]).collect() == []


def test_line_ranks_over_many_splits_and_files(spark, tmp_path):
    lines = [f"w word{i} {'é' * (i % 37)}" if i % 11 else "" for i in range(3000)]
    cuts = [(0, 1200), (1200, 1200), (1200, 1201), (1201, 3000)]
    for number, (low, high) in enumerate(cuts):
        (tmp_path / f"part-{number}.txt").write_text("".join(f"{line}\n" for line in lines[low:high]))
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    session.conf.set("spark.sql.files.openCostInBytes", "100")
    found = source.read_ranked_lines(session, str(tmp_path))
    assert session.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
    assert sorted(tuple(r) for r in found.collect()) == list(enumerate(lines, 1))


def test_observed_report_equals_a_report_and_reads_no_table(spark, tmp_path):
    df = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 5), (3, 1)], "k long, label int")
    checks = {"rows": F.count(F.lit(1)), "bad": quality.violations(F.col("label").isin(0, 1)), "top": F.max("label")}
    found = quality.write_observed(df, f"{tmp_path}/t", checks, {"keys": "k"})
    expected = quality.report(df, {**checks, "keys": F.count_distinct("k")})
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert spark.read.parquet(f"{tmp_path}/t").columns == ["k", "label"] and "Scan parquet" not in found._jdf.queryExecution().toString()
    empty = quality.write_observed(df.where("false"), f"{tmp_path}/e", {"rows": F.count(F.lit(1))}, {"keys": "k"})
    assert sorted(map(tuple, empty.collect())) == [("keys", 0), ("rows", 0)]


@pytest.fixture(scope="module")
def separable(spark):
    """Documents whose label shows in one of their sentences only."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(240):
        x = rng.normal(0, 0.3, (rng.integers(1, 6), 5))
        x[rng.integers(len(x)), 0] = 2.0 if i % 2 else -2.0
        rows.append((i, [x_.tolist() for x_ in x], i % 2, i % 5))
    rows += [(1000, [], 1, 1), (1001, None, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, vectors array<array<double>>, label int, fold int")


def test_one_gradient_equals_finite_differences():
    rng = np.random.default_rng(2)
    model, x = attention_training.initial(5, 3), rng.normal(size=(4, 5))
    for y in (0, 1):
        grad, loss, _ = model.gradient(x, y)
        flat = model.flat()
        for i in range(len(flat)):
            moved = flat.copy()
            moved[i] += 1e-6
            other = attention_training.Model.of(moved, 5, 3).gradient(x, y)[1]
            assert abs((other - loss) / 1e-6 - grad[i]) < 1e-4


def test_held_out_loss_falls_on_every_fold(separable):
    for fold in range(5):
        training, test = separable.where(F.col("fold") != fold).persist(), separable.where(F.col("fold") == fold)
        start = attention_training.initial(5, 3)
        model, losses = attention_training.train(training, 5, rounds=8, rate=0.1, start=start)
        before, after = (attention_training.gradient(test, m) for m in (start, model))
        assert losses[-1] < losses[0] and after[1] / after[2] < 0.8 * before[1] / before[2]
        training.unpersist()


def test_gradient_is_the_sum_over_documents(separable):
    model = attention_training.initial(5, 3)
    rows = [(np.array(r.vectors or []), r.label) for r in separable.collect()]
    parts = [model.gradient(x, y) for x, y in rows]
    total, loss, n = attention_training.gradient(separable.repartition(7), model)
    assert n == len(rows) and np.allclose(total, sum(p[0] for p in parts)) and np.isclose(loss, sum(p[1] for p in parts))
    assert attention_training.gradient(separable.where("false"), model)[2] == 0
    assert attention_training.train(separable.where("false"), 5)[1] == []


def test_documents_are_read_as_matrices_in_slices(spark, separable, monkeypatch):
    monkeypatch.setattr(attention_training, "SLICE_VECTORS", 3)
    model = attention_training.initial(5, 3)
    odd = spark.createDataFrame([(2000, [None, [1.0] * 5, None], 1, 0), (2001, [None], 0, 0)], separable.schema)
    batch = separable.unionByName(odd).select("vectors", "label").coalesce(1).toArrow().to_batches()[0].slice(1)
    parts = list(attention_training._documents(batch, "vectors", 5))
    assert sum(len(sizes) for _, _, sizes in parts) == batch.num_rows and max(len(x) for _, x, _ in parts) <= 5 and len(parts) > 50
    y = np.array(batch.column(1).to_pylist(), float)
    single = [model.gradient(np.array([v for v in d or [] if v is not None], float), t) for d, t in zip(batch.column(0).to_pylist(), y)]
    found = [model.gradients(x, sizes, y[part]) for part, x, sizes in parts]
    assert np.allclose(sum(f[0] for f in found), sum(s[0] for s in single)) and np.isclose(sum(f[1] for f in found), sum(s[1] for s in single))
    assert np.allclose(np.concatenate([model.logits(x, sizes) for _, x, sizes in parts]), [s[2] for s in single])


def test_prediction_pools_as_the_pooling_operator(spark, separable):
    model = attention_training.initial(5, 3)
    found = {r.doc_id: r.probability for r in attention_training.predict(separable, model, ["doc_id"]).collect()}
    rows = separable.select("doc_id", F.explode("vectors").alias("v"))
    pooled = {r.doc_id: np.array(r.pooled) for r in pooling.pool(rows, ["doc_id"], "v", model.attention).collect()}
    for doc, vector in pooled.items():
        assert abs(found[doc] - 1 / (1 + np.exp(-(vector @ model.o + model.c)))) < 1e-12
    assert found[1000] == found[1001] == 0.5


def test_queries_find_the_package_from_another_folder(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
import __spark_entry__ as driver
from pressgauge.session import build_session
spark = build_session("elsewhere", "local[2]", **{{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false"}})
print("rows", driver.queries()["attention_pool"](spark, {SMALL!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows 640" in done.stdout, done.stderr[-2000:]
