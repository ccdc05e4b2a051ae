import corpus_pipeline
from pressgauge.llm import toxicity

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "substring_dedup", "packing"]
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, SMALL)
        assert out.columns == docs.columns, name
        before, after = ({r.doc_id: r.text for r in x.collect()} for x in (now, out))
        assert set(after) <= set(before) and len(after) == out.count()
        if name != "substring_dedup":
            assert all(before[d] == t for d, t in after.items())
        if name == "exact_dedup":
            assert len({" ".join(t.split()) for t in before.values()}) == len(after)
        if name == "substring_dedup":
            assert set(after) == set(before) and all(len(after[d]) <= len(before[d]) for d in after)
        now = out
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(after)


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()} & {r.doc_id for r in docs.select("doc_id").collect()}
    assert clean <= {r.doc_id for r in toxicity.kept_documents(docs, labels).collect()}


def test_run_is_the_stages_in_order(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} == set(got.columns)
    assert got.count() > 0


def test_odd_rows_pass_through_the_whole_chain(spark, odd_documents, no_documents):
    long = spark.createDataFrame([(50, "long words here " * 30000, "x", 1)], odd_documents.schema)
    for docs in (odd_documents.unionByName(long), odd_documents.where("false")):
        now = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SMALL)
            assert now.columns == docs.columns
        packed = corpus_pipeline.STAGES[-1][1](spark, now, SMALL)
        assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in now.collect()}
