"""Time the headline queries and print one JSON line.

BENCH_SF_DIR picks the data folder, BENCH_CPUS the local cores, BENCH_QUERIES (comma-separated
names, or ``all``) the queries, BENCH_RUNS how often each is run; the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pressgauge.plans.catalog import QUERIES  # noqa: E402
from pressgauge.session import build_session  # noqa: E402

HEADLINE = (
    "weighted_sentiment", "comment_sentiment", "sentence_sentiment", "thread_rollup", "social_results",
    "tweet_flatten", "tweet_hits", "keyword_search", "keyword_mining", "seed_table", "record_encode", "record_decode",
    "letter_tokens", "punct_tokens", "stopword_filter", "lemma_filter", "adjective_filter", "term_counts",
    "vocabulary_topk", "article_extract", "article_results", "document_merge", "doc_index_matrix", "doc_lengths",
    "padded_matrix", "vector_lookup", "doc_vector", "attention_pool", "credibility_score",
    "stream_weighted_sentiment", "stream_upsert",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else list(HEADLINE)
    spark = build_session(
        "pressgauge-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["vocabulary_topk"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
