"""One registered query per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressgauge.llm import (
    ball_tree, bpe, collocation, exact_dedup, hard_negatives, html_text, maxent, packing, simhash, spotsigs, substring, toxicity, warc,
)
from pressgauge.llm.common import table


def op1_maxent(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents by a model that learns from nine tenths of them."""
    return maxent.score(table(spark, folder, "documents"), maxent.fold() == 0)


def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of all pages."""
    found = html_text.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Exact copies of every document, through a digest index that starts empty."""
    found = exact_dedup.deduplicate(table(spark, folder, "documents"))
    return found.withColumnRenamed("digest", "text_sha256")


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of four-word shingles, linked at four differing bits."""
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 13 words and more that a smaller doc_id also holds."""
    found = substring.repeats(table(spark, folder, "documents"), min_words=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    import public_tokenizers

    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=2)


def op7_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and their likeness to an edited text and to the next document."""
    return spotsigs.edited_likeness(table(spark, folder, "documents"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents by a model that has not seen the labels of the held-out third."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, folder, "labels"), toxicity.fold() != 1)
    out = F.coalesce(toxicity.fold() == 1, F.lit(False)).alias("held_out")
    chosen = (F.col("toxicity") >= 0.7).cast("int").alias("predicted")
    return toxicity.scores(docs, model).select("doc_id", out, F.col("toxicity").alias("score"), chosen)


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents and the bytes they decode to."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(coded, ranks).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    found = warc.archive(table(spark, folder, "pages"), least_bytes=0)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_collocation(spark: SparkSession, folder: str) -> DataFrame:
    """The best phrases of two to five words in each language."""
    return collocation.collocations(table(spark, folder, "documents"), longest=5, least=100, top=2000)


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, a seventh of the labels being moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings")
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=5, lowest=80, label=moved)


def op13_ball_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector with all others."""
    return ball_tree.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_maxent": op1_maxent,
    "op2_html_text": op2_html_text,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_simhash": op4_simhash,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_packing": op6_packing,
    "op7_spotsigs": op7_spotsigs,
    "op8_toxicity": op8_toxicity,
    "op9_bpe": op9_bpe,
    "op10_warc": op10_warc,
    "op11_collocation": op11_collocation,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_ball_tree": op13_ball_tree,
}

_COPIES = r"""
with d as (
    select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents
), g as (
    select *, min(doc_id) over (partition by text_sha256) as keep_id, count(*) over (partition by text_sha256) as group_size
    from d
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from g
"""

_PASSAGES = r"""
with w as (
    select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents
), windows as (
    select doc_id, i, array_to_string(words[i:i + 12], ' ') as span
    from (select doc_id, words, unnest(range(1, len(words) - 11)) as i from w where len(words) >= 13)
), low as (
    select span, min(doc_id) as low from windows group by span
), hit as (
    select distinct windows.doc_id, i from windows join low using (span) where low < windows.doc_id
), gone as (
    select distinct doc_id, i + k as i from hit, (select unnest(range(0, 13)) as k)
), kept as (
    select a.doc_id, string_agg(a.word, ' ' order by a.i) as kept
    from (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as i from w) a
    anti join gone on a.doc_id = gone.doc_id and a.i = gone.i
    group by a.doc_id
), removed as (
    select doc_id, count(*) as n from gone group by doc_id
)
select w.doc_id, cast(len(words) as bigint) as n_words, coalesce(removed.n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from w left join removed using (doc_id) left join kept using (doc_id)
"""

_RECORDS = """
with p as (
    select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages
), five as (
    select *, list_transform(range(0, 8), lambda i: cast('0x' || substr(hex, cast(i as int) * 5 + 1, 5) as integer)) as parts from p
), named as (
    select page_id, octet_length(encode(html)) as payload_bytes, min(page_id) over (partition by hex) as first,
        array_to_string(list_transform(parts, lambda v: substr(abc, ((v >> 15) & 31) + 1, 1) || substr(abc, ((v >> 10) & 31) + 1, 1)
            || substr(abc, ((v >> 5) & 31) + 1, 1) || substr(abc, (v & 31) + 1, 1)), '') as payload_digest
    from five, (select 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' as abc)
)
select page_id, payload_bytes, payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type,
    case when page_id <> first then first end as refers_to
from named
"""

_PHRASES = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
), w as (
    select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as words from pieces
), total as (
    select lang, sum(len(words)) as n from w group by lang
), f as (
    select lang, phrase, k, count(*) as a from (
        select lang, k, array_to_string(words[i:i + k - 1], ' ') as phrase
        from (select lang, words, k, unnest(range(1, len(words) - k + 2)) as i from w, (select unnest(range(1, 6)) as k))
    ) group by all having count(*) >= 100
), cuts as (
    select f.lang, f.phrase, f.k, f.a, n, x.k as cut, x.a as l, y.a as r,
        (1000 * f.a::hugeint * n::hugeint) // (x.a::hugeint * y.a::hugeint) as score
    from f join total using (lang) join f x on x.lang = f.lang and x.k < f.k and starts_with(f.phrase, x.phrase || ' ')
    join f y on y.lang = f.lang and y.phrase = substr(f.phrase, length(x.phrase) + 2)
), best as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1
), free as (
    select * from best b where not exists (
        select 1 from f where f.lang = b.lang and f.k > b.k and f.a >= b.a and contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' '))
)
select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank, phrase, a, l, r,
    cast(n as bigint) as n, cast(score as bigint) as score
from free qualify rank <= 2000
"""

_VECTORS = """
with v as (
    select vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
)"""

_NEGATIVES = _VECTORS + """, named as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, v from v where label is not null
), s as (
    select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
        cast(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) as bigint) as score
    from named a join named b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0
), positive as (
    select * from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, p.vec_id as positive_id, cast(row_number() over w as integer) as rank, n.vec_id as negative_id,
    p.score as positive_score, n.score as negative_score
from positive p join s n on n.anchor_id = p.anchor_id and not n.same
    and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score
window w as (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id) qualify rank <= 5
"""

_NEAREST = _VECTORS + """
select a.vec_id as query_id, cast(row_number() over w as integer) as rank, b.vec_id,
    cast(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) as bigint) as score
from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
window w as (partition by a.vec_id order by list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) desc, b.vec_id)
qualify rank <= 5
"""

ORACLES: dict[str, str] = {
    "op11_collocation": _PHRASES,
    "op12_hard_negatives": _NEGATIVES,
    "op13_ball_tree": _NEAREST,
    "op3_exact_dedup": _COPIES,
    "op5_substring_dedup": _PASSAGES,
    "op10_warc": _RECORDS,
}
