"""Article extraction from stored pages and the article-side enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pressgauge.functions import html
from pressgauge.functions.text import is_present
from pressgauge.operators import sentiment, tokens
from pressgauge.operators.joins import lookup
from pressgauge.operators.tweets import first_per_key


def extract(pages: DataFrame, page: str = "html") -> DataFrame:
    """Pages with ``news_title``, ``news_text`` and ``news_image`` in place of the HTML.

    One step per projection, as an expression used twice in one projection is evaluated twice. The
    result comes out of a generator, so that filters on it are not pushed down and evaluated anew.
    """
    others = [c for c in pages.columns if c != page]
    source = F.coalesce(F.col(page), F.lit(""))
    steps = pages.select(
        *others, html.raw_title(source).alias("_title"), html.without_blocks(source).alias("_page"),
        html.preview_address(html.preview_tag(source)).alias("_preview"), html.first_image(source).alias("_image"),
    )
    steps = steps.withColumns({
        "_page": html.main_part(F.col("_page")),
        "_image": F.when(F.col("_preview") != "", F.col("_preview")).otherwise(F.col("_image")),
    })
    steps = steps.withColumn("_page", html.block_lines(F.col("_page")))
    found = F.struct(
        html.one_line(html.unescape(F.col("_title"))).alias("news_title"),
        html.tidy_lines(html.unescape(F.col("_page"))).alias("news_text"),
        html.unescape(F.col("_image")).alias("news_image"),
    )
    return steps.select(*others, F.inline(F.array(found)))


def readable(articles: DataFrame) -> DataFrame:
    """Articles with a title and a text."""
    return articles.where(is_present(F.col("news_title")) & is_present(F.col("news_text")))


def fetch(
    seeds: DataFrame, pages: DataFrame, columns: Sequence[str] = ("news_id", "news_url"), *, small: bool | None = None,
    version: str | None = None,
) -> DataFrame:
    """Seeds with their stored page, extracted; a seed without page gets empty strings.

    Pages nobody asks for are dropped first, without a shuffle if the seeds are few; the others are
    extracted before the join, so the HTML does not travel with the seeds. Of an address stored more
    than once, one page is taken: the newest by the ``version`` column, if named, then the largest.
    """
    stored = pages.select(F.col("url").alias("news_url"), "html", *([version] if version else []))
    wanted = lookup(stored, seeds.select("news_url").distinct(), "news_url", "left_semi", small=small)
    newest = [F.desc_nulls_last(version)] if version else []
    wanted = first_per_key(wanted, ["news_url"], *newest, F.desc_nulls_last("html"))
    if version:
        wanted = wanted.drop(version)
    joined = seeds.select(*columns).join(extract(wanted), "news_url", "left")
    return joined.na.fill("", ["news_title", "news_text", "news_image"])


def enrich(
    articles: DataFrame,
    lexicon: DataFrame,
    lemmas: DataFrame,
    stop: DataFrame,
    *,
    small: bool | None = None,
) -> DataFrame:
    """Readable articles with sentence scores and lemma text; articles without lemmas are dropped."""
    useful = readable(articles)
    scores = sentiment.collect_scores(
        sentiment.score_sentences(useful, ["news_id"], "news_text", lexicon, small=small), ["news_id"]
    )
    rows = tokens.without_stop_words(tokens.token_rows(useful, ["news_id"], "news_text", by_id=True), stop, small=small)
    lemma_text = tokens.collect_tokens(tokens.lemmatize(rows, lemmas, small=small), ["news_id"], out="_t") \
        .select("news_id", F.array_join("_t", " ").alias("news_tokens"))
    return (
        useful.select("news_id", "news_title", "news_text", "news_image")
        .join(lemma_text, "news_id")
        .join(scores, "news_id")
    )
