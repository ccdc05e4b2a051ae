import pytest
from pyspark.sql import functions as F

from pressgauge.functions import text as text_fn
from pressgauge.operators import articles, keywords, quality, social, tokens


def table(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_lemmas_keep_order_and_drop_unknown(spark, rows):
    docs = table(spark, "id int, text string", (1, "Cats see the dogs see"), (2, "xyz"))
    lemmas = table(spark, "token string, lemma string", ("cats", "cat"), ("see", "see"), ("dogs", "dog"))
    for by_id in (False, True):
        found = tokens.collect_tokens(tokens.lemmatize(tokens.token_rows(docs, ["id"], by_id=by_id), lemmas), ["id"])
        assert rows(found) == [(1, ["cat", "see", "dog", "see"])]


def test_regrouping_by_id_needs_one_shuffle(spark):
    docs = table(spark, "id int, text string", (1, "a b"))
    lemmas = table(spark, "token string, lemma string", ("a", "a"))
    found = tokens.collect_tokens(tokens.lemmatize(tokens.token_rows(docs, ["id"], by_id=True), lemmas, small=True), ["id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan


def test_suffix_rules(spark, rows):
    docs = table(spark, "id int, text string", (1, "cats running was"))
    words = table(spark, "token string", ("cat",), ("run",), ("runn",))
    found = tokens.lemmatize_with_suffixes(tokens.token_rows(docs, ["id"]), words, [("s", ""), ("ning", ""), ("ing", "")])
    assert rows(tokens.collect_tokens(found, ["id"])) == [(1, ["cat", "run"])]


def test_speech_keeps_repeats(spark, rows):
    docs = table(spark, "id int, text string", (1, "big dog big small jump"))
    speech = table(spark, "token string, pos string", ("big", "a"), ("small", "s"), ("dog", "n"), ("jump", "v"))
    assert rows(tokens.collect_tokens(tokens.of_speech(tokens.token_rows(docs, ["id"]), speech), ["id"])) == [(1, ["big", "big", "small"])]


def test_stop_words(spark, rows):
    docs = table(spark, "id int, text string", (1, "the cat is on a mat"))
    stop = tokens.union_stop_words(tokens.default_stop_words(spark), table(spark, "token string", ("mat",), ("the",)))
    assert stop.where("token = 'the'").count() == 1
    found = tokens.without_stop_words(tokens.token_rows(docs, ["id"]), stop)
    assert rows(tokens.collect_tokens(found, ["id"])) == [(1, ["cat"])]
    assert tokens.apply_token_stages(docs, "text", "t").first().t == ["cat", "mat"]


def test_vocabulary_ranks_ties_by_word(spark, rows):
    docs = table(spark, "id int, text string", (1, "b a a c b d"))
    assert rows(tokens.vocabulary(tokens.token_rows(docs, ["id"]), 3), "idx") == [("a", 2, 1), ("b", 2, 2), ("c", 1, 3)]


def test_last_value_wins(spark, rows):
    df = table(spark, "k string, v int, o int", ("a", 1, 1), ("a", 0, 2), ("b", 1, 1))
    assert rows(tokens.last_value_per_key(df, "k", "v", "o"), "k") == [("a", 0), ("b", 1)]


def test_count_vectors(spark, rows):
    df = table(spark, "id int, t array<string>", (1, ["a", "b", "a"]), (2, []))
    model = tokens.fit_count_vectors(df, "t")
    assert rows(tokens.count_vector_rows(model, model.transform(df), ["id"]), "token") == [(1, "a", 2), (1, "b", 1)]


def test_mined_keywords(spark, rows):
    titles = table(spark, "title string", ("Storm hits New York",), ("IBM and the storm",))
    gazetteer = table(spark, "phrase string, ent_type string", ("New York", "GPE"), ("IBM", "ORG"), ("storm", "DATE"))
    for small in (None, False):
        assert rows(keywords.mine_keywords(titles, gazetteer, small=small), "keyword") == [("IBM",), ("New York",)]


def test_capitalised_runs(spark, rows):
    titles = table(spark, "title string", ("In New York, Bob met Ann",), ("New York and Bob", ), ("iPhone Éric",))
    assert rows(keywords.capitalised_runs(titles), "keyword") == [("Bob", 2)]
    found = dict(rows(keywords.capitalised_runs(titles, min_titles=1)))
    assert found == {"In New York": 1, "New York": 1, "Bob": 2, "Ann": 1, "Éric": 1}


def test_model_keywords(spark, rows):
    titles = table(spark, "title string", ("a b",), (None,))

    def load():
        return lambda text: [(w, "ORG" if w == "a" else "DATE") for w in text.split()]

    assert rows(keywords.model_keywords(titles, load)) == [("a",)]


def test_headlines(spark, rows):
    heads = table(spark, "title string, description string, content string, lang string", ("A - B", "d", None, "en"), ("C", "e", "f", "fr"))
    assert rows(keywords.headline_titles(heads).select("title")) == [("A ",)]
    assert rows(keywords.headline_texts(heads.where("lang = 'en'")).select("field", "line")) == [("title", "A - B"), ("description", "d"), ("content", None)]


PAGE = """<html><head><title>A &amp; <b>B</b>
 C</title><meta property="og:image" content="http://i/x.png?a=1&amp;b=2"><style>p{}</style></head>
<body><nav><p>menu</p></nav><article><h1>Head</h1><!-- <p>no</p> --><script>var t="</p>";</script>
<p>One  two&#33;</p><p>Three<br>four</p></article><p>outside</p></body></html>"""


def test_extract(spark):
    plain = "<body><p>x</p><img alt='y' src='http://i/1.png'></body>"
    pages = table(spark, "url string, html string", ("a", PAGE), ("b", plain), ("c", ""), ("d", None))
    found = {r.url: tuple(r)[1:] for r in articles.extract(pages).collect()}
    assert found["a"] == ("A & B C", "Head\nOne two!\nThree\nfour", "http://i/x.png?a=1&b=2")
    assert found["b"] == ("", "x", "http://i/1.png")
    assert found["c"] == found["d"] == ("", "", "")


@pytest.mark.parametrize("small", [True, False])
def test_fetch_gives_empty_strings_for_missing_pages(spark, rows, small):
    pages = table(spark, "url string, html string", ("a", PAGE), ("z", PAGE))
    seeds = table(spark, "news_id string, news_url string", ("1", "a"), ("2", "b"), ("3", "a"))
    found = articles.fetch(seeds, pages, small=small)
    assert [(r.news_id, r.news_title) for r in found.orderBy("news_id").collect()] == [("1", "A & B C"), ("2", ""), ("3", "A & B C")]
    assert [r.news_id for r in articles.readable(found).orderBy("news_id").collect()] == ["1", "3"]


def test_fetch_takes_the_newest_page(spark):
    pages = table(spark, "url string, html string, page_id int", ("a", "<title>old</title>", 1), ("a", "<title>new</title>", 2))
    seeds = table(spark, "news_id string, news_url string", ("1", "a"))
    assert [r.news_title for r in articles.fetch(seeds, pages, version="page_id").collect()] == ["new"]


def dictionaries(spark):
    return {
        "lexicon": table(spark, "token string, valence double", ("good", 2.0), ("bad", -2.0)),
        "stop": table(spark, "token string", ("the",)),
        "lemmas": table(spark, "token string, lemma string", ("good", "good"), ("bad", "bad"), ("cats", "cat"), ("the", "the")),
    }


def test_enriched_article(spark):
    found = table(spark, "news_id string, news_title string, news_text string, news_image string",
                  ("1", "t", "The good cats. bad", ""), ("2", "t", "zzz", ""), ("3", "", "good", ""))
    rows = articles.enrich(found, **dictionaries(spark)).collect()
    assert [(r.news_id, r.news_tokens, r.sentiment_scores) for r in rows] == [("1", "good cat bad", [0.4588, -0.4588])]


def test_social_side(spark):
    speech = table(spark, "token string, pos string", ("good", "a"), ("bad", "s"), ("cat", "n"))
    seeds = table(spark, "news_id string, news_keyword string, retweet_count long, favorite_count long, news_url string, tweet_url string",
                  ("n", "k", 1, 2, "u", "t"))
    comments = table(spark, "tweet_url string, position long, comment string, like_count long, comment_time string",
                     ("t", 0, "good cats", 3, "x"), ("t", 1, "zzz", 9, "y"), ("t", 2, "the bad good", 1, "z"), ("t", 3, "", 5, "w"))
    scored = social.score_comments(seeds, comments, **dictionaries(spark), speech=speech)
    first, second = social.roll_up(scored, part_size=2).orderBy("part").collect()
    assert (first.tweets_comment, first.tweets_tokens, first.like_counts, first.comment_time) == (["good cats"], "good", [3], "x")
    assert (second.tweets_comment, second.tweets_tokens, second.sentiment_scores) == (["the bad good"], "bad good", [0.0])
    assert first.weighted_sentiment_score == second.weighted_sentiment_score == pytest.approx(0.4588 * 3 / 4)


def test_quality(spark, rows):
    labels = table(spark, "doc_id int, quality int", (1, 0), (1, 2), (2, None))
    assert dict(rows(quality.label_checks(labels, "doc_id", "quality"))) == {"label_rows": 3, "label_keys": 2, "label_not_binary": 2}
    good, bad = quality.with_link(table(spark, "url string", ("http://a",), ("x",), (None,)))
    assert good.count() == 1 and bad.count() == 2
    vocab = table(spark, "token string, idx int", ("a", 1), ("b", 5))
    assert dict(rows(quality.vocabulary_checks(vocab, 4)))["vocabulary_idx_out_of_range"] == 1


def test_tokens_of_null_text(spark):
    docs = table(spark, "id int, text string", (1, None))
    assert tokens.token_rows(docs, ["id"]).count() == 0
    assert docs.where(text_fn.is_present(F.col("text"))).count() == 0


def test_adjectives_by_either_tag_set(spark):
    rows = spark.createDataFrame([("big",), ("best",), ("run",), ("red",)], "token string")
    speech = spark.createDataFrame([("big", "a"), ("best", "JJS"), ("run", "VB"), ("red", "JJ")], "token string, pos string")
    assert sorted(r.token for r in tokens.of_speech(rows, speech, small=True).collect()) == ["best", "big", "red"]


def test_two_tweets_of_one_article_stay_apart(spark):
    seeds = spark.createDataFrame(
        [("n", "k", 1, 2, "u", "t1"), ("n", "k", 1, 2, "u", "t2")],
        "news_id string, news_keyword string, retweet_count long, favorite_count long, news_url string, tweet_url string",
    )
    comments = spark.createDataFrame(
        [("t1", 0, "good", 1, "x"), ("t2", 0, "bad", 1, "x")],
        "tweet_url string, position long, comment string, like_count long, comment_time string",
    )
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -2.0), ("good", 2.0)], "token string, valence double")
    lemmas = spark.createDataFrame([("good", "good"), ("bad", "bad"), ("bad", "bad")], "token string, lemma string")
    speech = spark.createDataFrame([("good", "a")], "token string, pos string")
    stop = spark.createDataFrame([("the",), ("the",)], "token string")
    scored = social.score_comments(seeds, comments, lexicon=lexicon, lemmas=lemmas, speech=speech, stop=stop)
    assert {r.tweet_url: r.score for r in scored.collect()} == {"t1": 0.4588, "t2": -0.4588}
    rolled = social.roll_up(scored).collect()
    assert {r.tweet_url: r.weighted_sentiment_score for r in rolled} == {"t1": 0.4588, "t2": -0.4588} and len(rolled) == 2


def test_page_stored_twice_is_one_article(spark):
    seeds = spark.createDataFrame([("n", "u")], "news_id string, news_url string")
    pages = spark.createDataFrame([("u", "<title>A</title><p>x</p>"), ("u", "<title>A</title><p>x</p>")], "url string, html string")
    assert articles.fetch(seeds, pages).count() == 1
