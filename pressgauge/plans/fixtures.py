"""Inputs of the registered queries, derived by Spark from the given tables.

Tweets and comments come from ``conversations``, articles from ``pages`` and ``documents``. The
dictionaries are made from the corpus vocabulary and are bounded by its size, so that they may be
broadcast. A third of the tweets link to one page, to keep a hot key in every run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from pressgauge import schemas
from pressgauge.functions import counts
from pressgauge.functions import text as text_fn
from pressgauge.operators import pooling, tokens, tweets
from pressgauge.session import fresh_dir, ship_package
from pressgauge.sources.files import read_table

VOCABULARY = 1000
WIDTH = 64
EPOCH = 1_704_067_200

WORDS = pooling.Attention(
    w=tuple(tuple(((d * 7 + a * 3) % 11 - 5) / 10 for a in range(3)) for d in range(WIDTH)),
    b=(0.1, -0.2, 0.05), u=(0.5, -1.0, 0.75),
)
SENTENCES = pooling.Attention(
    w=tuple(tuple(((d * 5 + a * 4) % 9 - 4) / 10 for a in range(3)) for d in range(WIDTH)),
    b=(-0.1, 0.2, 0.0), u=(1.0, 0.5, -0.5),
)


_DICTIONARIES: dict[tuple[str, str, str], tuple[str, StructType]] = {}


class Inputs:
    """The derived tables over one data folder.

    The dictionaries that rank the corpus are stored once per application and folder, as a user's are.
    """

    def __init__(self, spark: SparkSession, folder: str):
        ship_package(spark)
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    def titles(self) -> DataFrame:
        first = F.substring_index("text", ".", 1)
        return self.table("documents").select("doc_id", "lang", F.concat(first, F.lit(" - "), "source").alias("title"))

    def posts(self) -> DataFrame:
        """Posts by the page they link to, a third of them to page 0."""
        conv = F.col("conv_id")
        page = F.when(conv % 3 == 0, F.lit(0)).otherwise(F.floor(conv / 4)).cast("bigint")
        return self.table("conversations").where("turn = 0").select(
            conv.alias("tweet_id"), "text", page.alias("page_id"),
            ((conv * 13) % 700).alias("retweet_count"),
            (((conv * 397) % 30) * 100).alias("favorite_count"),
            F.concat(F.lit("https://twitter.com/u"), (conv % 7).cast("string"), F.lit("/status/"), conv.cast("string")).alias("tweet_url"),
            F.when(conv % 5 == 0, F.lit("fr")).otherwise(F.lit("en")).alias("lang"),
        )

    def links(self) -> DataFrame:
        return self.table("pages").select("page_id", F.col("url").alias("news_url"))

    def tweets(self) -> DataFrame:
        return self.posts().join(self.links(), "page_id")

    def comments(self, conversations: DataFrame | None = None) -> DataFrame:
        conv, turn = F.col("conv_id"), F.col("turn")
        kind = (conv * 7 + turn) % 6
        like = (
            F.when(kind == 0, "").when(kind == 1, "12").when(kind == 2, "1.2K")
            .when(kind == 3, "3m").when(kind == 4, "1,234").otherwise("7")
        )
        source = conversations if conversations is not None else self.table("conversations")
        rows = source.where("turn > 0").select(
            conv.alias("tweet_id"), "turn", like.alias("like_str"), F.col("text").alias("comment"),
            F.timestamp_seconds(F.lit(EPOCH) + (conv % 1440) * 60 + turn).alias("event_time"),
        )
        return rows.withColumn("like_count", counts.like_weight(F.col("like_str")))

    def thread_comments(self) -> DataFrame:
        """Comments with the columns the seed join expects."""
        conv = F.col("tweet_id")
        return self.comments().select(
            F.concat(F.lit("https://twitter.com/u"), (conv % 7).cast("string"), F.lit("/status/"), conv.cast("string")).alias("tweet_url"),
            F.col("turn").alias("position"), "comment", "like_count",
            F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("comment_time"),
        )

    def english_tokens(self) -> DataFrame:
        return tokens.token_rows(self.table("documents").where("lang = 'en'"), ["doc_id"])

    def _dictionary(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key in _DICTIONARIES:
            path, schema = _DICTIONARIES[key]
            try:
                return self.spark.read.schema(schema).parquet(path)
            except AnalysisException:  # the shared folder was cleared meanwhile
                del _DICTIONARIES[key]
        rows, path = make(), fresh_dir(self.spark, name)
        rows.write.parquet(path)
        _DICTIONARIES[key] = (path, rows.schema)
        return self.spark.read.schema(rows.schema).parquet(path)

    def vocab(self) -> DataFrame:
        return self._dictionary("vocabulary", self.ranked_vocab)

    def ranked_vocab(self) -> DataFrame:
        return tokens.vocabulary(self.english_tokens(), VOCABULARY, min_length=3)

    def lexicon(self) -> DataFrame:
        return self.vocab().where("idx <= 200").select("token", (F.col("idx") % 9 - 4).cast("double").alias("valence"))

    def modifiers(self) -> DataFrame:
        idx = F.col("idx")
        return self.vocab().where("idx between 201 and 300").select(
            "token",
            F.when(idx % 3 == 0, F.lit(0.0)).when(idx % 2 == 0, F.lit(0.293)).otherwise(F.lit(-0.293)).alias("boost"),
            (idx % 3 == 0).alias("negates"),
        )

    def stop(self) -> DataFrame:
        return self.vocab().where("idx <= 25").select("token")

    def lemmas(self) -> DataFrame:
        word = F.col("token")
        lemma = F.when(word.endswith("s"), F.left(word, F.length(word) - 1)).otherwise(word)
        return self.vocab().where("idx % 5 <> 0").select("token", lemma.alias("lemma"))

    def speech(self) -> DataFrame:
        kind = F.col("idx") % 4
        return self.vocab().select(
            "token", F.when(kind == 0, "a").when(kind == 1, "s").when(kind == 2, "n").otherwise("v").alias("pos")
        )

    def phrases(self) -> DataFrame:
        return self._dictionary("phrases", self.ranked_phrases)

    def ranked_phrases(self) -> DataFrame:
        """The twenty most frequent word pairs."""
        pairs = tweets.phrase_rows(
            self.table("documents").where("lang = 'en'"), [], text_fn.letter_tokens(F.col("text")), [2]
        )
        ranked = pairs.groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))
        return ranked.orderBy(F.desc("n"), "phrase").limit(20).select("phrase")

    def keywords(self) -> DataFrame:
        words = self.vocab().where("idx between 50 and 70").select(F.col("token").alias("keyword"))
        return words.unionByName(self.phrases().select(F.col("phrase").alias("keyword")))

    def gazetteer(self) -> DataFrame:
        kind = F.col("idx") % 3
        return self.vocab().where("idx between 100 and 200").select(
            F.col("token").alias("phrase"),
            F.when(kind == 0, "ORG").when(kind == 1, "GPE").otherwise("DATE").alias("ent_type"),
        )

    def hits(self) -> DataFrame:
        """Every tweet under one or two keywords, so that pairs repeat."""
        words = F.when(F.col("tweet_id") % 2 == 0, F.array(F.lit("kw"), F.lit("alt"))).otherwise(F.array(F.lit("kw")))
        return self.tweets().select(
            "tweet_id", F.explode(words).alias("news_keyword"), "retweet_count", "favorite_count", "tweet_url", "news_url"
        )

    def seeds(self) -> DataFrame:
        return tweets.seeds(self.tweets().withColumn("news_keyword", F.lit("kw")), F.col("tweet_id"))

    def vectors(self) -> DataFrame:
        """Pretrained vectors for the words whose rank has one."""
        words = self.vocab().select("token", (F.col("idx") - 1).alias("vec_id"))
        return words.join(self.table("embeddings").select("vec_id", F.col("embedding").alias("vector")), "vec_id") \
            .select("token", "vector")

    def tweet_json(self) -> DataFrame:
        """Raw tweet objects."""
        return self.tweet_lines().select(F.from_json("value", schemas.TWEET).alias("t")).select("t.*")

    def tweet_lines(self) -> DataFrame:
        """Raw tweet objects as JSON text; every third one is a retweet."""
        t = self.tweets()
        n = F.col("tweet_id")
        created = F.date_format(F.timestamp_seconds(F.lit(EPOCH) + n * 4321), "EEE MMM dd HH:mm:ss Z yyyy")

        def body(shift: int, link: str, https: bool):
            url = F.lit("https://t.co/a" if https else "http://t.co/a")
            return [
                (n + shift).alias("id"), (n + shift).cast("string").alias("id_str"), created.alias("created_at"),
                F.col("text"), F.col("lang"),
                (F.col("retweet_count") + shift).alias("retweet_count"),
                (F.col("favorite_count") + shift).alias("favorite_count"),
                F.struct(F.concat(F.lit("u"), ((n + shift) % 7).cast("string")).alias("screen_name")).alias("user"),
                F.struct(F.when(n % 4 == 0, F.array().cast("array<struct<url:string,expanded_url:string>>")).otherwise(
                    F.array(F.struct(url.alias("url"), F.concat("news_url", F.lit(link)).alias("expanded_url")))
                ).alias("urls")).alias("entities"),
            ]

        inner = F.when(
            n % 3 == 0,
            F.when(n % 2 == 0, F.struct(*body(1000, "#inner", True))).otherwise(F.struct(*body(1000, "#inner", False))),
        )
        return t.select(F.to_json(F.struct(*body(0, "", True), inner.alias("retweeted_status"))).alias("value"))

    def social_tables(self) -> dict:
        return {
            "lexicon": self.lexicon(), "stop": self.stop(), "lemmas": self.lemmas(), "speech": self.speech(), "small": True,
        }

    def article_tables(self) -> dict:
        return {"lexicon": self.lexicon(), "stop": self.stop(), "lemmas": self.lemmas(), "small": True}
