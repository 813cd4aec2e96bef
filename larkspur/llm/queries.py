"""The queries of the training-data problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import abuse, copies, encoding, frequency, language, lookalike, mixing, personal, truncation
from larkspur.session import cut, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def own_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tweet_id and text of the tweets that aren't retweets of a known tweet."""
    return table(spark, sf_dir, "tweets").where("retweeted_status is null and tweet_id is not null and text is not null").select("tweet_id", "text")


@query
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.copy_links(own_tweets(spark, sf_dir), "tweet_id").toDF("tweet_id_a", "tweet_id_b")


@query
def p5_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text's record and number of copies, retweets and texts without letter or digit too."""
    t = table(spark, sf_dir, "tweets").where("tweet_id is not null and text is not null").select("tweet_id", "text")
    return copies.one_per_text(t, "tweet_id", bare=True).select(F.col("root").alias("tweet_id"), "copies")


@query
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.alike_pairs(own_tweets(spark, sf_dir), "tweet_id").toDF("tweet_id_a", "tweet_id_b")


@query
def p6_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tweet's text in its one form, words in their own script."""
    t = table(spark, sf_dir, "tweets").where("tweet_id is not null").select("tweet_id", "text")
    return lookalike.consistent(t, "tweet_id").distinct().select(F.col("key").alias("tweet_id"), "form")


@query
def p6_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every own tweet's class of texts that look the same, and how many look the same with other characters."""
    return lookalike.alike_classes(own_tweets(spark, sf_dir), "tweet_id").toDF("tweet_id", "class_id", "links")


def _frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    tweets = table(spark, sf_dir, "tweets").where("text is not null")
    terms = table(spark, sf_dir, "simple_term")
    fields = {
        "tweets.text": (frequency.count_words(tweets.select("tweet_id", "text").dropDuplicates(["tweet_id"])), tweets.select(F.count_distinct("tweet_id").alias("all_records"))),
        "simple_term.pos": (frequency.count_values(terms, "doc_id", "pos"), terms.select(F.count_distinct("doc_id").alias("all_records"))),
    }
    return _union([frequency.marked(frequency.radix_sum(parts), n).select(F.lit(f).alias("field"), "term", "occurrences", "records", "mark") for f, (parts, n) in fields.items()])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frequencies(spark, sf_dir).where("mark is not null").select("field", "term", "mark")


@query
def p7_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every term with its occurrences and records."""
    return _frequencies(spark, sf_dir)


_P7 = """with t as (select tweet_id, any_value(text) as text from tweets where text is not null group by tweet_id),
w as (select tweet_id, unnest(regexp_extract_all(lower(text), '\\p{L}+')) as term from t),
c as (select 'tweets.text' as field, term, count(*) as occurrences, count(distinct tweet_id) as records, (select count(*) from t) as n from w group by term
union all select 'simple_term.pos', pos, count(*), count(distinct doc_id), (select count(distinct doc_id) from simple_term) from simple_term where pos is not null group by pos),
m as (select *, case when records < 3 then 'rare' when records > 0.2 * n then 'common' end as mark from c) """
ORACLE["p7_found"] = _P7 + "select field, term, mark from m where mark is not null"
ORACLE["p7_terms"] = _P7 + "select field, term, occurrences, records, mark from m"


def _stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    tweets = table(spark, sf_dir, "tweets").where("tweet_id is not null")
    return language.stretches(tweets, table(spark, sf_dir, "lang_samples"), "tweet_id", "text", "lang")


@query
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without a label or with a wrong one, and mixed ones, a row per language held."""
    s = _stretches(spark, sf_dir).where("stretches is not null").select("key", language.label(F.col("lang")).alias("label"), F.array_distinct(F.transform("stretches", lambda x: x["lang"])).alias("langs"))
    s = s.withColumn("langs", F.when(F.size("langs") > 1, F.array_remove("langs", "und")).otherwise(F.col("langs")))
    case = (F.size("langs") > 1) | F.when(F.col("label").isNull(), F.col("langs")[0] != "und").otherwise(F.col("langs")[0] != F.col("label"))
    # Redelivered rows are equal: the cases, not the texts, are made unique.
    return s.where(case).select(F.col("key").alias("tweet_id"), F.explode("langs").alias("lang")).distinct()


@query
def p3_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's segments with language and confidence."""
    s = _stretches(spark, sf_dir).where("stretches is not null").select(F.col("key").alias("tweet_id"), F.posexplode("stretches").alias("segment", "s"))
    return s.select("tweet_id", "segment", "s.lang", F.round("s.confidence", 4).alias("confidence"), "s.start_pos", "s.end_pos").distinct()


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abuse.score(table(spark, sf_dir, "tweets").where("tweet_id is not null"), table(spark, sf_dir, "tweet_labels"))


@query
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Redelivered rows score alike: the cases, not the texts, are made unique.
    return _scores(spark, sf_dir).where(F.col("score") >= abuse.THRESHOLD).select(F.col("key").alias("tweet_id")).distinct()


@query
def p1_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tweet's score."""
    return _scores(spark, sf_dir).groupBy(F.col("key").alias("tweet_id")).agg(F.max("score").alias("score"))


@query
def p1_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tweets, cases and their rate per source (null sources are one)."""
    one = _scores(spark, sf_dir).groupBy("key", "source").agg(F.max("score").alias("score"))
    return one.groupBy("source").agg(F.count(F.lit(1)).alias("tweets"), F.count_if(F.col("score") >= abuse.THRESHOLD).alias("cases"), F.avg((F.col("score") >= abuse.THRESHOLD).cast("double")).alias("rate"), F.avg("score").alias("mean_score"))


@query
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "tweets").where("tweet_id is not null and text is not null")
    # Redelivered rows hold the same items: these, not the texts, are made unique.
    f = personal.found(t, "tweet_id", "text").select(F.col("key").alias("tweet_id"), F.explode("items").alias("i"))
    return f.select("tweet_id", "i.kind", "i.start_pos").distinct()


@query
def p2_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tweet's text with placeholders for personal data."""
    t = table(spark, sf_dir, "tweets").where("tweet_id is not null")
    return personal.redacted(t, "tweet_id", "text").select(F.col("key").alias("tweet_id"), "text").distinct()


@query
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.judged(table(spark, sf_dir, "documents"), "doc_id", "text", "source").where("why is not null").select(F.col("key").alias("doc_id"))


@query
def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts, cut ones and their rate per source."""
    j = truncation.judged(table(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return j.groupBy("source").agg(F.count(F.lit(1)).alias("texts"), F.count("why").alias("cut"), (F.count("why") / F.count(F.lit(1))).alias("rate"))


@query
def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encode(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("key", "doc_id")


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with their number of tokens."""
    ids = encoding.encode(table(spark, sf_dir, "documents"), "doc_id", "text").select(F.col("key").alias("doc_id"), F.size("ids").alias("tokens"))
    return cut(table(spark, sf_dir, "documents").select("doc_id", "source").join(ids, "doc_id"))


@query
def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mixture with their copies."""
    return mixing.mixture(_sized(spark, sf_dir), table(spark, sf_dir, "mix_targets"), "doc_id", "source", "tokens").withColumnRenamed("key", "doc_id")


@query
def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares reached."""
    docs, targets = _sized(spark, sf_dir), table(spark, sf_dir, "mix_targets")
    return mixing.reached(mixing.mixture(docs, targets, "doc_id", "source", "tokens"), docs, targets, "source", "tokens")
