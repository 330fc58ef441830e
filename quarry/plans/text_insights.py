"""Review-text analyses: cleaning to tokens without stopwords, frequent
words, comments per topic / aspect, top aspect per sentiment, top-k words
per topic.

Input roles:
  reviews(id, review, topic, aspect, sentiment)
  stopwords(word)

Plan shape: tokenising is `explode(split(regexp_replace(...)))` followed by
a plain filter (all JVM expressions, no Python); the stopword anti join is
broadcast only when the term list is under the planner's size threshold.
Every count is a `groupBy` with a partial aggregate, so a very frequent word
(or a topic holding a third of all tokens) is pre-aggregated in each map
task. Top-k per topic keeps k rows per topic in each partition before the
shuffle (`WindowGroupLimit`), so the final per-topic task sees at most
k x partitions rows, never a whole topic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import bag_to_string, normalize_label, review_tokens
from quarry.operators.agg import best_of, count_by
from quarry.operators.heavy import frequent_over, frequent_top_k
from quarry.operators.lookup import exclude_terms
from quarry.operators.rank import collect_top_k, top_k_per_group

TOKEN_COLUMNS = ("id", "word", "topic", "aspect", "sentiment")


def explode_tokens(df: DataFrame, text: str = "review", out: str = "word", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per token of the cleaned text (with the `keep` columns of its
    row); null text gives no rows."""
    return df.select(*keep, F.explode(review_tokens(text)).alias(out)).filter(F.col(out) != "")


def remove_stopwords(reviews: DataFrame, stopwords: DataFrame) -> DataFrame:
    """(id, word, topic, aspect, sentiment) for every token that is not a
    stopword. Sentiment is carried as stored (not normalised)."""
    tokens = explode_tokens(reviews, "review", "word", ("id", "topic", "aspect", "sentiment"))
    return exclude_terms(tokens, stopwords, "word").select(*TOKEN_COLUMNS)


def word_freq_over(tokens: DataFrame, min_freq: int = 500) -> DataFrame:
    """Words occurring more than `min_freq` times (tokens with a null id are
    not counted)."""
    counts = count_by(tokens, "word", count_col="id", name="frequency")
    return counts.filter(F.col("frequency") > min_freq).orderBy(F.desc("frequency"), "word")


def word_freq(tokens: DataFrame) -> DataFrame:
    """Occurrences of every word (tokens with a null id are not counted)."""
    return count_by(tokens, "word", count_col="id", name="frequency")


def topic_counts(reviews: DataFrame) -> DataFrame:
    """Comments per topic (null topic is one group; null ids not counted)."""
    return count_by(reviews, "topic", count_col="id", name="num_comments")


def aspect_counts(reviews: DataFrame) -> DataFrame:
    """Comments per aspect (null aspect is one group; null ids not counted)."""
    return count_by(reviews, "aspect", count_col="id", name="num_comments")


def clean_reviews(reviews: DataFrame) -> DataFrame:
    """Rows with id, aspect and sentiment present (and not a header line),
    sentiment trimmed and lower-cased."""
    kept = reviews.filter(
        F.col("id").isNotNull()
        & F.col("aspect").isNotNull()
        & F.col("sentiment").isNotNull()
        & (F.col("id").cast("string") != F.lit("id"))
    )
    return kept.select("id", "aspect", normalize_label("sentiment").alias("sentiment"))


def aspect_counts_for(clean: DataFrame, sentiment: str) -> DataFrame:
    """Comments per aspect for one (normalised) sentiment."""
    return count_by(clean.filter(F.col("sentiment") == sentiment), "aspect", count_col="aspect", name="cnt")


def top_aspect(clean: DataFrame, sentiment: str) -> DataFrame:
    """Aspect with the most comments of that sentiment (ties: smallest name)."""
    return best_of(aspect_counts_for(clean, sentiment), "cnt", tie="aspect")


def top_aspect_by_sentiment(clean: DataFrame, sentiments: tuple[str, ...] = ("negative", "positive")) -> DataFrame:
    """The top aspect of several sentiments in one pass: one grouped count
    on (sentiment, aspect), then the first row per sentiment."""
    counts = count_by(clean.filter(F.col("sentiment").isin(*sentiments)), ["sentiment", "aspect"], "aspect", "cnt")
    return top_k_per_group(counts, "sentiment", "cnt", 1, tie="aspect").drop("rank")


def topk_words(
    tokens: DataFrame,
    sentiment: str | None = None,
    k: int = 5,
    out: str = "top_words",
) -> DataFrame:
    """Per topic, the k most frequent words as a bag `{(word,n),...}`.

    With `sentiment`, only tokens whose stored sentiment equals it exactly
    are used and a token counts when its id is present; without it every
    token counts when its topic is present. Ties go to the smaller word."""
    if sentiment is not None:
        tokens = tokens.filter(F.col("sentiment") == sentiment)
        counter = "id"
    else:
        counter = "topic"
    counts = count_by(tokens, ["topic", "word"], count_col=counter, name="count")
    top = collect_top_k(counts, "topic", "count", k, ["word", "count"], tie="word", out="__bag")
    return top.select("topic", bag_to_string("__bag", ["word", "count"]).alias(out))


def topk_words_by_sentiment(
    tokens: DataFrame,
    sentiments: tuple[str, ...] = ("positive", "negative"),
    k: int = 5,
    out: str = "top_words",
) -> DataFrame:
    """`topk_words` for several sentiments in one pass: one grouped count on
    (sentiment, topic, word) and one top-k per (sentiment, topic), instead
    of a scan, count and top-k per sentiment."""
    picked = tokens.filter(F.col("sentiment").isin(*sentiments))
    counts = count_by(picked, ["sentiment", "topic", "word"], count_col="id", name="count")
    top = collect_top_k(counts, ["sentiment", "topic"], "count", k, ["word", "count"], tie="word", out="__bag")
    return top.select("sentiment", "topic", bag_to_string("__bag", ["word", "count"]).alias(out))


def frequent_words_over(tokens: DataFrame, min_freq: int = 500) -> DataFrame:
    """`word_freq_over` from a summary: only words of hash buckets with more than
    `min_freq` tokens are counted one by one (see `operators.heavy`)."""
    found = frequent_over(tokens.where(F.col("id").isNotNull()), "word", min_freq, "frequency")
    return found.orderBy(F.desc("frequency"), "word")


def frequent_topk_words(
    tokens: DataFrame, sentiment: str | None = None, k: int = 5, out: str = "top_words"
) -> DataFrame:
    """`topk_words` from a summary: the tail of rare words is neither shuffled nor
    counted. A word none of whose tokens counts is never listed."""
    counter = "topic" if sentiment is None else "id"
    if sentiment is not None:
        tokens = tokens.where(F.col("sentiment") == sentiment)
    counted = tokens.where(F.col(counter).isNotNull()).select("topic", "word")
    found = frequent_top_k(counted, "topic", "word", k, "count")
    top = collect_top_k(found.drop("rank"), "topic", "count", k, ["word", "count"], tie="word", out="__bag")
    return top.select("topic", bag_to_string("__bag", ["word", "count"]).alias(out))


def sample_tokens(tokens: DataFrame, n: int = 10) -> DataFrame:
    """Any n token rows (a preview: no order is implied)."""
    return tokens.limit(n)


def sample_check(sample: DataFrame, tokens: DataFrame) -> DataFrame:
    """(n_rows, n_found): rows of a written sample, and how many of them are
    rows of the token relation."""
    same = [sample[c].eqNullSafe(tokens[c]) for c in tokens.columns]
    found = sample.join(tokens, reduce(Column.__and__, same), "left_semi")
    return sample.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(0).alias("n_found")).unionByName(
        found.agg(F.lit(0).alias("n_rows"), F.count(F.lit(1)).alias("n_found"))
    ).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_found").alias("n_found"))
