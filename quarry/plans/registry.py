"""Registered queries: (spark, sf_dir) -> DataFrame, each with the DuckDB SQL
that must give the same rows on the same parquet tables.

Every query reads the driver's tables whole (through the role views of
`quarry.roles`); oracle texts alias every computed column to the Spark
name. Numeric conventions shared by both sides:
  * means are sum / count rounded half-up on the shortest decimal form:
    Spark `round(x, 2)`; DuckDB `round(CAST(x AS DECIMAL(28,12)), 2)`;
  * money is summed as DECIMAL and cast to DOUBLE after rounding;
  * counts, years, months, day differences and ranks are BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry import roles
from quarry.functions.scalar import (
    AGE_EDGES,
    AGE_LABELS_LEFT,
    AGE_LABELS_RIGHT,
    REVIEW_DIGIT_CLASS,
    REVIEW_PUNCT_CLASS,
    TOKEN_SEPARATORS,
)
from quarry.plans import commerce, files, ratings, text_insights
from quarry.roles import role, role_cte

Query = Callable[[SparkSession, str], DataFrame]


def R(expr: str, digits: int = 2) -> str:
    """Oracle-side half-up rounding of a double expression to a DOUBLE."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,12)), {digits}) AS DOUBLE)"


def F2(expr: str) -> str:
    """Oracle-side `%.2f` text of a double expression."""
    return f"printf('%.2f', {R(expr)})"


def JT(expr: str) -> str:
    """Oracle-side Java `trim` (strip characters up to U+0020)."""
    return f"trim({expr}, {_JAVA_TRIM_SQL})"


def CLEAN(expr: str) -> str:
    """Oracle-side review cleaning: lower, then the two character classes."""
    return (
        f"regexp_replace(regexp_replace(lower({expr}), '{_PUNCT}', ' ', 'g'), "
        f"'{_DIGITS}', ' ', 'g')"
    )


# ---------------------------------------------------------------------------
# Fixed values of the oracle side, taken from the marked blocks of the library:
# report patterns (the two-decimal numbers are formatted by F2), labels and
# character classes.
def _pattern(text: str) -> str:
    return "'" + text.replace("%.2f", "%s").replace("'", "''") + "'"


_GENRE_LINE, _BEST_GENRE_LINE = _pattern(ratings.GENRE_LINE), _pattern(ratings.BEST_GENRE_LINE)
_MOVIE_LINE, _BEST_MOVIE_LINE = _pattern(ratings.MOVIE_LINE), _pattern(ratings.BEST_MOVIE_LINE)
_GENDER_LINE, _GAP_LINE, _AGE_LINE = (_pattern(x) for x in (ratings.GENDER_LINE, ratings.GAP_LINE, ratings.AGE_LINE))
_AGE_RIGHT, _AGE_LEFT = AGE_LABELS_RIGHT, AGE_LABELS_LEFT
_PUNCT, _DIGITS = REVIEW_PUNCT_CLASS.replace("'", "''"), REVIEW_DIGIT_CLASS
_SEPARATORS = TOKEN_SEPARATORS
# ---------------------------------------------------------------------------

_JAVA_TRIM_SQL = " || ".join(f"chr({i})" for i in range(0x21))

# Lookups reduced to one row per key (the greatest value wins), as the Spark
# side does with `unique_lookup` before every lookup join.
_MT = "(SELECT movie_id, max(title) AS title FROM movies GROUP BY movie_id)"
_MG = "(SELECT movie_id, max(genres) AS genres FROM movies GROUP BY movie_id)"
_UG_LONG = "(SELECT user_id, max(gender) AS gender FROM users GROUP BY user_id)"
_UO = "(SELECT user_id, max(occupation_id) AS occupation_id FROM users GROUP BY user_id)"
_OO = "(SELECT occupation_id, max(occupation) AS occupation FROM occupations GROUP BY occupation_id)"


QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


# --------------------------------------------------------------------------
# Ratings (C1-C6)

register(
    "movie_rating_stats",
    role_cte("ratings", "movies")
    + f"""
    SELECT r.movie_id, m.title, {R('sum(r.rating) / count(r.rating)')} AS avg_rating,
           count(r.rating) AS n_ratings
    FROM ratings r JOIN {_MT} m ON r.movie_id = m.movie_id
    GROUP BY r.movie_id, m.title HAVING count(r.rating) > 0""",
)(lambda spark, d: ratings.movie_rating_stats(role(spark, d, "ratings"), role(spark, d, "movies")))


def _r(spark, d, *names):
    return [role(spark, d, n) for n in names]


_MOVIE_STATE = "ms AS (SELECT movie_id, sum(rating) AS rs, count(rating) AS n FROM ratings GROUP BY movie_id)"


def _title(default_prefix: str, alias: str = "w") -> str:
    return (
        f"CASE WHEN m.movie_id IS NULL THEN '{default_prefix}' || CAST({alias}.movie_id AS VARCHAR) "
        f"ELSE m.title END AS title"
    )


register(
    "best_movie",
    role_cte("ratings", "movies")
    + f""", {_MOVIE_STATE},
    top AS (SELECT * FROM ms WHERE n >= 5 ORDER BY rs / n DESC NULLS LAST, movie_id ASC LIMIT 1)
    SELECT w.movie_id, {_title('MovieID:')}, {R('w.rs / w.n')} AS avg_rating, w.n AS n_ratings
    FROM top w LEFT JOIN {_MT} m ON w.movie_id = m.movie_id""",
)(lambda spark, d: ratings.best_movie(*_r(spark, d, "ratings", "movies")))

_GENRES = (
    f"gs AS (SELECT {JT('g.genre')} AS genre, g.rs, g.n FROM (SELECT unnest(string_split(m.genres, '|')) AS genre, "
    f"ms.rs, ms.n FROM ms JOIN {_MG} m ON ms.movie_id = m.movie_id) g), "
    "gst AS (SELECT genre, sum(rs) / sum(n) AS a, CAST(sum(n) AS BIGINT) AS n FROM gs GROUP BY genre HAVING sum(n) > 0)"
)

register(
    "genre_rating",
    role_cte("ratings", "movies")
    + f""", {_MOVIE_STATE}, {_GENRES}
    SELECT genre, {R('a')} AS avg_rating, n AS n_ratings FROM gst""",
)(lambda spark, d: ratings.genre_rating(*_r(spark, d, "ratings", "movies")))

register(
    "best_genre",
    role_cte("ratings", "movies")
    + f""", {_MOVIE_STATE}, {_GENRES}
    SELECT genre, {R('a')} AS avg_rating, n AS n_ratings FROM gst ORDER BY a DESC NULLS LAST, genre ASC LIMIT 1""",
)(lambda spark, d: ratings.best_genre(*_r(spark, d, "ratings", "movies")))

register(
    "genre_report_with_best",
    role_cte("ratings", "movies")
    + f""", {_MOVIE_STATE}, {_GENRES}
    SELECT genre AS key, printf({_GENRE_LINE}, {F2('a')}, n) AS line FROM gst
    UNION ALL
    SELECT '{ratings.BEST_GENRE_LABEL}' AS key, printf({_BEST_GENRE_LINE}, genre, {F2('a')}, n) AS line
    FROM (SELECT * FROM gst ORDER BY a DESC NULLS LAST, genre ASC LIMIT 1)""",
)(lambda spark, d: ratings.genre_report_with_best(*_r(spark, d, "ratings", "movies")))

_GENDER_WIDE = (
    f"rg AS (SELECT r.movie_id, r.rating, u.g AS g FROM ratings r "
    f"JOIN (SELECT user_id, max(upper({JT('gender')})) AS g FROM users GROUP BY user_id) u "
    "ON r.user_id = u.user_id WHERE r.rating IS NOT NULL), "
    "gw AS (SELECT movie_id, sum(CASE WHEN g = 'M' THEN rating END) AS sm, count(CASE WHEN g = 'M' THEN rating END) AS nm, "
    "sum(CASE WHEN g = 'F' THEN rating END) AS sf, count(CASE WHEN g = 'F' THEN rating END) AS nf FROM rg GROUP BY movie_id)"
)

register(
    "movie_gender_wide",
    role_cte("ratings", "users", "movies")
    + f""", {_GENDER_WIDE}
    SELECT w.movie_id, {_title('MovieID:')}, COALESCE({R('w.sm / w.nm')}, 0.0) AS avg_male, w.nm AS n_male,
           COALESCE({R('w.sf / w.nf')}, 0.0) AS avg_female, w.nf AS n_female
    FROM gw w LEFT JOIN {_MT} m ON w.movie_id = m.movie_id""",
)(lambda spark, d: ratings.movie_gender_wide(*_r(spark, d, "ratings", "users", "movies")))

register(
    "biggest_gender_gap",
    role_cte("ratings", "users", "movies")
    + f""", {_GENDER_WIDE},
    top AS (SELECT movie_id, abs(sm / nm - sf / nf) AS gap FROM gw WHERE nm > 0 AND nf > 0
            ORDER BY gap DESC NULLS LAST, movie_id ASC LIMIT 1)
    SELECT w.movie_id, {_title('MovieID:')}, {R('w.gap')} AS gap FROM top w LEFT JOIN {_MT} m ON w.movie_id = m.movie_id""",
)(lambda spark, d: ratings.biggest_gender_gap(*_r(spark, d, "ratings", "users", "movies")))

register(
    "movie_gender_long",
    role_cte("ratings", "users", "movies")
    + f""",
    rg AS (SELECT r.movie_id, r.rating, CASE WHEN u.user_id IS NULL THEN 'Unknown' ELSE u.gender END AS gender
           FROM ratings r LEFT JOIN {_UG_LONG} u ON r.user_id = u.user_id WHERE r.rating IS NOT NULL),
    w AS (SELECT movie_id, gender, sum(rating) / count(rating) AS a, count(rating) AS n FROM rg GROUP BY movie_id, gender)
    SELECT w.movie_id, {_title('MovieID ')}, w.gender, {R('w.a')} AS avg_rating, w.n AS n_ratings
    FROM w LEFT JOIN {_MT} m ON w.movie_id = m.movie_id""",
)(lambda spark, d: ratings.movie_gender_long(*_r(spark, d, "ratings", "users", "movies")))

_BAND_RIGHT = "CASE WHEN {a} IS NULL THEN NULL" + "".join(
    f" WHEN {{a}} <= {edge} THEN '{label}'" for edge, label in zip(AGE_EDGES, _AGE_RIGHT)
) + f" ELSE '{_AGE_RIGHT[-1]}' END"
_BAND_LEFT = "CASE WHEN {a} IS NULL THEN NULL" + "".join(
    f" WHEN {{a}} < {edge} THEN '{label}'" for edge, label in zip(AGE_EDGES, _AGE_LEFT)
) + f" ELSE '{_AGE_LEFT[-1]}' END"


_UA_RIGHT = (
    f"(SELECT user_id, max({_BAND_RIGHT.format(a='age')}) AS b FROM users WHERE age IS NOT NULL GROUP BY user_id)"
)
_UA_LEFT = (
    f"(SELECT user_id, max(COALESCE({_BAND_LEFT.format(a='age')}, 'Unknown')) AS age_group FROM users "
    "GROUP BY user_id)"
)


def _band_avg(label: str) -> str:
    return (
        f"COALESCE({R(f'sum(CASE WHEN b = {chr(39)}{label}{chr(39)} THEN rating END) / '
                     f'count(CASE WHEN b = {chr(39)}{label}{chr(39)} THEN rating END)')}, 0.0)"
    )


_BAND_MEANS = ", ".join(
    f"{_band_avg(label)} AS avg_{suffix}" for suffix, label in zip(ratings.AGE_SUFFIXES, _AGE_RIGHT)
)

register(
    "movie_age_wide",
    role_cte("ratings", "users", "movies")
    + f""",
    rb AS (SELECT r.movie_id, r.rating, u.b AS b FROM ratings r
           JOIN {_UA_RIGHT} u ON r.user_id = u.user_id WHERE r.rating IS NOT NULL),
    w AS (SELECT movie_id, {_BAND_MEANS} FROM rb GROUP BY movie_id)
    SELECT w.movie_id, {_title('MovieID:')}, avg_0_18, avg_18_35, avg_35_50, avg_50p
    FROM w LEFT JOIN {_MT} m ON w.movie_id = m.movie_id""",
)(lambda spark, d: ratings.movie_age_wide(*_r(spark, d, "ratings", "users", "movies")))

register(
    "movie_age_long",
    role_cte("ratings", "users", "movies")
    + f""",
    rb AS (SELECT r.movie_id, r.rating,
                  CASE WHEN u.user_id IS NULL THEN 'Unknown' ELSE u.age_group END AS age_group
           FROM ratings r LEFT JOIN {_UA_LEFT} u ON r.user_id = u.user_id WHERE r.rating IS NOT NULL),
    w AS (SELECT movie_id, age_group, sum(rating) / count(rating) AS a, count(rating) AS n FROM rb GROUP BY movie_id, age_group)
    SELECT w.movie_id, {_title('MovieID ')}, w.age_group, {R('w.a')} AS avg_rating, w.n AS n_ratings
    FROM w LEFT JOIN {_MT} m ON w.movie_id = m.movie_id""",
)(lambda spark, d: ratings.movie_age_long(*_r(spark, d, "ratings", "users", "movies")))

register(
    "age_bands",
    role_cte("users")
    + f"""
    SELECT age, {_BAND_RIGHT.format(a='age')} AS band_upper_inclusive, {_BAND_LEFT.format(a='age')} AS band_lower_inclusive,
           count(*) AS n_users
    FROM users GROUP BY age""",
)(lambda spark, d: ratings.age_bands(role(spark, d, "users")))

register(
    "occupation_rating",
    role_cte("ratings", "users", "occupations")
    + f""",
    pu AS (SELECT user_id, sum(rating) AS rs, count(rating) AS n FROM ratings GROUP BY user_id),
    wo AS (SELECT pu.rs, pu.n, CASE WHEN u.user_id IS NULL THEN 0 ELSE u.occupation_id END AS occupation_id
           FROM pu LEFT JOIN {_UO} u ON pu.user_id = u.user_id),
    wn AS (SELECT wo.rs, wo.n, CASE WHEN o.occupation_id IS NULL THEN 'Unknown' ELSE o.occupation END AS occupation
           FROM wo LEFT JOIN {_OO} o ON wo.occupation_id = o.occupation_id)
    SELECT occupation, {R('sum(rs) / sum(n)')} AS avg_rating, CAST(sum(n) AS BIGINT) AS n_ratings
    FROM wn GROUP BY occupation HAVING sum(n) > 0""",
)(lambda spark, d: ratings.occupation_rating(*_r(spark, d, "ratings", "users", "occupations")))

register(
    "rating_by_year",
    role_cte("ratings")
    + f"""
    SELECT year(make_timestamp(CAST(epoch(rated_at) AS BIGINT) * 1000000)) AS year,
           {R('sum(rating) / count(rating)')} AS avg_rating, count(rating) AS n_ratings
    FROM ratings GROUP BY 1""",
)(
    lambda spark, d: ratings.rating_by_year(
        ratings.with_epoch_seconds(role(spark, d, "ratings")), "rated_epoch", epoch=True
    )
)

register(
    "movie_report_lines",
    role_cte("ratings", "movies")
    + f""", {_MOVIE_STATE}
    SELECT m.title, printf({_MOVIE_LINE}, {F2('w.rs / w.n')}, w.n) AS line
    FROM ms w JOIN {_MT} m ON w.movie_id = m.movie_id WHERE w.n > 0""",
)(lambda spark, d: ratings.movie_report_lines(*_r(spark, d, "ratings", "movies")))


register(
    "report_lines",
    role_cte("ratings", "users", "occupations")
    + f""",
    pu AS (SELECT user_id, sum(rating) AS rs, count(rating) AS n FROM ratings GROUP BY user_id),
    wo AS (SELECT pu.rs, pu.n, CASE WHEN u.user_id IS NULL THEN 0 ELSE u.occupation_id END AS occupation_id
           FROM pu LEFT JOIN {_UO} u ON pu.user_id = u.user_id),
    wn AS (SELECT wo.rs, wo.n, CASE WHEN o.occupation_id IS NULL THEN 'Unknown' ELSE o.occupation END AS occupation
           FROM wo LEFT JOIN {_OO} o ON wo.occupation_id = o.occupation_id),
    st AS (SELECT occupation, {F2('sum(rs) / sum(n)')} AS a, CAST(sum(n) AS BIGINT) AS n
           FROM wn GROUP BY occupation HAVING sum(n) > 0)
    SELECT occupation, '  ' || rpad(occupation, CAST(greatest(length(occupation), 20) AS INTEGER), ' ') || ' '
           || rpad(a, CAST(greatest(length(a), 12) AS INTEGER), ' ') || ' ' || CAST(n AS VARCHAR) AS line
    FROM st""",
)(lambda spark, d: ratings.occupation_report_lines(*_r(spark, d, "ratings", "users", "occupations")))


def _unique_latest_order(spark, d):
    from quarry.operators.lookup import unique_lookup

    orders = role(spark, d, "shop_orders").select("customer_trx_id", "order_id", "purchase_ts")
    return unique_lookup(orders, "customer_trx_id", order=["purchase_ts", "order_id"])


register(
    "unique_lookup",
    role_cte("shop_orders")
    + """
    SELECT customer_trx_id, order_id, purchase_ts FROM (
        SELECT customer_trx_id, order_id, purchase_ts,
               row_number() OVER (PARTITION BY customer_trx_id ORDER BY purchase_ts DESC, order_id DESC) AS rn
        FROM shop_orders) WHERE rn = 1""",
)(_unique_latest_order)

# --------------------------------------------------------------------------
# Review text (C7-C11)

_TOKENS = (
    "tok AS (SELECT id, word, topic, aspect, sentiment FROM ("
    f"SELECT id, unnest(string_split_regex({CLEAN('review')}, '{_SEPARATORS}')) AS word, topic, aspect, sentiment "
    "FROM reviews) t WHERE word <> '' AND NOT EXISTS (SELECT 1 FROM stopwords s WHERE s.word = t.word))"
)


def _tokens(spark, d):
    return text_insights.remove_stopwords(role(spark, d, "reviews"), role(spark, d, "stopwords"))


register(
    "scan_stopwords",
    role_cte("reviews", "stopwords") + f", {_TOKENS}\n    SELECT id, word, topic, aspect, sentiment FROM tok",
)(
    lambda spark, d: text_insights.remove_stopwords(
        role(spark, d, "reviews"), files.stopwords_from_file(spark, role(spark, d, "stopwords"))
    )
)

register(
    "remove_stopwords",
    role_cte("reviews", "stopwords") + f", {_TOKENS}\n    SELECT id, word, topic, aspect, sentiment FROM tok",
)(_tokens)

register(
    "word_freq_over",
    role_cte("reviews", "stopwords")
    + f", {_TOKENS}\n    SELECT word, count(id) AS frequency FROM tok GROUP BY word HAVING count(id) > 500",
)(lambda spark, d: text_insights.word_freq_over(_tokens(spark, d), 500))

register(
    "topic_counts",
    role_cte("reviews") + "\n    SELECT topic, count(id) AS num_comments FROM reviews GROUP BY topic",
)(lambda spark, d: text_insights.topic_counts(role(spark, d, "reviews")))

register(
    "aspect_counts",
    role_cte("reviews") + "\n    SELECT aspect, count(id) AS num_comments FROM reviews GROUP BY aspect",
)(lambda spark, d: text_insights.aspect_counts(role(spark, d, "reviews")))

_CLEAN_REVIEWS = (
    f"cr AS (SELECT id, aspect, lower({JT('sentiment')}) AS sentiment FROM reviews "
    "WHERE id IS NOT NULL AND aspect IS NOT NULL AND sentiment IS NOT NULL AND CAST(id AS VARCHAR) <> 'id')"
)

register(
    "clean_reviews",
    role_cte("reviews") + f", {_CLEAN_REVIEWS}\n    SELECT id, aspect, sentiment FROM cr",
)(lambda spark, d: text_insights.clean_reviews(role(spark, d, "reviews")))

for _s in ("negative", "positive"):
    register(
        f"aspect_counts_{_s}",
        role_cte("reviews")
        + f", {_CLEAN_REVIEWS}\n    SELECT aspect, count(aspect) AS cnt FROM cr WHERE sentiment = '{_s}' GROUP BY aspect",
    )(lambda spark, d, s=_s: text_insights.aspect_counts_for(text_insights.clean_reviews(role(spark, d, "reviews")), s))
    register(
        f"top_aspect_{_s}",
        role_cte("reviews")
        + f", {_CLEAN_REVIEWS}\n    SELECT aspect, count(aspect) AS cnt FROM cr WHERE sentiment = '{_s}' "
        "GROUP BY aspect ORDER BY cnt DESC, aspect ASC LIMIT 1",
    )(lambda spark, d, s=_s: text_insights.top_aspect(text_insights.clean_reviews(role(spark, d, "reviews")), s))

register(
    "top_aspect_by_sentiment",
    role_cte("reviews")
    + f""", {_CLEAN_REVIEWS},
    c AS (SELECT sentiment, aspect, count(aspect) AS cnt FROM cr WHERE sentiment IN ('negative', 'positive')
          GROUP BY sentiment, aspect)
    SELECT sentiment, aspect, cnt FROM (
        SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY cnt DESC, aspect ASC) AS rn FROM c) WHERE rn = 1""",
)(lambda spark, d: text_insights.top_aspect_by_sentiment(text_insights.clean_reviews(role(spark, d, "reviews"))))


def _topk_sql(where: str, counter: str, out: str) -> str:
    return (
        role_cte("reviews", "stopwords")
        + f""", {_TOKENS},
    c AS (SELECT topic, word, count({counter}) AS cnt FROM tok {where} GROUP BY topic, word),
    r AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY cnt DESC, word ASC) AS rn FROM c)
    SELECT topic, '{{' || string_agg('(' || word || ',' || CAST(cnt AS VARCHAR) || ')', ',' ORDER BY rn) || '}}' AS {out}
    FROM r WHERE rn <= 5 GROUP BY topic"""
    )


register("topk_words_positive", _topk_sql("WHERE sentiment = 'positive'", "id", "top_positive_words"))(
    lambda spark, d: text_insights.topk_words(_tokens(spark, d), "positive", 5, "top_positive_words")
)
register("topk_words_negative", _topk_sql("WHERE sentiment = 'negative'", "id", "top_negative_words"))(
    lambda spark, d: text_insights.topk_words(_tokens(spark, d), "negative", 5, "top_negative_words")
)
register("topk_words_all", _topk_sql("", "topic", "top_words"))(
    lambda spark, d: text_insights.topk_words(_tokens(spark, d), None, 5, "top_words")
)

register(
    "topk_words_by_sentiment",
    role_cte("reviews", "stopwords")
    + f""", {_TOKENS},
    c AS (SELECT sentiment, topic, word, count(id) AS cnt FROM tok WHERE sentiment IN ('positive', 'negative')
          GROUP BY sentiment, topic, word),
    r AS (SELECT *, row_number() OVER (PARTITION BY sentiment, topic ORDER BY cnt DESC, word ASC) AS rn FROM c)
    SELECT sentiment, topic,
           '{{' || string_agg('(' || word || ',' || CAST(cnt AS VARCHAR) || ')', ',' ORDER BY rn) || '}}' AS top_words
    FROM r WHERE rn <= 5 GROUP BY sentiment, topic""",
)(lambda spark, d: text_insights.topk_words_by_sentiment(_tokens(spark, d)))

# A preview: any 10 token rows. No order is implied: compared are the number
# of rows and how many of them are rows of the token relation.
register(
    "sample_tokens",
    role_cte("reviews", "stopwords")
    + f", {_TOKENS}, n AS (SELECT least(count(*), 10) AS n FROM tok)\n    SELECT n AS n_rows, n AS n_found FROM n",
)(lambda spark, d: files.sampled(spark, *_r(spark, d, "reviews", "stopwords"), 10))

# --------------------------------------------------------------------------
# Commerce (C12-C18)

_SHOP_TABLES = ("orders", "customer", "lineitem", "part", "events")

register(
    "table_row_counts",
    "\n    UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _SHOP_TABLES),
)(lambda spark, d: commerce.table_row_counts({t: roles.table(spark, d, t) for t in _SHOP_TABLES}))

_PROFILED = _SHOP_TABLES + ("documents", "labels")

register(
    "table_profile",
    "WITH n AS ("
    + " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _PROFILED)
    + """),
    c AS (SELECT table_name, count(*) AS n_columns, string_agg(column_name, ',' ORDER BY ordinal_position) AS column_names,
                 string_agg(data_type, ',' ORDER BY ordinal_position) AS column_types
          FROM information_schema.columns GROUP BY table_name)
    SELECT n.table_name, n.n_rows, c.n_columns, c.column_names, c.column_types
    FROM n JOIN c ON n.table_name = c.table_name""",
)(lambda spark, d: commerce.table_profile({t: spark.read.parquet(f"{d.rstrip('/')}/{t}.parquet") for t in _PROFILED}))


register(
    "summary_metrics",
    role_cte("shop_orders", "shop_customers", "shop_items")
    + """
    SELECT metric, value, format('{:,}', value) AS value_text FROM (
        SELECT 'total_orders' AS metric, count(*) AS value FROM shop_orders
        UNION ALL SELECT 'distinct_customers', CAST(count(DISTINCT customer_trx_id)
            + COALESCE(max(CASE WHEN customer_trx_id IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) FROM shop_customers
        UNION ALL SELECT 'distinct_sellers', CAST(count(DISTINCT seller_id)
            + COALESCE(max(CASE WHEN seller_id IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) FROM shop_items)""",
)(lambda spark, d: commerce.summary_metrics(*_r(spark, d, "shop_orders", "shop_customers", "shop_items")))

register(
    "orders_by_country",
    role_cte("shop_orders", "shop_customers")
    + """
    SELECT c.country, count(*) AS total_orders
    FROM shop_orders o LEFT JOIN shop_customers c ON o.customer_trx_id = c.customer_trx_id GROUP BY c.country""",
)(lambda spark, d: commerce.orders_by_country(*_r(spark, d, "shop_orders", "shop_customers")))

register(
    "order_month_counts",
    role_cte("shop_orders")
    + """
    SELECT CAST(year(purchase_ts) AS BIGINT) AS year, CAST(month(purchase_ts) AS BIGINT) AS month,
           count(*) AS total_orders
    FROM shop_orders GROUP BY 1, 2""",
)(lambda spark, d: commerce.order_month_counts(role(spark, d, "shop_orders")))

_SCORES = (
    "sc AS (SELECT review_score FROM (SELECT CASE WHEN regexp_full_match(review_score, '\\s*[+-]?[0-9]+\\s*') "
    "THEN TRY_CAST(review_score AS INTEGER) END AS review_score FROM shop_reviews) "
    "WHERE review_score IS NOT NULL AND review_score BETWEEN 1 AND 5)"
)

register(
    "avg_score",
    role_cte("shop_reviews") + f", {_SCORES}\n    SELECT {R('avg(review_score)')} AS avg_score FROM sc",
)(lambda spark, d: commerce.avg_score(role(spark, d, "shop_reviews")))

register(
    "score_distribution",
    role_cte("shop_reviews") + f", {_SCORES}\n    SELECT review_score, count(*) AS count FROM sc GROUP BY review_score",
)(lambda spark, d: commerce.score_distribution(role(spark, d, "shop_reviews")))

REVENUE_YEAR = 1998

register(
    "revenue_by_category",
    role_cte("shop_orders", "shop_items", "shop_products")
    + f"""
    SELECT p.category, CAST(round(sum(i.price + i.freight), 2) AS DOUBLE) AS total_revenue,
           count(o.order_id) AS total_orders
    FROM shop_orders o JOIN shop_items i ON o.order_id = i.order_id JOIN shop_products p ON i.product_id = p.product_id
    WHERE year(o.purchase_ts) = {REVENUE_YEAR} GROUP BY p.category""",
)(
    lambda spark, d: commerce.revenue_by_category(
        *_r(spark, d, "shop_orders", "shop_items", "shop_products"), year=REVENUE_YEAR
    )
)

_DELIVERY = (
    "dl AS (SELECT o.order_id, CAST(datediff('day', CAST(i.shipping_limit_date AS DATE), CAST(o.carrier_date AS DATE)) AS BIGINT) AS diff "
    "FROM shop_orders o JOIN shop_items i ON o.order_id = i.order_id "
    "WHERE o.carrier_date IS NOT NULL AND i.shipping_limit_date IS NOT NULL)"
)

register(
    "delivery_summary",
    role_cte("shop_orders", "shop_items")
    + f""", {_DELIVERY}
    SELECT count(order_id) AS total_orders, {R('sum(diff)::DOUBLE / count(diff)')} AS avg_diff_days,
           min(diff) AS min_diff_days, max(diff) AS max_diff_days,
           CAST(sum(CASE WHEN diff <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS on_time_or_early,
           CAST(sum(CASE WHEN diff > 0 THEN 1 ELSE 0 END) AS BIGINT) AS late_deliveries
    FROM dl""",
)(lambda spark, d: commerce.delivery_summary(*_r(spark, d, "shop_orders", "shop_items")))

register(
    "delivery_classes",
    role_cte("shop_orders", "shop_items")
    + f""", {_DELIVERY}
    SELECT CASE WHEN diff < 0 THEN '{commerce.STATUS_EARLY}' WHEN diff = 0 THEN '{commerce.STATUS_ON_TIME}'
                ELSE '{commerce.STATUS_LATE}' END AS status,
           count(*) AS count, {R('sum(diff)::DOUBLE / count(diff)')} AS avg_diff_days
    FROM dl GROUP BY 1""",
)(lambda spark, d: commerce.delivery_classes(*_r(spark, d, "shop_orders", "shop_items")))

register(
    "seller_ranking",
    role_cte("shop_items")
    + """,
    st AS (SELECT seller_id, round(sum(price + freight), 2) AS rev, count(DISTINCT order_id) AS total_orders
           FROM shop_items GROUP BY seller_id)
    SELECT seller_id, CAST(rev AS DOUBLE) AS total_revenue, total_orders,
           CAST(dense_rank() OVER (ORDER BY rev DESC NULLS LAST) AS BIGINT) AS revenue_rank,
           CAST(dense_rank() OVER (ORDER BY total_orders DESC NULLS LAST) AS BIGINT) AS orders_rank
    FROM st""",
)(lambda spark, d: commerce.seller_ranking(role(spark, d, "shop_items")))

# --------------------------------------------------------------------------
# Sources and sinks (S1-S13): Spark-derived files written to the shared
# checkpoint folder and read back through the library's readers.


def _ratings_epoch(spark, d):
    return ratings.with_epoch_seconds(role(spark, d, "ratings"))


def _junk(spark, d):
    return files.junk_lines(roles.table(spark, d, "events"), role(spark, d, "shop_reviews"))


_RATINGS_EPOCH_SQL = (
    role_cte("ratings")
    + "\n    SELECT user_id, movie_id, rating, CAST(epoch(rated_at) AS BIGINT) AS rated_epoch FROM ratings"
)

register("scan_ratings", _RATINGS_EPOCH_SQL)(
    lambda spark, d: files.scan_ratings(spark, _ratings_epoch(spark, d), _junk(spark, d))
)

register(
    "bad_record_filter",
    role_cte("shop_reviews")
    + """
    SELECT 'unparsable movie_id' AS reject_reason, count(*) AS n_lines FROM events
    UNION ALL SELECT 'too few fields', count(*) FROM shop_reviews
    UNION ALL SELECT 'unparsable rating', count(*) FROM events""",
)(lambda spark, d: files.bad_record_counts(spark, _ratings_epoch(spark, d), _junk(spark, d)))

register("union_sources", _RATINGS_EPOCH_SQL)(
    lambda spark, d: files.union_sources(spark, _ratings_epoch(spark, d), 1998)
)

register(
    "scan_reviews",
    role_cte("reviews")
    + """
    SELECT id, NULLIF(regexp_replace(review, '[;\\r\\n]', ' ', 'g'), '') AS review, NULLIF(topic, '') AS topic,
           NULLIF(aspect, '') AS aspect, NULLIF(sentiment, '') AS sentiment
    FROM reviews""",
)(lambda spark, d: files.scan_reviews(spark, role(spark, d, "reviews")))

register("scan_csv", role_cte("shop_items") + "\n    SELECT * FROM shop_items")(
    lambda spark, d: files.scan_csv(spark, role(spark, d, "shop_items"))
)

register("write_roundtrip", ORACLE["movie_rating_stats"])(
    lambda spark, d: files.tsv_roundtrip(
        spark,
        QUERIES["movie_rating_stats"](spark, d),
        [("movie_id", "bigint"), ("title", "string"), ("avg_rating", "double"), ("n_ratings", "bigint")],
    )
)

register(
    "staged_word_freq",
    role_cte("reviews", "stopwords") + f", {_TOKENS}\n    SELECT word, count(id) AS frequency FROM tok GROUP BY word",
)(lambda spark, d: text_insights.word_freq(files.staged(spark, _tokens(spark, d), "tokens")))

register("stream_movie_rating_stats", ORACLE["movie_rating_stats"])(
    lambda spark, d: files.stream_movie_stats(spark, _ratings_epoch(spark, d), _junk(spark, d), role(spark, d, "movies"))
)

# --------------------------------------------------------------------------
# Report renderings (S12 with A15): detail lines plus a summary line.

register(
    "movie_report_with_best",
    role_cte("ratings", "movies")
    + f""", {_MOVIE_STATE},
    st AS (SELECT ms.movie_id, m.title, ms.rs / ms.n AS a, ms.n FROM ms JOIN {_MT} m ON ms.movie_id = m.movie_id
           WHERE ms.n > 0)
    SELECT title AS key, printf({_MOVIE_LINE}, {F2('a')}, n) AS line FROM st
    UNION ALL
    SELECT '{ratings.BEST_MOVIE_LABEL}' AS key, printf({_BEST_MOVIE_LINE}, title, {F2('a')}, 5) AS line
    FROM (SELECT * FROM st WHERE n >= 5 ORDER BY a DESC NULLS LAST, movie_id ASC LIMIT 1)""",
)(lambda spark, d: ratings.movie_report_with_best(*_r(spark, d, "ratings", "movies")))

register(
    "gender_report_with_gap",
    role_cte("ratings", "users", "movies")
    + f""", {_GENDER_WIDE},
    named AS (SELECT w.*, {_title('MovieID:')} FROM gw w LEFT JOIN {_MT} m ON w.movie_id = m.movie_id)
    SELECT title AS key,
           printf({_GENDER_LINE}, COALESCE({F2('sm / nm')}, '0.00'), nm, COALESCE({F2('sf / nf')}, '0.00'), nf) AS line
    FROM named
    UNION ALL
    SELECT '{ratings.GAP_LABEL}' AS key, printf({_GAP_LINE}, title, {F2('gap')}) AS line
    FROM (SELECT title, movie_id, abs(sm / nm - sf / nf) AS gap FROM named WHERE nm > 0 AND nf > 0
          ORDER BY gap DESC NULLS LAST, movie_id ASC LIMIT 1)""",
)(lambda spark, d: ratings.gender_report_with_gap(*_r(spark, d, "ratings", "users", "movies")))


def _p2(expr: str) -> str:
    return f"printf('%.2f', COALESCE({R(expr)}, 0.0))"


_RAW_BAND_MEANS = ", ".join(
    f"sum(CASE WHEN b = '{x}' THEN rating END) / count(CASE WHEN b = '{x}' THEN rating END) AS a{i}"
    for i, x in enumerate(_AGE_RIGHT, 1)
)

register(
    "age_report_lines",
    role_cte("ratings", "users", "movies")
    + f""",
    rb AS (SELECT r.movie_id, r.rating, u.b AS b FROM ratings r
           JOIN {_UA_RIGHT} u ON r.user_id = u.user_id WHERE r.rating IS NOT NULL),
    w AS (SELECT movie_id, {_RAW_BAND_MEANS} FROM rb GROUP BY movie_id)
    SELECT {_title('MovieID:').replace(' AS title', '')} AS key,
           printf({_AGE_LINE}, {_p2('a1')}, {_p2('a2')}, {_p2('a3')}, {_p2('a4')}) AS line
    FROM w LEFT JOIN {_MT} m ON w.movie_id = m.movie_id""",
)(lambda spark, d: ratings.age_report_lines(*_r(spark, d, "ratings", "users", "movies")))

register(
    "reference_files_movie_stats",
    role_cte("ratings", "movies")
    + f"""
    SELECT CAST(r.movie_id AS VARCHAR) AS movie_id, m.title, {R('sum(r.rating) / count(r.rating)')} AS avg_rating,
           count(r.rating) AS n_ratings
    FROM ratings r JOIN {_MT} m ON r.movie_id = m.movie_id
    GROUP BY r.movie_id, m.title HAVING count(r.rating) > 0""",
)(lambda spark, d: files.reference_files_movie_stats(spark, _ratings_epoch(spark, d), role(spark, d, "movies")))

# --------------------------------------------------------------------------
# More of the reference's own file layouts and their edge cases.

register(
    "genre_rating_trailing_delimiter",
    role_cte("ratings", "movies")
    + f""", {_MOVIE_STATE}, {_GENRES}
    SELECT genre, {R('a')} AS avg_rating, n AS n_ratings FROM gst""",
)(
    lambda spark, d: ratings.genre_rating(
        role(spark, d, "ratings"),
        role(spark, d, "movies").selectExpr("movie_id", "title", "concat(genres, '|', if(movie_id % 2 = 0, '|', '')) AS genres"),
        trailing_empty=False,
    )
)

register(
    "movies_with_commas",
    role_cte("movies")
    + """
    SELECT CAST(movie_id AS VARCHAR) AS movie_id, title, replace(genres, '|', ',') AS genres FROM movies""",
)(lambda spark, d: files.movies_with_commas(spark, role(spark, d, "movies")))

register(
    "scan_csv_inferred",
    role_cte("shop_items")
    + """
    SELECT order_id, product_id, seller_id, CAST(price AS DOUBLE) AS price, CAST(freight AS DOUBLE) AS freight,
           strftime(shipping_limit_date, '%Y-%m-%d') AS shipping_day
    FROM shop_items""",
)(
    lambda spark, d: files.scan_csv_inferred(spark, role(spark, d, "shop_items")).selectExpr(
        "order_id", "product_id", "seller_id", "CAST(price AS DOUBLE) AS price", "CAST(freight AS DOUBLE) AS freight",
        "date_format(shipping_limit_date, 'yyyy-MM-dd') AS shipping_day",
    )
)

register("overwrite_report", ORACLE["aspect_counts"])(
    lambda spark, d: files.overwritten(
        spark, QUERIES["topic_counts"](spark, d), QUERIES["aspect_counts"](spark, d),
        [("aspect", "string"), ("num_comments", "bigint")],
    )
)

register(
    "clean_reviews_with_header",
    role_cte("reviews")
    + f""", {_CLEAN_REVIEWS}
    SELECT CAST(id AS VARCHAR) AS id, aspect, sentiment FROM cr""",
)(lambda spark, d: files.clean_reviews_with_header(spark, role(spark, d, "reviews")))

_TEXT_USERS = role_cte("ratings", "text_users", "movies") + """,
    r AS (SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(movie_id AS VARCHAR) AS movie_id, rating FROM ratings),
    t AS (SELECT CAST(movie_id AS VARCHAR) AS movie_id, max(title) AS title FROM movies GROUP BY ALL)"""


def _from_files(spark, d, others: str):
    columns = {"movies": ("movie_id", "title", "genres"), "text_occupations": ("occupation_id", "occupation")}[others]
    return files.reference_files(
        spark, _ratings_epoch(spark, d), role(spark, d, "text_users"), role(spark, d, others).select(*columns),
        others.replace("text_", ""),
    )


register(
    "reference_files_gender_wide",
    _TEXT_USERS
    + f""",
    g AS (SELECT r.movie_id, sum(CASE WHEN u.gender = 'M' THEN rating END) AS sm, count(CASE WHEN u.gender = 'M' THEN 1 END) AS nm,
                 sum(CASE WHEN u.gender = 'F' THEN rating END) AS sf, count(CASE WHEN u.gender = 'F' THEN 1 END) AS nf
          FROM r JOIN text_users u ON r.user_id = u.user_id GROUP BY r.movie_id)
    SELECT g.movie_id, coalesce(t.title, 'MovieID:' || g.movie_id) AS title,
           coalesce({R('sm / nm')}, 0.0) AS avg_male, nm AS n_male, coalesce({R('sf / nf')}, 0.0) AS avg_female, nf AS n_female
    FROM g LEFT JOIN t ON t.movie_id = g.movie_id""",
)(lambda spark, d: ratings.movie_gender_wide(*_from_files(spark, d, "movies")))

register(
    "reference_files_age_wide",
    _TEXT_USERS
    + f""",
    rb AS (SELECT r.movie_id, rating, {_BAND_RIGHT.format(a='u.age')} AS b
           FROM r JOIN text_users u ON r.user_id = u.user_id WHERE u.age IS NOT NULL),
    w AS (SELECT movie_id, {_BAND_MEANS} FROM rb GROUP BY movie_id)
    SELECT w.movie_id, coalesce(t.title, 'MovieID:' || w.movie_id) AS title, avg_0_18, avg_18_35, avg_35_50, avg_50p
    FROM w LEFT JOIN t ON t.movie_id = w.movie_id""",
)(lambda spark, d: ratings.movie_age_wide(*_from_files(spark, d, "movies")))

register(
    "reference_files_occupation_rating",
    role_cte("ratings", "text_users", "text_occupations")
    + f""",
    pu AS (SELECT CAST(user_id AS VARCHAR) AS user_id, sum(rating) AS rs, count(rating) AS n FROM ratings GROUP BY ALL),
    wo AS (SELECT pu.rs, pu.n, CASE WHEN u.user_id IS NULL THEN '0' ELSE u.occupation_id END AS occupation_id
           FROM pu LEFT JOIN text_users u ON pu.user_id = u.user_id),
    wn AS (SELECT wo.rs, wo.n, coalesce(o.occupation, 'Unknown') AS occupation
           FROM wo LEFT JOIN text_occupations o ON wo.occupation_id = o.occupation_id)
    SELECT occupation, {R('sum(rs) / sum(n)')} AS avg_rating, CAST(sum(n) AS BIGINT) AS n_ratings
    FROM wn GROUP BY occupation""",
)(lambda spark, d: ratings.occupation_rating(*_from_files(spark, d, "text_occupations")))

# --------------------------------------------------------------------------
# Line order, rounding, layouts of written tables, summaries, single passes.

register(
    "movies_listed_again",
    role_cte("ratings", "movies")
    + f""",
    last AS (SELECT movie_id, CASE WHEN movie_id % 2 = 0 THEN '' ELSE 'zz ' END AS mark, title, genres FROM movies)
    SELECT CAST(r.movie_id AS VARCHAR) AS movie_id, m.mark || m.title AS title, m.mark || m.genres AS genres,
           {R('sum(r.rating) / count(r.rating)')} AS avg_rating, count(r.rating) AS n_ratings
    FROM ratings r JOIN last m ON r.movie_id = m.movie_id
    GROUP BY r.movie_id, m.mark, m.title, m.genres HAVING count(r.rating) > 0""",
)(lambda spark, d: files.movies_listed_again(spark, _ratings_epoch(spark, d), role(spark, d, "movies")))


def PY(expr: str) -> str:
    """Oracle-side rounding as Python's `round(x, 2)`: the text of two decimals
    of the exact binary value."""
    return f"CAST(printf('%.2f', {expr}) AS DOUBLE)"


register(
    "movie_rating_stats_python_rounding",
    role_cte("ratings", "movies")
    + f"""
    SELECT r.movie_id, m.title, {PY('sum(r.rating) / count(r.rating)')} AS avg_rating,
           count(r.rating) AS n_ratings
    FROM ratings r JOIN {_MT} m ON r.movie_id = m.movie_id
    GROUP BY r.movie_id, m.title HAVING count(r.rating) > 0""",
)(lambda spark, d: ratings.movie_rating_stats(*_r(spark, d, "ratings", "movies"), rounding="python"))

register(
    "genre_rating_python_rounding",
    role_cte("ratings", "movies")
    + f""", {_MOVIE_STATE}, {_GENRES}
    SELECT genre, {PY('a')} AS avg_rating, n AS n_ratings FROM gst""",
)(lambda spark, d: ratings.genre_rating(*_r(spark, d, "ratings", "movies"), rounding="python"))

# One written layout, two analyses: the gender report's columns beside the age
# report's, per movie.
register(
    "gender_and_age_from_layout",
    role_cte("ratings", "users", "movies")
    + f""", {_GENDER_WIDE},
    rb AS (SELECT r.movie_id, r.rating, u.b AS b FROM ratings r
           JOIN {_UA_RIGHT} u ON r.user_id = u.user_id WHERE r.rating IS NOT NULL),
    aw AS (SELECT movie_id, {_BAND_MEANS} FROM rb GROUP BY movie_id)
    SELECT w.movie_id, {_title('MovieID:')}, COALESCE({R('w.sm / w.nm')}, 0.0) AS avg_male, w.nm AS n_male,
           COALESCE({R('w.sf / w.nf')}, 0.0) AS avg_female, w.nf AS n_female, avg_0_18, avg_18_35, avg_35_50, avg_50p
    FROM gw w JOIN aw ON aw.movie_id = w.movie_id LEFT JOIN {_MT} m ON w.movie_id = m.movie_id""",
)(lambda spark, d: ratings.gender_and_age(*_r(spark, d, "ratings", "users", "movies")))

REVENUE_FROM, REVENUE_TO = "1996-07-01", "1997-04-15"

register(
    "revenue_by_category_between",
    role_cte("shop_orders", "shop_items", "shop_products")
    + f"""
    SELECT p.category, CAST(round(sum(i.price + i.freight), 2) AS DOUBLE) AS total_revenue,
           count(o.order_id) AS total_orders
    FROM shop_orders o JOIN shop_items i ON o.order_id = i.order_id JOIN shop_products p ON i.product_id = p.product_id
    WHERE o.purchase_ts >= DATE '{REVENUE_FROM}' AND o.purchase_ts < DATE '{REVENUE_TO}' GROUP BY p.category""",
)(lambda spark, d: _revenue_between(*_r(spark, d, "shop_orders", "shop_items", "shop_products")))


def _revenue_between(orders, items, products):
    lines = commerce.stage_lines_by_year(orders, items)
    return commerce.revenue_by_category_between(orders, lines, products, REVENUE_FROM, REVENUE_TO)


register("frequent_words_over", ORACLE["word_freq_over"])(
    lambda spark, d: text_insights.frequent_words_over(_tokens(spark, d), 500)
)
register("frequent_topk_words_all", ORACLE["topk_words_all"])(
    lambda spark, d: text_insights.frequent_topk_words(_tokens(spark, d), None, 5, "top_words")
)
register("frequent_topk_words_positive", ORACLE["topk_words_positive"])(
    lambda spark, d: text_insights.frequent_topk_words(_tokens(spark, d), "positive", 5, "top_positive_words")
)

register(
    "distinct_orders",
    role_cte("shop_items")
    + """
    SELECT seller_id, count(DISTINCT order_id) AS total_orders FROM shop_items WHERE seller_id IS NOT NULL GROUP BY seller_id
    UNION ALL SELECT NULL, count(DISTINCT order_id) FROM shop_items""",
)(lambda spark, d: commerce.distinct_orders(role(spark, d, "shop_items")))

register("movie_report_observed", ORACLE["movie_report_with_best"])(
    lambda spark, d: ratings.movie_report_observed(*_r(spark, d, "ratings", "movies"))[0]
)

register(
    "replaced_report",
    role_cte("reviews") + "\n    SELECT topic, 2 * count(id) AS num_comments FROM reviews GROUP BY topic",
)(
    lambda spark, d: files.replaced_by_rename(
        spark, QUERIES["topic_counts"](spark, d), [("topic", "string"), ("num_comments", "bigint")]
    )
)

register(
    "sort_out_ratings",
    role_cte("ratings", "shop_reviews")
    + """
    SELECT 'row' AS kind, user_id, movie_id, rating, CAST(epoch(rated_at) AS BIGINT) AS rated_epoch, NULL::BIGINT AS n_lines
    FROM ratings
    UNION ALL SELECT 'unparsable movie_id', NULL, NULL, NULL, NULL, count(*) FROM events HAVING count(*) > 0
    UNION ALL SELECT 'too few fields', NULL, NULL, NULL, NULL, count(*) FROM shop_reviews HAVING count(*) > 0
    UNION ALL SELECT 'unparsable rating', NULL, NULL, NULL, NULL, count(*) FROM events HAVING count(*) > 0""",
)(lambda spark, d: files.sorted_out(spark, _ratings_epoch(spark, d), _junk(spark, d)))
