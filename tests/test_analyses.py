"""Reference semantics of the analyses on hand-made rows."""

from __future__ import annotations

from quarry_test_helpers import rows

from quarry.plans import commerce as C
from quarry.plans import ratings as R
from quarry.plans import text_insights as T

RATINGS = "user_id bigint, movie_id bigint, rating double, rated_at timestamp_ntz"


def ratings_df(spark, data):
    from datetime import datetime

    return spark.createDataFrame([(u, m, r, datetime(2020, 1, 1)) for u, m, r in data], RATINGS)


def movies_df(spark, data):
    return spark.createDataFrame(data, "movie_id bigint, title string, genres string")


def users_df(spark, data):
    return spark.createDataFrame(data, "user_id bigint, gender string, age int, occupation_id int")


def test_movie_stats_inner_vs_default(spark):
    r = ratings_df(spark, [(1, 10, 4.0), (2, 10, 5.0), (1, 11, 3.0)])
    m = movies_df(spark, [(10, "Ten", "A|B")])
    assert rows(R.movie_rating_stats(r, m)) == [(10, "Ten", 4.5, 2)]
    assert rows(R.movie_rating_stats(r, m, missing="default")) == [(10, "Ten", 4.5, 2), (11, "MovieID:11", 3.0, 1)]


def test_best_movie_min_count_ties_and_missing_title(spark):
    data = [(u, 10, 4.0) for u in range(5)] + [(u, 11, 4.0) for u in range(5)] + [(1, 12, 5.0)]
    data += [(u, 13, 5.0) for u in range(5)]
    r = ratings_df(spark, data)
    m = movies_df(spark, [(10, "Ten", "A"), (11, "Eleven", "A")])
    # 13 has the best mean with 5 ratings but no title row: kept with a default title
    assert rows(R.best_movie(r, m)) == [(13, "MovieID:13", 5.0, 5)]
    # ranking titled movies only: 10 and 11 tie, the smaller id wins; 12 has too few ratings
    assert rows(R.best_movie(r, m, missing="drop")) == [(10, "Ten", 4.0, 5)]


def test_genre_rating_counts_once_per_genre_and_trims(spark):
    r = ratings_df(spark, [(1, 10, 4.0), (2, 10, 2.0), (3, 11, 5.0), (4, 99, 1.0)])
    m = movies_df(spark, [(10, "Ten", "Drama| Comedy"), (11, "Eleven", "Drama")])
    got = rows(R.genre_rating(r, m))
    assert got == [("Comedy", 3.0, 2), ("Drama", 3.67, 3)]  # movie 99 has no genres: gone
    assert rows(R.best_genre(r, m)) == [("Drama", 3.67, 3)]
    report = dict(rows(R.genre_report_with_best(r, m)))
    assert report["*** BEST GENRE ***"] == '"Drama" is the highest rated genre with average rating 3.67 over 3 rating(s).'
    assert report["Comedy"] == "Average rating: 3.00 (Total ratings: 2)"


def test_gender_wide_and_long(spark):
    r = ratings_df(spark, [(1, 10, 4.0), (2, 10, 2.0), (3, 10, 5.0), (9, 10, 1.0), (3, 11, 3.0)])
    u = users_df(spark, [(1, "m", 20, 1), (2, " F ", 30, 2), (3, "X", 40, 3)])
    m = movies_df(spark, [(10, "Ten", "A")])
    wide = rows(R.movie_gender_wide(r, u, m))
    # case-insensitive M/F; X counts for neither side but movie 11 still appears; user 9 unknown: dropped
    assert wide == [(10, "Ten", 4.0, 1, 2.0, 1), (11, "MovieID:11", 0.0, 0, 0.0, 0)]
    assert rows(R.biggest_gender_gap(r, u, m)) == [(10, "Ten", 2.0)]
    long = rows(R.movie_gender_long(r, u, m))
    assert (10, "Ten", "Unknown", 1.0, 1) in long and (10, "Ten", "X", 5.0, 1) in long
    assert (11, "MovieID 11", "X", 3.0, 1) in long


def test_age_band_rules_differ_at_edges(spark):
    r = ratings_df(spark, [(1, 10, 4.0), (2, 10, 2.0), (3, 10, 5.0), (4, 10, 3.0)])
    u = users_df(spark, [(1, "M", 18, 1), (2, "F", 35, 1), (3, "M", 50, 1), (4, "F", None, 1)])
    m = movies_df(spark, [(10, "Ten", "A")])
    wide = rows(R.movie_age_wide(r, u, m))
    assert wide == [(10, "Ten", 4.0, 2.0, 5.0, 0.0)]  # upper-inclusive; user 4 (no age) dropped
    long = rows(R.movie_age_long(r, u, m), "age_group", "avg_rating")
    assert long == [("18 - 35", 4.0), ("35 -50", 2.0), ("50+", 5.0), ("Unknown", 3.0)]


def test_occupation_default_chain(spark):
    r = ratings_df(spark, [(1, 10, 4.0), (2, 10, 2.0), (9, 10, 5.0), (3, 10, 1.0)])
    u = users_df(spark, [(1, "M", 20, 7), (2, "F", 30, 0), (3, "F", 30, 8)])
    occ = spark.createDataFrame([(7, "Artist"), (0, "Other")], "occupation_id int, occupation string")
    got = rows(R.occupation_rating(r, u, occ))
    # unknown user 9 -> id 0 -> "Other"; id 8 has no name -> Unknown
    assert got == [("Artist", 4.0, 1), ("Other", 3.5, 2), ("Unknown", 1.0, 1)]


def test_rating_by_year_from_epoch(spark):
    df = spark.createDataFrame([(1, 1, 4.0, 1577836799), (1, 1, 2.0, 1577836800)],
                               "user_id bigint, movie_id bigint, rating double, ts bigint")
    assert rows(R.rating_by_year(df, "ts", epoch=True)) == [(2019, 4.0, 1), (2020, 2.0, 1)]


REVIEWS = "id string, review string, topic string, aspect string, sentiment string"


def test_clean_reviews_and_top_aspect(spark):
    rv = spark.createDataFrame(
        [("id", "header", "t", "aspect", "sentiment"), ("1", "x", "t", "ROOM", " Negative "),
         ("2", "x", "t", "ROOM", "negative"), ("3", "x", "t", "FOOD", "negative"),
         ("4", "x", "t", "FOOD", None), (None, "x", "t", "FOOD", "negative"), ("5", "x", "t", None, "positive")],
        REVIEWS,
    )
    clean = T.clean_reviews(rv)
    assert clean.count() == 3
    assert rows(T.top_aspect(clean, "negative")) == [("ROOM", 2)]
    assert rows(T.top_aspect(clean, "positive")) == []
    both = rows(T.top_aspect_by_sentiment(clean))
    assert both == [("negative", "ROOM", 2)]


def test_tokens_stopwords_and_topk(spark):
    rv = spark.createDataFrame(
        [("1", "The cat, the DOG! 42 cats", "en", "a", "positive"),
         ("2", "cat dog dog", "en", "a", " Positive "),
         ("3", "Le chat", "fr", "b", "positive"),
         ("4", None, "fr", "b", "positive")],
        REVIEWS,
    )
    stop = spark.createDataFrame([("the",), ("le",), ("the",)], "word string")
    tokens = T.remove_stopwords(rv, stop)
    assert rows(tokens, "id", "word") == [("1", "cat"), ("1", "cats"), ("1", "dog"), ("2", "cat"), ("2", "dog"),
                                          ("2", "dog"), ("3", "chat")]
    pos = dict(rows(T.topk_words(tokens, "positive", 2, "top")))
    # ' Positive ' rows are not 'positive': only review 1 and 3 count; ties by word
    assert pos == {"en": "{(cat,1),(cats,1)}", "fr": "{(chat,1)}"}
    allw = dict(rows(T.topk_words(tokens, None, 1, "top")))
    assert allw == {"en": "{(dog,3)}", "fr": "{(chat,1)}"}
    assert rows(T.word_freq_over(tokens, 1), "word") == [("cat",), ("dog",)]


def test_summary_metrics_and_delivery(spark):
    from datetime import datetime

    orders = spark.createDataFrame(
        [(1, 100, datetime(2020, 1, 1), datetime(2020, 1, 5)), (2, None, datetime(2020, 2, 1), None),
         (3, 101, datetime(2021, 2, 1), datetime(2021, 2, 1))],
        "order_id bigint, customer_trx_id bigint, purchase_ts timestamp_ntz, carrier_date timestamp_ntz",
    )
    customers = spark.createDataFrame([(100, "DE"), (None, "FR"), (101, "DE")], "customer_trx_id bigint, country string")
    items = spark.createDataFrame(
        [(1, 5, 1, 10.0, 1.0, datetime(2020, 1, 6)), (1, 6, 2, 2.5, 0.5, datetime(2020, 1, 4)),
         (3, 5, 1, 1.0, 0.0, datetime(2021, 2, 1)), (3, 5, None, 1.0, 0.0, None)],
        "order_id bigint, product_id bigint, seller_id bigint, price double, freight double, "
        "shipping_limit_date timestamp_ntz",
    ).selectExpr("order_id", "product_id", "seller_id", "CAST(price AS DECIMAL(18,2)) AS price",
                 "CAST(freight AS DECIMAL(18,2)) AS freight", "shipping_limit_date")
    metrics = {r.metric: r.value for r in C.summary_metrics(orders, customers, items).collect()}
    assert metrics == {"total_orders": 3, "distinct_customers": 3, "distinct_sellers": 3}
    assert rows(C.orders_by_country(orders, customers)) == [("DE", 2), (None, 1)]
    summary = C.delivery_summary(orders, items).first()
    assert (summary.total_orders, summary.avg_diff_days, summary.min_diff_days, summary.max_diff_days,
            summary.on_time_or_early, summary.late_deliveries) == (3, 0.0, -1, 1, 2, 1)
    classes = rows(C.delivery_classes(orders, items))
    assert classes == [("Dung han", 1, 0.0), ("Giao som", 1, -1.0), ("Giao tre", 1, 1.0)]
    rev = rows(C.revenue_by_category(orders, items, spark.createDataFrame([(5, "X"), (6, "Y")],
                                                                         "product_id bigint, category string"), 2020))
    assert rev == [("X", 11.0, 1), ("Y", 3.0, 1)]
    ranking = rows(C.seller_ranking(items))
    assert ranking == [(1, 12.0, 2, 1, 1), (2, 3.0, 1, 2, 2), (None, 1.0, 1, 3, 2)]


def test_scores_filtering(spark):
    rv = spark.createDataFrame([(1, "5"), (2, "n/a"), (3, "4.6"), (4, "0"), (5, "1"), (6, None), (7, "5")],
                               "review_id bigint, review_score string")
    assert rows(C.score_distribution(rv)) == [(1, 1), (5, 2)]
    assert C.avg_score(rv).first()[0] == 3.67


def test_report_lines(spark):
    data = [(u, 10, 4.0) for u in range(5)] + [(1, 11, 3.0), (2, 11, 5.0), (3, 11, 2.0)]
    r = ratings_df(spark, data)
    m = movies_df(spark, [(10, "Ten", "A"), (11, "Eleven", "B")])
    u = users_df(spark, [(0, "M", 18, 1), (1, "F", 60, 1), (2, "M", 30, 1), (3, "F", 40, 1), (4, "M", 50, 1)])
    movie = dict(rows(R.movie_report_with_best(r, m)))
    assert movie["Eleven"] == "AverageRating: 3.33 (TotalRatings: 3)"
    assert movie["*** BEST MOVIE ***"] == (
        "Ten is the highest rated movie with an average rating of 4.00 among movies with at least 5 ratings."
    )
    gender = dict(rows(R.gender_report_with_gap(r, u, m)))
    assert gender["Eleven"] == "Male_Avg: 5.00 (count: 1), Female_Avg: 2.50 (count: 2)"
    assert gender["*** BIGGEST GENDER GAP ***"] == '"Eleven" gap=2.50'
    age = dict(rows(R.age_report_lines(r, u, m)))
    assert age["Eleven"] == "[0-18: 0.00, 18-35: 5.00, 35-50: 2.00, 50+: 3.00]"


def test_duplicate_lookup_keys_do_not_multiply_ratings(spark):
    r = ratings_df(spark, [(1, 10, 4.0), (2, 10, 2.0), (1, 11, 5.0)])
    m = movies_df(spark, [(10, "A", "X"), (10, "B", "Y"), (11, "C", "X")])
    u = users_df(spark, [(1, "F", 20, 3), (1, "M", 40, 4), (2, "F", 30, 3)])
    occ = spark.createDataFrame([(3, "Artist"), (4, "Nurse"), (4, "Doctor")], "occupation_id int, occupation string")
    # one title per movie (the greatest), counts untouched
    assert rows(R.movie_rating_stats(r, m)) == [(10, "B", 3.0, 2), (11, "C", 5.0, 1)]
    # genres of movie 10 come from one row only (the greatest: "Y")
    assert rows(R.genre_rating(r, m)) == [("X", 5.0, 1), ("Y", 3.0, 2)]
    wide = rows(R.movie_gender_wide(r, u, m), "movie_id", "n_male", "n_female")
    assert wide == [(10, 1, 1), (11, 1, 0)]  # user 1 counted once, as 'M' (the greatest)
    occ_rows = rows(R.occupation_rating(r, u, occ))
    assert sum(n for _, _, n in occ_rows) == 3


def test_best_genre_raw_or_rounded(spark):
    # B: 4.004 (rounds to 4.00), A: 4.0 -> raw picks B, rounded ties and picks A (smaller name)
    data = [(u, 10, 4.0) for u in range(3)] + [(u, 11, 4.0) for u in range(249)] + [(999, 11, 5.0)]
    r = ratings_df(spark, data)
    m = movies_df(spark, [(10, "Ten", "A"), (11, "Eleven", "B")])
    assert rows(R.best_genre(r, m), "genre") == [("B",)]
    assert rows(R.best_genre(r, m, rank_on="rounded"), "genre") == [("A",)]


def test_semantic_parameters(spark):
    r = ratings_df(spark, [(1, 10, 4.0), (2, 10, 2.0), (9, 10, 5.0)])
    u = users_df(spark, [(1, "M", 18, 1), (2, "f", 35, 1)])
    m = movies_df(spark, [(10, "Ten", "A")])
    # unknown user 9 kept in the long form by default, dropped on request
    assert ("Unknown",) in rows(R.movie_gender_long(r, u, m), "gender")
    assert ("Unknown",) not in rows(R.movie_gender_long(r, u, m, missing="drop"), "gender")
    # wide gender with its own value list
    wide = R.movie_gender_wide(r, u, m, genders={"f": "F"})
    assert wide.columns == ["movie_id", "title", "avg_f", "n_f"] and rows(wide, "avg_f") == [(2.0,)]
    # the same ages banded both ways in both shapes
    assert rows(R.movie_age_wide(r, u, m, closed="left"), "avg_0_18", "avg_18_35", "avg_35_50") == [(0.0, 4.0, 2.0)]
    assert rows(R.movie_age_long(r, u, m, closed="right", missing="drop"), "age_group") == [("0-18",), ("18-35",)]
