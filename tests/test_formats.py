"""The reference's own file layouts read into role columns, analyses end to end."""

from __future__ import annotations

import os
import tempfile

from quarry_test_helpers import rows

from quarry.plans import commerce as C
from quarry.plans import ratings as R
from quarry.plans import text_insights as T
from quarry.sources import formats as X


def folder_with(files: dict[str, str]) -> str:
    base = tempfile.mkdtemp(prefix="quarry-formats-")
    for name, text in files.items():
        with open(os.path.join(base, name), "w", encoding="utf-8") as fh:
            fh.write(text)
    return base


def test_rating_files_end_to_end(spark):
    d = folder_with({
        "ratings_1.txt": "1,101,4.0,1577836800\n2,101,5.0,1577836800\n\n3,102,abc,1\n",
        "ratings_2.txt": " 3 , 102 , 2.0 , 1609459200\n4,103,3.0,1609459200\n2,102\n",
        "movies.txt": "101,Heat (1995),Action|Crime\n102,Up (2009),Animation| Family\n",
        "users.txt": "1,M,25,7,111\n2,F,40,3,222\n3,F,17,7,333\nbad,X\n",
        "occupation.txt": "7,Programmer\n3,Artist\n",
    })
    ratings = X.read_ratings(spark, [f"{d}/ratings_1.txt", f"{d}/ratings_2.txt"])
    movies = X.read_movies(spark, f"{d}/movies.txt")
    users = X.read_users(spark, f"{d}/users.txt")
    occ = X.read_occupations(spark, f"{d}/occupation.txt")
    assert ratings.count() == 4  # blank, non-numeric and short lines skipped; fields trimmed
    assert rows(R.movie_rating_stats(ratings, movies)) == [("101", "Heat (1995)", 4.5, 2), ("102", "Up (2009)", 2.0, 1)]
    assert rows(R.genre_rating(ratings, movies), "genre") == [("Action",), ("Animation",), ("Crime",), ("Family",)]
    assert rows(R.rating_by_year(ratings, "rated_epoch", epoch=True)) == [(2020, 4.5, 2), (2021, 2.5, 2)]
    # users 1 and 3 are programmers, 2 an artist; user 4 is unknown -> id 0 -> no name
    assert rows(R.occupation_rating(ratings, users, occ)) == [("Artist", 5.0, 1), ("Programmer", 3.0, 2),
                                                              ("Unknown", 3.0, 1)]
    long = rows(R.movie_age_long(ratings, users, movies), "movie_id", "age_group", "n_ratings")
    assert ("102", "0 - 18", 1) in long and ("103", "Unknown", 1) in long


def test_review_and_stopword_files(spark):
    d = folder_with({
        "hotel-review.csv": "1;Phong dep, sach!;ROOMS;CLEAN;positive\nx;Gia cao;PRICES;VALUE; Negative \n"
                            "3;;ROOMS;;negative;extra\n",
        "stopwords.txt": "the\nsuch as\n",
    })
    reviews = X.read_reviews(spark, f"{d}/hotel-review.csv")
    assert rows(reviews, "id", "topic", "aspect") == [(1, "ROOMS", "CLEAN"), (3, "ROOMS", None), (None, "PRICES", "VALUE")]
    tokens = T.remove_stopwords(reviews, X.read_stopwords(spark, f"{d}/stopwords.txt"))
    assert rows(tokens, "word") == [("cao",), ("dep",), ("gia",), ("phong",), ("sach",)]
    assert rows(T.topic_counts(reviews)) == [("PRICES", 0), ("ROOMS", 2)]  # a null id is not counted


def test_shop_csv_files(spark):
    d = folder_with({
        "orders.csv": "Order_ID;Customer_Trx_ID;Order_Purchase_Timestamp;Order_Delivered_Carrier_Date\n"
                      "o1;c1;2024-01-03 10:00:00;2024-01-05 09:00:00\no2;c9;2023-12-30 08:00:00;\n",
        "Customer_List.csv": "Customer_Trx_ID;Customer_Country\nc1;Germany\n",
        "order_items.csv": "Order_ID;Product_ID;Seller_ID;Price;Freight_Value;Shipping_Limit_Date\n"
                           "o1;p1;s1;10.50;1.25;2024-01-04 00:00:00\no2;p1;s2;3;0;2024-01-01 00:00:00\n",
        "products.csv": "Product_ID;Product_Category_Name\np1;Toys\n",
        "order_reviews.csv": "Review_ID;Review_Score\nr1;5\nr2;4.5\nr3;\n",
    })
    t = X.read_shop_tables(spark, d)
    assert rows(C.orders_by_country(t["orders"], t["customers"])) == [("Germany", 1), (None, 1)]
    assert rows(C.revenue_by_category(t["orders"], t["items"], t["products"], 2024)) == [("Toys", 11.75, 1)]
    assert rows(C.score_distribution(t["reviews"])) == [(5, 1)]
    assert rows(C.delivery_classes(t["orders"], t["items"])) == [("Giao tre", 1, 1.0)]


def test_users_by_need(spark):
    """Lines without an age, an occupation or both still hold a gender."""
    d = folder_with({"users.txt": "1,F,,7,1\n2,F\n3,M,old,K1,3\n4,M,30,07,4\n5\n"})
    users = X.read_users(spark, f"{d}/users.txt")
    assert rows(users, "user_id", "gender", "age", "occupation_id") == [
        ("1", "F", None, "7"), ("2", "F", None, None), ("3", "M", None, "K1"), ("4", "M", 30, "07")]
    ratings = spark.sql("SELECT CAST(id AS STRING) AS user_id, 'm' AS movie_id, 4.0D AS rating FROM range(1, 6)")
    movies = spark.sql("SELECT 'm' AS movie_id, 'M' AS title, 'g' AS genres")
    wide = R.movie_gender_wide(ratings, users, movies).first()
    assert (wide.n_male, wide.n_female) == (2, 2)
    ages = R.movie_age_wide(ratings, users, movies).first()
    assert (ages.avg_18_35, ages.avg_0_18, ages.avg_35_50) == (4.0, 0.0, 0.0)


def test_text_occupation_ids_stay_apart(spark):
    d = folder_with({"users.txt": "1,F,20,07,1\n2,F,20,7,1\n3,F,20,K1,1\n", "occ.txt": "07,Cook\n7,Pilot\nK1,Guard\n"})
    ratings = spark.sql("SELECT CAST(id AS STRING) AS user_id, 'm' AS movie_id, CAST(id AS DOUBLE) AS rating FROM range(1, 5)")
    got = R.occupation_rating(ratings, X.read_users(spark, f"{d}/users.txt"), X.read_occupations(spark, f"{d}/occ.txt"))
    assert rows(got) == [("Cook", 1.0, 1), ("Guard", 3.0, 1), ("Pilot", 2.0, 1), ("Unknown", 4.0, 1)]
