"""Readers for the reference's own input files, returning the role columns
the analyses take (see FIXTURES.md section 1 for the layouts):

  ratings text     UserID,MovieID,Rating,Timestamp           -> read_ratings
  movies text      MovieID,Title,Genres (a|b|c)              -> read_movies
  users text       UserID,Gender,Age,OccupationID,Zip        -> read_users
  occupation text  OccupationID,OccupationName               -> read_occupations
  review text      id;review;topic;aspect;sentiment          -> read_reviews
  stopword list    one term per line                         -> read_stopwords
  shop CSVs        `;` with a header line                    -> read_shop_tables

Ids stay text, as the files hold them (so `007` and `7` are different ids).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.delimited import read_csv_table, read_delimited, read_terms

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def read_ratings(
    spark: SparkSession, paths: str | Sequence[str], on_bad: str = "drop", trim: bool = True
) -> DataFrame:
    """(user_id, movie_id, rating, rated_epoch, rated_at); several files read
    as one relation. A line needs user, movie and a numeric rating; the
    timestamp may be missing. `rated_at` is the UTC wall clock of the epoch."""
    schema = [("user_id", "string"), ("movie_id", "string"), ("rating", "double"), ("rated_epoch", "bigint")]
    df = read_delimited(spark, paths, schema, ",", on_bad, trim, required=["user_id", "movie_id", "rating"])
    return df.withColumn("rated_at", F.expr(f"timestampadd(SECOND, rated_epoch, {_EPOCH_NTZ})"))


def read_movies(
    spark: SparkSession,
    path: str | Sequence[str],
    max_fields: int = -1,
    on_bad: str = "drop",
    trim: bool = True,
    with_order: bool = False,
) -> DataFrame:
    """(movie_id, title, genres). `max_fields=3` keeps everything after the
    second comma in `genres` (a split with a limit); the default splits on
    every comma. Genres may be missing (title-only lines are kept). With
    `with_order` the later of two lines of one movie wins in every analysis,
    for title and genres alike; without it the greater value wins."""
    schema = [("movie_id", "string"), ("title", "string"), ("genres", "string")]
    return read_delimited(spark, path, schema, ",", on_bad, trim, required=["movie_id", "title"],
                          max_fields=max_fields, with_order=with_order)


def read_users(
    spark: SparkSession,
    path: str | Sequence[str],
    on_bad: str = "drop",
    trim: bool = True,
    required: Sequence[str] = ("user_id", "gender"),
    with_order: bool = False,
) -> DataFrame:
    """(user_id, gender, age, occupation_id, zip). A line needs the `required`
    fields: user and gender, unless an analysis needs more. A missing or
    unparsable age is null, and the age analyses leave those users out. With
    `with_order` the later of two lines of one user wins."""
    schema = [("user_id", "string"), ("gender", "string"), ("age", "int"), ("occupation_id", "string"),
              ("zip", "string")]
    return read_delimited(spark, path, schema, ",", on_bad, trim, required=required, with_order=with_order)


def read_occupations(
    spark: SparkSession,
    path: str | Sequence[str],
    trim: bool = True,
    on_bad: str = "drop",
    with_order: bool = False,
) -> DataFrame:
    """(occupation_id, occupation); `with_order` as in `read_users`."""
    schema = [("occupation_id", "string"), ("occupation", "string")]
    return read_delimited(spark, path, schema, ",", on_bad, trim, with_order=with_order)


def read_reviews(
    spark: SparkSession, path: str | Sequence[str], on_bad: str = "null", id_type: str = "int"
) -> DataFrame:
    """(id, review, topic, aspect, sentiment) from `;` text with a declared
    schema: fields untrimmed, an empty field is null, an id that is not a
    number is null (the row stays), extra fields are ignored. With
    `id_type='string'` the id is taken as written."""
    schema = [("id", id_type), ("review", "string"), ("topic", "string"), ("aspect", "string"),
              ("sentiment", "string")]
    return read_delimited(spark, path, schema, ";", on_bad=on_bad, trim=False, empty_as_null=True)


def read_stopwords(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(word): one term per line, taken as written."""
    return read_terms(spark, path, "word")


# Column names of the shop files (as their header lines spell them).
SHOP_FILES = {
    "orders": ("orders.csv", {"Order_ID": "order_id", "Customer_Trx_ID": "customer_trx_id",
                              "Order_Purchase_Timestamp": "purchase_ts",
                              "Order_Delivered_Carrier_Date": "carrier_date"}),
    "customers": ("Customer_List.csv", {"Customer_Trx_ID": "customer_trx_id", "Customer_Country": "country"}),
    "items": ("order_items.csv", {"Order_ID": "order_id", "Product_ID": "product_id", "Seller_ID": "seller_id",
                                  "Price": "price", "Freight_Value": "freight",
                                  "Shipping_Limit_Date": "shipping_limit_date"}),
    "products": ("products.csv", {"Product_ID": "product_id", "Product_Category_Name": "category"}),
    "reviews": ("order_reviews.csv", {"Review_Score": "review_score"}),
}


def read_shop_tables(spark: SparkSession, folder: str, sep: str = ";") -> dict[str, DataFrame]:
    """The five shop tables from `;` CSVs with header lines, renamed to the
    role columns. Money is read as DECIMAL(18,2) (exact sums), timestamps as
    timestamp_ntz, the review score as text (it is parsed by the analysis).
    Only the used columns are typed; the header decides their position."""
    types = {"price": "decimal(18,2)", "freight": "decimal(18,2)", "purchase_ts": "timestamp_ntz",
             "carrier_date": "timestamp_ntz", "shipping_limit_date": "timestamp_ntz"}
    out = {}
    for role, (name, columns) in SHOP_FILES.items():
        raw = read_csv_table(spark, f"{folder.rstrip('/')}/{name}", sep=sep, infer=False)
        picked = []
        for src, dst in columns.items():
            col = F.col(f"`{src}`")
            picked.append((col.try_cast(types[dst]) if dst in types else col).alias(dst))
        out[role] = raw.select(*picked)
    return out
