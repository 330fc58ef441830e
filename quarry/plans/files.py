"""File round trips: the reference reads and writes flat text files; these
analyses write Spark-derived tables in those formats into the shared
checkpoint folder and read them back through the library's readers.

  ratings text  `user_id, movie_id, rating, epoch` lines (comma, padded),
                mixed with lines from other sources that the reader must
                reject (event lines: non-numeric movie field; review-score
                lines: too few fields);
  reviews text  `;`-separated, declared schema, no trimming, empty = null;
  CSV tables    `;` with a header line, declared schema;
  TSV reports   tab-separated, headerless;
  stage         parquet intermediate re-read as a directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path
from quarry.sources.delimited import read_csv_table, read_delimited, read_delimited_rejects, read_terms, sort_out
from quarry.sources.sinks import stage, to_lines, write_csv, write_delimited

RATINGS_SCHEMA = [("user_id", "bigint"), ("movie_id", "bigint"), ("rating", "double"), ("rated_epoch", "bigint")]
REVIEWS_SCHEMA = [("id", "bigint"), ("review", "string"), ("topic", "string"), ("aspect", "string"),
                  ("sentiment", "string")]


def ratings_lines(ratings_epoch: DataFrame) -> DataFrame:
    """Rating lines with a space after each comma (the reader trims)."""
    return to_lines(ratings_epoch.select("user_id", "movie_id", "rating", "rated_epoch"), ", ")


def junk_lines(events: DataFrame, scores: DataFrame) -> DataFrame:
    """Lines from other sources in the same folder: four fields with a
    non-numeric second field, two-field lines, and lines whose rating is a
    number only to a lenient parser (`NaN`, `1e3`, `4d`)."""
    ev = to_lines(events.select("user_id", "event_type", "value", "event_id"), ",")
    sc = to_lines(scores.select("review_id", "review_score"), ",")
    spelled = F.get(F.array(F.lit("NaN"), F.lit("1e3"), F.lit("4d")), F.pmod("event_id", F.lit(3)).cast("int"))
    odd = to_lines(events.select("user_id", "event_id", spelled.alias("rating"), F.lit(0).alias("at")), ",")
    return ev.unionByName(sc).unionByName(odd)


def write_ratings_text(spark: SparkSession, ratings_epoch: DataFrame, junk: DataFrame | None = None) -> str:
    path = scratch_path(spark, "ratings-text")
    lines = ratings_lines(ratings_epoch)
    if junk is not None:
        lines = lines.unionByName(junk)
    lines.write.mode("overwrite").text(path)
    return path


def scan_ratings(spark: SparkSession, ratings_epoch: DataFrame, junk: DataFrame) -> DataFrame:
    """Ratings read back from mixed text: bad lines skipped, fields trimmed."""
    path = write_ratings_text(spark, ratings_epoch, junk)
    return read_delimited(spark, path, RATINGS_SCHEMA, ",", on_bad="drop", trim=True)


def bad_record_counts(spark: SparkSession, ratings_epoch: DataFrame, junk: DataFrame) -> DataFrame:
    """Rejected lines of the mixed ratings text, counted per reason."""
    path = write_ratings_text(spark, ratings_epoch, junk)
    rejects = read_delimited_rejects(spark, path, RATINGS_SCHEMA, ",")
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_lines"))


def union_sources(spark: SparkSession, ratings_epoch: DataFrame, split_year: int) -> DataFrame:
    """Ratings written as two sources (before / from `split_year`), read back
    as one relation from the list of the two folders; either may be empty."""
    path = scratch_path(spark, "ratings-two-sources")
    early = F.year("rated_at") < split_year
    folders = {f"{path}/first": early, f"{path}/second": F.coalesce(~early, F.lit(True))}
    for folder, rows in folders.items():
        ratings_lines(ratings_epoch.where(rows)).write.mode("overwrite").text(folder)
    return read_delimited(spark, list(folders), RATINGS_SCHEMA, ",")


def scan_reviews(spark: SparkSession, reviews: DataFrame) -> DataFrame:
    """Reviews as `;` text (field separators and line breaks inside the
    review blanked), read back with a declared schema: no trimming, an
    empty field is null, an unparsable id is null."""
    flat = reviews.withColumn("review", F.regexp_replace("review", "[;\r\n]", " "))
    path = scratch_path(spark, "reviews-text")
    to_lines(flat.select(*[n for n, _ in REVIEWS_SCHEMA]), ";").write.mode("overwrite").text(path)
    return read_delimited(spark, path, REVIEWS_SCHEMA, ";", on_bad="null", trim=False, empty_as_null=True)


ITEMS_DDL = (
    "order_id BIGINT, product_id BIGINT, seller_id BIGINT, price DECIMAL(18,2), freight DECIMAL(18,2), "
    "shipping_limit_date TIMESTAMP_NTZ"
)


def scan_csv(spark: SparkSession, items: DataFrame) -> DataFrame:
    """Order items as `;` CSV with a header, read back with a declared schema."""
    path = write_csv(items, scratch_path(spark, "items-csv"), sep=";")
    return read_csv_table(spark, path, sep=";", schema=ITEMS_DDL)


def tsv_roundtrip(spark: SparkSession, report: DataFrame, schema) -> DataFrame:
    """A report written as headerless TSV and read back."""
    path = write_delimited(report, scratch_path(spark, "report-tsv"), sep="\t")
    return read_delimited(spark, path, schema, "\t", on_bad="fail", trim=False)


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """`df` materialised as parquet in the shared folder and read back."""
    return stage(df, scratch_path(spark, name))


def stopwords_from_file(spark: SparkSession, stopwords: DataFrame) -> DataFrame:
    """A stopword list written one term per line and read back as a term list."""
    path = scratch_path(spark, "stopwords-text")
    stopwords.select("word").write.mode("overwrite").text(path)
    return read_terms(spark, path)


def stream_movie_stats(spark: SparkSession, ratings_epoch: DataFrame, junk: DataFrame, movies: DataFrame) -> DataFrame:
    """The per-movie report computed incrementally from the ratings text
    folder (catch-up run over every file present), then read back."""
    from quarry.streaming.incremental import movie_state_stream, read_movie_stats, run_movie_stats, text_stream

    source = write_ratings_text(spark, ratings_epoch, junk)
    out = scratch_path(spark, "stream-out")
    query = run_movie_stats(movie_state_stream(text_stream(spark, source, RATINGS_SCHEMA)), out)
    query.awaitTermination()
    return read_movie_stats(spark, out, movies)


def reference_files_movie_stats(spark: SparkSession, ratings_epoch: DataFrame, movies: DataFrame) -> DataFrame:
    """The per-movie report computed the way a user of the reference would:
    ratings and movies written in the reference's own text layouts, read
    back with `quarry.sources.formats` (ids as text), then analysed."""
    from quarry.plans.ratings import movie_rating_stats
    from quarry.sources.formats import read_movies, read_ratings

    ratings_path = write_ratings_text(spark, ratings_epoch)
    movies_path = scratch_path(spark, "movies-text")
    to_lines(movies.select("movie_id", "title", "genres"), ",").write.mode("overwrite").text(movies_path)
    return movie_rating_stats(read_ratings(spark, ratings_path), read_movies(spark, movies_path))


def scan_csv_inferred(spark: SparkSession, items: DataFrame) -> DataFrame:
    """Order items as `;` CSV with a header, read back with inferred types."""
    path = write_csv(items, scratch_path(spark, "items-csv"), sep=";")
    return read_csv_table(spark, path, sep=";")


def overwritten(spark: SparkSession, first: DataFrame, second: DataFrame, schema) -> DataFrame:
    """Two reports written one after the other to the same folder, read once:
    the second one's rows."""
    path = scratch_path(spark, "report-overwritten")
    for report in (first, second):
        write_delimited(report, path, sep="\t")
    return read_delimited(spark, path, schema, "\t", on_bad="fail", trim=False)


def sampled(spark: SparkSession, reviews: DataFrame, stopwords: DataFrame, n: int = 10) -> DataFrame:
    """(n_rows, n_found) of a preview of n token rows. The preview is looked up
    among the tokens of its own reviews only: the reviews are restricted to the
    sampled ids (n at most) before they are split into tokens."""
    from quarry.plans.text_insights import remove_stopwords, sample_check, sample_tokens

    sample = staged(spark, sample_tokens(remove_stopwords(reviews, stopwords), n), "token-sample")
    ids = sample.select(F.col("id").alias("sampled_id")).distinct()
    own = reviews.join(ids, reviews["id"].eqNullSafe(ids["sampled_id"]), "left_semi")
    return sample_check(sample, remove_stopwords(own, stopwords))


def clean_reviews_with_header(spark: SparkSession, reviews: DataFrame) -> DataFrame:
    """Clean reviews of a `;` text that starts with a line of column names and
    whose id is read as text: the header row goes by its value."""
    from quarry.plans.text_insights import clean_reviews
    from quarry.sources.formats import read_reviews

    names = [n for n, _ in REVIEWS_SCHEMA]
    flat = reviews.withColumn("review", F.regexp_replace("review", "[;\r\n]", " "))
    header = spark.createDataFrame([(";".join(names),)], "value string")
    path = scratch_path(spark, "reviews-with-header")
    header.unionByName(to_lines(flat.select(*names), ";")).write.mode("overwrite").text(path)
    return clean_reviews(read_reviews(spark, path, id_type="string"))


def movies_with_commas(spark: SparkSession, movies: DataFrame) -> DataFrame:
    """Movies whose genres hold the field separator, read with a split limit."""
    from quarry.sources.formats import read_movies

    path = scratch_path(spark, "movies-text")
    commas = movies.withColumn("genres", F.regexp_replace("genres", "[|]", ","))
    to_lines(commas.select("movie_id", "title", "genres"), ",").write.mode("overwrite").text(path)
    return read_movies(spark, path, max_fields=3)


def write_users_text(spark: SparkSession, users: DataFrame) -> str:
    """Users in the reference's layout; a user without an occupation is a line
    of two fields, one without an age has that field blank."""
    path = scratch_path(spark, "users-text")
    short = F.col("occupation_id").isNull()
    fields = users.select("user_id", "gender", "age", "occupation_id", F.lit("70000").alias("zip"))
    full = to_lines(fields.where(~short), ",")
    full.unionByName(to_lines(fields.where(short).select("user_id", "gender"), ",")).write.mode("overwrite").text(path)
    return path


def reference_files(
    spark: SparkSession, ratings_epoch: DataFrame, users: DataFrame, others: DataFrame, name: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ratings, users and movies (or occupations) written in the reference's
    text layouts and read back with the library's readers."""
    from quarry.sources.formats import read_movies, read_occupations, read_ratings, read_users

    path = scratch_path(spark, f"{name}-text")
    to_lines(others, ",").write.mode("overwrite").text(path)
    reader = {"movies": read_movies, "occupations": read_occupations}[name]
    return (
        read_ratings(spark, write_ratings_text(spark, ratings_epoch)),
        read_users(spark, write_users_text(spark, users)),
        reader(spark, path),
    )


def movies_listed_again(spark: SparkSession, ratings_epoch: DataFrame, movies: DataFrame) -> DataFrame:
    """Per movie title, genres, mean and count, of movies that are listed up to
    three times: in a first file, and on two lines one after the other in a
    second one (movies of an even id; the others only in the first). All earlier
    spellings are greater as text, so only the lines' order tells which wins."""
    from quarry.plans.ratings import movie_rating_with_genres
    from quarry.sources.formats import read_movies, read_ratings

    def spelled(mark: str):
        return F.concat_ws(",", "movie_id", F.concat(F.lit(mark), "title"), F.concat(F.lit(mark), "genres"))

    path = scratch_path(spark, "movies-listed-again")
    movies.select(spelled("zz ").alias("value")).write.text(f"{path}/first")
    again = movies.where("movie_id % 2 = 0").select(F.explode(F.array(spelled("yy "), spelled(""))).alias("value"))
    again.write.text(f"{path}/second")
    read = read_movies(spark, [f"{path}/first", f"{path}/second"], with_order=True)
    return movie_rating_with_genres(read_ratings(spark, write_ratings_text(spark, ratings_epoch)), read)


def sorted_out(spark: SparkSession, ratings_epoch: DataFrame, junk: DataFrame) -> DataFrame:
    """Rows and reject counts of the mixed ratings text from one parse of it:
    the rows with kind 'row', the counts with the reason as kind."""
    path = write_ratings_text(spark, ratings_epoch, junk)
    good, _, counts = sort_out(spark, path, RATINGS_SCHEMA, ",")
    return good.withColumn("kind", F.lit("row")).unionByName(
        counts.select(F.col("reject_reason").alias("kind"), "n_lines"), allowMissingColumns=True
    )


def replaced_by_rename(spark: SparkSession, report: DataFrame, schema) -> DataFrame:
    """A report that is replaced by one computed from itself: the first is
    written, then its rows with the count doubled take its place, committed by
    rename (the old files are read until the new ones are complete)."""
    path = scratch_path(spark, "report-replaced")
    key, count = [n for n, _ in schema]
    read = lambda: read_delimited(spark, path, schema, "\t", on_bad="fail", trim=False)
    write_delimited(report.select(key, count), path, commit="rename")
    write_delimited(read().withColumn(count, F.col(count) * 2), path, commit="rename")
    return read()
