"""Rating analyses: per movie, genre, gender, age band, occupation, year.

Input roles (column names):
  ratings(user_id, movie_id, rating, rated_at)
  movies(movie_id, title, genres)            genres: 'a|b|c'
  users(user_id, gender, age, occupation_id)
  occupations(occupation_id, occupation)

Lookups never multiply facts: every lookup projection is reduced to one row
per key first (`unique_lookup`; among duplicates the greatest value wins,
deterministically), as a per-key dictionary or a reducer holding one value
per key would; where the reader carries the lines' places, the later line wins).
The de-duplicated lookup is hash-partitioned on the join key, so a sort-merge
join reuses it without another shuffle.

Plan shape: where the grouping key determines the lookup key, ratings are
reduced to (sum, count) per lookup key *before* the join (per movie for
titles and genres, per user for occupations), so the join and the second
shuffle see one row per key instead of one row per rating, and a hot key is
absorbed by the partial aggregate. Gender and age need the user's attribute
per rating, so ratings are joined to users first (sort-merge join on
user_id, split by adaptive skew handling when one user is hot; broadcast
only when users is under the size threshold).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from quarry.functions.scalar import (
    AGE_LABELS_LEFT,
    AGE_LABELS_RIGHT,
    age_band,
    epoch_utc_year,
    fmt2,
    java_trim,
    pad_right,
    round_half_up,
    split_list,
    to_epoch_seconds,
)
from quarry.operators.agg import (
    best_of,
    biggest_gap,
    finish_mean,
    mean_count,
    mean_count_wide,
    merge_sum_count,
    sum_count,
    with_summary_row,
)
from quarry.operators.lookup import JoinLayout, attach, place_of, skew_safe_lookup, stage_for_join, unique_lookup
from quarry.sources.sinks import format_report, stage_observed

# ---------------------------------------------------------------------------
# Report texts and default labels as the reference prints them.
BEST_GENRE_LABEL = "*** BEST GENRE ***"
GENRE_LINE = "Average rating: %.2f (Total ratings: %d)"
BEST_GENRE_LINE = '"%s" is the highest rated genre with average rating %.2f over %d rating(s).'
MOVIE_LINE = "AverageRating: %s (TotalRatings: %d)"
BEST_MOVIE_LABEL = "*** BEST MOVIE ***"
BEST_MOVIE_LINE = "%s is the highest rated movie with an average rating of %.2f among movies with at least %d ratings."
GENDER_LINE = "Male_Avg: %.2f (count: %d), Female_Avg: %.2f (count: %d)"
GAP_LABEL = "*** BIGGEST GENDER GAP ***"
GAP_LINE = '"%s" gap=%.2f'
AGE_LINE = "[0-18: %.2f, 18-35: %.2f, 35-50: %.2f, 50+: %.2f]"
UNKNOWN_GROUP = "Unknown"
# ---------------------------------------------------------------------------

GENDERS = {"male": "M", "female": "F"}
AGE_SUFFIXES = ("0_18", "18_35", "35_50", "50p")
AGE_BANDS_RIGHT = dict(zip(AGE_SUFFIXES, AGE_LABELS_RIGHT))
AGE_BANDS_LEFT = dict(zip(AGE_SUFFIXES, AGE_LABELS_LEFT))


def _movie_id_title(prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.col("movie_id").cast("string"))


def _titles(movies: DataFrame) -> DataFrame:
    return unique_lookup(movies.select("movie_id", "title", *place_of(movies)), "movie_id")


def movie_state(ratings: DataFrame) -> DataFrame:
    """(movie_id, rating_sum, n_ratings) over parsed ratings."""
    return sum_count(ratings, "movie_id", "rating", "rating_sum", "n_ratings")


def movie_rating_stats(
    ratings: DataFrame,
    movies: DataFrame,
    digits: int = 2,
    missing: str = "drop",
    default_title: Column | str | None = None,
    rounding: str = "half_up",
) -> DataFrame:
    """Mean rating and count per movie with its title.

    missing='drop': movies without a title row are left out (inner join);
    missing='default': they keep `default_title` (default 'MovieID:<id>')."""
    state = movie_state(ratings).filter(F.col("n_ratings") > 0)
    if default_title is None:
        default_title = _movie_id_title("MovieID:")
    named = attach(state, _titles(movies), "movie_id", missing, {"title": default_title})
    return finish_mean(named, "rating_sum", "n_ratings", digits, rounding=rounding).select(
        "movie_id", "title", "avg_rating", "n_ratings"
    )


def best_movie(
    ratings: DataFrame,
    movies: DataFrame,
    min_count: int = 5,
    digits: int = 2,
    missing: str = "default",
    default_title: Column | str | None = None,
    rank_on: str = "raw",
    rounding: str = "half_up",
) -> DataFrame:
    """The movie with the highest mean among movies with >= min_count
    ratings; ties go to the smallest movie_id. The title is looked up after
    the winner is found (one row joined, not every rating).

    missing='default' keeps a winner without a title row (title from
    `default_title`, default 'MovieID:<id>'); 'drop' ranks only titled movies.
    rank_on='raw' compares unrounded means, 'rounded' the printed ones."""
    state = movie_state(ratings).filter(F.col("n_ratings") >= min_count)
    stats = finish_mean(state, "rating_sum", "n_ratings", digits, raw_name="avg_raw", rounding=rounding)
    if default_title is None:
        default_title = _movie_id_title("MovieID:")
    if missing == "drop":
        stats = stats.join(movies.select("movie_id"), "movie_id", "left_semi")
    key = "avg_raw" if rank_on == "raw" else "avg_rating"
    top = best_of(stats, key, tie="movie_id")
    named = attach(top, _titles(movies), "movie_id", "default", {"title": default_title})
    return named.select("movie_id", "title", "avg_rating", "n_ratings")


def genre_rating(
    ratings: DataFrame,
    movies: DataFrame,
    digits: int = 2,
    trim: bool = True,
    raw_name: str | None = None,
    order: bool = True,
    trailing_empty: bool = True,
    rounding: str = "half_up",
) -> DataFrame:
    """Mean rating and count per genre, best first; a rating counts once for
    every genre of its movie. Ratings of movies without a genre row
    disappear. `trailing_empty` says whether `A|B|` holds a last, empty genre."""
    state = movie_state(ratings)
    genres = unique_lookup(movies.select("movie_id", "genres", *place_of(movies)), "movie_id").select(
        "movie_id", split_list("genres", "|", trim, trailing_empty).alias("genre_list")
    )
    joined = state.join(genres, "movie_id", "inner")
    exploded = joined.select(F.explode("genre_list").alias("genre"), "rating_sum", "n_ratings")
    merged = merge_sum_count(exploded, "genre", "rating_sum", "n_ratings").filter(F.col("n_ratings") > 0)
    out = finish_mean(merged, "rating_sum", "n_ratings", digits, raw_name=raw_name, rounding=rounding)
    out = out.select("genre", "avg_rating", "n_ratings", *([raw_name] if raw_name else []))
    return out.orderBy(F.desc("avg_rating"), "genre") if order else out


def movie_rating_with_genres(ratings: DataFrame, movies: DataFrame, digits: int = 2) -> DataFrame:
    """(movie_id, title, genres, avg_rating, n_ratings): the per-movie report with
    the whole lookup row, title and genres of one line."""
    lookup = unique_lookup(movies.select("movie_id", "title", "genres", *place_of(movies)), "movie_id")
    named = attach(movie_state(ratings).filter(F.col("n_ratings") > 0), lookup, "movie_id", "drop")
    out = finish_mean(named, "rating_sum", "n_ratings", digits)
    return out.select("movie_id", "title", "genres", "avg_rating", "n_ratings")


def best_genre(
    ratings: DataFrame, movies: DataFrame, digits: int = 2, rank_on: str = "raw", trailing_empty: bool = True
) -> DataFrame:
    """Genre with the highest mean; ties to the smallest name. rank_on='raw'
    compares unrounded means, 'rounded' the means rounded to `digits` (two
    genres equal after rounding then tie)."""
    stats = genre_rating(ratings, movies, digits, raw_name="avg_raw", order=False, trailing_empty=trailing_empty)
    key = "avg_raw" if rank_on == "raw" else "avg_rating"
    return best_of(stats, key, tie="genre").select("genre", "avg_rating", "n_ratings")


def genre_report_with_best(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Report lines (key, line): one per genre plus the best-genre line."""
    stats = genre_rating(ratings, movies, digits=2, raw_name="avg_raw", order=False)
    detail = stats.select(
        F.col("genre").alias("key"),
        F.format_string(GENRE_LINE, F.col("avg_raw"), F.col("n_ratings")).alias("line"),
    )
    best = best_of(stats, "avg_raw", tie="genre").select(
        F.lit(BEST_GENRE_LABEL).alias("key"),
        F.format_string(BEST_GENRE_LINE, F.col("genre"), F.col("avg_raw"), F.col("n_ratings")).alias("line"),
    )
    return with_summary_row(detail, best)


def movie_report_lines(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """(title, line) rendered like the per-movie report."""
    stats = movie_rating_stats(ratings, movies)
    return stats.select(
        "title", F.format_string(MOVIE_LINE, fmt2("avg_rating"), F.col("n_ratings")).alias("line")
    )


def occupation_report_lines(
    ratings: DataFrame, users: DataFrame, occupations: DataFrame, widths: tuple[int, int] = (20, 12)
) -> DataFrame:
    """Fixed-width report lines: occupation left-justified in 20 columns,
    mean with two decimals in 12, then the count (fields are never cut)."""
    stats = occupation_rating(ratings, users, occupations)
    line = F.concat(
        F.lit("  "), pad_right("occupation", widths[0]), F.lit(" "),
        pad_right(fmt2("avg_rating"), widths[1]), F.lit(" "), F.col("n_ratings").cast("string"),
    )
    return stats.select("occupation", line.alias("line"))


def movie_report_with_best(ratings: DataFrame, movies: DataFrame, min_count: int = 5) -> DataFrame:
    """(key, line): one line per titled movie, then the best-movie line
    (highest unrounded mean among titled movies with >= min_count ratings)."""
    state = movie_state(ratings).filter(F.col("n_ratings") > 0)
    named = attach(state, _titles(movies), "movie_id", "drop")
    stats = finish_mean(named, "rating_sum", "n_ratings", 2, raw_name="avg_raw")
    detail = stats.select("title", fmt2("avg_rating").alias("avg_text"), "n_ratings")
    detail = format_report(detail, "title", MOVIE_LINE, ["avg_text", "n_ratings"])
    best = best_of(stats, "avg_raw", tie="movie_id", min_count=min_count, count_col="n_ratings")
    best = best.select(F.lit(BEST_MOVIE_LABEL).alias("label"), "title", "avg_raw", F.lit(min_count).alias("k"))
    return with_summary_row(detail, format_report(best, "label", BEST_MOVIE_LINE, ["title", "avg_raw", "k"]))


def movie_report_observed(ratings: DataFrame, movies: DataFrame, min_count: int = 5) -> tuple[DataFrame, Row]:
    """`movie_report_with_best` from one pass: the per-movie table is written
    once, and the number of movies, of ratings and the best movie are metrics of
    that job. Returns the report lines and the metrics row (`n_movies`,
    `n_ratings`, `best`: null without a movie of `min_count` ratings)."""
    state = movie_state(ratings).filter(F.col("n_ratings") > 0)
    named = attach(state, _titles(movies), "movie_id", "drop")
    stats = finish_mean(named, "rating_sum", "n_ratings", 2, raw_name="avg_raw")
    stats = stats.select("movie_id", "title", "avg_raw", "avg_rating", "n_ratings")
    # the least struct has the highest mean, then the smallest movie
    ranked = F.struct((-F.col("avg_raw")).alias("minus"), "movie_id", "title", "avg_raw")
    counts = (F.col("n_ratings") >= min_count) & ~F.isnan("avg_raw")
    metrics = {
        "n_movies": F.count(F.lit(1)),
        "n_ratings": F.sum("n_ratings"),
        "best": F.min(F.when(counts, ranked)),
    }
    written, seen = stage_observed(stats, metrics, "movie-report")
    detail = written.select("title", fmt2("avg_rating").alias("avg_text"), "n_ratings")
    detail = format_report(detail, "title", MOVIE_LINE, ["avg_text", "n_ratings"])
    best = [(BEST_MOVIE_LABEL, seen.best.title, seen.best.avg_raw, min_count)] if seen.best else []
    summary = ratings.sparkSession.createDataFrame(best, "label string, title string, avg_raw double, k int")
    return with_summary_row(detail, format_report(summary, "label", BEST_MOVIE_LINE, ["title", "avg_raw", "k"])), seen


def gender_report_with_gap(ratings: DataFrame, users: DataFrame, movies: DataFrame) -> DataFrame:
    """(key, line): male / female means and counts per movie, then the
    biggest-gap line."""
    wide = movie_gender_wide(ratings, users, movies, raw=True)
    raw = {"m": F.coalesce(F.col("raw_avg_male"), F.lit(0.0)), "f": F.coalesce(F.col("raw_avg_female"), F.lit(0.0))}
    lines = wide.select("title", raw["m"].alias("m"), "n_male", raw["f"].alias("f"), "n_female")
    detail = format_report(lines, "title", GENDER_LINE, ["m", "n_male", "f", "n_female"])
    top = biggest_gap(wide, "raw_avg_male", "raw_avg_female", "n_male", "n_female", tie="movie_id", out="raw_gap")
    gap = format_report(top.select(F.lit(GAP_LABEL).alias("label"), "title", "raw_gap"), "label", GAP_LINE,
                        ["title", "raw_gap"])
    return with_summary_row(detail, gap)


def age_report_lines(ratings: DataFrame, users: DataFrame, movies: DataFrame) -> DataFrame:
    """(key, line): the four upper-inclusive age-band means per movie."""
    wide = movie_age_wide(ratings, users, movies)
    return format_report(wide, "title", AGE_LINE, [f"avg_{s}" for s in AGE_SUFFIXES])


def stage_ratings_with_users(
    ratings: DataFrame, users: DataFrame, buckets: int | None = None, salts: int = 8
) -> JoinLayout:
    """Ratings and users written once in one join layout, for the gender and age
    analyses (`layout=`); each of them then joins without a shuffle. Users are
    one row each there, the one `unique_lookup` keeps of all their columns."""
    rated = ratings.where(F.col("rating").isNotNull()).select("user_id", "movie_id", "rating")
    return stage_for_join(rated, users, "user_id", buckets, salts)


def _rated_with(
    ratings: DataFrame | None,
    users: DataFrame | None,
    attr: Column,
    name: str,
    missing: str,
    layout: JoinLayout | None = None,
    known: Column | None = None,
) -> DataFrame:
    """Ratings with one attribute of their user; `known` says which users count."""
    if layout is not None:
        kept = layout if known is None else JoinLayout(layout.facts, layout.lookup.where(known), layout.on)
        return kept.attach({name: attr}, missing, {name: F.lit(UNKNOWN_GROUP)})
    if known is not None:
        users = users.where(known)
    # Ratings are joined to users row by row, so a user holding a large share
    # of all ratings is a hot key here: the written lookup gives the join
    # plain shuffles that adaptive execution can split.
    lookup = skew_safe_lookup(users.select("user_id", attr.alias(name), *place_of(users)), "user_id")
    rated = ratings.filter(F.col("rating").isNotNull())
    return attach(rated, lookup, "user_id", missing, {name: F.lit(UNKNOWN_GROUP)})


def movie_gender_wide(
    ratings: DataFrame | None,
    users: DataFrame | None,
    movies: DataFrame,
    digits: int = 2,
    raw: bool = False,
    missing: str = "drop",
    genders: dict[str, str] | None = None,
    layout: JoinLayout | None = None,
    rounding: str = "half_up",
) -> DataFrame:
    """Per movie: male and female mean and count side by side (0.0 when a
    side is empty). Ratings of unknown users are dropped (missing='drop') or
    count for neither side (missing='default'); genders other than the
    listed ones (compared case-insensitively, default M/F) count for neither
    side but the movie still appears. `genders` maps a column suffix to a
    gender value; the output columns then follow those suffixes. With `layout`
    (see `stage_ratings_with_users`) ratings and users are read from there."""
    genders = genders or GENDERS
    rated = _rated_with(ratings, users, F.upper(java_trim("gender")), "gender", missing, layout)
    wide = mean_count_wide(rated, "movie_id", "gender", "rating",
                           {k: v.upper() for k, v in genders.items()}, digits, 0.0, raw=raw, rounding=rounding)
    named = attach(wide, _titles(movies), "movie_id", "default", {"title": _movie_id_title("MovieID:")})
    pairs = [c for g in genders for c in (f"avg_{g}", f"n_{g}")]
    extra = [f"raw_avg_{g}" for g in genders] if raw else []
    return named.select("movie_id", "title", *pairs, *extra)


def biggest_gender_gap(ratings: DataFrame, users: DataFrame, movies: DataFrame, digits: int = 2) -> DataFrame:
    """The movie with the largest |male mean - female mean| among movies
    rated by both; ties to the smallest movie_id."""
    wide = movie_gender_wide(ratings, users, movies, digits, raw=True)
    top = biggest_gap(wide, "raw_avg_male", "raw_avg_female", "n_male", "n_female", tie="movie_id", out="raw_gap")
    return top.select("movie_id", "title", round_half_up("raw_gap", digits).alias("gap"))


def movie_gender_long(
    ratings: DataFrame,
    users: DataFrame,
    movies: DataFrame,
    digits: int = 2,
    missing: str = "default",
    rounding: str = "half_up",
) -> DataFrame:
    """One row per (movie, gender) with mean and count, ordered by movie id
    (as text) and gender; ratings of unknown users form the group 'Unknown'
    (missing='default') or are dropped (missing='drop'); any gender value is
    its own group."""
    rated = _rated_with(ratings, users, F.col("gender"), "gender", missing)
    stats = mean_count(rated, ["movie_id", "gender"], "rating", digits, rounding=rounding)
    named = attach(stats, _titles(movies), "movie_id", "default", {"title": _movie_id_title("MovieID ")})
    out = named.select("movie_id", "title", "gender", "avg_rating", "n_ratings")
    return out.orderBy(F.col("movie_id").cast("string"), "gender")


def movie_age_wide(
    ratings: DataFrame | None,
    users: DataFrame | None,
    movies: DataFrame,
    digits: int = 2,
    closed: str = "right",
    missing: str = "drop",
    layout: JoinLayout | None = None,
    rounding: str = "half_up",
) -> DataFrame:
    """Per movie: mean rating in each age band (0.0 when empty); bands are
    upper-inclusive (closed='right') or lower-inclusive ('left'). Users
    without a usable age are left out of the lookup; ratings of users not in
    it are dropped (missing='drop') or count for no band ('default'). With
    `layout` ratings and users are read from there."""
    bands = AGE_BANDS_RIGHT if closed == "right" else AGE_BANDS_LEFT
    with_age = F.col("age").isNotNull()
    rated = _rated_with(ratings, users, age_band("age", closed), "age_group", missing, layout, with_age)
    wide = mean_count_wide(
        rated, "movie_id", "age_group", "rating", bands, digits, 0.0, with_counts=False, rounding=rounding
    )
    named = attach(wide, _titles(movies), "movie_id", "default", {"title": _movie_id_title("MovieID:")})
    return named.select("movie_id", "title", *[f"avg_{s}" for s in AGE_SUFFIXES])


def gender_and_age(ratings: DataFrame, users: DataFrame, movies: DataFrame) -> DataFrame:
    """Per movie the wide gender means and the wide age-band means side by side
    (movies that have both), from one written layout of ratings and users."""
    layout = stage_ratings_with_users(ratings, users)
    by_gender = movie_gender_wide(None, None, movies, layout=layout)
    by_age = movie_age_wide(None, None, movies, layout=layout).drop("title")
    return by_gender.join(by_age, "movie_id")


def movie_age_long(
    ratings: DataFrame,
    users: DataFrame,
    movies: DataFrame,
    digits: int = 2,
    closed: str = "left",
    missing: str = "default",
    rounding: str = "half_up",
) -> DataFrame:
    """One row per (movie, age band), bands lower-inclusive (closed='left')
    or upper-inclusive ('right'); unknown users (and users without an age)
    form the group 'Unknown' (missing='default') or are dropped ('drop')."""
    band = F.coalesce(age_band("age", closed), F.lit(UNKNOWN_GROUP))
    rated = _rated_with(ratings, users, band, "age_group", missing)
    stats = mean_count(rated, ["movie_id", "age_group"], "rating", digits, rounding=rounding)
    named = attach(stats, _titles(movies), "movie_id", "default", {"title": _movie_id_title("MovieID ")})
    out = named.select("movie_id", "title", "age_group", "avg_rating", "n_ratings")
    return out.orderBy(F.col("movie_id").cast("string"), "age_group")


def age_bands(users: DataFrame) -> DataFrame:
    """Both banding rules side by side, with the number of users per age."""
    return (
        users.groupBy("age")
        .agg(F.count(F.lit(1)).alias("n_users"))
        .select(
            "age",
            age_band("age", "right").alias("band_upper_inclusive"),
            age_band("age", "left").alias("band_lower_inclusive"),
            "n_users",
        )
    )


def occupation_rating(
    ratings: DataFrame,
    users: DataFrame,
    occupations: DataFrame,
    digits: int = 2,
    default_occupation_id: object = 0,
    rounding: str = "half_up",
) -> DataFrame:
    """Mean and count per occupation name, best first. A rating whose user is unknown
    gets occupation id `default_occupation_id`, which is then looked up like
    any id; an id without a name gives 'Unknown'. Ratings are reduced per
    user before the two lookups."""
    per_user = sum_count(ratings, "user_id", "rating", "rating_sum", "n_ratings")
    with_occ = attach(
        per_user, unique_lookup(users.select("user_id", "occupation_id", *place_of(users)), "user_id"), "user_id", "default",
        {"occupation_id": default_occupation_id},
    )
    names = unique_lookup(occupations.select("occupation_id", "occupation", *place_of(occupations)), "occupation_id")
    named = attach(with_occ, names, "occupation_id", "default", {"occupation": UNKNOWN_GROUP})
    merged = merge_sum_count(named, "occupation", "rating_sum", "n_ratings").filter(F.col("n_ratings") > 0)
    out = finish_mean(merged, "rating_sum", "n_ratings", digits, rounding=rounding)
    out = out.select("occupation", "avg_rating", "n_ratings")
    return out.orderBy(F.desc("avg_rating"), "occupation")


def rating_by_year(
    ratings: DataFrame,
    ts_col: str = "rated_at",
    epoch: bool = False,
    digits: int = 2,
    rounding: str = "half_up",
) -> DataFrame:
    """Mean and count per calendar year (UTC) of the rating time; `epoch`
    says the column holds Unix seconds."""
    year = epoch_utc_year(ts_col) if epoch else F.year(F.col(ts_col)).cast("bigint")
    return mean_count(ratings.withColumn("year", year), "year", "rating", digits, rounding=rounding).orderBy("year")


def with_epoch_seconds(ratings: DataFrame, ts_col: str = "rated_at", out: str = "rated_epoch") -> DataFrame:
    """Ratings carrying the rating time as Unix seconds (the text-file form)."""
    return ratings.withColumn(out, to_epoch_seconds(ts_col))
