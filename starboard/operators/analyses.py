"""The analysis catalogue: rating frames in, one lazy frame per analysis out.

Ratings are by far the largest table, so every analysis that needs users or movies
first folds the ratings to one row per user (``user_activity``) or per movie
(``movie_activity``). The fold combines on the map side, which takes the weight off
hot keys, and only its result, at most as long as the profile table, is joined.
Sums and counts are carried along, never averages, so the folds can be added up again.
No function here starts a job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starboard.functions.columns import age_bucket, case, label_rank, percent, ratio, score_bucket

_ADDED = ("n_rows", "rating_count", "rating_sum", "high_count")


def _folded(high: float) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count("rating").alias("rating_count"),
        F.sum("rating").alias("rating_sum"),
        F.count_if(F.col("rating") >= high).alias("high_count"),
    ]


def user_activity(ratings: DataFrame, high: float = 4.0) -> DataFrame:
    """One row per user: how many ratings, their sum, how many at or above ``high``."""
    return ratings.groupBy("user_id").agg(*_folded(high))


def movie_activity(ratings: DataFrame, high: float = 4.0) -> DataFrame:
    """One row per movie, as ``user_activity``."""
    return ratings.groupBy("movie_id").agg(*_folded(high))


def _totals(columns: Sequence[str] = _ADDED) -> list[Column]:
    return [F.sum(name).alias(name) for name in columns]


def _join_kind(scope: str) -> str:
    """Profiles without any rating count only under the scope 'all'."""
    if scope not in ("rated", "all"):
        raise ValueError(f"scope must be 'rated' or 'all', not {scope!r}")
    return "inner" if scope == "rated" else "left"


# Precision of approximate counts: a standard error of about 1.04 / sqrt(2 ** 12), 1.6 per cent.
PRECISION = 12


def distinct_count(column: str, how: str = "exact") -> Column:
    """Number of different values: 'exact', or 'approx' by a sketch of bounded size.

    Exact counts bring every distinct value of a group to one place in two steps; sketches are
    folded on the map side, one per group and task.
    """
    if how == "exact":
        return F.count_distinct(column)
    if how == "approx":
        return F.hll_sketch_estimate(F.hll_sketch_agg(column, F.lit(PRECISION)))
    raise ValueError(f"distinct must be 'exact' or 'approx', not {how!r}")


def average(digits: int) -> Column:
    return ratio("rating_sum", "rating_count", digits)


# ---- scores ----------------------------------------------------------------------------------


def rating_distribution(
    ratings: DataFrame, bucket: str = "trunc", total: int | None = None
) -> DataFrame:
    """Ratings per whole score with their share of all ratings, or of a known total."""
    scores = ratings.groupBy(score_bucket("rating", bucket).alias("score")).agg(
        F.count(F.lit(1)).alias("count")
    )
    whole = F.lit(total) if total is not None else scores.agg(F.sum("count")).scalar()
    return scores.select("score", "count", percent("count", whole).alias("percentage")).orderBy(
        "score"
    )


# ---- movies and genres -----------------------------------------------------------------------


def rank_movies(
    per_movie: DataFrame,
    movies: DataFrame,
    min_count: int = 50,
    k: int = 20,
    by: str = "title",
    order: str = "rounded",
) -> DataFrame:
    if by not in ("title", "movie_id"):
        raise ValueError(f"by must be 'title' or 'movie_id', not {by!r}")
    if order not in ("rounded", "exact"):
        raise ValueError(f"order must be 'rounded' or 'exact', not {order!r}")
    keys = ["title"] if by == "title" else ["movie_id", "title"]
    grouped = (
        per_movie.join(movies.select("movie_id", "title"), "movie_id")
        .groupBy(*keys)
        .agg(*_totals(("n_rows", "rating_count", "rating_sum")))
        .where(F.col("n_rows") >= min_count)
    )
    named = grouped.select(
        *(["movie_id"] if by == "movie_id" else []),
        F.col("title").alias("movie_name"),
        average(2).alias("avg_rating"),
        F.col("n_rows").alias("rating_count"),
        F.try_divide("rating_sum", "rating_count").alias("exact"),
    )
    best = F.desc("avg_rating" if order == "rounded" else "exact")
    ties = [F.desc("rating_count"), F.asc("movie_name")]
    if by == "movie_id":
        ties.append(F.asc("movie_id"))
    return named.orderBy(best, *ties).limit(k).drop("exact")


def top_movies(
    ratings: DataFrame,
    movies: DataFrame,
    min_count: int = 50,
    k: int = 20,
    by: str = "title",
    order: str = "rounded",
) -> DataFrame:
    """Best rated movies with enough ratings. Movies of one title count as one by default."""
    return rank_movies(movie_activity(ratings), movies, min_count, k, by, order)


def summarise_genres(
    per_movie: DataFrame, genres: DataFrame, movie_scope: str = "rated", distinct: str = "exact"
) -> DataFrame:
    joined = genres.select("movie_id", "genre").join(
        per_movie, "movie_id", _join_kind(movie_scope)
    )
    return (
        joined.groupBy("genre")
        .agg(
            distinct_count("movie_id", distinct).alias("movie_count"),
            *_totals(("n_rows", "rating_count", "rating_sum")),
        )
        .where(F.col("n_rows") > 0)
        .select(
            F.col("genre").alias("genre_name"),
            "movie_count",
            average(2).alias("avg_rating"),
            "rating_count",
        )
        .orderBy(F.desc("movie_count"), "genre_name")
    )


def genre_stats(
    ratings: DataFrame, genres: DataFrame, movie_scope: str = "rated", distinct: str = "exact"
) -> DataFrame:
    """Movies, average and ratings per genre; ``movie_scope='all'`` counts unrated movies too."""
    return summarise_genres(movie_activity(ratings), genres, movie_scope, distinct)


def genre_count(genres: DataFrame) -> DataFrame:
    return genres.agg(F.count_distinct("genre").alias("genre_count"))


def movie_counts_all(genres: DataFrame, distinct: str = "exact") -> DataFrame:
    """Movies per genre, rated or not."""
    return genres.groupBy(F.col("genre").alias("genre_name")).agg(
        distinct_count("movie_id", distinct).alias("movie_count")
    )


# ---- users -----------------------------------------------------------------------------------


def profile(users: DataFrame) -> DataFrame:
    """User id with gender, age and occupation, filled in where a column is missing."""
    fills = {"gender": F.lit("?"), "age": F.lit(0), "occupation": F.lit("?")}
    return users.select(
        "user_id",
        *[F.col(name) if name in users.columns else fill.alias(name)
          for name, fill in fills.items()],
    )


def rank_users(per_user: DataFrame, users: DataFrame | None, k: int = 20) -> DataFrame:
    keys = ["user_id", "gender", "age", "occupation"]
    if users is None:
        counted = per_user.select(
            "user_id",
            F.lit("?").alias("gender"),
            F.lit(0).alias("age"),
            F.lit("?").alias("occupation"),
            "n_rows", "rating_count", "rating_sum",
        )
    else:
        # Grouping again merges repeated profile rows; it needs no further shuffle.
        counted = (
            per_user.join(profile(users), "user_id")
            .groupBy(*keys)
            .agg(*_totals(("n_rows", "rating_count", "rating_sum")))
        )
    return (
        counted.select(
            *keys, F.col("n_rows").alias("rating_count"), average(2).alias("avg_rating")
        )
        .orderBy(F.desc("rating_count"), *keys)
        .limit(k)
    )


def active_users(ratings: DataFrame, users: DataFrame | None = None, k: int = 20) -> DataFrame:
    """Users with the most ratings, with their profile if there is a users table."""
    return rank_users(user_activity(ratings), users, k)


def with_age_group(users: DataFrame) -> DataFrame:
    """The users with an ``age_group``, derived from the age where the table has none."""
    if "age_group" in users.columns:
        return users
    return users.withColumn("age_group", age_bucket("age"))


def group_activity(
    per_user: DataFrame, users: DataFrame, key: str, user_scope: str = "rated",
    distinct: str = "exact",
) -> DataFrame:
    """Users and summed activity per value of one profile column, named ``label``."""
    return (
        users.select("user_id", F.col(key).alias("label"))
        .join(per_user, "user_id", _join_kind(user_scope))
        .groupBy("label")
        .agg(distinct_count("user_id", distinct).alias("user_count"), *_totals())
        .where(F.col("n_rows") > 0)
    )


def demographic_rollup(
    per_user: DataFrame,
    users: DataFrame,
    keys: Sequence[str] = ("gender", "age_group", "occupation"),
    user_scope: str = "rated",
    distinct: str = "exact",
) -> DataFrame:
    """``group_activity`` for several profile columns with a single join.

    Rows are (dimension, label, ...). The expansion works on rows already folded per
    user, so it never multiplies the ratings.
    """
    keys = list(keys)
    joined = users.select("user_id", *keys).join(per_user, "user_id", _join_kind(user_scope))
    grouped = joined.groupingSets([[key] for key in keys], *keys).agg(
        F.grouping_id(*keys).alias("absent"),
        distinct_count("user_id", distinct).alias("user_count"),
        *_totals(),
    )
    # In grouping_id the bit of a column is set when the column is not grouped by.
    everything = (1 << len(keys)) - 1
    masks = {key: everything & ~(1 << place) for place, key in enumerate(reversed(keys))}
    dimension = case(*[(F.col("absent") == mask, key) for key, mask in masks.items()])
    label = case(
        *[(F.col("absent") == mask, F.col(key).cast("string")) for key, mask in masks.items()]
    )
    return grouped.where(F.col("n_rows") > 0).select(
        dimension.alias("dimension"), label.alias("label"), "user_count", *_ADDED
    )


def of_dimension(rollup: DataFrame, key: str) -> DataFrame:
    """One dimension of a roll-up, in the shape of ``group_activity``."""
    return rollup.where(F.col("dimension") == key).drop("dimension")


def gender_report(grouped: DataFrame) -> DataFrame:
    return grouped.select(
        F.col("label").alias("gender"),
        "user_count",
        "rating_count",
        average(3).alias("avg_rating"),
        percent("high_count", "n_rows").alias("high_rate_pct"),
    ).orderBy("gender")


def age_group_report(grouped: DataFrame) -> DataFrame:
    return grouped.select(
        F.col("label").alias("age_group"),
        "user_count",
        "rating_count",
        average(3).alias("avg_rating"),
    ).orderBy(label_rank("age_group"), "age_group")


def occupation_report(grouped: DataFrame, k: int | None = 20) -> DataFrame:
    report = grouped.select(
        F.col("label").alias("occupation"),
        "user_count",
        "rating_count",
        average(3).alias("avg_rating"),
        ratio("rating_count", "user_count", 1).alias("rating_per_user"),
    ).orderBy(F.desc("rating_count"), "occupation")
    return report if k is None else report.limit(k)


def gender_comparison(
    ratings: DataFrame, users: DataFrame, high: float = 4.0, user_scope: str = "rated"
) -> DataFrame:
    """Users, ratings, average and the share of high ratings per gender."""
    return gender_report(group_activity(user_activity(ratings, high), users, "gender", user_scope))


def gender_rating_share(
    ratings: DataFrame, users: DataFrame, user_scope: str = "all"
) -> DataFrame:
    """Share of all ratings, also those by unknown users, that each gender contributes.

    Unknown users stay in the join as a group of their own, so the ratings are read once and all
    of them are the sum over the few groups.
    """
    kinds = {"rated": "right", "all": "full"}
    _join_kind(user_scope)
    joined = users.select("user_id", F.col("gender").alias("label"), F.lit(True).alias("known")).join(
        user_activity(ratings), "user_id", kinds[user_scope])
    grouped = joined.groupBy("label", "known").agg(
        F.count_distinct("user_id").alias("user_count"), *_totals())
    whole = grouped.withColumn("whole", F.sum("n_rows").over(Window.partitionBy()))
    return (
        whole.where(F.col("known") & (F.col("n_rows") > 0))
        .select(
            F.col("label").alias("gender"),
            "user_count",
            F.col("n_rows").alias("rating_count"),
            average(3).alias("avg_rating"),
            percent("n_rows", "whole").alias("rating_share_pct"),
        )
        .orderBy("gender")
    )


def age_group_stats(ratings: DataFrame, users: DataFrame, user_scope: str = "rated") -> DataFrame:
    """Users, ratings and average per age group, youngest first."""
    grouped = group_activity(
        user_activity(ratings), with_age_group(users), "age_group", user_scope
    )
    return age_group_report(grouped)


def occupation_stats(
    ratings: DataFrame, users: DataFrame, k: int | None = 20, user_scope: str = "rated"
) -> DataFrame:
    """Users, ratings, average and ratings per user for the busiest occupations."""
    grouped = group_activity(user_activity(ratings), users, "occupation", user_scope)
    return occupation_report(grouped, k)


def age_genre_topk(
    ratings: DataFrame, users: DataFrame, genres: DataFrame, k: int = 3
) -> DataFrame:
    """The genres each age group rates most.

    Ratings are folded to (age group, movie) before they meet the genres, so that the
    join multiplies at most a handful of rows per movie. The join with the users is the
    only one that moves whole ratings; a hot user is split there by the skew join of AQE.
    """
    per_movie = (
        ratings.select("user_id", "movie_id")
        .join(with_age_group(users).select("user_id", "age_group"), "user_id")
        .groupBy("age_group", "movie_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_genre = (
        per_movie.join(genres.select("movie_id", "genre"), "movie_id")
        .groupBy("age_group", "genre")
        .agg(F.sum("n").alias("genre_rating_count"))
    )
    place = Window.partitionBy("age_group").orderBy(F.desc("genre_rating_count"), "genre")
    return (
        per_genre.withColumn("place", F.row_number().over(place))
        .where(F.col("place") <= k)
        .orderBy(label_rank("age_group"), "age_group", "place")
        .select("age_group", "genre", "genre_rating_count")
    )


def group_user_counts(users: DataFrame, key: str, distinct: str = "exact") -> DataFrame:
    """Users per value of a profile column, with or without ratings."""
    return users.groupBy(key).agg(distinct_count("user_id", distinct).alias("user_count"))


# ---- totals ----------------------------------------------------------------------------------


def summarise(
    per_user: DataFrame,
    movies: DataFrame | None = None,
    users: DataFrame | None = None,
    users_from: str = "profiles",
    distinct: str = "exact",
) -> DataFrame:
    if users_from not in ("profiles", "ratings"):
        raise ValueError(f"users_from must be 'profiles' or 'ratings', not {users_from!r}")
    if movies is None:
        total_movies = F.lit(0).cast("bigint")
    else:
        total_movies = movies.agg(distinct_count("movie_id", distinct)).scalar()
    if users is None or users_from == "ratings":
        total_users = F.col("raters")
    else:
        total_users = users.agg(distinct_count("user_id", distinct)).scalar()
    totals = per_user.agg(
        F.count("user_id").alias("raters"), *_totals(("n_rows", "rating_count", "rating_sum"))
    )
    return totals.select(
        total_movies.alias("total_movies"),
        F.coalesce("n_rows", F.lit(0)).alias("total_ratings"),
        total_users.alias("total_users"),
        average(3).alias("avg_rating"),
    )


def dashboard_summary(
    ratings: DataFrame,
    movies: DataFrame | None = None,
    users: DataFrame | None = None,
    users_from: str = "profiles",
    distinct: str = "exact",
) -> DataFrame:
    """Distinct movies and users, number of ratings and their average, in one row.

    Folding the ratings per user first gives the number of raters, the number of
    ratings and the average from a single pass.
    """
    return summarise(user_activity(ratings), movies, users, users_from, distinct)


def summary_from_ratings(ratings: DataFrame, distinct: str = "exact") -> DataFrame:
    """Movies, ratings and users as far as the ratings alone tell.

    Two folds, each reading one column, instead of one pass that would have to expand
    every rating once per distinct count. Approximate counts are one pass.
    """
    if distinct == "approx":
        return ratings.agg(
            distinct_count("movie_id", distinct).alias("movie_count"),
            F.count(F.lit(1)).alias("rating_count"),
            distinct_count("user_id", distinct).alias("user_count"))
    per_user = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows"))
    movie_count = ratings.agg(F.count_distinct("movie_id")).scalar()
    return per_user.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rating_count"),
        F.count("user_id").alias("user_count"),
    ).select(movie_count.alias("movie_count"), "rating_count", "user_count")
