"""Approximate distinct counts against exact ones."""

import pytest
from pyspark.sql import functions as F

from starboard.operators import analyses as A
from starboard.operators.sketches import distinct_sketches, estimates, united
from starboard.plans import marts as M
from starboard.plans.analysis import Frames, analyze_all
from starboard.plans.dataset import analyze_dataset

# Three standard errors.
MOST = 3 * 1.04 / 2 ** (A.PRECISION / 2)


@pytest.fixture(scope="module")
def frames(spark):
    """30 000 ratings, a third by one user, of 9000 users and 4000 movies."""
    rows = spark.range(30_000)
    user = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 9000)
    ratings = rows.select(user.alias("user_id"), (F.col("id") * 7 % 4000).alias("movie_id"),
                          (F.col("id") % 10 / 2).alias("rating"), F.lit(0).cast("bigint").alias("ts"))
    users = spark.range(9000).select(
        F.col("id").alias("user_id"), F.when(F.col("id") % 4 == 0, "F").otherwise("M").alias("gender"),
        (F.col("id") % 60).cast("int").alias("age"),
        F.when(F.col("id") % 2 == 0, "writer").alias("occupation"))
    movies = spark.range(5000).select(
        F.col("id").alias("movie_id"), F.col("id").cast("string").alias("title"))
    genres = movies.select("movie_id", "title", F.when(
        F.col("movie_id") % 5 == 0, "War").otherwise("Drama").alias("genre"))
    return Frames(ratings, movies, users, genres)


def close(exact, approx):
    assert exact.keys() == approx.keys()
    for key, n in exact.items():
        assert abs(approx[key] - n) <= max(1, MOST * n), (key, n, approx[key])


def test_approximate_counts_in_the_analyses(frames):
    def counts(frame, key, value):
        return {row[key]: row[value] for row in frame.collect()}

    for build, key, value in [
        (lambda how: A.genre_stats(frames.ratings, frames.movie_genres, "all", how), "genre_name",
         "movie_count"),
        (lambda how: A.movie_counts_all(frames.movie_genres, how), "genre_name", "movie_count"),
        (lambda how: A.group_user_counts(frames.users, "gender", how), "gender", "user_count"),
    ]:
        close(counts(build("exact"), key, value), counts(build("approx"), key, value))
    exact, approx = [A.summary_from_ratings(frames.ratings, how).first().asDict()
                     for how in ("exact", "approx")]
    close(exact, approx)
    assert exact["rating_count"] == approx["rating_count"]
    with pytest.raises(ValueError, match="distinct"):
        A.distinct_count("user_id", "roughly")


def test_marts_with_approximate_counts(frames):
    exact, approx = [analyze_all(frames, distinct=how) for how in ("exact", "approx")]
    for name, key, value in (("gender_comparison", "gender", "user_count"),
                             ("age_group_stats", "age_group", "user_count"),
                             ("genre_stats", "genre_name", "movie_count")):
        pair = [{r[key]: r[value] for r in marts[name].collect()} for marts in (exact, approx)]
        close(*pair)
        others = [sorted(map(str, marts[name].drop(value).drop("rating_per_user").collect()))
                  for marts in (exact, approx)]
        assert others[0] == others[1]


def test_sketches_unite_to_those_of_all_rows(frames, spark):
    halves = [frames.ratings.where(F.col("user_id") % 2 == side) for side in (0, 1)]
    parts = [distinct_sketches(half, frames.movies, frames.users, frames.movie_genres)
             for half in halves]
    both = {(r.measure, r.label): r.estimate
            for r in estimates(united(parts[0].union(parts[1]))).collect()}
    whole = {(r.measure, r.label): r.estimate for r in estimates(distinct_sketches(
        frames.ratings, frames.movies, frames.users, frames.movie_genres)).collect()}
    assert both.keys() == whole.keys()
    exact = {("raters", "all"): frames.ratings.select("user_id").distinct().count(),
             ("rated_movies", "all"): 4000, ("movies", "all"): 5000,
             ("genre_movies", "War"): 1000, ("genre_movies", "Drama"): 4000,
             ("gender_users", "F"): 2250, ("gender_users", "M"): 6750,
             ("occupation_users", "writer"): 4500, ("occupation_users", None): 4500}
    close(exact, {key: both[key] for key in exact})
    close(exact, {key: whole[key] for key in exact})
    nothing = distinct_sketches(frames.ratings.limit(0))
    assert nothing.count() == 0


def test_stored_sketches_count_datasets_together(spark, folder, tmp_path):
    root = str(tmp_path / "marts")
    head = "user_id,movie_id,rating\n"
    folder(a_csv=head + "".join(f"{i},{i % 50},4\n" for i in range(600)))
    analyze_dataset(spark, str(tmp_path / "files"), root, 1, "one")
    folder_two = tmp_path / "two"
    folder_two.mkdir()
    (folder_two / "b.csv").write_text(head + "".join(f"{i},{i % 80},4\n" for i in range(300, 900)))
    analyze_dataset(spark, str(folder_two), root, 2, "two")
    for ids, users, movies in ((None, 900, 80), ([1], 600, 50), ([2], 600, 80), ([9], None, None)):
        found = {r.measure: r.estimate for r in M.united_counts(spark, root, ids).collect()}
        close({} if users is None else {"raters": users, "rated_movies": movies}, found)
