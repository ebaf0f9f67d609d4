"""Analyses against a direct computation on a small star with every kind of gap."""

import pytest

from starboard.operators import analyses as A
from starboard.operators.cleaning import movie_genres
from starboard.plans.analysis import Frames, analyze_all
from starboard.session import stage

# user 9 has no profile, movie 99 is unknown, user 5 and movie 40 have no rating
RATINGS = [
    (1, 10, 5.0), (1, 11, 4.0), (1, 20, 3.0), (2, 10, 4.0), (2, 11, 2.5), (2, 99, 1.0),
    (3, 10, 3.5), (3, 20, 4.5), (4, 30, 0.5), (9, 10, 5.0), (9, 30, 2.0),
]
MOVIES = [
    (10, "Heat", "Action|Crime"), (11, "Heat", "Drama"), (20, "Up", "Drama|Comedy| "),
    (30, "Jaws", "Horror"), (40, "Alien", "Horror|Sci-Fi"),
]
USERS = [
    (1, "Male", 17, "writer"), (2, "Female", 30, "artist"), (3, "Female", 60, "writer"),
    (4, None, None, "artist"), (5, "Male", 20, "lawyer"),
]


@pytest.fixture(scope="module")
def star(spark):
    ratings = spark.createDataFrame(
        [(u, m, r, 0) for u, m, r in RATINGS], "user_id int, movie_id int, rating double, ts bigint")
    movies = spark.createDataFrame(
        [(m, t, t, g) for m, t, g in MOVIES],
        "movie_id int, title string, title_full string, genres_raw string")
    users = spark.createDataFrame(
        USERS, "user_id int, gender string, age int, occupation string")
    return Frames(ratings, movies, users, movie_genres(movies))


def test_distribution(star, rows):
    assert rows(A.rating_distribution(star.ratings)) == [
        (0, 1, 9.09), (1, 1, 9.09), (2, 2, 18.18), (3, 2, 18.18), (4, 3, 27.27), (5, 2, 18.18)]
    assert rows(A.rating_distribution(star.ratings, "round"), "score", "count") == [
        (1, 2), (2, 1), (3, 2), (4, 3), (5, 3)]
    assert rows(A.rating_distribution(star.ratings, total=100), "percentage")[0] == (1.0,)


def test_distribution_is_sorted(star):
    scores = [row["score"] for row in A.rating_distribution(star.ratings).collect()]
    assert scores == sorted(scores)


def test_top_movies_by_title_and_by_id(star):
    by_title = A.top_movies(star.ratings, star.movies, min_count=2).collect()
    assert [tuple(row) for row in by_title] == [("Heat", 4.0, 6), ("Up", 3.75, 2), ("Jaws", 1.25, 2)]
    by_id = A.top_movies(star.ratings, star.movies, min_count=2, by="movie_id", k=2).collect()
    assert [tuple(row) for row in by_id] == [(10, "Heat", 4.38, 4), (20, "Up", 3.75, 2)]


def test_top_movies_exact_order(spark):
    ratings = spark.createDataFrame(
        [(i, 1, 4.0) for i in range(1000)] + [(0, 1, 4.5)] + [(1, 2, 4.0)],
        "user_id int, movie_id int, rating double")
    movies = spark.createDataFrame([(1, "B"), (2, "A")], "movie_id int, title string")
    # Both round to 4.00; the exact average of B is higher, and B has more ratings.
    exact = A.top_movies(ratings, movies, 1, order="exact").collect()
    assert [row["movie_name"] for row in exact] == ["B", "A"]
    assert exact[0]["avg_rating"] == exact[1]["avg_rating"] == 4.0


def test_genres(star, rows):
    assert rows(A.genre_stats(star.ratings, star.movie_genres)) == [
        ("Action", 1, 4.38, 4), ("Comedy", 1, 3.75, 2), ("Crime", 1, 4.38, 4),
        ("Drama", 2, 3.5, 4), ("Horror", 1, 1.25, 2)]
    everything = dict(rows(
        A.genre_stats(star.ratings, star.movie_genres, "all"), "genre_name", "movie_count"))
    assert everything == {"Action": 1, "Comedy": 1, "Crime": 1, "Drama": 2, "Horror": 2}
    assert dict(rows(A.movie_counts_all(star.movie_genres)))["Sci-Fi"] == 1
    assert rows(A.genre_count(star.movie_genres)) == [(6,)]


def test_active_users(star):
    known = A.active_users(star.ratings, star.users, k=3).collect()
    assert [tuple(row) for row in known] == [
        (1, "Male", 17, "writer", 3, 4.0), (2, "Female", 30, "artist", 3, 2.5),
        (3, "Female", 60, "writer", 2, 4.0)]
    bare = A.active_users(star.ratings).collect()
    assert len(bare) == 5 and tuple(bare[0]) == (1, "?", 0, "?", 3, 4.0)


def test_active_users_without_some_profile_columns(star):
    top = A.active_users(star.ratings, star.users.drop("age", "occupation"), k=1).first()
    assert tuple(top) == (1, "Male", 0, "?", 3, 4.0)


def test_repeated_profile_rows_merge(star):
    doubled = star.users.unionAll(star.users)
    top = A.active_users(star.ratings, doubled, k=1).first()
    assert (top["user_id"], top["rating_count"], top["avg_rating"]) == (1, 6, 4.0)
    gender = A.gender_comparison(star.ratings, doubled).where("gender = 'Male'").first()
    assert (gender["user_count"], gender["rating_count"]) == (1, 6)


def test_gender(star, rows):
    rated = rows(A.gender_comparison(star.ratings, star.users))
    assert rated == [("Female", 2, 5, 3.1, 40.0), ("Male", 1, 3, 4.0, 66.67), (None, 1, 1, 0.5, 0.0)]
    everyone = A.gender_comparison(star.ratings, star.users, user_scope="all")
    assert dict(rows(everyone, "gender", "user_count")) == {"Female": 2, "Male": 2, None: 1}
    shares = A.gender_rating_share(star.ratings, star.users)
    assert dict(rows(shares, "gender", "rating_share_pct")) == {
        "Female": 45.45, "Male": 27.27, None: 9.09}


def test_age_groups_in_order_with_unknown_apart(star):
    groups = A.age_group_stats(star.ratings, star.users).collect()
    assert [(r["age_group"], r["rating_count"]) for r in groups] == [
        (None, 1), ("Under18", 3), ("26-35", 3), ("56+", 2)]


def test_age_genre(star, rows):
    top = A.age_genre_topk(star.ratings, star.users, star.movie_genres, k=1)
    assert [tuple(row) for row in top.collect()] == [
        (None, "Horror", 1), ("Under18", "Drama", 2), ("26-35", "Action", 1), ("56+", "Action", 1)]


def test_occupations(star):
    jobs = A.occupation_stats(star.ratings, star.users).collect()
    assert [tuple(row) for row in jobs] == [("writer", 2, 5, 4.0, 2.5), ("artist", 2, 4, 2.0, 2.0)]
    assert A.occupation_stats(star.ratings, star.users, k=1).count() == 1


def test_summaries(star, rows):
    assert rows(A.dashboard_summary(star.ratings, star.movies, star.users)) == [(5, 11, 5, 3.182)]
    assert rows(A.dashboard_summary(star.ratings)) == [(0, 11, 5, 3.182)]
    assert rows(A.summary_from_ratings(star.ratings)) == [(5, 11, 5)]
    assert dict(rows(A.group_user_counts(star.users, "occupation"))) == {
        "writer": 2, "artist": 2, "lawyer": 1}


def test_empty_ratings(star, rows):
    none = star.ratings.where("false")
    assert rows(A.dashboard_summary(none, star.movies)) == [(5, 0, 0, None)]
    assert rows(A.rating_distribution(none)) == []
    assert rows(A.gender_comparison(none, star.users, user_scope="all")) == []


def test_rollup_equals_single_reports(star, rows):
    users = A.with_age_group(star.users)
    per_user = A.user_activity(star.ratings)
    for scope in ("rated", "all"):
        rollup = A.demographic_rollup(per_user, users, user_scope=scope)
        for key in ("gender", "age_group", "occupation"):
            single = A.group_activity(per_user, users, key, scope)
            assert rows(A.of_dimension(rollup, key)) == rows(single)


def test_analyze_all_equals_single_analyses(star, rows):
    marts = analyze_all(star, min_count=2, stage=stage)
    assert rows(marts["top_movies"]) == rows(A.top_movies(star.ratings, star.movies, 2))
    assert rows(marts["genre_stats"]) == rows(A.genre_stats(star.ratings, star.movie_genres))
    assert rows(marts["active_users"]) == rows(A.active_users(star.ratings, star.users))
    assert rows(marts["gender_comparison"]) == rows(A.gender_comparison(star.ratings, star.users))
    assert rows(marts["age_group_stats"]) == rows(A.age_group_stats(star.ratings, star.users))
    assert rows(marts["occupation_stats"]) == rows(A.occupation_stats(star.ratings, star.users))
    assert rows(marts["dashboard_summary"]) == [(5, 11, 5, 3.182)]


def test_analyze_all_leaves_out_what_it_cannot_compute(star):
    assert set(analyze_all(Frames(star.ratings))) == {
        "rating_distribution", "active_users", "dashboard_summary"}
    only_gender = star.users.select("user_id", "gender")
    marts = analyze_all(Frames(star.ratings, star.movies, only_gender))
    assert set(marts) == {
        "rating_distribution", "top_movies", "active_users", "gender_comparison",
        "dashboard_summary"}


def test_totals_agree(star):
    total = star.ratings.count()
    distribution = A.rating_distribution(star.ratings).collect()
    assert sum(row["count"] for row in distribution) == total
    assert abs(sum(row["percentage"] for row in distribution) - 100) < 0.05


@pytest.mark.parametrize("call", [
    lambda s: A.genre_stats(s.ratings, s.movie_genres, "some"),
    lambda s: A.top_movies(s.ratings, s.movies, by="year"),
    lambda s: A.top_movies(s.ratings, s.movies, order="random"),
    lambda s: A.dashboard_summary(s.ratings, users_from="guess"),
])
def test_unknown_options_are_refused(star, call):
    with pytest.raises(ValueError):
        call(star)
