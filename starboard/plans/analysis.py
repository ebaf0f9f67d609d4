"""All analyses of one dataset, sharing the two folds of the ratings."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from starboard.operators import analyses as A
from starboard.session import together

Stage = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class Frames:
    """Canonical tables of a dataset; what the dataset lacks is None."""

    ratings: DataFrame
    movies: DataFrame | None = None
    users: DataFrame | None = None
    movie_genres: DataFrame | None = None


def _lazy(df: DataFrame, label: str) -> DataFrame:
    return df


def analyze_all(
    frames: Frames,
    min_count: int = 50,
    k: int = 20,
    high: float = 4.0,
    bucket: str = "trunc",
    user_scope: str = "rated",
    movie_scope: str = "rated",
    users_from: str = "profiles",
    stage: Stage = _lazy,
    distinct: str = "exact",
) -> dict[str, DataFrame]:
    """Mart name -> frame, for the marts the given tables allow.

    ``stage`` may write a shared intermediate once (``starboard.session.stage``), so that
    the ratings are read three times in all: by score, per user and per movie.
    """
    per_user, per_movie = together(
        [
            lambda: stage(A.user_activity(frames.ratings, high), "user_activity"),
            lambda: stage(A.movie_activity(frames.ratings, high), "movie_activity")
            if frames.movies is not None or frames.movie_genres is not None
            else None,
        ]
    )
    marts = {"rating_distribution": A.rating_distribution(frames.ratings, bucket)}
    if per_movie is not None:
        if frames.movies is not None:
            marts["top_movies"] = A.rank_movies(per_movie, frames.movies, min_count, k)
        if frames.movie_genres is not None:
            marts["genre_stats"] = A.summarise_genres(
                per_movie, frames.movie_genres, movie_scope, distinct
            )
    marts["active_users"] = A.rank_users(per_user, frames.users, k)
    if frames.users is not None:
        marts.update(_demographics(per_user, frames.users, k, user_scope, stage, distinct))
    marts["dashboard_summary"] = A.summarise(
        per_user, frames.movies, frames.users, users_from, distinct)
    return marts


def _demographics(
    per_user: DataFrame, users: DataFrame, k: int, user_scope: str, stage: Stage, distinct: str
) -> dict[str, DataFrame]:
    if "age" in users.columns:
        users = A.with_age_group(users)
    keys = [key for key in ("gender", "age_group", "occupation") if key in users.columns]
    if not keys:
        return {}
    rollup = stage(A.demographic_rollup(per_user, users, keys, user_scope, distinct), "rollup")
    reports = {
        "gender": ("gender_comparison", A.gender_report),
        "age_group": ("age_group_stats", A.age_group_report),
        "occupation": ("occupation_stats", lambda grouped: A.occupation_report(grouped, k)),
    }
    return {
        mart: report(A.of_dimension(rollup, key))
        for key, (mart, report) in reports.items()
        if key in keys
    }
