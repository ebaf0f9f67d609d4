"""Approximate distinct counts by HLL sketches that can be kept and united.

A sketch is some kilobytes whatever it has counted. Sketches of several datasets unite to the
sketch of all their rows, so users and movies of a union are counted without a second look at any
rating. Folding is done on the map side: a hot group sends one sketch per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starboard.operators.analyses import PRECISION, with_age_group

def _sketch(rows: DataFrame, measure: str, column: str, label: str | None, precision: int) -> DataFrame:
    shown = F.col(label).cast("string") if label else F.lit("all")
    return rows.where(F.col(column).isNotNull()).groupBy(shown.alias("label")).agg(
        F.hll_sketch_agg(column, F.lit(precision)).alias("sketch")).select(
        F.lit(measure).alias("measure"), "label", "sketch")


def distinct_sketches(
    ratings: DataFrame, movies: DataFrame | None = None, users: DataFrame | None = None,
    genres: DataFrame | None = None, precision: int = PRECISION,
) -> DataFrame:
    """(measure, label, sketch): users and movies of the ratings, movies of the catalogue and by
    genre, users by gender, age group and occupation. What cannot be counted is left out.

    A null label is a group like others; null ids are not counted.
    """
    parts = [_sketch(ratings, "raters", "user_id", None, precision),
             _sketch(ratings, "rated_movies", "movie_id", None, precision)]
    if movies is not None:
        parts.append(_sketch(movies, "movies", "movie_id", None, precision))
    if genres is not None:
        parts.append(_sketch(genres, "genre_movies", "movie_id", "genre", precision))
    if users is not None:
        known = with_age_group(users) if "age" in users.columns else users
        parts += [_sketch(known, f"{key}_users", "user_id", key, precision)
                  for key in ("gender", "age_group", "occupation") if key in known.columns]
    return reduce(DataFrame.unionAll, parts)


def united(sketches: DataFrame) -> DataFrame:
    """One sketch per measure and label of sketches (measure, label, sketch) of many datasets."""
    return sketches.groupBy("measure", "label").agg(F.hll_union_agg("sketch").alias("sketch"))


def estimates(sketches: DataFrame) -> DataFrame:
    """(measure, label, estimate)."""
    return sketches.select("measure", "label", F.hll_sketch_estimate("sketch").alias("estimate"))
