"""Cleaning of ratings, movies and users, with a reason for every row that is set aside."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starboard.functions.columns import (
    age_bucket,
    case,
    decode_gender,
    decode_occupation,
    genre_list,
    strip,
    strip_title_year,
    to_number,
)
from starboard.schemas import CANONICAL

ROW_OK = "ok"
REASONS = ("missing_key", "invalid_timestamp", "invalid_rating", "rating_out_of_range")



def typed_columns(df: DataFrame, table: str) -> list[Column]:
    """The columns of a canonical table in their types; empty or unfit text is null."""
    given = dict(df.dtypes)
    columns = []
    for field in CANONICAL[table].fields:
        name, kind = field.name, field.dataType.simpleString()
        if name not in given:
            column = F.lit(None).cast(kind)
        elif kind == "string":
            column = F.nullif(strip(F.col(name).cast("string")), F.lit(""))
        elif given[name] == kind:
            column = F.col(name)
        else:
            column = to_number(name, kind)
        columns.append(column.alias(name))
    return columns


def typed(df: DataFrame, table: str) -> DataFrame:
    return df.select(*typed_columns(df, table))


def rating_reason(
    lo: float, hi: float, require: Sequence[str] = ("user_id", "movie_id")
) -> Column:
    """Why a typed rating row is not usable, or ``ok``.

    A rating that was no number is null here and set aside; it never becomes a zero.
    """
    rating = F.col("rating")
    tests = [
        (F.col(name).isNull(), "invalid_timestamp" if name == "ts" else "missing_key")
        for name in require
    ]
    tests.append((rating.isNull(), "invalid_rating"))
    tests.append((~rating.between(lo, hi), "rating_out_of_range"))
    return F.coalesce(case(*tests), F.lit(ROW_OK))


def judge_ratings(
    ratings: DataFrame,
    lo: float,
    hi: float,
    require: Sequence[str] = ("user_id", "movie_id"),
) -> DataFrame:
    """The typed rating columns, the row as it came in ``raw``, and the ``reason``."""
    columns = typed_columns(ratings, "ratings")
    judged = ratings.select(F.struct("*").alias("raw"), *columns)
    return judged.withColumn("reason", rating_reason(lo, hi, require))


def clean_ratings(
    ratings: DataFrame,
    lo: float = 1,
    hi: float = 5,
    require: Sequence[str] = ("user_id", "movie_id"),
    dedup: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Usable ratings in canonical types, and the other rows as they came with a reason.

    Strict cleaning is ``lo=1, hi=5, require=(user_id, movie_id, ts)``, lenient cleaning
    is ``lo=0, hi=10``.
    """
    judged = judge_ratings(ratings, lo, hi, require)
    valid = typed(judged.where(F.col("reason") == ROW_OK), "ratings")
    valid = valid.withColumn("ts", F.coalesce("ts", F.lit(0).cast("bigint")))
    if dedup:
        valid = distinct_rows(valid)
    return valid, judged.where(F.col("reason") != ROW_OK).select("raw.*", "reason")


def quality_counts(
    ratings: DataFrame,
    lo: float = 0,
    hi: float = 10,
    require: Sequence[str] = ("user_id", "movie_id"),
) -> DataFrame:
    """Rows before and after cleaning and removed rows by reason, in one pass."""
    return judge_ratings(ratings, lo, hi, require).agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(F.col("reason") == ROW_OK).alias("rows_after"),
        F.count_if(F.col("reason") != ROW_OK).alias("rows_removed"),
        *[F.count_if(F.col("reason") == reason).alias(reason) for reason in REASONS],
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def require_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys))


def trim_fields(df: DataFrame, *names: str) -> DataFrame:
    """Strip the named text columns, or every text column if none is named."""
    chosen = names or [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns({name: strip(name) for name in chosen})


def clean_movies(movies: DataFrame, strip_year: bool = True) -> DataFrame:
    """Distinct movies with a key; the title loses its year, the full title keeps it."""
    full = F.col("title_full") if "title_full" in movies.columns else F.col("title")
    full = strip(F.coalesce(F.nullif(full, F.lit("")), F.col("title")))
    title = strip_title_year("title") if strip_year else F.col("title")
    cleaned = typed(movies.withColumns({"title_full": full, "title": title}), "movies")
    return distinct_rows(require_keys(cleaned, "movie_id"))


def explode_genres(movies: DataFrame, column: str = "genres_raw") -> DataFrame:
    """One row per movie and genre."""
    return movies.select("movie_id", "title", F.explode(genre_list(column)).alias("genre"))


def movie_genres(movies: DataFrame, column: str = "genres_raw") -> DataFrame:
    return distinct_rows(require_keys(explode_genres(movies, column), "movie_id", "genre"))


def decode_users(users: DataFrame) -> DataFrame:
    """Canonical users from the coded raw file: gender letter, age, occupation code."""
    coded = users.withColumns(
        {
            "age": to_number("age", "int"),
            "occupation_id": to_number("occupation", "int"),
            "occupation": decode_occupation("occupation"),
            "gender": decode_gender("gender"),
        }
    )
    return typed(coded.withColumn("age_group", age_bucket("age")), "users")


def clean_users(users: DataFrame) -> DataFrame:
    """Distinct users with a key; the age group is derived where none is given."""
    table = typed(users, "users")
    given = F.nullif(F.col("age_group"), F.lit(""))
    table = table.withColumn("age_group", F.coalesce(given, age_bucket("age")))
    return distinct_rows(require_keys(table, "user_id"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table, as a check after loading."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("tbl"), "cnt")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def gender_tally(users: DataFrame) -> DataFrame:
    return users.agg(
        F.count_if(F.col("gender") == "Male").alias("male_users"),
        F.count_if(F.col("gender") == "Female").alias("female_users"),
    )
