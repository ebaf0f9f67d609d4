"""Canonical tables, mart tables and fixed values of the rating model."""

from __future__ import annotations

from pyspark.sql import types as T

INT, LONG, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
TEXT, TIME = T.StringType(), T.TimestampType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


CANONICAL: dict[str, T.StructType] = {
    "movies": _struct(movie_id=LONG, title=TEXT, title_full=TEXT, genres_raw=TEXT),
    "ratings": _struct(user_id=LONG, movie_id=LONG, rating=DOUBLE, ts=LONG),
    "users": _struct(
        user_id=LONG,
        gender=TEXT,
        age=INT,
        age_group=TEXT,
        occupation_id=INT,
        occupation=TEXT,
        zipcode=TEXT,
    ),
    "movie_genres": _struct(movie_id=LONG, title=TEXT, genre=TEXT),
}

# Column order of the headerless '::' files.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "movies": ("movie_id", "title", "genres"),
    "ratings": ("user_id", "movie_id", "rating", "timestamp"),
    "users": ("user_id", "gender", "age", "occupation", "zipcode"),
}

MARTS: dict[str, T.StructType] = {
    "rating_distribution": _struct(score=INT, count=LONG, percentage=T.DecimalType(5, 2)),
    "top_movies": _struct(movie_name=TEXT, avg_rating=T.DecimalType(4, 2), rating_count=LONG),
    "genre_stats": _struct(
        genre_name=TEXT,
        movie_count=LONG,
        avg_rating=T.DecimalType(4, 2),
        rating_count=LONG,
    ),
    "active_users": _struct(
        user_id=LONG,
        gender=TEXT,
        age=INT,
        occupation=TEXT,
        rating_count=LONG,
        avg_rating=T.DecimalType(4, 2),
    ),
    "gender_comparison": _struct(
        gender=TEXT,
        user_count=LONG,
        rating_count=LONG,
        avg_rating=T.DecimalType(5, 3),
        high_rate_pct=T.DecimalType(5, 2),
    ),
    "age_group_stats": _struct(
        age_group=TEXT,
        user_count=LONG,
        rating_count=LONG,
        avg_rating=T.DecimalType(5, 3),
    ),
    # Ratings per user is a ratio without an upper bound, hence the wide decimal.
    "occupation_stats": _struct(
        occupation=TEXT,
        user_count=LONG,
        rating_count=LONG,
        avg_rating=T.DecimalType(5, 3),
        rating_per_user=T.DecimalType(20, 1),
    ),
    "dashboard_summary": _struct(
        total_movies=LONG,
        total_ratings=LONG,
        total_users=LONG,
        avg_rating=T.DecimalType(5, 3),
    ),
}

REGISTRY = _struct(
        name=TEXT,
        movie_count=LONG,
        rating_count=LONG,
        user_count=LONG,
        created_at=TIME,
    )

# Accepted file name endings.
EXTENSIONS = ("csv", "dat", "txt", "tsv")

# Names under which a canonical column may arrive, best first.
ALIASES: dict[str, tuple[str, ...]] = {
    "movie_id": ("movie_id", "movieid", "movie"),
    "user_id": ("user_id", "userid", "user"),
    "rating": ("rating", "score", "rate"),
    "title": ("title",),
    "title_full": ("title_full",),
    "genres": ("genres", "genre", "genres_raw", "category", "categories"),
    "gender": ("gender",),
    "age": ("age",),
    "age_group": ("age_group",),
    "occupation_id": ("occupation_id",),
    "occupation": ("occupation",),
    "zipcode": ("zipcode",),
    "time": ("time", "timestamp", "ts"),
}

# Every name under which a canonical column may arrive.
KNOWN_NAMES = tuple(name for names in ALIASES.values() for name in names)

# A line with one of these as a whole field is a header line.
HEADER_NAMES = (
    "movie_id", "movieid", "user_id", "userid", "rating", "title", "movie", "score",
)

# Field names that mark a file as rating data, exactly or as a part.
DATA_NAMES = (
    "user_id", "userid", "user", "movie_id", "movieid", "movie", "rating", "score", "rate",
    "title", "genres", "genre", "gender", "age", "occupation",
)
DATA_NAME_PARTS = "id|rating|score|title|genre|user|movie"

# Age groups in display order, each with its highest age.
AGE_GROUPS: tuple[tuple[str, int | None], ...] = (
    ("Under18", 18),
    ("19-25", 25),
    ("26-35", 35),
    ("36-45", 45),
    ("46-55", 55),
    ("56+", None),
)
AGE_LABELS = tuple(label for label, _ in AGE_GROUPS)

# Occupation labels by code, 0 to 20.
OCCUPATIONS = (
    "other",
    "academic/educator",
    "artist",
    "clerical/admin",
    "college/grad student",
    "customer service",
    "doctor/health care",
    "executive/managerial",
    "farmer",
    "homemaker",
    "K-12 student",
    "lawyer",
    "programmer",
    "retired",
    "sales/marketing",
    "scientist",
    "self-employed",
    "technician/engineer",
    "tradesman/craftsman",
    "unemployed",
    "writer",
)
UNKNOWN_OCCUPATION = "unknown"

DEFAULT_DATASET = 0
