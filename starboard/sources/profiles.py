"""Columns of headerless files, told from what they hold.

One pass folds every column of every headerless file to a slim profile: how many of its values
are whole numbers, ratings, times, genders, ages, text or lists, in what range and of how many
kinds. From the profiles of a file's columns the columns are assigned to a role; where several
assignments fit equally well and the customary order of columns does not decide, the file is
ambiguous and stays out. Profiles are data like dialects: one plan for any number of files.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starboard.functions.columns import not_blank, strip, to_number
from starboard.schemas import ALIASES
from starboard.sources.dialects import cells_of
from starboard.sources.sizes import small_enough

# Share of a column's values that have to be of a kind for the column to be of it. Damaged rows
# are expected, so it is little more than half.
FIT = 0.6
# Share of values with a pipe from which a text column is taken for a list of genres.
LISTED = 0.05
# A column of scores has few kinds of values; one decimal on a scale to 10 makes 101.
MOST_SCORES = 110

KINDS = ("key", "score", "time", "gender", "age", "text")

# Customary order of columns in files without names, by role; decides between equal fits.
CUSTOMARY: dict[str, tuple[str, ...]] = {
    "ratings": ("user_id", "movie_id", "rating", "time"),
    "movies": ("movie_id", "title", "genres"),
    "users": ("user_id", "gender", "age", "occupation", "zipcode"),
}


def profile_columns(lines: DataFrame, dialects: DataFrame) -> DataFrame:
    """One row per column of every file with a delimiter and no header.

    file_path, pos, n (values that are not empty), the share of values of each of ``KINDS``,
    listed (share with a pipe), least and highest number, and about how many different values.
    """
    bare = dialects.where("not has_header and sep is not null").select(
        "file_path", "sep", F.size("names").alias("width"))
    width = max(bare.agg(F.max("width")).first()[0] or 0, 2)
    bare = small_enough(bare.drop("width"))
    cells = lines.where(not_blank("value")).join(bare, "file_path").select(
        "file_path", F.posexplode(cells_of(F.col("value"), F.col("sep"), width)).alias("pos", "cell"))
    value = F.nullif(strip("cell"), F.lit(""))
    values = cells.select("file_path", "pos", value.alias("value")).where("value is not null")
    wholes = values.withColumn("whole", to_number("value", "bigint"))
    whole, value = F.col("whole"), F.col("value")
    # A whole number is one, and has no letter: only other values meet the further patterns.
    number = F.when(whole.isNotNull(), whole.cast("double")).otherwise(to_number(value, "double"))
    typed = wholes.withColumn("number", number)
    number, other = F.col("number"), whole.isNull()
    kinds = {
        "key": whole.isNotNull(),
        "score": number.between(0, 10),
        "time": whole.between(100_000_000, 99_999_999_999),
        "gender": other & F.lower(value).isin("m", "f", "male", "female"),
        "age": whole.between(1, 120),
        "text": other & value.rlike("[A-Za-z\\u0080-\\uFFFF]"),
        "listed": F.contains(value, F.lit("|")),
    }
    return typed.groupBy("file_path", "pos").agg(
        F.count(F.lit(1)).alias("n"),
        *[(F.count_if(test) / F.count(F.lit(1))).alias(kind) for kind, test in kinds.items()],
        F.min("number").alias("least"), F.max("number").alias("highest"),
        F.approx_count_distinct("value").alias("different"),
    ).withColumn("score", F.when(F.col("different") <= MOST_SCORES, F.col("score")).otherwise(0.0))


def _of_kind(kind: str, least: float = FIT) -> Column:
    """Positions of the columns of a kind, in their order."""
    return F.transform(F.filter("columns", lambda c: c[kind] >= least), lambda c: c["pos"])


def _chosen(found: Column, customary: int) -> Column:
    """The only position found, or the customary one among several; null if none or undecided."""
    return F.when(F.array_contains(found, F.lit(customary)), F.lit(customary)).when(
        F.size(found) == 1, F.get(found, F.lit(0)))


def assign_columns(profiles: DataFrame) -> DataFrame:
    """(file_path, role, at, ambiguous) for every profiled file.

    A file with a gender and a key is of users; one with a score and two keys beside it and
    beside a time is of ratings; one with a key and a text is of movies. ``at`` holds the
    positions of the canonical columns. ``ambiguous`` is true if there is a column for
    everything a role needs, but more than one for something, and none at the customary place.
    """
    files = profiles.groupBy("file_path").agg(F.sort_array(F.collect_list(
        F.struct("pos", *KINDS, "listed"))).alias("columns"))
    kinds = files.select(
        "file_path", F.array_max(F.transform("columns", lambda c: c["pos"])).alias("last"),
        *[_of_kind(kind).alias(kind) for kind in KINDS],
        F.array_intersect(_of_kind("listed", LISTED), _of_kind("text")).alias("listed"))
    key, text = F.col("key"), F.array_except("text", "gender")
    titles = F.array_except(text, F.col("listed"))
    # A file with one text column has a title, also where it holds pipes.
    titles = F.when((F.size(titles) == 0) & (F.size("listed") > 0), F.col("listed")).otherwise(titles)
    scores = F.array_except("score", "time")
    placed = kinds.withColumns({
        "is_user": (F.size("gender") > 0) & (F.size("key") > 0),
        "scores": scores, "titles": titles,
        "time_at": _chosen(F.col("time"), 3),
    })
    # A score with halves or tenths is no key; whole ones are told by their place alone.
    broken = F.array_except("scores", key)
    score_at = F.when(F.size(broken) == 1, F.get(broken, F.lit(0))).otherwise(
        _chosen(F.col("scores"), CUSTOMARY["ratings"].index("rating")))
    placed = placed.withColumn("score_at", score_at)
    taken = F.array(F.coalesce("score_at", F.lit(-1)))
    placed = placed.withColumn("keys", F.array_except(F.array_except(key, taken), F.col("time")))
    both = F.array_contains("keys", F.lit(0)) & F.array_contains("keys", F.lit(1))
    users_at = F.when(both, 0).when(F.size("keys") == 2, F.get("keys", F.lit(0)))
    movies_at = F.when(both, 1).when(F.size("keys") == 2, F.get("keys", F.lit(1)))
    # As many columns as a rating needs, whatever they are taken for.
    plain = F.array_except(key, F.col("time"))
    can_rate = (F.size("scores") > 0) & (
        F.size(F.array_distinct(F.concat(plain, F.col("scores")))) >= 3) & (F.size(plain) >= 2)
    judged = placed.withColumns({
        "users_at": users_at, "movies_at": movies_at, "can_rate": can_rate,
        "title_at": _chosen(F.col("titles"), 1),
        # Ages are whole numbers too; a key that is none goes before.
        "key_at": F.coalesce(F.when(F.col("is_user") & ~F.array_contains("key", F.lit(0)), _chosen(
            F.array_except("key", "age"), 0)), _chosen(F.col("key"), 0)),
    })
    role = (F.when(F.col("is_user"), "users").when(F.col("can_rate"), "ratings")
            .when((F.size("titles") > 0) & (F.size("key") > 0), "movies"))
    judged = judged.withColumn("seems", role)
    whole = (F.when(F.col("seems") == "users", F.col("key_at").isNotNull()
                    & _chosen(F.col("gender"), 1).isNotNull())
             .when(F.col("seems") == "ratings", F.col("score_at").isNotNull()
                   & F.col("users_at").isNotNull())
             .when(F.col("seems") == "movies", F.col("title_at").isNotNull()
                   & F.col("key_at").isNotNull()))
    judged = judged.withColumn("role", F.when(whole, F.col("seems")))
    customary_user = (F.col("key_at") == 0) & F.array_contains("gender", F.lit(1))
    ages = F.array_except("age", F.array("key_at"))
    genres = F.array_except("listed", F.array("title_at"))
    # A third column of text without pipes is one of single genres.
    third = F.when((F.col("key_at") == 0) & (F.col("title_at") == 1)
                   & F.array_contains("titles", F.lit(2)), 2)
    places = {
        "ratings": {"user_id": F.col("users_at"), "movie_id": F.col("movies_at"),
                    "rating": F.col("score_at"), "time": F.col("time_at")},
        "movies": {"movie_id": F.col("key_at"), "title": F.col("title_at"),
                   "genres": F.coalesce(_chosen(genres, 2), third)},
        "users": {"user_id": F.col("key_at"), "gender": _chosen(F.col("gender"), 1),
                  "age": _chosen(ages, 2),
                  "occupation": F.when(customary_user & (F.col("last") >= 3), 3),
                  "zipcode": F.when(customary_user & (F.col("last") >= 4), 4)},
    }

    def place(name: str) -> Column:
        found = [F.when(F.col("role") == role, places[role][name])
                 for role in places if name in places[role]]
        return (F.coalesce(*found) if found else F.lit(None)).cast("int").alias(name)

    return judged.select(
        "file_path", "role", F.struct(*[place(name) for name in ALIASES]).alias("at"),
        (F.col("seems").isNotNull() & F.col("role").isNull()).alias("ambiguous"))


def _pattern_of(file_path: str) -> str:
    """The pattern that matches just the file of a path as a scan spells it."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file_path))


# So many headerless files are read by their paths; of more the lines of all files are joined.
MOST_PATHS = 1000


def with_profiles(
    lines: DataFrame, dialects: DataFrame,
    reread: Callable[[list[str]], DataFrame] | None = None,
) -> DataFrame:
    """``dialects`` with role and positions of headerless files, and ``ambiguous``.

    The lines of headerless files are read once more; without such files nothing is read.
    ``reread`` gives the lines of some files by their paths, so that others are not touched.
    """
    bare = dialects.where("not has_header and sep is not null").select("file_path")
    names = [row["file_path"] for row in bare.limit(MOST_PATHS + 1).collect()]
    if not names:
        return dialects.withColumn("ambiguous", F.lit(False))
    if reread and len(names) <= MOST_PATHS:
        lines = reread([_pattern_of(name) for name in names])
    assigned = assign_columns(profile_columns(lines, dialects)).select(
        "file_path", F.col("role").alias("told_role"), F.col("at").alias("told_at"), "ambiguous")
    told = F.col("told_role").isNotNull()
    places = F.array(*[F.col("told_at")[name] for name in ALIASES])
    rest = F.array_except(F.sequence(F.lit(0), F.size("fields") - 1), places)
    return dialects.join(assigned, "file_path", "left").withColumns({
        "role": F.coalesce("told_role", "role"),
        "at": F.when(told, F.col("told_at")).otherwise(F.col("at")),
        "extra_at": F.when(told, rest).otherwise(F.col("extra_at")),
        "extra_names": F.when(told, F.transform(rest, lambda i: F.get("fields", i))).otherwise(
            F.col("extra_names")),
        "ambiguous": F.coalesce("ambiguous", F.lit(False)),
    }).drop("told_role", "told_at")
