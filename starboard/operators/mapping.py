"""Mapping of unknown column names to the canonical tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starboard.functions.columns import ColumnLike, as_column, strip
from starboard.operators.cleaning import typed
from starboard.schemas import ALIASES, CANONICAL

_QUOTES = "[\"'`]"

# Canonical table column -> alias group, where the two names differ.
_FED_BY = {"ts": "time", "genres_raw": "genres"}

ROLES = ("ratings", "movies", "users")


def normalize_header(names: Iterable[str]) -> list[str]:
    """Names without quotes, trimmed and in lower case."""
    return [re.sub(_QUOTES, "", name).strip().lower() for name in names]


def normalized(name: ColumnLike) -> Column:
    """``normalize_header`` as an expression."""
    return F.lower(strip(F.regexp_replace(as_column(name), _QUOTES, "")))


def map_aliases(names: Sequence[str]) -> dict[str, str]:
    """Given name -> canonical name; the best alias present wins, other names are not listed."""
    by_clean: dict[str, str] = {}
    for name, clean in zip(names, normalize_header(names)):
        by_clean.setdefault(clean, name)
    mapped = {}
    for canonical, aliases in ALIASES.items():
        found = next((by_clean[alias] for alias in aliases if alias in by_clean), None)
        if found is not None:
            mapped[found] = canonical
    return mapped


def rename_columns(df: DataFrame) -> DataFrame:
    """Known columns under their canonical names, unknown columns as they are."""
    mapped = map_aliases(df.columns)
    return df.select(*[F.col(f"`{name}`").alias(mapped.get(name, name)) for name in df.columns])


def classify_table(names: Iterable[str]) -> str | None:
    """Which table a set of canonical column names is, if any."""
    names = set(names)
    if "rating" in names:
        return "ratings"
    if {"movie_id", "title"} <= names:
        return "movies"
    if "user_id" in names and names & {"gender", "age"}:
        return "users"
    return None


def canonicalize(df: DataFrame, role: str) -> DataFrame:
    """A renamed frame in the columns and types of a canonical table."""
    present = set(df.columns)
    wanted = {}
    for field in CANONICAL[role].fields:
        source = next(
            (name for name in (field.name, _FED_BY.get(field.name)) if name in present), None
        )
        if source:
            wanted[field.name] = F.col(source)
    return fallbacks(typed(df.select(*[c.alias(n) for n, c in wanted.items()]), role), role)


def fallbacks(df: DataFrame, role: str) -> DataFrame:
    """Stand-ins for optional columns: full title from title, no genres, time zero."""
    if role == "movies":
        return df.withColumns(
            {
                "title": F.coalesce("title", F.lit("")),
                "title_full": F.coalesce("title_full", "title", F.lit("")),
                "genres_raw": F.coalesce("genres_raw", F.lit("")),
            }
        )
    if role == "ratings":
        return df.withColumn("ts", F.coalesce("ts", F.lit(0).cast("bigint")))
    return df


def default_fill(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls by defaults and add columns that are missing altogether."""
    filled = {}
    for name, value in defaults.items():
        default = F.lit(value)
        filled[name] = F.coalesce(F.col(name), default) if name in df.columns else default
    return df.withColumns(filled)


# What a profile shows where nothing is known.
PROFILE_DEFAULTS = {"gender": "?", "age": 0, "occupation": "?"}

# What an imported user row holds where nothing is known.
USER_DEFAULTS = {
    "gender": "", "age": 0, "age_group": "", "occupation_id": 0, "occupation": "", "zipcode": "",
}


def merge_role_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """All files of one role as one table; a column missing in one of them is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
