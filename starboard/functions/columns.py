"""Column expressions of the rating model. All built-in, nothing leaves the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from starboard.schemas import AGE_GROUPS, AGE_LABELS, OCCUPATIONS, UNKNOWN_OCCUPATION

ColumnLike = Column | str

_BLANKS = " \t\r\n\f\x0b"
_INTEGER = r"^\s*[-+]?[0-9]+(\.0*)?\s*$"
_DECIMAL = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$"


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def case(*branches: tuple[Column, object]) -> Column:
    """The value beside the first condition that holds, null if none does."""
    return reduce(lambda chain, branch: chain.when(*branch), branches[1:], F.when(*branches[0]))


def strip(value: ColumnLike) -> Column:
    """Remove blanks, tabs and line ends on both sides (``trim`` knows only the blank)."""
    return F.btrim(as_column(value), F.lit(_BLANKS))


def not_blank(line: ColumnLike) -> Column:
    """Whether a line holds anything; looks no further than its first character."""
    return F.ltrim(as_column(line), F.lit(_BLANKS)) != ""


def to_number(value: ColumnLike, type_name: str) -> Column:
    """Null instead of an error for text that is no plain number.

    The pattern keeps out what a cast would let through, ``4f``, ``NaN``, ``Infinity``,
    and spares the cast the text it can only fail on: inside ``try_cast`` a failure is an
    exception, a hundred times as dear as the pattern.
    """
    text = as_column(value).cast("string")
    if type_name in ("int", "bigint"):
        # Whole numbers come as 5.0 from tools that keep them as doubles.
        whole = F.substring_index(text, ".", 1)
        return F.when(text.rlike(_INTEGER), whole.try_cast(type_name))
    return F.when(text.rlike(_DECIMAL), text.try_cast(type_name))


def strip_title_year(title: ColumnLike) -> Column:
    return strip(F.regexp_replace(as_column(title), r"\s*\([0-9]{4}\)\s*$", ""))


def genre_list(genres: ColumnLike) -> Column:
    """The pieces between the pipes, trimmed, without empty ones."""
    pieces = F.transform(F.split(as_column(genres), r"\|"), strip)
    return F.filter(pieces, lambda piece: piece != "")


def age_bucket(age: ColumnLike) -> Column:
    """Age group label; an unknown age stays null instead of joining the oldest group."""
    age = as_column(age)
    return case(
        *[(age.isNotNull() if highest is None else age <= highest, label)
          for label, highest in AGE_GROUPS]
    )


def decode_gender(code: ColumnLike) -> Column:
    code = as_column(code)
    return F.when(code.isNull(), None).when(F.upper(code) == "M", "Male").otherwise("Female")


def decode_occupation(code: ColumnLike) -> Column:
    text = strip(as_column(code).cast("string"))
    number = F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))
    label = F.get(F.array(*[F.lit(name) for name in OCCUPATIONS]), number)
    return F.coalesce(label, F.lit(UNKNOWN_OCCUPATION))


def score_bucket(rating: ColumnLike, bucket: str = "trunc") -> Column:
    rating = as_column(rating)
    if bucket == "trunc":
        return rating.try_cast("int")
    if bucket == "round":
        return F.round(rating, 0).try_cast("int")
    raise ValueError(f"bucket must be 'trunc' or 'round', not {bucket!r}")


def label_rank(value: ColumnLike, labels: Sequence[str] = AGE_LABELS) -> Column:
    """Position in a fixed label list, for sorting; labels outside the list come first."""
    return F.array_position(F.array(*[F.lit(label) for label in labels]), as_column(value))


def ratio(part: ColumnLike, whole: ColumnLike, digits: int, scale: float = 1.0) -> Column:
    """``part * scale / whole`` rounded half up; null where ``whole`` is zero."""
    part = as_column(part).cast("double")
    if scale != 1.0:
        part = part * F.lit(scale)
    return F.round(F.try_divide(part, as_column(whole).cast("double")), digits)


def percent(part: ColumnLike, whole: ColumnLike, digits: int = 2) -> Column:
    return ratio(part, whole, digits, 100.0)
