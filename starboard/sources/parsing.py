"""From lines of any dialect to rows of the canonical tables, in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starboard.functions.columns import not_blank
from starboard.operators.cleaning import (
    ROW_OK,
    clean_movies,
    clean_users,
    distinct_rows,
    rating_reason,
    typed,
    typed_columns,
)
from starboard.operators.mapping import ROLES, fallbacks, normalized
from starboard.schemas import ALIASES, CANONICAL
from starboard.sources.dialects import cells_of
from starboard.sources.sizes import BROADCAST_BYTES, text_bytes

HEADER = "header"
TOO_FEW_FIELDS = "too_few_fields"

# What parsing needs to know about a file.
_SENT = ("file_path", "role", "sep", "has_header", "names", "at", "extra_names", "extra_at")

# Canonical text columns cut from a line, under the names of the canonical tables.
_CELLS = {"time": "ts", "genres": "genres_raw"}


@dataclass(frozen=True)
class DialectSize:
    """What the driver has to know about a dialect table: its size, not its rows."""

    files: int
    width: int
    bytes: int


def measure(dialects: DataFrame) -> DialectSize:
    row = dialects.where("role is not null").agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.max(F.size("fields")), F.lit(0)).alias("width"),
        F.coalesce(
            F.sum(F.octet_length(F.to_json(F.struct(*_SENT))) + 64), F.lit(0)
        ).alias("bytes"),
    ).first()
    return DialectSize(row["files"], row["width"], row["bytes"])


def _reason(lo: float, hi: float) -> Column:
    no_movie = F.when(F.col("movie_id").isNull(), "missing_key").otherwise(ROW_OK)
    no_user = F.when(F.col("user_id").isNull(), "missing_key").otherwise(ROW_OK)
    return (
        F.when(F.col("shape") != ROW_OK, F.col("shape"))
        .when(F.col("role") == "ratings", rating_reason(lo, hi))
        .when(F.col("role") == "movies", no_movie)
        .otherwise(no_user)
    )


# Bytes of a file's key and of the key of its dialect.
_KEY_BYTES = 24


def _with_dialects(lines: DataFrame, dialects: DataFrame, size: DialectSize) -> DataFrame:
    """``lines`` with the dialect of their file, the text staying where it is read.

    Many files have few dialects. Where the rows per file are too many bytes to be broadcast, only
    a hash of the path and a hash of the dialect are, beside the different dialects. Beyond that,
    or if two hashes are the same by chance, the planner joins.
    """
    if size.bytes <= BROADCAST_BYTES:
        return lines.join(F.broadcast(dialects), "file_path")
    if size.files * _KEY_BYTES <= BROADCAST_BYTES:
        shape = [name for name in dialects.columns if name != "file_path"]
        text = F.to_json(F.struct(*shape), {"ignoreNullFields": "false"})
        keyed = dialects.withColumns({
            "file_key": F.xxhash64("file_path"), "shape_key": F.xxhash64(text), "shape_text": text})
        chance = keyed.agg(
            (F.count_distinct("file_key") == F.count(F.lit(1))).alias("files"),
            (F.count_distinct("shape_key") == F.count_distinct("shape_text")).alias("shapes"))
        shapes = keyed.groupBy("shape_key").agg(*[F.first(name).alias(name) for name in shape])
        told = chance.first()
        if told["files"] and told["shapes"] and text_bytes(shapes) <= BROADCAST_BYTES:
            files = F.broadcast(keyed.select("file_key", "shape_key"))
            return lines.withColumn("file_key", F.xxhash64("file_path")).join(
                files, "file_key").join(F.broadcast(shapes), "shape_key").drop(
                "file_key", "shape_key")
    return lines.join(dialects, "file_path")


def parse_rows(
    lines: DataFrame,
    dialects: DataFrame,
    lo: float = 0,
    hi: float = 10,
    size: DialectSize | None = None,
) -> DataFrame:
    """Every line that is not blank of the files with a role, with its reason.

    Columns: file_path, role, reason, the canonical columns in their types, ``extra`` with
    the unknown columns by name, and for rows set aside the line as it came in ``value``.
    ``reason`` is ``ok`` for usable rows and ``header`` for header lines, the first too.
    """
    size = size or measure(dialects)
    line, sep = F.trim("value"), F.col("sep")
    text = _with_dialects(lines.where(not_blank("value")).select("file_path", "value"),
                          dialects.where("role is not null").select(*_SENT), size)
    # One step per select: what is cut here is used once per column and not cut again.
    shape = F.when(~F.contains(line, sep), TOO_FEW_FIELDS).otherwise(ROW_OK)
    cells = text.select(
        "file_path", "role", "value", "at", "extra_at", "extra_names", "has_header", "names",
        shape.alias("shape"),
        cells_of(F.col("value"), sep, max(size.width, 2)).alias("cells"),
    )
    # A header is a line whose fields are those of the file's own header, all of them and in
    # its order; a row that has such a word as one of its values is a row. Most lines differ in
    # the first field already.
    own_header = (
        F.col("has_header")
        & (normalized(F.get("cells", F.lit(0))) == F.get("names", F.lit(0)))
        & (F.transform(F.slice("cells", F.lit(1), F.size("names")), normalized) == F.col("names"))
    )
    cells = cells.withColumn("shape", F.when(own_header, HEADER).otherwise(F.col("shape")))
    extra = F.map_from_arrays(
        "extra_names", F.transform("extra_at", lambda i: F.get("cells", i))
    )
    named = cells.select(
        "file_path",
        "role",
        "value",
        "shape",
        F.when((F.col("shape") == ROW_OK) & (F.size("extra_at") > 0), extra).alias("extra"),
        *[
            F.get("cells", F.col("at")[name]).alias(_CELLS.get(name, name))
            for name in ALIASES
        ],
    )
    judged = named.select(
        "file_path", "role", "value", "shape", "extra", *_canonical_columns(named)
    ).withColumn("reason", _reason(lo, hi))
    aside = ~F.col("reason").isin(ROW_OK, HEADER)
    return judged.withColumn("value", F.when(aside, F.col("value"))).drop("shape")


def _canonical_columns(df: DataFrame) -> list[Column]:
    """The typed columns of all canonical tables a file can hold, each once."""
    names, columns = set(), []
    for role in ROLES:
        for name, column in zip(CANONICAL[role].names, typed_columns(df, role)):
            if name not in names:
                names.add(name)
                columns.append(column)
    return columns


def quarantine_of(rows: DataFrame) -> DataFrame:
    """(file_path, role, value, reason) of the rows set aside; header lines are not data."""
    return rows.where(~F.col("reason").isin(ROW_OK, HEADER)).select(
        "file_path", "role", "value", "reason"
    )


def usable(rows: DataFrame, role: str) -> DataFrame:
    return rows.where((F.col("role") == role) & (F.col("reason") == ROW_OK))


def canonical_ratings(rows: DataFrame, dedup: bool = True) -> DataFrame:
    table = fallbacks(typed(usable(rows, "ratings"), "ratings"), "ratings")
    return distinct_rows(table) if dedup else table


def canonical_movies(rows: DataFrame) -> DataFrame:
    return fallbacks(clean_movies(usable(rows, "movies"), strip_year=False), "movies")


def canonical_users(rows: DataFrame) -> DataFrame:
    return clean_users(usable(rows, "users"))


def parse_lines(
    lines: DataFrame, dialects: DataFrame, lo: float = 0, hi: float = 10
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Canonical frames by role, and the quarantine."""
    rows = parse_rows(lines, dialects, lo, hi)
    tables = {
        "ratings": canonical_ratings(rows),
        "movies": canonical_movies(rows),
        "users": canonical_users(rows),
    }
    return tables, quarantine_of(rows)


def line_counts(rows: DataFrame, dialects: DataFrame) -> DataFrame:
    """Per file: lines by outcome. Repeated headers are the header lines after the first."""
    counted = rows.groupBy("file_path").agg(
        F.count_if(F.col("reason") == ROW_OK).alias("valid"),
        F.count_if(F.col("reason") == HEADER).alias("headers"),
        F.count_if(~F.col("reason").isin(ROW_OK, HEADER)).alias("quarantined"),
    )
    return dialects.where("role is not null").join(counted, "file_path").select(
        "file_path",
        "role",
        "valid",
        "quarantined",
        (F.col("headers") - F.col("has_header").cast("bigint")).alias("repeated_headers"),
    )
