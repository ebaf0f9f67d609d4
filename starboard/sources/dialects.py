"""Per-file dialect: delimiter, header, column positions and the table the file holds.

A dialect is data, one row per file, not a plan of its own. So any number of files with
any mix of dialects is read by the same plan, and the driver never loops over files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starboard.functions.columns import case, not_blank
from starboard.operators.mapping import normalized
from starboard.schemas import ALIASES, DATA_NAME_PARTS, DATA_NAMES, HEADER_NAMES
from starboard.sources.lines import first_text

DELIMITERS = ("::", "\t", ",")


def delimiter_of(line: Column) -> Column:
    """The delimiter a line shows: '::' before tab before comma; null if it has none."""
    return case(*[(F.contains(line, F.lit(choice)), choice) for choice in DELIMITERS])


def split_line(line: Column, delimiter: Column) -> Column:
    """Plain split by a delimiter held in a column; each branch has a literal pattern."""
    return case(*[(delimiter == choice, F.split(line, choice, -1)) for choice in DELIMITERS])


def _unquoted(line: Column, sep: Column, width: int) -> Column:
    """The values of a line with quotes, as a struct of ``width`` texts, short lines padded."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    quoted = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true"}
    return F.when(sep == "\t", F.from_csv(line, schema, {**quoted, "sep": "\t"})).otherwise(
        F.from_csv(line, schema, {**quoted, "sep": ","})
    )


def cells_of(value: Column, sep: Column, width: int) -> Column:
    """The fields of a line as an array of texts.

    Delimiters inside double quotes belong to the value. Only lines with a quote need the CSV
    parser, which gives ``width`` fields; '::' files know no quotes.
    """
    line = F.trim(value)
    quoted = (sep != "::") & F.contains(value, F.lit('"'))
    row = F.when(quoted, _unquoted(line, sep, width))
    fields = F.array(*[row[f"c{i}"] for i in range(width)])
    return F.when(quoted, fields).otherwise(split_line(line, sep))


def _literals(names: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(name) for name in names])


def is_header(fields: Column) -> Column:
    return F.arrays_overlap(fields, _literals(HEADER_NAMES))


# A field that is a header name, bare or in quotes, by delimiter.
_HEADER_FIELD = {
    sep: rf"(^|{sep})[\s\"'`]*({'|'.join(HEADER_NAMES)})[\s\"'`]*($|{sep})" for sep in DELIMITERS
}
# Every header name contains one of these: a plain search that spares most lines the pattern.
_HEADER_HINTS = ("id", "rating", "title", "movie", "score")


def is_header_line(line: Column, sep: Column) -> Column:
    """``is_header`` on a whole line with a known delimiter, without cutting it up."""
    low = F.lower(line)
    hint = reduce(Column.__or__, [F.contains(low, F.lit(part)) for part in _HEADER_HINTS])
    return hint & case(*[(sep == choice, low.rlike(_HEADER_FIELD[choice])) for choice in DELIMITERS])


def _position(fields: Column, canonical: str) -> Column:
    """Index of a canonical column among the fields, by its best alias; null if absent."""
    found = [
        F.nullif(F.array_position(fields, alias), F.lit(0).cast("bigint"))
        for alias in ALIASES[canonical]
    ]
    return (F.coalesce(*found) - 1).cast("int")


def _role(at: Column) -> Column:
    def has(name: str) -> Column:
        return at[name].isNotNull()

    return (
        F.when(has("rating"), "ratings")
        .when(has("movie_id") & has("title"), "movies")
        .when(has("user_id") & (has("gender") | has("age")), "users")
    )


def sniff_dialect(lines: DataFrame) -> DataFrame:
    """One row per file with at least one line that is not blank.

    The first such line decides. The set of delimiters seen tells files with mixed
    delimiters apart.
    """
    text = lines.where(not_blank("value")).select(
        "file_path", "pos", F.trim("value").alias("line")
    )
    heads = text.groupBy("file_path").agg(
        first_text("line", "pos").alias("head"),
        F.array_sort(F.collect_set(delimiter_of(F.col("line")))).alias("delimiters_seen"),
        F.count(F.lit(1)).alias("n_lines"),
    )
    head = F.col("head")
    split = heads.withColumn("sep", delimiter_of(head)).withColumn(
        "names", F.transform(split_line(head, F.col("sep")), normalized)
    )
    named = split.withColumn("has_header", F.coalesce(is_header(F.col("names")), F.lit(False)))
    fields = F.when(
        F.col("has_header"), F.col("names")
    ).otherwise(F.transform("names", lambda _, i: F.concat(F.lit("_c"), i.cast("string"))))
    placed = named.withColumn("fields", fields).withColumn(
        "at", F.struct(*[_position(F.col("fields"), name).alias(name) for name in ALIASES])
    )
    known = F.array(*[F.col("at")[name] for name in ALIASES])
    first = F.filter(
        F.sequence(F.lit(0), F.size("fields") - 1),
        lambda i: F.array_position("fields", F.get("fields", i)) == i + 1,
    )
    return (
        placed.withColumn("role", _role(F.col("at")))
        .withColumn("extra_at", F.array_except(first, known))
        .withColumn("extra_names", F.transform("extra_at", lambda i: F.get("fields", i)))
    )


def _known_column(names: Column) -> Column:
    return F.exists(
        names,
        lambda name: name.isin(*DATA_NAMES) | name.rlike(f"({DATA_NAME_PARTS})"),
    )


def admission_report(files: DataFrame, dialects: DataFrame) -> DataFrame:
    """(file_path, accepted, role, reason) for every file, also the empty ones.

    With the dialects of ``sniff_dialect`` alone headerless files have no role; ``with_profiles``
    tells what they hold.
    """
    if "ambiguous" not in dialects.columns:
        dialects = dialects.withColumn("ambiguous", F.lit(False))
    # A listing and a scan spell the path of a local file differently.
    path = F.regexp_replace("file_path", "^file:/+", "file:/")
    judged = files.withColumn("file_path", path).join(
        dialects.withColumn("file_path", path), "file_path", "left"
    )
    reason = (
        F.when(F.col("head").isNull(), "empty_file")
        .when(F.col("sep").isNull(), "no_delimiter")
        .when(F.col("ambiguous"), "ambiguous_columns")
        .when(F.col("role").isNotNull(), None)
        .when(~_known_column(F.col("names")), "no_known_column")
        .otherwise("no_role")
    )
    return judged.select(
        "file_path", reason.isNull().alias("accepted"), "role", reason.alias("reason")
    )
