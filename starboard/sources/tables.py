"""Readers of files and tables whose layout is known beforehand."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starboard.functions.columns import not_blank, strip
from starboard.operators.cleaning import (
    clean_movies,
    clean_ratings,
    decode_users,
    distinct_rows,
    require_keys,
    typed,
)
from starboard.operators.mapping import fallbacks, normalized
from starboard.schemas import ALIASES, CANONICAL, HEADER_NAMES, RAW_COLUMNS
from starboard.session import stage
from starboard.sources.dialects import cells_of, split_line
from starboard.sources.lines import first_text
from starboard.sources.sizes import small_enough


def _headed(
    spark: SparkSession, paths: str | Sequence[str], sep: str
) -> tuple[DataFrame, DataFrame]:
    """(file_path, names) of files of one delimiter, and (names, cells) of the lines below.

    The first line of each file that is not blank is its header, wherever the file is split; lines
    with the same fields further down are headers too. Headers are one row per file, broadcast if
    they are measured to be small.
    """
    lines = spark.read.text(paths).where(not_blank("value")).select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row")).alias("pos"))
    heads = stage(lines.groupBy("file_path").agg(
        first_text(F.trim("value"), "pos").alias("head")), "heads")
    fields = F.size(split_line(F.col("head"), F.lit(sep)))
    width = max(heads.agg(F.max(fields)).first()[0] or 0, 2)

    def name(cell: Column) -> Column:
        return F.coalesce(normalized(cell), F.lit(""))

    heads = heads.select("file_path", F.transform(
        cells_of(F.col("head"), F.lit(sep), width), name).alias("names"))
    cut = lines.select("value", "file_path").join(small_enough(heads), "file_path").select(
        "names", cells_of(F.col("value"), F.lit(sep), width).alias("cells"))
    # Most lines differ in the first field already.
    header = (name(F.get("cells", F.lit(0))) == F.get("names", F.lit(0))) & (
        F.transform(F.slice("cells", F.lit(1), F.size("names")), name) == F.col("names"))
    return heads, cut.where(~header)


def _cell(aliases: Sequence[str]) -> Column:
    """The text below the first of some names that a line's file has; null if it has none."""
    places = [F.nullif(F.array_position("names", name), F.lit(0).cast("bigint"))
              for name in aliases]
    place = (F.coalesce(*places) - 1).cast("int")
    return F.nullif(strip(F.get("cells", place)), F.lit(""))


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A canonical table from CSV files with a header row, quoted values allowed.

    Each file's header names its columns, whatever their order. Columns a file does not have and
    values that do not fit are null.
    """
    _, cells = _headed(spark, path, ",")
    texts = cells.select(*[
        _cell(("timestamp", "ts") if name == "ts" else (name,)).alias(name)
        for name in CANONICAL[table].names])
    return typed(texts, table)


def read_dialect(spark: SparkSession, paths: Sequence[str], sep: str) -> DataFrame:
    """Header files of one delimiter, columns under canonical names, all values as text.

    Each file is read by its own header; a column that a file does not have is null there. The
    names found in the headers come to the driver, each once.
    """
    heads, cells = _headed(spark, list(paths), sep)
    found = [row[0] for row in heads.select(F.posexplode("names").alias("at", "name"))
             .groupBy("name").agg(F.min("at").alias("at")).orderBy("at", "name")
             .select("name").collect() if row[0]]
    # The best name of a canonical column stands for all others that a file may have for it.
    known = {name: canonical for canonical, names in ALIASES.items() for name in names}
    columns = dict.fromkeys(known.get(name, name) for name in found)
    return cells.select(*[_cell(ALIASES.get(name, (name,))).alias(name) for name in columns])


# Stands for a replacement character that a line came with, while bad bytes are made such.
_KEPT = "\x01\x02\x01"


def readable(text: str) -> Column:
    """The text without bytes that are no UTF-8; a replacement character it came with stays."""
    marked = F.replace(text, F.lit("\ufffd"), F.lit(_KEPT))
    repaired = F.replace(F.make_valid_utf8(marked), F.lit("\ufffd"), F.lit(""))
    return F.when(F.is_valid_utf8(text), F.col(text)).otherwise(
        F.replace(repaired, F.lit(_KEPT), F.lit("\ufffd")))


def raw_lines(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Text columns of a headerless '::' file; blank, header and short lines are dropped, and so
    are bytes that are no UTF-8."""
    names = RAW_COLUMNS[kind]
    parts = F.split(F.col("line"), "::", -1)
    rows = (
        spark.read.text(path)
        .select(strip(readable("value")).alias("line"))
        .where("line <> ''")
        .select(parts.alias("parts"))
        .where(F.size("parts") >= len(names))
        .where(~normalized(F.col("parts")[0]).isin(*HEADER_NAMES))
    )
    return rows.select(*[F.col("parts")[i].alias(name) for i, name in enumerate(names)])


def read_raw_dat(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A canonical table from a headerless '::' file of ratings, movies or users."""
    rows = raw_lines(spark, path, kind)
    if kind == "ratings":
        strict = ("user_id", "movie_id", "ts")
        return clean_ratings(rows.withColumnRenamed("timestamp", "ts"), 1, 5, strict)[0]
    if kind == "movies":
        return fallbacks(clean_movies(rows.withColumnRenamed("genres", "genres_raw")), "movies")
    return distinct_rows(require_keys(decode_users(rows), "user_id"))


def catalog_counts(
    spark: SparkSession, database: str | None = None, pattern: str | None = None
) -> DataFrame:
    """(tbl, cnt) of every table and view the catalog lists, or of those named by ``pattern``."""
    names = [table.name if table.isTemporary or not table.namespace
             else ".".join([*table.namespace, table.name])
             for table in spark.catalog.listTables(database, pattern)]
    if not names:
        return spark.createDataFrame([], "tbl string, cnt bigint")
    counts = [
        spark.table(name).agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("tbl"), "cnt")
        for name in names
    ]
    return reduce(DataFrame.unionAll, counts)


def preview(spark: SparkSession, table: str, rows: int = 5) -> DataFrame:
    return spark.table(table).limit(rows)
