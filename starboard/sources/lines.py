"""Line scan over the delimited files of a dataset folder, of whatever dialect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starboard.functions.columns import ColumnLike
from starboard.schemas import EXTENSIONS


def name_pattern(exts: Sequence[str] = EXTENSIONS) -> str:
    return "*.{" + ",".join(exts) + "}"


def list_files(spark: SparkSession, path: str, exts: Sequence[str] = EXTENSIONS) -> DataFrame:
    """(file_path) of the accepted files, empty ones included.

    A scan passes over empty files, so the names come from the listing that the driver
    makes for every scan anyway. No content is read.
    """
    listed = spark.read.option("pathGlobFilter", name_pattern(exts)).text(path).inputFiles()
    return spark.createDataFrame([(name,) for name in listed], "file_path string")


def scan_lines(
    spark: SparkSession, path: str | list[str], exts: Sequence[str] = EXTENSIONS
) -> DataFrame:
    """(value, file_path, pos) for every line of a folder, or of some paths; ``pos`` orders the lines within a file.

    Files are split, so the order is by block first and by row within the task second.
    A byte order mark is dropped by the text reader.
    """
    lines = spark.read.option("pathGlobFilter", name_pattern(exts)).text(path)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("pos"),
    )


def first_text(text: ColumnLike, pos: ColumnLike) -> Column:
    """The text at the least position, as an aggregate for which lines are hashed by their file.

    ``min_by`` alone keeps a text in its buffer, for which Spark sorts all lines of a task. An
    object aggregate beside it makes it hash; it is part of the value, so that it is not pruned
    where only some columns of the result are read.
    """
    seen = F.collect_set(F.lit(True))
    return F.when(F.size(seen) > 0, F.min_by(text, pos))
