"""Files of any dialect as a stream: the batch ingestion, one micro-batch at a time.

A micro-batch holds whole files, so their dialects, headers and column profiles are found as in a
folder read at once, each file by its own. A second stream drops repeated ratings by keyed state
that expires, so that neither readers nor the state have to look at everything that ever came.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starboard.operators.cleaning import ROW_OK, typed
from starboard.operators.mapping import fallbacks
from starboard.schemas import CANONICAL, EXTENSIONS
from starboard.session import stage
from starboard.sources.dialects import admission_report, sniff_dialect
from starboard.sources.lines import name_pattern
from starboard.sources.parsing import HEADER, canonical_movies, canonical_users, parse_rows
from starboard.sources.profiles import with_profiles
from starboard.streaming.held import first_within
from starboard.streaming.ratings import start, unsorted_folders

RATING = ("user_id", "movie_id", "rating", "ts")


def _row_schema() -> T.StructType:
    fields = {field.name: field for role in ("ratings", "movies", "users")
              for field in CANONICAL[role].fields}
    return T.StructType([
        T.StructField("file_path", T.StringType()), T.StructField("value", T.StringType()),
        T.StructField("arrived", T.TimestampType()), *fields.values(),
        T.StructField("batch_id", T.LongType()), T.StructField("role", T.StringType()),
        T.StructField("reason", T.StringType())])


_FILES = "file_path string, accepted boolean, role string, reason string, batch_id long"


def read_upload_lines(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """New files of a folder as a stream of lines that know their file and their block."""
    reader = spark.readStream.format("text").option("pathGlobFilter", name_pattern(EXTENSIONS))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(
        "value", F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"))


def ingest_uploads(
    lines: DataFrame, out: str, checkpoint: str, lo: float = 0, hi: float = 10,
    once: bool = True, arrived: Callable[[int], Column] | None = None,
) -> StreamingQuery:
    """Write the rows of every file by batch, role and reason, and what became of the file.

    Nothing in a file stops the stream: rows that cannot be used are set aside with their line
    and reason, and so are whole files without a role. A batch repeated after a failure replaces
    its own folder. Files without any line are not seen by a stream. ``arrived`` gives the time
    at which a batch counts as come in, the present one if left out.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.select("value", "file_path", F.struct(
            "block", F.monotonically_increasing_id().alias("row")).alias("pos"))
        sniffed = stage(sniff_dialect(numbered), "dialects")
        dialects = stage(with_profiles(numbered, sniffed), "profiled")
        report = admission_report(dialects.select("file_path"), dialects)
        report.write.mode("overwrite").parquet(f"{out}/files/batch_id={batch_id}")
        unsorted_folders(batch.sparkSession)
        time = arrived(batch_id) if arrived else F.current_timestamp()
        rows = parse_rows(numbered, dialects, lo, hi).where(F.col("reason") != HEADER)
        rows.drop("extra").withColumn("arrived", time).write.mode("overwrite").partitionBy(
            "role", "reason").parquet(f"{out}/rows/batch_id={batch_id}")

    return start(lines, write, "append", checkpoint, once)


def upload_rows(spark: SparkSession, out: str) -> DataFrame:
    """All rows that have come in, usable and set aside."""
    return spark.read.schema(_row_schema()).option("basePath", f"{out}/rows").parquet(f"{out}/rows")


def upload_files(spark: SparkSession, out: str) -> DataFrame:
    """(file_path, accepted, role, reason, batch_id) of all files that have come in."""
    return spark.read.schema(_FILES).option("basePath", f"{out}/files").parquet(f"{out}/files")


def uploaded_movies(spark: SparkSession, out: str) -> DataFrame:
    return canonical_movies(upload_rows(spark, out))


def uploaded_users(spark: SparkSession, out: str) -> DataFrame:
    return canonical_users(upload_rows(spark, out))


def unique_ratings(spark: SparkSession, out: str, within: str = "7 days") -> DataFrame:
    """Usable ratings that came in, as a stream without those that are repeated.

    A repeat that comes in no later than ``within`` after the first is always left out. State of
    older ones goes as soon as a batch has shown that their time is over, so what is held are the
    ratings of about twice that time and not all that ever came; a repeat of a rating that is no
    longer held is kept once more.
    """
    rows = spark.readStream.schema(_row_schema()).option("basePath", f"{out}/rows").parquet(
        f"{out}/rows")
    usable = rows.where((F.col("role") == "ratings") & (F.col("reason") == ROW_OK))
    ratings = usable.select(*RATING, "arrived").withColumn(
        "ts", F.coalesce("ts", F.lit(0).cast("bigint")))
    return first_within(ratings, RATING, "arrived", within)


def write_unique(
    ratings: DataFrame, out: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Keep the stream of ``unique_ratings``, each batch in a folder of its own."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/unique/batch_id={batch_id}")

    return start(ratings, write, "append", checkpoint, once)


def uploaded_ratings(spark: SparkSession, out: str) -> DataFrame:
    """The ratings that ``write_unique`` has kept. Nothing is compared or sorted here."""
    schema = T.StructType([*CANONICAL["ratings"].fields])
    kept = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{out}/unique")
    return fallbacks(typed(kept, "ratings"), "ratings")
