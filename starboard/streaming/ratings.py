"""Rating files and events as streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starboard import snapshots
from starboard.functions.columns import not_blank, score_bucket
from starboard.operators.cleaning import ROW_OK, distinct_rows, judge_ratings, typed
from starboard.operators.mapping import fallbacks, map_aliases, normalized
from starboard.schemas import CANONICAL, EXTENSIONS, KNOWN_NAMES
from starboard.session import stage
from starboard.sources.dialects import DELIMITERS, is_header_line, split_line
from starboard.sources.lines import name_pattern
from starboard.sources.parsing import TOO_FEW_FIELDS


def read_rating_lines(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """New rating files of a folder as a stream of lines."""
    reader = spark.readStream.format("text").option("pathGlobFilter", name_pattern(EXTENSIONS))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def parse_rating_lines(
    lines: DataFrame, columns: Sequence[str], sep: str = ",", lo: float = 0, hi: float = 10
) -> DataFrame:
    """Typed and judged rating rows of files with declared columns and delimiter.

    For files that are all laid out alike; ``starboard.streaming.uploads`` finds the layout of
    each. Lines with just the declared names are headers and dropped, wherever they stand. A line
    of nothing but names of columns, though not the declared ones, stops the stream, since the
    rows below it would have their columns swapped. A row that has such a word among its values
    is a row. ``value`` is the line of a row set aside.
    """
    if sep not in DELIMITERS:
        raise ValueError(f"delimiter must be one of {DELIMITERS}, not {sep!r}")
    names = {"time": "ts"}
    targets = {name: names.get(known, known) for name, known in map_aliases(columns).items()}
    schema = ", ".join(f"`{name}` string" for name in columns)
    options = {
        "sep": sep, "quote": "" if sep == "::" else '"', "escape": '"',
        "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
    }
    line = F.col("line")
    declared = F.array(*[normalized(F.lit(name)) for name in columns])
    # Most lines hold no header name at all and are not cut up for the comparison.
    hinted = is_header_line(line, F.lit(sep))
    fields = F.transform(split_line(line, F.lit(sep)), normalized)
    header = hinted & (fields == declared)
    headed = hinted & F.forall(fields, lambda name: name.isin(*KNOWN_NAMES))
    other = F.raise_error(F.concat(F.lit("header differs from the declared columns: "), line))
    rows = (
        lines.where(not_blank("value"))
        .select("value", F.trim("value").alias("line"))
        .where(~header)
        .withColumn("line", F.when(headed, other).otherwise(line))
        .withColumn("row", F.from_csv("line", schema, options))
        .withColumn("short", ~F.contains("line", F.lit(sep)))
    )
    cells = rows.select(
        "value", "short", *[F.col("row")[name].alias(target) for name, target in targets.items()]
    )
    judged = judge_ratings(cells, lo, hi).withColumn(
        "reason", F.when(F.col("raw.short"), TOO_FEW_FIELDS).otherwise(F.col("reason")))
    return judged.withColumn("value", F.when(F.col("reason") != ROW_OK, F.col("raw.value"))).drop(
        "raw"
    )


def stream_ingest(
    judged: DataFrame, out: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Write judged rows batch by batch, usable ones and the quarantine side by side.

    Each batch replaces its own folder, so a batch that is repeated after a failure
    leaves no row twice. The folders below it by reason come from the same single pass.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        path = f"{out}/batch_id={batch_id}"
        unsorted_folders(batch.sparkSession)
        batch.write.mode("overwrite").partitionBy("reason").parquet(path)

    return start(judged, write, "append", checkpoint, once)


_INGESTED = T.StructType(
    [
        *CANONICAL["ratings"].fields,
        T.StructField("value", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("reason", T.StringType()),
    ]
)


def ingested(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """What ``stream_ingest`` has written so far: canonical ratings, and the quarantine.

    As in a folder read at once, a rating that came in repeatedly counts once.
    """
    rows = spark.read.schema(_INGESTED).parquet(out)
    good = fallbacks(typed(rows.where(F.col("reason") == ROW_OK), "ratings"), "ratings")
    return distinct_rows(good), rows.where(F.col("reason") != ROW_OK).select("value", "reason")


def stream_distribution(ratings: DataFrame, bucket: str = "trunc") -> DataFrame:
    """Ratings per score as a running result."""
    return ratings.groupBy(score_bucket("rating", bucket).alias("score")).agg(
        F.count(F.lit(1)).alias("count")
    )


def stream_activity(
    events: DataFrame, time: str = "ts", window: str = "1 day", late: str = "1 hour"
) -> DataFrame:
    """Events per tumbling window of event time; later than ``late`` is left out."""
    return (
        events.withWatermark(time, late)
        .groupBy(F.window(time, window).alias("period"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            F.col("period.start").alias("window_start"),
            F.col("period.end").alias("window_end"),
            "count",
        )
    )


def write_result(
    result: DataFrame, out: str, checkpoint: str, mode: str = "complete", once: bool = True,
    keys: Sequence[str] = (),
) -> StreamingQuery:
    """Keep a running result as a table that ``read_result`` reads at any time.

    Complete mode writes the whole result, update mode the last table with the rows that have
    changed in place of those of the same ``keys``, append mode adds the new rows. Every batch is
    written beside the table and switched to, so readers see one batch or the next, never half a
    table, and a batch that comes again after a failure changes nothing.
    """
    if mode == "update" and not keys:
        raise ValueError("update mode needs the keys by which changed rows replace others")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = snapshots.note(spark, out).get("batch_id", -1)
        if batch_id <= done:
            # Already in the table; its rows are computed all the same, for the stream's state.
            batch.write.format("noop").mode("overwrite").save()
            return
        old = read_result(spark, out) if mode == "update" else None
        if old is not None:
            changed = stage(batch, "changed")
            kept = old.join(changed.select(*keys).distinct(), list(keys), "left_anti")
            batch = kept.select(*changed.columns).unionByName(changed)
        snapshots.replace(spark, out, {RESULT: batch}, mode == "append", {"batch_id": batch_id})

    return start(result, write, mode, checkpoint, once)


RESULT = "result"


def read_result(spark: SparkSession, out: str) -> DataFrame | None:
    """The table that ``write_result`` has kept last; None before its first batch."""
    paths = snapshots.current(spark, out).get(RESULT)
    return spark.read.parquet(*paths) if paths else None


# More folders than there are of role and reason.
MOST_FOLDERS = 32


def unsorted_folders(spark: SparkSession) -> None:
    """Let a batch's tasks write the rows of few folders as they come.

    Otherwise every task sorts its rows by their folder first, and spills them. The session is the
    stream's own, not the caller's.
    """
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(MOST_FOLDERS))


def start(df: DataFrame, write, mode: str, checkpoint: str, once: bool) -> StreamingQuery:
    """Start a stream with a writer for its batches, to run through once or to go on."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(write)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
