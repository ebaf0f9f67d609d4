"""Per-dataset result tables, the dataset registry and the views served from them.

Every dataset is a folder of its tables. They are (re)written beside the old ones and switched
together (``starboard.snapshots``), so a rerun leaves the same state, a write that fails leaves
the old one, and two datasets never meet.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starboard import snapshots
from starboard.functions.columns import label_rank
from starboard.operators.analyses import summary_from_ratings
from starboard.operators.mapping import PROFILE_DEFAULTS, default_fill
from starboard.operators.sketches import distinct_sketches, estimates, united
from starboard.plans.analysis import Frames
from starboard.schemas import CANONICAL, DEFAULT_DATASET, MARTS, REGISTRY

REGISTRY_TABLE = "datasets"
SKETCHES = "distinct_sketches"
_CANONICAL_PREFIX = "canonical_"


def checked_id(dataset_id: int) -> int:
    """Dataset ids are whole numbers, never text that could end up in a path or a query."""
    if isinstance(dataset_id, bool) or not isinstance(dataset_id, int) or dataset_id < 0:
        raise ValueError(f"dataset id must be a whole number from 0, not {dataset_id!r}")
    return dataset_id


def dataset_folder(root: str, dataset_id: int) -> str:
    return f"{root.rstrip('/')}/dataset_id={checked_id(dataset_id)}"


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(
        *[F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
    )


def read_all(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """The whole table with its ``dataset_id``; empty if nothing was written yet."""
    full = T.StructType([*schema.fields, T.StructField("dataset_id", T.IntegerType())])
    paths = snapshots.current_of_all(spark, f"{root.rstrip('/')}/dataset_id=*", table)
    if not paths:
        return _empty(spark, full)
    number = F.regexp_extract("_metadata.file_path", r"/dataset_id=([0-9]+)/", 1).cast("int")
    return spark.read.schema(schema).parquet(*paths).select(
        *schema.names, number.alias("dataset_id"))


def _read(
    spark: SparkSession, root: str, table: str, dataset_id: int, schema: T.StructType | None = None
) -> DataFrame | None:
    """A table of one dataset, from its own folder; None if it has none."""
    paths = snapshots.current(spark, dataset_folder(root, dataset_id)).get(table)
    if not paths:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


# ---- writing ---------------------------------------------------------------------------------


def _conformed_marts(marts: Mapping[str, DataFrame]) -> dict[str, DataFrame | None]:
    """Every mart as it is written; None for one that cannot be computed."""
    return {name: _conform(marts[name], schema) if name in marts else None
            for name, schema in MARTS.items()}


def _conformed_tables(frames: Frames) -> dict[str, DataFrame | None]:
    """Every canonical table as it is written: known columns only, in their types."""
    tables = {}
    for table, schema in CANONICAL.items():
        frame = getattr(frames, table)
        known = [] if frame is None else [f for f in schema.fields if f.name in frame.columns]
        tables[_CANONICAL_PREFIX + table] = (
            None if frame is None else _conform(frame, T.StructType(known)))
    return tables


def write_marts(
    spark: SparkSession, marts: Mapping[str, DataFrame], root: str, dataset_id: int
) -> None:
    """Replace the marts of a dataset. A mart that cannot be computed any more goes away."""
    snapshots.replace(spark, dataset_folder(root, dataset_id), _conformed_marts(marts))


def append_mart(df: DataFrame, root: str, name: str, dataset_id: int) -> None:
    """Add rows to a mart without replacing what is there. A rerun repeats its rows."""
    rows = {name: _conform(df, MARTS[name])}
    snapshots.replace(df.sparkSession, dataset_folder(root, dataset_id), rows, append=True)


def write_canonical(frames: Frames, root: str, dataset_id: int) -> None:
    """Replace the canonical tables of a dataset: known columns only, in their types."""
    spark = frames.ratings.sparkSession
    snapshots.replace(spark, dataset_folder(root, dataset_id), _conformed_tables(frames))


def read_canonical(spark: SparkSession, root: str, dataset_id: int) -> Frames:
    """The canonical tables of a dataset; columns it never had are left out."""
    return Frames(**{table: _read(spark, root, _CANONICAL_PREFIX + table, dataset_id)
                     for table in CANONICAL})


def rewrite_dataset(
    frames: Frames, analyze: Callable[[Frames], Mapping[str, DataFrame]], root: str,
    dataset_id: int, name: str | None = None,
) -> Frames:
    """Write a dataset's canonical tables, the marts that ``analyze`` makes of them and the
    registry row, and switch to all of them at once. Returns the written tables.

    If anything fails on the way, the dataset stays as it was.
    """
    spark = frames.ratings.sparkSession
    known = _registered(spark, root, dataset_id)
    with snapshots.Change(spark, dataset_folder(root, dataset_id)) as change:
        change.put(_conformed_tables(frames))
        written = Frames(**{table: change.read(_CANONICAL_PREFIX + table) for table in CANONICAL})
        change.put({**_conformed_marts(analyze(written)), SKETCHES: distinct_sketches(
            written.ratings, written.movies, written.users, written.movie_genres)})
        summary = change.read("dashboard_summary")
        row = _registry_row(spark, dataset_id, name, known, summary, written.ratings)
        change.put({REGISTRY_TABLE: row})
    return written


def export_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = False) -> None:
    df.write.mode("overwrite").option("sep", sep).option("header", header).csv(path)


def write_jdbc(
    df: DataFrame, options: Mapping[str, str], columns: Mapping[str, str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Write to a database table. Address and credentials come from the caller only.

    ``columns`` maps frame columns to table columns, in the order to be written.
    """
    if columns is not None:
        df = df.select(*[F.col(name).alias(target) for name, target in columns.items()])
    settings = {"batchsize": "1000", "truncate": "true", **options}
    df.write.format("jdbc").options(**settings).mode(mode).save()


# ---- registry --------------------------------------------------------------------------------


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    return read_all(spark, root, REGISTRY_TABLE, REGISTRY).withColumnRenamed("dataset_id", "id")


def register_dataset(spark: SparkSession, root: str, name: str) -> int:
    """Enter a dataset under the next free id, with no counts yet.

    The id is taken from the rows present, so registrations have to come one at a time.
    """
    highest = read_registry(spark, root).agg(F.max("id").alias("id")).first()["id"]
    dataset_id = max(highest or 0, DEFAULT_DATASET) + 1
    row = spark.range(1).select(
        F.lit(name).alias("name"),
        *[F.lit(0).alias(c) for c in ("movie_count", "rating_count", "user_count")],
        F.current_timestamp().alias("created_at"),
    )
    _write_registry_row(spark, row, root, dataset_id)
    return dataset_id


def _write_registry_row(spark: SparkSession, row: DataFrame, root: str, dataset_id: int) -> None:
    snapshots.replace(spark, dataset_folder(root, dataset_id),
                      {REGISTRY_TABLE: _conform(row, REGISTRY)})


def _registered(spark: SparkSession, root: str, dataset_id: int) -> Row | None:
    row = _read(spark, root, REGISTRY_TABLE, dataset_id, REGISTRY)
    return None if row is None else row.first()


def _registry_row(
    spark: SparkSession, dataset_id: int, name: str | None, known: Row | None,
    summary: DataFrame | None, ratings: DataFrame | None,
) -> DataFrame:
    totals = None if summary is None else summary.first()
    if totals and totals["total_ratings"] > 0:
        names = {"movie_count": "total_movies", "rating_count": "total_ratings",
                 "user_count": "total_users"}
        counts = {name: totals[total] for name, total in names.items()}
    elif ratings is not None:
        counts = summary_from_ratings(ratings).first().asDict()
    else:
        counts = {}
    row = spark.range(1).select(
        F.lit(name or (known["name"] if known else f"Dataset_{dataset_id}")).alias("name"),
        *[F.lit(counts.get(column, 0)).alias(column)
          for column in ("movie_count", "rating_count", "user_count")],
        (F.lit(known["created_at"]) if known else F.current_timestamp()).alias("created_at"),
    )
    return _conform(row, REGISTRY)


def update_registry(
    spark: SparkSession, root: str, dataset_id: int, name: str | None = None
) -> None:
    """Set the counts of a dataset from its summary, or from its ratings if it has none."""
    checked_id(dataset_id)
    row = _registry_row(
        spark, dataset_id, name, _registered(spark, root, dataset_id),
        _read(spark, root, "dashboard_summary", dataset_id),
        _read(spark, root, _CANONICAL_PREFIX + "ratings", dataset_id))
    _write_registry_row(spark, row, root, dataset_id)


def delete_dataset(spark: SparkSession, root: str, dataset_id: int) -> None:
    """Drop marts, canonical tables and registry row. The default dataset is protected.

    The manifest goes first: from then on readers find no dataset, whole or in part.
    """
    if checked_id(dataset_id) == DEFAULT_DATASET:
        raise ValueError("the default dataset cannot be deleted")
    folder = dataset_folder(root, dataset_id)
    snapshots.remove(spark, f"{folder}/{snapshots.MANIFEST}")
    snapshots.remove(spark, folder)


# ---- serving ---------------------------------------------------------------------------------


def read_mart(spark: SparkSession, root: str, name: str, dataset_id: int) -> DataFrame:
    """The rows of one dataset, from its own folder: no other dataset is even listed."""
    mart = _read(spark, root, name, dataset_id, MARTS[name])
    return _empty(spark, MARTS[name]) if mart is None else mart


def write_sketches(frames: Frames, root: str, dataset_id: int) -> None:
    """Replace the distinct-count sketches of a dataset."""
    sketches = distinct_sketches(frames.ratings, frames.movies, frames.users, frames.movie_genres)
    snapshots.replace(frames.ratings.sparkSession, dataset_folder(root, dataset_id),
                      {SKETCHES: sketches})


def united_counts(
    spark: SparkSession, root: str, dataset_ids: Sequence[int] | None = None
) -> DataFrame:
    """(measure, label, estimate): different users and movies of several datasets taken together,
    or of all, from their sketches alone."""
    schema = T.StructType([T.StructField("measure", T.StringType()),
                           T.StructField("label", T.StringType()),
                           T.StructField("sketch", T.BinaryType())])
    stored = read_all(spark, root, SKETCHES, schema)
    if dataset_ids is not None:
        stored = stored.where(F.col("dataset_id").isin([checked_id(i) for i in dataset_ids]))
    return estimates(united(stored))


# Fixed value: rows in the views of top movies and occupations.
VIEW_ROWS = 20


def serve(mart: DataFrame, name: str, k: int | None = VIEW_ROWS) -> DataFrame:
    """A mart in the order and shape in which it is shown.

    Top movies and occupations are lists of the first ``k`` rows, or of all with ``None``.
    """
    most = (lambda shown: shown) if k is None else (lambda shown: shown.limit(k))
    if name == "rating_distribution":
        return mart.orderBy("score")
    if name == "top_movies":
        return most(mart.orderBy(F.desc("avg_rating"), F.desc("rating_count"), "movie_name"))
    if name == "genre_stats":
        return mart.orderBy(F.desc("movie_count"), "genre_name")
    if name == "active_users":
        shown = default_fill(mart, PROFILE_DEFAULTS)
        shown = shown.withColumn("age", F.col("age").cast("string"))
        return shown.orderBy(F.desc("rating_count"), "user_id")
    if name == "gender_comparison":
        return mart.orderBy("gender")
    if name == "age_group_stats":
        return mart.orderBy(label_rank("age_group"), "age_group")
    if name == "occupation_stats":
        return most(mart.orderBy(F.desc("rating_count"), "occupation"))
    if name == "dashboard_summary":
        return mart.limit(1)
    raise ValueError(f"no mart named {name!r}")


def mart_view(
    spark: SparkSession, root: str, name: str, dataset_id: int, k: int | None = VIEW_ROWS
) -> DataFrame:
    return serve(read_mart(spark, root, name, dataset_id), name, k)


def list_datasets(spark: SparkSession, root: str) -> DataFrame:
    return read_registry(spark, root).select(
        "id", "name", "movie_count", "rating_count", "user_count"
    ).orderBy("id")


def status_of(registry: DataFrame, summaries: DataFrame) -> DataFrame:
    """(id, status): ready once the summary of a dataset has a row; the default always is."""
    done = summaries.groupBy(F.col("dataset_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    ready = (F.col("id") == DEFAULT_DATASET) | F.col("n").isNotNull()
    return registry.select("id").join(done, "id", "left").select(
        "id", F.when(ready, "ready").otherwise("analyzing").alias("status")
    )


def dataset_status(spark: SparkSession, root: str) -> DataFrame:
    summaries = read_all(spark, root, "dashboard_summary", MARTS["dashboard_summary"])
    return status_of(read_registry(spark, root), summaries)


def dataset_badge(registry: DataFrame) -> DataFrame:
    badge = (
        F.when(F.col("id") == DEFAULT_DATASET, "default")
        .when(F.col("rating_count") > 0, "analysed")
        .otherwise("not_analysed")
    )
    return registry.select("id", badge.alias("badge"))


# Sections of a briefing in their order: mart, columns, whether it is a list of the first rows.
_BRIEFING: tuple[tuple[str, Sequence[str], bool], ...] = (
    ("dashboard_summary", ("total_movies", "total_ratings", "total_users", "avg_rating"), False),
    ("rating_distribution", ("score", "count", "percentage"), False),
    ("genre_stats", ("genre_name", "movie_count", "avg_rating", "rating_count"), True),
    ("top_movies", ("movie_name", "avg_rating", "rating_count"), True),
    ("gender_comparison",
     ("gender", "user_count", "rating_count", "avg_rating", "high_rate_pct"), False),
    ("age_group_stats", ("age_group", "user_count", "rating_count", "avg_rating"), False),
    ("occupation_stats", ("occupation", "user_count", "rating_count", "avg_rating"), True),
)

# Fixed value: rows of a list in a briefing.
BRIEFING_ROWS = 10


_BRIEFING_SCHEMA = T.StructType(
    [
        T.StructField("section", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("line", T.LongType()),
        T.StructField("content", T.StringType()),
    ]
)


def briefing_of(marts: Mapping[str, DataFrame], k: int | None = BRIEFING_ROWS) -> DataFrame:
    """(section, name, line, content): the marts of a dataset as JSON lines to read out.

    One row per line, so that nothing has to fit into a single value; marts that are
    missing or empty leave no line. Genres, movies and occupations are lists of the first ``k``
    rows, or of all with ``None``.
    """
    sections = []
    for number, (name, columns, listed) in enumerate(_BRIEFING, start=1):
        if name not in marts:
            continue
        shown = serve(marts[name], name, None)
        shown = shown.limit(k) if listed and k is not None else shown
        content = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        sections.append(
            shown.select(
                F.lit(number).alias("section"), F.lit(name).alias("name"),
                F.monotonically_increasing_id().alias("line"), content.alias("content"),
            )
        )
    briefing = sections[0]
    for section in sections[1:]:
        briefing = briefing.unionAll(section)
    return briefing.orderBy("section", "line")


def dataset_briefing(
    spark: SparkSession, root: str, dataset_id: int, k: int | None = BRIEFING_ROWS
) -> DataFrame:
    there = snapshots.current(spark, dataset_folder(root, dataset_id))
    names = [name for name, _, _ in _BRIEFING if name in there]
    if not names:
        return _empty(spark, _BRIEFING_SCHEMA)
    return briefing_of({name: read_mart(spark, root, name, dataset_id) for name in names}, k)
