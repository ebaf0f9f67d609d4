"""Canonical tables and marts as tables of the catalog, one partition per dataset.

Where a warehouse has a catalog, other users find the results there by name. Each table is stored
as Parquet, partitioned by dataset id; publishing a dataset replaces its partitions and no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starboard.plans import marts as M
from starboard.schemas import CANONICAL, DEFAULT_DATASET, MARTS

PARTITION = "dataset_id"


def _tables() -> dict[str, T.StructType]:
    return {**{f"canonical_{name}": schema for name, schema in CANONICAL.items()}, **MARTS}


def _checked_database(database: str) -> str:
    """Names of databases are words, never text that could end up in a statement."""
    if not database.isidentifier():
        raise ValueError(f"a database has a plain name, not {database!r}")
    return database


def _table(database: str, name: str) -> str:
    return f"{_checked_database(database)}.{name}"


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database and its empty tables where they are missing.

    Its files lie below ``location``, or in the warehouse where none is given.
    """
    place = "" if location is None else " location '" + location.replace("'", "\\'") + "'"
    spark.sql(f"create database if not exists {_checked_database(database)}{place}")
    for name, schema in _tables().items():
        if not spark.catalog.tableExists(_table(database, name)):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            spark.sql(f"create table {_table(database, name)} ({columns}, {PARTITION} int) "
                      f"using parquet partitioned by ({PARTITION})")


def _insert(
    spark: SparkSession, frame: DataFrame | None, database: str, name: str, dataset_id: int
) -> None:
    """Replace the partition of a dataset; without a frame there is none."""
    if frame is None:
        _drop_partition(spark, database, name, dataset_id)
        return
    # Columns a dataset never had are null in the table.
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in frame.columns
               else F.lit(None).cast(f.dataType).alias(f.name) for f in _tables()[name].fields]
    spark.sql(f"insert overwrite table {_table(database, name)} partition "
              f"({PARTITION}={M.checked_id(dataset_id)}) select * from {{rows}}",
              rows=frame.select(*columns))


def _drop_partition(spark: SparkSession, database: str, name: str, dataset_id: int) -> None:
    spark.sql(f"alter table {_table(database, name)} drop if exists partition "
              f"({PARTITION}={M.checked_id(dataset_id)})")


def publish(
    spark: SparkSession, root: str, dataset_id: int, database: str, location: str | None = None
) -> None:
    """Put a dataset's canonical tables and marts into the tables of the catalog.

    What the dataset does not have, or has no more, is not there either. Rows of other datasets
    are not read or moved.
    """
    create_tables(spark, database, location)
    frames = M.read_canonical(spark, root, M.checked_id(dataset_id))
    for name in CANONICAL:
        _insert(spark, getattr(frames, name), database, f"canonical_{name}", dataset_id)
    for name in MARTS:
        mart = M.read_mart(spark, root, name, dataset_id)
        _insert(spark, None if mart.isEmpty() else mart, database, name, dataset_id)


def published(spark: SparkSession, database: str, name: str, dataset_id: int) -> DataFrame:
    """One dataset's rows of a table, from its partition alone."""
    rows = spark.table(_table(database, name))
    return rows.where(F.col(PARTITION) == M.checked_id(dataset_id)).drop(PARTITION)


def withdraw(spark: SparkSession, dataset_id: int, database: str) -> None:
    """Drop a dataset's partitions from all tables. The default dataset is protected."""
    if M.checked_id(dataset_id) == DEFAULT_DATASET:
        raise ValueError("the default dataset cannot be withdrawn")
    for name in _tables():
        if spark.catalog.tableExists(_table(database, name)):
            _drop_partition(spark, database, name, dataset_id)


def drop_tables(spark: SparkSession, database: str) -> None:
    """Drop the database with all its tables."""
    spark.sql(f"drop database if exists {_checked_database(database)} cascade")
