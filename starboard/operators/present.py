"""Shapes in which a mart is shown: JSON rows, slices, shares and mean lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starboard.functions.columns import percent


def json_rows(df: DataFrame) -> DataFrame:
    """Each row as a JSON object. Nulls are kept, numbers stay numbers, text stays text."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def top_n_slice(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def share_of_slice(df: DataFrame, value: str) -> DataFrame:
    """Percentage of each row within the shown rows, which are few: one window holds them all."""
    whole = Window.partitionBy()
    return df.withColumn("share_pct", percent(value, F.sum(value).over(whole)))


def mean_line(df: DataFrame, value: str) -> DataFrame:
    """The mean of the shown values beside every row."""
    return df.withColumn("mean_value", df.agg(F.avg(value)).scalar())
