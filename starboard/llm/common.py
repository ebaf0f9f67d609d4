"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starboard.session import stage

# A frame is broadcast only after it was counted and found to have at most so many slim rows.
BROADCAST_ROWS = 500_000
# Keys collected per range to place its borders. Beyond the most ranges they become longer.
SAMPLED_KEYS = 16
MOST_RANGES = 65_536


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small(frame: DataFrame) -> DataFrame:
    """The frame with a broadcast hint if it was counted to be small."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def runs(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Cuts of a batch into runs of rows of about ``most`` bytes of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start, done = 0, 0
    while start < len(ends):
        stop = max(int(np.searchsorted(ends, done + most, side="right")), start + 1)
        yield start, stop
        start, done = stop, ends[stop - 1]


def without_ids(docs: DataFrame, dropped: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the ids in ``dropped`` (one column); a null id is an id like others."""
    gone = stage(dropped.toDF("_gone").distinct(), "dropped")
    return docs.join(small(gone), docs[key].eqNullSafe(gone["_gone"]), "left_anti")


def range_borders(keys: DataFrame, rows_per_range: int) -> list:
    """Borders that cut the sorted non-null keys of a one-column frame into even ranges.

    Only a hashed sample of the keys reaches the driver, ``SAMPLED_KEYS`` for each range and
    at most ``MOST_RANGES`` ranges. The borders decide who computes what, never the result.
    """
    name = keys.columns[0]
    keys = keys.where(F.col(name).isNotNull())
    total = keys.count()
    ranges = min(max(total // rows_per_range, 1), MOST_RANGES)
    if ranges == 1:
        return []
    share = max(total // (ranges * SAMPLED_KEYS), 1)
    seen = sorted(row[0] for row in keys.where(
        F.pmod(F.xxhash64(name, F.lit(7)), F.lit(share)) == 0).collect())
    return sorted({seen[i * len(seen) // ranges] for i in range(1, ranges) if seen})


def range_of(key: Column, borders: list) -> Column:
    """Number of borders at or below the key, looked up in two steps; null counts as lowest."""
    if not borders:
        return F.lit(0)
    step = max(int(len(borders) ** 0.5), 1)
    groups = [borders[i:i + step] for i in range(0, len(borders), step)]
    heads = F.array(*[F.lit(g[0]) for g in groups])
    group = F.size(F.filter(heads, lambda b: b <= key))
    lists = F.array(*[F.array(*[F.lit(b) for b in g]) for g in groups])
    inside = F.size(F.filter(F.element_at(lists, group), lambda b: b <= key))
    return F.when(key.isNull() | (group == 0), 0).otherwise((group - 1) * step + inside)


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); component is the smallest id reachable.

    Labels move along links and then along labels (id -> label of its label), so the number
    of rounds follows the logarithm of the longest path. Each round is a written table.
    """
    both = stage(links.select("a", "b").union(links.select("b", "a")).distinct(), label)
    labels = stage(both.groupBy("a").agg(F.min("b").alias("m"))
                   .select(F.col("a").alias("id"), F.least("a", "m").alias("component")), label)
    while True:
        near = (both.join(labels, both.b == labels.id)
                .groupBy(both.a.alias("n")).agg(F.min("component").alias("m")))
        jump = labels.select(F.col("id").alias("via"), F.col("component").alias("far"))
        moved = stage(labels.join(near, labels.id == near.n)
                      .join(jump, labels.component == jump.via)
                      .select("id", F.least("component", "m", "far").alias("component"),
                              (F.least("m", "far") < F.col("component")).alias("moved")), label)
        labels = moved.select("id", "component")
        if not moved.where("moved").take(1):
            return labels
