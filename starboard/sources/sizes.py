"""Broadcasts behind a check of what they weigh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows per file up to this many bytes are sent to every executor; beyond it the planner joins.
BROADCAST_BYTES = 64 * 1024 * 1024


def text_bytes(frame: DataFrame) -> int:
    """Bytes of all values of a frame written out as text, with a little for each row."""
    size = F.octet_length(F.to_json(F.struct(*frame.columns))) + 64
    return frame.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]


def small_enough(frame: DataFrame, most: int | None = None) -> DataFrame:
    """The frame with a broadcast hint if it was measured to be small."""
    most = BROADCAST_BYTES if most is None else most
    return F.broadcast(frame) if text_bytes(frame) <= most else frame
