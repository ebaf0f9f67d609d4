"""Rows that come in again are left out by keyed state that holds many rows under one key.

Spark's own ``dropDuplicatesWithinWatermark`` keeps an entry in the state store for every row: with
the default store some 200 bytes on the heap, twice where two versions are held, and every batch
goes over all of them. Here rows are spread over parts by a hash, and the state of a part is one
block of bytes: its rows sorted, their bytes turned by place and compressed. A part is read and
written where a batch brings rows for it or some of its rows have had their time. Rows go to the
state and back in blocks as well, for Spark handles every single one of them dearly there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# More parts make smaller states to rewrite for few rows, and more calls for many rows.
PARTS = 4096
# Rows of a block on its way, and rows a task gathers before it sorts them into blocks.
BLOCK_ROWS, GATHERED_ROWS = 512, 1 << 19


def first_within(
    rows: DataFrame, keys: Sequence[str], time: str, within: str, parts: int = PARTS
) -> DataFrame:
    """The ``keys`` and the ``time`` of the first row of each key, as a stream.

    As ``withWatermark(time, within).dropDuplicatesWithinWatermark(keys)`` has it: a row whose key
    is held is left out, a key is held until the watermark has reached its time and ``within``,
    and rows behind the watermark are dropped. Of rows that come in one batch the earliest counts.
    Keys are bigint or double and never null. ``parts`` belongs to the checkpoint, as the number
    of shuffle partitions does. Rows of one time travel together, so few times are best.
    """
    kinds, names = dict(rows.dtypes), tuple(keys)
    marked = rows.select(
        F.pmod(F.xxhash64(*names), F.lit(parts)).cast("int").alias("part"),
        F.unix_micros(time).alias("at"), *names)
    blocks = marked.mapInArrow(
        _blocks(names, BLOCK_ROWS, GATHERED_ROWS), "part int, at bigint, block binary")
    timed = blocks.select("part", F.timestamp_micros("at").alias(time), "block")
    first = timed.withWatermark(time, within).groupBy("part").applyInPandasWithState(
        _first_rows(len(names), _delay(rows, within), BLOCK_ROWS, GATHERED_ROWS), "block binary",
        "packed binary", "append", "EventTimeTimeout")
    schema = ", ".join(f"`{name}` {kinds[name]}" for name in names)
    flat = first.mapInArrow(
        _rows(names, tuple(kinds[name] for name in names), GATHERED_ROWS), f"{schema}, at bigint")
    return flat.select(*names, F.timestamp_micros("at").alias(time))


def _delay(rows: DataFrame, within: str) -> int:
    """Microseconds of ``within``, by the rules of the watermark."""
    catalyst = rows.sparkSession._jvm.org.apache.spark.sql.catalyst
    interval = catalyst.util.IntervalUtils.fromIntervalString(within)
    return catalyst.plans.logical.EventTimeWatermark.getDelayMs(interval) * 1000


# What the functions need is inside of them, so that workers need not find this package.


def _packing(width: int) -> tuple[Callable, Callable]:
    """Rows of ``width`` numbers of 64 bits as bytes, and back: bytes of one place side by side."""

    def pack(rows):
        import numpy as np
        import pyarrow as pa

        flat = np.ascontiguousarray(rows).view("u1").reshape(len(rows), width * 8)
        turned = pa.py_buffer(np.ascontiguousarray(flat.T))
        packed = pa.Codec("zstd", compression_level=1).compress(turned, asbytes=True)
        return len(rows).to_bytes(8, "little") + packed

    def unpack(packed):
        import numpy as np
        import pyarrow as pa

        n = int.from_bytes(packed[:8], "little")
        flat = pa.Codec("zstd").decompress(packed[8:], n * width * 8, asbytes=True)
        turned = np.frombuffer(flat, "u1").reshape(width * 8, n)
        return np.ascontiguousarray(turned.T).view("<i8")

    return pack, unpack


def _blocks(keys: tuple[str, ...], block_rows: int, gathered_rows: int) -> Callable:
    """From rows to blocks of one part and time: the bits of the keys, and the microsecond."""
    pack, _ = _packing(len(keys) + 1)

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        def sorted_blocks(gathered):
            part = np.concatenate([batch.column("part").to_numpy() for batch in gathered])
            rows = np.empty((len(part), len(keys) + 1), "<i8")
            for i, name in enumerate((*keys, "at")):
                columns = [batch.column(name).to_numpy() for batch in gathered]
                rows[:, i] = np.concatenate(columns).view("<i8")
            order = np.lexsort((rows[:, -1], part))
            part, rows = part[order], rows[order]
            new = np.ones(len(part), bool)
            new[1:] = (part[1:] != part[:-1]) | (rows[1:, -1] != rows[:-1, -1])
            begun = np.flatnonzero(new)
            place = np.arange(len(part)) - np.repeat(begun, np.diff(begun, append=len(part)))
            starts = np.flatnonzero(place % block_rows == 0)
            packed = [pack(rows[i:j]) for i, j in zip(starts, [*starts[1:], len(part)])]
            return pa.RecordBatch.from_arrays(
                [pa.array(part[starts]), pa.array(rows[starts, -1]), pa.array(packed, pa.binary())],
                ["part", "at", "block"])

        gathered, n = [], 0
        for batch in batches:
            gathered.append(batch)
            n += batch.num_rows
            if n >= gathered_rows:
                yield sorted_blocks(gathered)
                gathered, n = [], 0
        if n:
            yield sorted_blocks(gathered)

    return cut


def _rows(keys: tuple[str, ...], kinds: tuple[str, ...], gathered_rows: int) -> Callable:
    """From blocks to rows."""
    _, unpack = _packing(len(keys) + 1)

    def flat(batches):
        import numpy as np
        import pyarrow as pa

        types = ["<f8" if kind == "double" else "<i8" for kind in (*kinds, "bigint")]

        def columns(blocks):
            rows = np.concatenate(blocks)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(rows[:, i]).view(kind))
                 for i, kind in enumerate(types)], [*keys, "at"])

        blocks, n = [], 0
        for batch in batches:
            for block in batch.column(0):
                blocks.append(unpack(block.as_py()))
                n += len(blocks[-1])
                if n >= gathered_rows // 8:
                    yield columns(blocks)
                    blocks, n = [], 0
        if n:
            yield columns(blocks)

    return flat


def _first_rows(n_keys: int, delay: int, block_rows: int, gathered_rows: int) -> Callable:
    """What is done to a part that has new rows, or whose first row has had its time.

    Its state are the bits of the keys that are held, and the microsecond at which their time ends.
    """
    pack, unpack = _packing(n_keys + 1)

    def keep(part, frames, state):
        import numpy as np
        import pandas as pd

        def merged(held, blocks):
            """Both as columns, the last of which says whether a row is new."""
            came = np.concatenate(blocks)
            both = np.ones((n_keys + 2, held.shape[1] + len(came)), "<i8")
            both[:, :held.shape[1]] = held
            both[:-1, held.shape[1]:] = came.T
            both[n_keys, held.shape[1]:] += delay
            # Of equal keys the one that was held comes first, then the earliest.
            both = both[:, np.lexsort((both[n_keys], both[-1], *both[n_keys - 1::-1]))]
            first = np.ones(both.shape[1], bool)
            first[1:] = (both[:n_keys, 1:] != both[:n_keys, :-1]).any(axis=0)
            return both[:, first]

        rows = np.zeros((n_keys + 2, 0), "<i8")
        if state.exists:
            held = unpack(*state.get)
            rows = np.zeros((n_keys + 2, len(held)), "<i8")
            rows[:-1] = held.T
        blocks, n = [], 0
        for frame in frames:
            for block in frame["block"]:
                blocks.append(unpack(block))
                n += len(blocks[-1])
                if n >= max(gathered_rows, rows.shape[1]):
                    rows, blocks, n = merged(rows, blocks), [], 0
        if blocks:
            rows = merged(rows, blocks)
        fresh = rows[:-1, rows[-1] == 1].T.copy()
        if len(fresh):
            fresh[:, -1] -= delay
            yield pd.DataFrame({"block": [
                pack(fresh[i:i + block_rows]) for i in range(0, len(fresh), block_rows)]})
        now = state.getCurrentWatermarkMs()
        alive = rows[n_keys] > now * 1000
        rows = rows[:-1, alive]
        if not rows.shape[1]:
            if state.exists:
                state.remove()
            return
        if len(fresh) or not alive.all():
            state.update((pack(rows.T),))
        # The part is called again as soon as the watermark is at the first of these ends.
        state.setTimeoutTimestamp(max(-(-int(rows[n_keys].min()) // 1000) - 1, now + 1))

    return keep
