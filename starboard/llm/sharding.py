"""Sharding by fixed virtual slots.

Records are hashed into thousands of slots that never change. What is kept is a small,
versioned map from slots to shards; rebalancing and growing write a new version of the map
in which few slots have another shard, and records follow their slot.
"""

from __future__ import annotations

import bisect
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from starboard.llm.common import small
from starboard.session import scratch_path, stage

SLOTS = 16_384
MAP_SCHEMA = "version int, slot int, shard int, bytes long, n_rows long"
# Shards count as even when their bytes differ by at most this share of their mean.
TOLERANCE = 0.0005


def slot_of(*key: Column, slots: int = SLOTS) -> Column:
    """Slot of a record by its key columns; records of the same ones share a slot."""
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


def slot_weights(records: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows per slot of records (slot, size): one row per slot reaches the driver."""
    found = records.groupBy("slot").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    return {row["slot"]: (row["b"], row["n"]) for row in found.collect()}


def first_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Version 1: slots dealt in turn."""
    return [slot % shards for slot in range(slots)]


def rebalance(owner: list[int], weights: list[int], shards: int) -> list[int]:
    """The map after moving few slots so that the shards' weights become nearly equal.

    The heaviest shard gives the lightest the slot nearest to half their difference, or
    swaps two slots for it; both lower the sum of squares, so this ends.
    """
    owner = list(owner)
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(owner):
        if weights[slot]:
            held[shard].append((weights[slot], slot))
    for pieces in held:
        pieces.sort()
    load = [sum(w for w, _ in pieces) for pieces in held]
    enough = max(1, TOLERANCE * sum(load) / shards)

    def nearest(pieces, wanted):
        at = bisect.bisect_left(pieces, (wanted, -1))
        return min(pieces[max(at - 1, 0):at + 1], key=lambda p: abs(p[0] - wanted), default=None)

    def hand_over(piece, giver, taker):
        held[giver].remove(piece)
        bisect.insort(held[taker], piece)
        owner[piece[1]] = taker
        load[giver] -= piece[0]
        load[taker] += piece[0]

    while True:
        high, low = load.index(max(load)), load.index(min(load))
        gap = load[high] - load[low]
        if gap <= enough:
            return owner
        single = nearest(held[high], gap / 2)
        if single and 0 < single[0] < gap and abs(single[0] - gap / 2) <= gap / 4:
            hand_over(single, high, low)
            continue
        best = (single[0], single, None) if single and single[0] < gap else None
        for piece in held[high]:
            back = nearest(held[low], piece[0] - gap / 2)
            if back and 0 < piece[0] - back[0] < gap:
                difference = piece[0] - back[0]
                if best is None or abs(difference - gap / 2) < abs(best[0] - gap / 2):
                    best = (difference, piece, back)
        if best is None:
            return owner
        hand_over(best[1], high, low)
        if best[2]:
            hand_over(best[2], low, high)


def grow(owner: list[int], weights: list[int], shards: int) -> list[int]:
    """The map with one more shard: slots move only into the new one, up to its fair share."""
    owner, load = list(owner), [0] * (shards + 1)
    for slot, shard in enumerate(owner):
        load[shard] += weights[slot]
    fair = sum(load) / (shards + 1)
    for slot in sorted(range(len(owner)), key=lambda s: (-weights[s], s)):
        giver, weight = owner[slot], weights[slot]
        if load[giver] - weight >= fair * 0.98 and load[shards] + weight <= fair:
            owner[slot] = shards
            load[giver] -= weight
            load[shards] += weight
    return owner


def save_map(spark: SparkSession, path: str, version: int, owner: list[int],
             weights: dict[int, tuple[int, int]]) -> None:
    """Append one version of the map; versions already written stay as they are."""
    rows = [(version, slot, shard, *weights.get(slot, (0, 0))) for slot, shard in enumerate(owner)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, the latest by default; ``slots`` rows."""
    stored = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == version)


def shard_documents(docs: DataFrame, shards: int = 8, slots: int = SLOTS,
                    map_path: str | None = None) -> DataFrame:
    """Shard and place of every row of ``docs`` (doc_id, text), by bytes.

    Returns doc_id, size (UTF-8 bytes of the text, none for null, plus 1), text_crc32 (of an
    empty text for null), law ``bytes``, shard, slot (place within the shard, gapless from 0),
    grown_shard (null), virtual_slot and map_version. A row's virtual slot follows from its doc_id
    and text; rows that repeat both, or have no id and the same text, are numbered and spread over
    all slots, so that bytes stay even. Each row has a place. An empty table gives no rows.

    The driver holds ``slots`` numbers. Places are numbered within virtual slots, which are
    small and even, and moved by the rows of the shard's slots before them.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    key = ["doc_id", "text_crc32", "size"]
    read = stage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row")), "shard-rows")
    repeated = stage(read.groupBy(key).count().where("count > 1").select(
        *[F.col(name).alias(f"_{name}") for name in key]), "shard-repeated")
    same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in key])
    number = F.when(F.col("_size").isNotNull(), F.col("row"))
    records = stage(read.join(small(repeated), same, "left").select(
        *key, "row", slot_of(*map(F.col, key), number, slots=slots).alias("virtual_slot")),
        "shard-records")
    weights = slot_weights(records.select(F.col("virtual_slot").alias("slot"), "size"))
    path = map_path or scratch_path(spark, "shard-map")
    start, sizes = first_map(shards, slots), [weights.get(s, (0, 0))[0] for s in range(slots)]
    save_map(spark, path, 1, start, weights)
    save_map(spark, path, 2, rebalance(start, sizes, shards), weights)

    chosen = load_map(spark, path)
    before = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    places = F.broadcast(chosen.select(
        F.col("slot").alias("virtual_slot"), "shard", F.col("version").alias("map_version"),
        F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("first_place")))
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "row")
    return records.withColumn("nth", F.row_number().over(inside) - 1).join(
        places, "virtual_slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first_place") + F.col("nth")).cast("long").alias("slot"),
        F.lit(None).cast(T.IntegerType()).alias("grown_shard"), "virtual_slot", "map_version")
