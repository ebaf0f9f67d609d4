"""The trie of conversation prefixes, by ROLLUP over positional columns of turn ids.

A turn's id is the digest of its role and text. The first turns of a conversation stand in the
columns of a first block, the following ones in those of further blocks. One ROLLUP over a block's
columns aggregates all prefixes that end in it, told apart by ``grouping_id``; a conversation that
goes on does so in the next block under its node, which is named by its smallest member. A second
ROLLUP, over the nodes from the last block back to the first, sums what lies below every node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starboard.session import stage

# Columns of the first, second and all further blocks. Short conversations, which most are, need
# one narrow block; a long one needs as many rounds as blocks.
WIDTHS = (8, 16, 32)
# A turn id: 32 bytes of digest and 8 of the text's length.
ID_BYTES = 40
# At most so many neighbouring ids (a power of two) are written out in one group.
IDS_TOGETHER_BITS = 12


def turn_id(role: Column, text: Column) -> Column:
    """Digest of role and text with the text's UTF-8 bytes; null counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    size = F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")
    return F.unhex(F.concat(F.sha2(both.cast("binary"), 256), size))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, turn_id, n_turns) of all rows (conv_id, turn, role, text).

    Positions count from 0 by turn, null first, then role and text. Rows without conv_id belong
    to no conversation and are left out. Rows are sorted over all tasks together and counted from
    the start of their part, so a conversation with a large share of the rows is many parts.
    """
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(),
             F.col("text").asc()]
    parts = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", turn_id(F.col("role"), F.col("text")).alias("turn_id"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")),
        "turns")
    by_conversation = Window.partitionBy("conv_id")
    before = by_conversation.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = parts.groupBy("conv_id", "part").agg(
        F.min("at").alias("first"), F.count("*").alias("n")).select(
        "conv_id", "part", "first", F.sum("n").over(by_conversation).alias("n_turns"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return parts.join(firsts, ["conv_id", "part"]).select(
        "conv_id", (F.col("before") + F.col("at") - F.col("first")).alias("position"),
        "turn_id", "n_turns")


def _starts(longest: int, widths: Sequence[int]) -> list[tuple[int, int]]:
    """(first position, columns) of the blocks for conversations of up to ``longest`` turns."""
    blocks, at = [], 0
    while at < longest or not blocks:
        width = widths[min(len(blocks), len(widths) - 1)]
        blocks.append((at, width))
        at += width
    return blocks


def _block_of(position: Column, widths: Sequence[int]) -> tuple[Column, Column]:
    """Block and column of a position."""
    edges = [sum(widths[:i]) for i in range(len(widths))]
    last = len(widths) - 1
    beyond = position - F.lit(edges[last])
    block = F.lit(last) + F.floor(beyond / F.lit(widths[last]))
    column = F.pmod(beyond, F.lit(widths[last]))
    for i in reversed(range(last)):
        inside = position < edges[i + 1]
        block = F.when(inside, i).otherwise(block)
        column = F.when(inside, position - edges[i]).otherwise(column)
    return block.cast("int"), column.cast("int")


def _names(width: int) -> list[str]:
    return [f"t{i}" for i in range(width)]


def _path(columns: Sequence[Column]) -> Column:
    return F.concat(*[F.coalesce(c, F.lit(bytearray())) for c in columns])


def _rolled(rows: DataFrame, width: int, *measures: Column) -> DataFrame:
    """ROLLUP over ``top`` and the block's columns: top, path, level and the measures of every
    prefix; level 0 is ``top`` itself."""
    names = _names(width)
    level = F.lit(width) - F.bit_count(F.grouping_id())
    rolled = rows.rollup("top", *names).agg(level.alias("level"), *measures)
    path = _path([F.col(name) for name in names])
    # Conversations that end before a level have no turn there.
    return rolled.withColumn("path", path).drop(*names).where(
        (F.col("level") >= 0) & (F.octet_length("path") == F.col("level") * ID_BYTES))


def _opened(paths: DataFrame, width: int) -> DataFrame:
    """The frame with the block's columns in place of ``path``."""
    cut = [F.substring("path", i * ID_BYTES + 1, ID_BYTES) for i in range(width)]
    return paths.select(*[c for c in paths.columns if c != "path"], *[
        F.when(F.octet_length(part) > 0, part).alias(name)
        for name, part in zip(_names(width), cut, strict=True)])


def _digests(ended: DataFrame) -> DataFrame:
    """(depth, conv_id, ends_sha256) of nodes, from rows (depth, conv_id, member).

    Neighbouring members are written out together, then a node's stretches are sorted and hashed
    one after the other without being held.
    """
    stretches = ended.groupBy("depth", "conv_id", F.shiftright(
        "member", IDS_TOGETHER_BITS).alias("stretch")).agg(F.array_join(
            F.sort_array(F.collect_list("member")).cast("array<string>"), ",").alias("listed"))
    keys = ["depth", "conv_id"]
    ordered = stretches.repartition(*keys).sortWithinPartitions(*keys, "stretch").select(
        *keys, "listed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out: list[tuple] = []
            for depth, conv_id, listed in zip(*[c.to_pylist() for c in batch.columns],
                                              strict=True):
                if (depth, conv_id) == node:
                    digest.update(b"," + listed.encode())
                    continue
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = (depth, conv_id), hashlib.sha256(listed.encode())
            yield _node_rows(out)
        if node:
            yield _node_rows([(*node, digest.hexdigest())])

    return ordered.mapInArrow(run, "depth long, conv_id long, ends_sha256 string")


def _node_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
         pa.array(columns[2], pa.string())], names=["depth", "conv_id", "ends_sha256"])


def prefix_trie(turns: DataFrame, conversations: DataFrame,
                widths: Sequence[int] = WIDTHS) -> DataFrame:
    """Nodes of the trie of all prefixes of conversations.

    ``turns``: conv_id, position (gapless from 0), turn_id and n_turns, each position once.
    ``conversations``: every conv_id once with n_turns; it may be 0.

    Returns per node conv_id (its smallest member), depth, parent_conv_id (null for the root),
    n_convs (members), n_children, n_leaves (nodes without a child in its subtree, itself
    included), saved_tokens (over its subtree, (n_convs - 1) times the UTF-8 bytes of a node's
    last text), ends_sha256 (digest of the comma-joined ids of members that end here, smallest
    first) and turn_id. Equal conversations share all their nodes; without any conversation there
    is no node, without any turn only the root.
    """
    spark = turns.sparkSession
    block, column = _block_of(F.col("position"), widths)
    # A group is at most one block of one conversation.
    blocks = stage(turns.groupBy("conv_id", block.alias("block")).agg(
        F.max("n_turns").alias("n_turns"),
        F.transform(F.sort_array(F.collect_list(F.struct(column.alias("at"), "turn_id"))),
                    lambda s: s["turn_id"]).alias("ids")), "blocks")
    whole = conversations.agg(F.min("conv_id").alias("root"), F.count("*").alias("n"),
                              F.max("n_turns").alias("longest")).first()
    schema = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
              "n_leaves long, saved_tokens long, ends_sha256 string, turn_id binary")
    if not whole["n"]:
        return spark.createDataFrame([], schema)
    layout = _starts(whole["longest"] or 0, widths)
    later = blocks.where("block > 0")
    if len(layout) > 1:
        later = stage(later.repartition("block", "conv_id"), "later-blocks")

    nodes, ended = [], []
    seats = None
    for number, (start, width) in enumerate(layout):
        held = (blocks if number == 0 else later).where(F.col("block") == number)
        if seats is None:
            held = held.withColumn("top", F.lit(whole["root"]))
        else:
            held = held.join(seats.where(F.col("n_turns") > start).select(
                "conv_id", F.col("node").alias("top")), "conv_id")
        ids = [F.get("ids", F.lit(i)).alias(name) for i, name in enumerate(_names(width))]
        rows = held.select("conv_id", "top", "n_turns", *ids)
        found = stage(_rolled(
            rows, width, F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
            F.max("n_turns").alias("longest")).where("level > 0"), f"nodes-{number}")
        nodes.append(found)
        # The node at which each conversation ends or leaves the block.
        path = _path([F.col(name) for name in _names(width)])
        seats = stage(rows.select("conv_id", "top", "n_turns", path.alias("path")).join(
            found.select("top", "path", F.col("conv_id").alias("node")), ["top", "path"])
            .select("conv_id", "node", "n_turns"), f"seats-{number}")
        ended.append(seats.where(F.col("n_turns") <= start + width))

    summed, below = [], None
    for number, (start, width) in reversed(list(enumerate(layout))):
        size = F.conv(F.hex(F.substring("path", -8, 8)), 16, 10).cast("long")
        own = nodes[number].select(
            "top", "path", "level", "conv_id", "n_convs",
            (F.col("longest") == start + F.col("level")).cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * size).alias("saved"))
        if below is not None:
            own = own.join(below.select(
                F.col("top").alias("conv_id"), F.lit(width).alias("level"),
                F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved")),
                ["conv_id", "level"], "left").withColumns({
                    "leaves": F.col("leaves") + F.coalesce("more_leaves", F.lit(0)),
                    "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0))})
        opened = _opened(own.select(
            "top", "path", "conv_id", "n_convs", "leaves", "saved"), width)
        subtrees = stage(_rolled(
            opened, width, F.min("conv_id").alias("conv_id"), F.max("n_convs").alias("n_convs"),
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
            .withColumn("depth", start + F.col("level").cast("long")), f"subtrees-{number}")
        below = subtrees.where("level = 0")
        summed.append(subtrees.where("level > 0").withColumn("block", F.lit(number)))

    inner = reduce(DataFrame.union, summed)
    parents = inner.select("block", "top", F.col("path").alias("prefix"),
                           F.col("conv_id").alias("parent_conv_id"))
    prefix = F.expr(f"substring(path, 1, {ID_BYTES} * (level - 1))")
    # The first level of a block hangs below the node that the block is keyed by.
    listed = ["conv_id", "depth", "parent_conv_id", "n_convs", "leaves", "saved",
              F.expr(f"right(path, {ID_BYTES})").alias("turn_id")]
    deep = inner.where("level > 1").withColumn("prefix", prefix).join(
        parents, ["block", "top", "prefix"]).select(*listed)
    first = inner.where("level = 1").withColumn("parent_conv_id", F.col("top")).select(*listed)
    total = below.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    root = total.select(
        F.lit(whole["root"]).alias("conv_id"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), F.lit(whole["n"]).alias("n_convs"),
        F.coalesce("leaves", F.lit(1)).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved"),
        F.lit(None).cast("binary").alias("turn_id"))
    tree = stage(deep.union(first).union(root), "tree")
    children = tree.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id")).agg(
        F.count("*").alias("n_children"))
    ends = reduce(DataFrame.union, [e.select(
        F.col("n_turns").cast("long").alias("depth"), F.col("node").alias("conv_id"),
        F.col("conv_id").alias("member")) for e in ended])
    turnless = conversations.where("n_turns = 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(whole["root"]).alias("conv_id"),
        F.col("conv_id").cast("long").alias("member"))
    digests = _digests(ends.union(turnless))
    nothing = hashlib.sha256(b"").hexdigest()
    return tree.join(children, ["depth", "conv_id"], "left").join(
        digests, ["depth", "conv_id"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"), "turn_id")
