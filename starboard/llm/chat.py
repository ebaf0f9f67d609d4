"""Chat formatting of reply trees.

A conversation is a tree of messages. Self-joins that double their step (parent, grandparent,
...) enumerate the messages of every root-to-leaf path in as many rounds as the depth has
binary digits; only ids move until the paths are chosen. Paths of a tree are ranked by the mean
score of their messages, and each chosen path becomes one formatted conversation.

A turn is written as ``<|role|>text</s>``, with the text of a user turn between ``[INST] `` and
`` [/INST]``. In texts and roles a backslash is doubled and one is put into every string that
could be read as a mark, so the marks are the only ones and the texts can be had back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starboard.session import stage

# The marks of the template.
ROLE_OPEN, ROLE_CLOSE, TURN_END = "<|", "|>", "</s>"
USER_OPEN, USER_CLOSE = "[INST] ", " [/INST]"
# The first character of a mark, standing before the rest of it.
_MARK_START = r"([<\[|])(?=\||/?s>|/?INST\]|>)"
_TURN = r"(?s)<\|(.*?)\|>(.*?)</s>"


def escaped(text: Column) -> Column:
    doubled = F.regexp_replace(F.coalesce(text, F.lit("")), r"\\", r"\\\\")
    return F.regexp_replace(doubled, _MARK_START, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def paths(messages: DataFrame) -> DataFrame:
    """(tree_id, leaf_id, steps, msg_id): the messages of every root-to-leaf path.

    ``messages`` has tree_id, msg_id and parent_id; steps counts from the leaf (0) to the root.
    A message whose parent is not there is a root. Messages below a loop of parents have no
    root and are left out.
    """
    nodes = messages.select("tree_id", "msg_id", "parent_id")
    known = nodes.select(F.col("tree_id").alias("t"), F.col("msg_id").alias("m"))
    up = stage(nodes.join(known, nodes.tree_id.eqNullSafe(known.t)
                          & (nodes.parent_id == known.m))
               .select("tree_id", "msg_id", F.col("parent_id").alias("above")), "chat-up")
    most = nodes.groupBy("tree_id").count().agg(F.max("count")).first()[0] or 0
    jumps, step = [up], 1
    while step < most and jumps[-1].take(1):
        far = jumps[-1].select(F.col("tree_id").alias("t"), F.col("msg_id").alias("m"),
                               F.col("above").alias("far"))
        last = jumps[-1]
        jumps.append(stage(last.join(far, last.tree_id.eqNullSafe(far.t) & (last.above == far.m))
                           .select("tree_id", "msg_id", F.col("far").alias("above")), "chat-jump"))
        step *= 2
    parents = up.select(F.col("tree_id").alias("t"), F.col("above").alias("m")).distinct()
    leaves = nodes.join(parents, nodes.tree_id.eqNullSafe(parents.t)
                        & (nodes.msg_id == parents.m), "left_anti")
    if step >= most:  # a jump over a whole tree means a loop
        looped = jumps[-1].select(F.col("tree_id").alias("t"), F.col("msg_id").alias("m"))
        leaves = leaves.join(looped, leaves.tree_id.eqNullSafe(looped.t)
                             & (leaves.msg_id == looped.m), "left_anti")
    found = leaves.select("tree_id", F.col("msg_id").alias("leaf_id"), F.lit(0).alias("steps"),
                          "msg_id")
    for k in range(len(jumps) - 1, -1, -1):
        jump = jumps[k].select(F.col("tree_id").alias("t"), F.col("msg_id").alias("m"), "above")
        further = found.join(jump, found.tree_id.eqNullSafe(jump.t) & (found.msg_id == jump.m)) \
            .select("tree_id", "leaf_id", (F.col("steps") + (1 << k)).alias("steps"),
                    F.col("above").alias("msg_id"))
        found = stage(found.union(further), "chat-paths")
    return found


def chosen_paths(messages: DataFrame, best: int | None = None) -> DataFrame:
    """Paths with branch_rank and score; of each tree the ``best`` ones, or all."""
    steps = paths(messages)
    scores = messages.select(F.col("tree_id").alias("t"), F.col("msg_id").alias("m"), "score")
    scored = steps.join(scores, steps.tree_id.eqNullSafe(scores.t)
                         & steps.msg_id.eqNullSafe(scores.m)) \
        .groupBy("tree_id", "leaf_id").agg(F.avg("score").alias("score"))
    order = Window.partitionBy("tree_id").orderBy(F.col("score").desc_nulls_last(), "leaf_id")
    ranked = scored.withColumn("branch_rank", F.row_number().over(order))
    if best is not None:
        ranked = ranked.where(F.col("branch_rank") <= best)
    ranked = ranked.select(F.col("tree_id").alias("t"), F.col("leaf_id").alias("l"), "score",
                           "branch_rank")
    return steps.join(ranked, steps.tree_id.eqNullSafe(ranked.t)
                      & steps.leaf_id.eqNullSafe(ranked.l)) \
        .drop("t", "l")


def format_turns(turns: Column) -> Column:
    """The formatted text of an array of turns (role, text)."""
    def one(turn: Column) -> Column:
        body = escaped(turn["text"])
        wrapped = F.when(turn["role"] == "user", F.concat(
            F.lit(USER_OPEN), body, F.lit(USER_CLOSE))).otherwise(body)
        return F.concat(F.lit(ROLE_OPEN), escaped(turn["role"]), F.lit(ROLE_CLOSE), wrapped,
                        F.lit(TURN_END))

    return F.array_join(F.transform(turns, one), "")


def parse_turns(formatted: Column) -> Column:
    """The turns (role, text) read back from a formatted conversation."""
    roles = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(1))
    bodies = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2))

    def one(role: Column, body: Column) -> Column:
        plain = F.when(role == "user", F.substring(
            body, F.lit(len(USER_OPEN) + 1),
            F.length(body) - (len(USER_OPEN) + len(USER_CLOSE)))).otherwise(body)
        return F.struct(unescaped(role).alias("role"), unescaped(plain).alias("text"))

    return F.zip_with(roles, bodies, one)


def loss_spans(formatted: Column) -> Column:
    """Spans (start, end), in code points of the formatted text, that the loss is taken on:
    the texts of assistant turns."""
    roles = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(1))
    bodies = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2))
    sizes = F.zip_with(roles, bodies, lambda role, body: F.struct(
        (role == "assistant").alias("mine"), F.length(role).alias("role"),
        F.length(body).alias("body")))
    marks = len(ROLE_OPEN) + len(ROLE_CLOSE)
    walked = F.aggregate(
        sizes, F.struct(F.lit(0).alias("at"), F.array().cast(
            "array<struct<start:int,end:int>>").alias("found")),
        lambda state, s: F.struct(
            (state["at"] + s["role"] + marks + s["body"] + len(TURN_END)).alias("at"),
            F.when(s["mine"], F.concat(state["found"], F.array(F.struct(
                (state["at"] + s["role"] + marks).alias("start"),
                (state["at"] + s["role"] + marks + s["body"]).alias("end")))))
            .otherwise(state["found"]).alias("found")))
    return walked["found"]


def loss_text(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(
        formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def format_conversations(messages: DataFrame, best: int | None = None) -> DataFrame:
    """One formatted conversation per chosen root-to-leaf path of every tree.

    ``messages``: tree_id, msg_id (unique in its tree; of repeated ones the smallest row
    counts), parent_id (null for a root), role, text, score. Returns tree_id, leaf_id,
    branch_rank, score, formatted and loss_spans. Null roles and texts are empty, null scores
    count for nothing and put a path last; ties in score go by leaf_id; a null tree_id is a tree
    like others. Empty tables give no rows.
    """
    single = messages.groupBy("tree_id", "msg_id").agg(F.min(F.struct(
        "parent_id", "role", "text", "score")).alias("row")).select(
        "tree_id", "msg_id", "row.parent_id", "row.role", "row.text", "row.score")
    single = stage(single, "chat-messages")
    chosen = chosen_paths(single, best)
    words = single.select(F.col("tree_id").alias("t"), F.col("msg_id").alias("m"), "role", "text")
    rows = chosen.join(words, chosen.tree_id.eqNullSafe(words.t)
                       & chosen.msg_id.eqNullSafe(words.m))
    gathered = rows.groupBy("tree_id", "leaf_id", "branch_rank", F.col("score")).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("steps")).alias("at"), "role", "text")))
        .alias("turns"))
    texts = gathered.select("tree_id", "leaf_id", "branch_rank", "score",
                            format_turns(F.col("turns")).alias("formatted"))
    return texts.withColumn("loss_spans", loss_spans(F.col("formatted")))


def threads(rows: DataFrame) -> DataFrame:
    """Messages of flat conversations (conv_id, turn, role, text): each turn replies to the one
    before it. Rows of one turn follow each other by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.select("conv_id", "role", "text", F.row_number().over(order).alias("n"))
    return numbered.select(
        F.col("conv_id").alias("tree_id"), F.col("n").cast("long").alias("msg_id"),
        F.when(F.col("n") > 1, F.col("n") - 1).cast("long").alias("parent_id"), "role", "text",
        F.length("text").cast("double").alias("score"))
