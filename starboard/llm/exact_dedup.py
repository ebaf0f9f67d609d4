"""Exact deduplication through recipes of content-defined chunks.

A text is cut where its own content says so, and becomes a recipe: the ordered list of its
chunks' identifiers. An identifier is the chunk's hash together with its rank among the
different chunks of that hash, so equal identifiers mean equal chunks. Chunks travel once,
after duplicates were dropped where they were read; documents are compared by recipes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starboard.session import stage

SHORTEST, LONGEST = 512, 2048
# The characters that do not count when texts are compared.
WHITE_SPACE = r"[\x20\x09-\x0D]+"
# A chunk ends at the first of these after SHORTEST characters, or after LONGEST.
CHUNK = rf"(?s).{{{SHORTEST},{LONGEST - 1}}}?[.,;:!?]|.{{1,{LONGEST}}}"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def chunks(text: Column) -> Column:
    """Content-defined chunks of a normalised text, in order; none of an empty one."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def clashing_chunks(texts: DataFrame) -> DataFrame:
    """(hash, chunk, rank) of chunks whose hash is shared by different chunks: as a rule none.

    Every distinct chunk is moved once, to the place of its hash, and compared there.
    """
    every = texts.select(F.explode(chunks(F.col("norm"))).alias("chunk")).select(
        F.xxhash64("chunk").alias("hash"), "chunk").distinct()
    # Chunks are moved again only if there is such a hash.
    same = stage(every.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"),
                 "chunk-hashes")
    if not same.take(1):
        return texts.sparkSession.createDataFrame([], "hash long, chunk string, rank int")
    return every.join(same, "hash").select(
        "hash", "chunk", F.row_number().over(Window.partitionBy("hash").orderBy("chunk"))
        .alias("rank"))


def recipes(texts: DataFrame) -> DataFrame:
    """Adds ``recipe``, the ordered verified identifiers, to rows with ``norm``; drops ``norm``."""
    clashes = stage(clashing_chunks(texts), "chunk-clashes")
    if not clashes.take(1):
        return texts.withColumn("recipe", F.transform(
            chunks(F.col("norm")), lambda c: F.struct(F.xxhash64(c).alias("hash"),
                                                      F.lit(1).alias("rank")))).drop("norm")
    # Two 64-bit hashes met: identifiers are looked up, chunk by chunk, in the table of clashes.
    others = [c for c in texts.columns if c != "norm"]
    rows = texts.withColumn("row", F.monotonically_increasing_id())
    rows = stage(rows, "chunk-rows")
    single = rows.select("row", F.posexplode_outer(chunks(F.col("norm"))).alias("pos", "chunk"))
    single = single.withColumn("hash", F.xxhash64("chunk")).join(
        clashes, ["hash", "chunk"], "left")
    lists = single.groupBy("row").agg(F.sort_array(F.collect_list(F.when(
        F.col("pos").isNotNull(), F.struct("pos", "hash", F.coalesce("rank", F.lit(1))
                                           .alias("rank"))))).alias("steps"))
    return rows.join(lists, "row").select(*others, F.transform(
        "steps", lambda s: F.struct(s["hash"].alias("hash"), s["rank"].alias("rank")))
        .alias("recipe"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): which of the equal texts stays.

    Texts are equal if they are without white space; null counts as empty. Of equal ones stays
    the row with the most code points, then the smallest doc_id (null first). Returns doc_id,
    keep_id, group_size, kept, text_sha256 and n_chunks. Repeated rows of the doc_id that stays
    all stay. An empty table gives no rows; texts of any length are read whole.

    Groups are folded where the rows are read, so a group of any size is few rows in the
    shuffle; finding each row's group is a join whose hot keys Spark splits.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("norm"),
        F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"))
    texts = texts.withColumn("text_sha256", F.sha2(F.col("norm").cast("binary"), 256))
    rows = stage(recipes(texts), "recipes")
    # The list itself is the key; its length and digest only spare the comparison of lists.
    key = ["text_sha256", "recipe"]
    groups = rows.groupBy(*key).agg(
        F.count("*").alias("group_size"),
        F.min(F.struct((-F.col("n_chars")).alias("longest"), F.col("doc_id").alias("id")))
        .alias("best"))
    # Written, so that both sides of the join are plain and a hot key of it can be split.
    groups = stage(groups.select(*key, "group_size", F.col("best.id").alias("keep_id")),
                   "text-groups")
    return rows.join(groups, key).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id"))
        .alias("kept"), "text_sha256", F.size("recipe").alias("n_chunks"))
