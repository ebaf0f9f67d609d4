"""Document fingerprints by a homomorphic multiset hash of paragraphs.

A paragraph is hashed to a wide vector, and a document's fingerprint is the sum of its
paragraphs' vectors, each lane modulo a power of two. Order does not matter, and a paragraph
is added to or taken from a fingerprint without the rest of the text.

The vector has two parts. ``EXACT`` lanes of 32 bits are hashes of the whole paragraph; they
decide equality. 64 lanes of 32 bits count, for each bit position, the paragraph's sentences
whose hash has that bit set. Counts add up like the other lanes, and as +1/-1 sums they give an
unbiased estimate of the inner product of two documents' multisets of sentences.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starboard.llm.common import range_borders, range_of
from starboard.session import stage

EXACT = 10
BITS = 32  # one long holds two 32-bit counters
COUNTERS = (1 << 32) | 1
LOW = (1 << 32) - 1
ROWS_PER_RANGE = 2000
LANES = [f"e{i}" for i in range(EXACT)] + [f"c{i}" for i in range(BITS)] + ["n_sentences"]


def items(text: Column, which: int) -> Column:
    """Paragraphs (lines that are not blank) and sentences of a text, with what they are."""
    def tagged(found: Column, kind: str) -> Column:
        return F.transform(F.filter(found, lambda s: F.trim(s) != ""), lambda s: F.struct(
            F.lit(which).alias("which"), F.lit(kind).alias("kind"), s.alias("item")))

    return F.concat(tagged(F.split(text, "\n"), "paragraph"),
                    tagged(F.split(text, r"[.!?\n]+"), "sentence"))


def summed_lanes(exploded: DataFrame, *keys: str) -> DataFrame:
    """Fingerprint lanes per key of rows (keys, kind, item): plain sums, so they can be split."""
    hashed = exploded.select(*keys, (F.col("kind") == "paragraph").alias("whole"), "item",
                             F.xxhash64("item").alias("h"))
    exact = [F.sum(F.when(F.col("whole"), F.xxhash64("item", F.lit(i)).bitwiseAND(
        F.lit(LOW)))).alias(f"e{i}") for i in range(EXACT)]
    bits = [F.sum(F.when(~F.col("whole"), F.shiftright("h", i).bitwiseAND(F.lit(COUNTERS))))
            .alias(f"c{i}") for i in range(BITS)]
    count = F.sum(F.when(~F.col("whole"), 1)).alias("n_sentences")
    return hashed.groupBy(*keys).agg(*exact, *bits, count)


def reduced(lanes: DataFrame) -> DataFrame:
    """Lanes modulo their power of two; a document without any paragraph has zeros."""
    return lanes.select(*[c for c in lanes.columns if c not in LANES], *[
        (F.coalesce(F.col(c), F.lit(0)).bitwiseAND(F.lit(LOW)) if c[0] == "e"
         else F.coalesce(F.col(c), F.lit(0))).alias(c) for c in LANES])


def combine(a: DataFrame, b: DataFrame, key: str, sign: int = 1) -> DataFrame:
    """Fingerprints after insertion (sign 1) or deletion (-1) of the paragraphs in ``b``.

    Both are reduced lanes by ``key``; a key missing in ``b`` stays as it is.
    """
    change = b.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in LANES])
    return reduced(a.join(change, a[key].eqNullSafe(change["_key"]), "left").select(
        a[key], *[(a[c] + sign * F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in LANES]))


def digest(prefix: str = "") -> Column:
    """The exact lanes as text."""
    return F.concat(*[F.lpad(F.lower(F.hex(F.col(f"{prefix}e{i}"))), 8, "0")
                      for i in range(EXACT)])


def likeness(left: str, right: str) -> Column:
    """0 to 1: twice the inner product over the sum of squared lengths, by the 64 counters."""
    def signed(prefix: str) -> list[Column]:
        n = F.col(f"{prefix}n_sentences")
        values = []
        for i in range(BITS):
            both = F.col(f"{prefix}c{i}")
            values += [2 * both.bitwiseAND(F.lit(LOW)) - n, 2 * F.shiftright(both, 32) - n]
        return [v.cast("double") for v in values]

    def total(values: list[Column]) -> Column:
        return reduce(lambda x, y: x + y, values)

    a, b = signed(left), signed(right)
    inner = total([x * y for x, y in zip(a, b, strict=True)])
    squares = total([x * x + y * y for x, y in zip(a, b, strict=True)])
    same = reduce(lambda x, y: x & y, [F.col(f"{left}e{i}") == F.col(f"{right}e{i}")
                                       for i in range(EXACT)])
    return F.when(same, 1.0).when(squares == 0, 0.0).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * inner / squares)))


def with_next(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Each text with the next one by descending doc_id; the last is followed by the first.

    Rows are cut into ranges of doc_id; the first row of a range is also sent to the range that
    ends before it, so that texts move once and no task sees more than a range. Rows of one
    doc_id follow each other by text, null ids come last.
    Adds pos (range, place) and next_pos, by which a fingerprint finds its neighbour's.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    borders = range_borders(ids, rows_per_range)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("home", range_of(F.col("doc_id"), borders))
    heads = ids.withColumn("home", range_of(F.col("doc_id"), borders)).groupBy("home").agg(
        F.max("doc_id").alias("top")).collect()  # one row per range
    filled = sorted(((r["home"], r["top"]) for r in heads), key=lambda pair: pair[0])
    # The head of a range is the guest of the next higher one, the highest of the lowest: a table
    # of one row per range, of which there are at most ``MOST_RANGES``.
    hosts = [home for home, _ in filled[1:]] + [home for home, _ in filled[:1]]
    tops = F.broadcast(docs.sparkSession.createDataFrame(
        [(home, top, host) for (home, top), host in zip(filled, hosts, strict=True)],
        "home int, top long, host int"))
    here = F.struct(F.col("home").alias("range"), F.lit(False).alias("guest"))
    there = F.struct(F.col("host").alias("range"), F.lit(True).alias("guest"))
    is_head = F.col("doc_id").eqNullSafe(F.col("top"))
    rows = rows.join(tops, "home")
    seats = F.when(is_head, F.array(here, there)).otherwise(F.array(here))
    rows = rows.select("doc_id", "text", "home", F.explode(seats).alias("seat"))
    rows = rows.select("doc_id", "text", "home", "seat.range", "seat.guest")
    order = Window.partitionBy("range").orderBy(
        "guest", F.col("doc_id").desc_nulls_last(), "text")
    placed = rows.select(
        "*", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("after"),
        F.lead("guest").over(order).alias("after_guest"),
        F.lead("home").over(order).alias("after_home"))
    return placed.where(~F.col("guest")).select(
        "doc_id", "text", F.coalesce("after", "text").alias("next_text"),
        F.struct(F.col("range").alias("r"), F.col("place").alias("p")).alias("pos"),
        F.struct(F.coalesce("after_home", "range").alias("r"),
                 F.when(F.coalesce("after_guest", F.lit(True)), 1).otherwise(F.col("place") + 1)
                 .alias("p")).alias("next_pos"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of ``docs`` (doc_id, text) and of its edited text.

    The edited text has its last floor(n/2) code points replaced by as many first ones of the
    next document by descending doc_id. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next. A null text is empty; an empty text has the
    fingerprint of no paragraph; equal texts have equal fingerprints, repeated rows each a row.
    """
    rows = with_next(docs).withColumn("n_chars", F.length("text"))
    rows = rows.withColumn("edited", F.expr(
        "concat(substring(text, 1, n_chars - cast(floor(n_chars / 2) as int)),"
        " substring(next_text, 1, cast(floor(n_chars / 2) as int)))"))
    heads = ["doc_id", "n_chars", "edited_sha256", "pos", "next_pos"]
    nothing = F.array(*[F.struct(F.lit(w).alias("which"), F.lit("").alias("kind"),
                                 F.lit("").alias("item")) for w in (0, 1)])
    exploded = rows.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "pos", "next_pos",
        F.explode(F.concat(nothing, items(F.col("text"), 0), items(F.col("edited"), 1)))
        .alias("i")).select(*heads, "i.which", "i.kind", "i.item")
    exploded = exploded.withColumn("kind", F.when(F.col("kind") != "", F.col("kind")))
    lanes = stage(reduced(summed_lanes(exploded, *heads, "which")), "fingerprints")
    own = lanes.where("which = 0").select(*heads, *[F.col(c).alias(f"a_{c}") for c in LANES])
    edited = lanes.where("which = 1").select(
        F.col("pos").alias("b_pos"), *[F.col(c).alias(f"b_{c}") for c in LANES])
    after = lanes.where("which = 0").select(
        F.col("pos").alias("c_pos"), *[F.col(c).alias(f"c_{c}") for c in LANES])
    joined = own.join(edited, own.pos == edited.b_pos).join(after, own.next_pos == after.c_pos)
    return joined.select(
        "doc_id", "n_chars", "edited_sha256", digest("a_").alias("fingerprint"),
        digest("b_").alias("edited_fingerprint"), likeness("a_", "b_").alias("near_edited"),
        likeness("a_", "c_").alias("near_next"))
