"""Near-duplicate groups by b-bit MinHash.

Documents are sets of word shingles. Of each set 320 minima are taken; 53 bands of six minima
bring candidates together, and the two low bits of every minimum, packed into ten longs, give
an estimate of similarity, corrected for bits that agree by chance, by counting bits. Candidates
that pass it are confirmed on their full sets of shingles. Of pairs as similar as the threshold,
3 in 100 000 share no band and 4 in a million are estimated too low.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starboard.llm.common import components, runs, small
from starboard.session import stage

WORDS = 5
BANDS, ROWS = 53, 6
MINIMA = 320
BIT_COUNT = 2
LONGS = MINIMA * BIT_COUNT // 64
SIMILARITY = 75  # per cent
# Pairs estimated below this are not confirmed: 4.5 standard errors under the threshold.
LEAST_ESTIMATE = 0.62
# Texts that meet a centre in one task of the confirmation.
TOGETHER = 64
# Pairs confirmed per document and per two components in the first round; ``MORE`` times as many
# in each round after it, until none is left.
PAIRS, PAIRS_OF_COMPONENTS, MORE = 2, 8, 8
# Smallest shingle hashes kept of a document whose band still holds several components; of a set
# no larger they are all.
SKETCH = 512
WHOLE = (1 << 63) - 1
# Standard errors that an estimate from such sketches may lie under the threshold.
SLACK = 4.5
# Bytes of text hashed at once.
BLOCK = 1 << 19

_RANDOM = np.random.default_rng(20)
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]  # A-Z count as a-z
_PLACES = _RANDOM.integers(1, 1 << 62, WORDS + 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _RANDOM.integers(1, 1 << 62, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SUMMANDS = _RANDOM.integers(1, 1 << 62, MINIMA, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

SIGNATURE = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, bits array<long>"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, dtype=np.uint64)]),
                      dtype=np.uint64)


def shingle_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text.

    Words are hashed by polynomials, read off from running sums over the bytes of all texts.
    A text of fewer words than a shingle has one, the whole sequence; without words, none.
    """
    joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    space = _IS_SPACE[joined]
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(
        _BYTES[joined] * _powers(_BASE, len(joined) - 1), dtype=np.uint64)])
    words = _mixed((sums[ends] - sums[starts])
                   * _powers(_BASE_INVERSE, len(joined))[starts]
                   + (ends - starts).astype(np.uint64))
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(starts, bounds)
    n = len(words) - WORDS + 1
    rolled = np.zeros(0, dtype=np.uint64)
    if n > 0:
        rolled = words[:n] * _PLACES[0]
        for i in range(1, WORDS):
            rolled = rolled + words[i:i + n] * _PLACES[i]
        rolled = _mixed(rolled)
    found = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= WORDS:
            found.append(np.unique(rolled[a:b - WORDS + 1]))
        elif b > a:
            parts = np.append(words[a:b] * _PLACES[:b - a], _PLACES[-1:] * np.uint64(b - a))
            found.append(_mixed(parts.sum(dtype=np.uint64, keepdims=True)))
        else:
            found.append(np.zeros(0, dtype=np.uint64))
    return found


def _blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    block, size = [], 0
    for text in texts:
        if block and size + len(text) > BLOCK:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


def _in_blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Ids and sets of the rows (doc_id, text) of a batch, as many at once as make a block."""
    for start, stop in runs(batch.column(1), BLOCK):
        texts = batch.column(1).slice(start, stop - start).cast(pa.binary()).to_pylist()
        yield batch.column(0).slice(start, stop - start), shingle_hashes(
            [text or b"" for text in texts])


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    """Arrays of numbers as one column of lists."""
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate([np.zeros(0, dtype=np.int64), *values])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The minima of each non-empty set, one row per set."""
    every = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    found = np.empty((len(sets), MINIMA), dtype=np.uint64)
    for i in range(MINIMA):
        found[:, i] = np.minimum.reduceat(every * _FACTORS[i] + _SUMMANDS[i], starts)
    return found


def signatures(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): size and key of its shingle set, band keys, packed bits."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sets in _in_blocks(batch):
                k1 = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                k2 = np.array([np.bitwise_xor.reduce(_mixed(s + np.uint64(1))) for s in sets],
                              dtype=np.uint64)
                full = [i for i, s in enumerate(sets) if len(s)]
                bands = [np.zeros(0, dtype=np.int64)] * len(sets)
                bits = [np.zeros(LONGS, dtype=np.int64)] * len(sets)
                if full:
                    found = minima([sets[i] for i in full])
                    bands_of = _mixed(found[:, :BANDS * ROWS]).reshape(-1, BANDS, ROWS) * _PLACES[:ROWS]
                    keys = _mixed(bands_of.sum(axis=2, dtype=np.uint64)
                                  + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                    low = ((_mixed(found) >> np.uint64(40)) & np.uint64(3)).reshape(
                        -1, LONGS, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))
                    packed = np.bitwise_or.reduce(low, axis=2).view(np.int64)
                    for i, k, p in zip(full, keys, packed, strict=True):
                        bands[i], bits[i] = k, p
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(k1.view(np.int64)),
                     pa.array(k2.view(np.int64)), _lists(bands), _lists(bits)],
                    names=["doc_id", "n_shingles", "k1", "k2", "bands", "bits"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        sign, SIGNATURE)


def estimate(a: str, b: str) -> Column:
    """Similarity from the packed bits, corrected for minima whose bits agree by chance."""
    differing = F.lit(0)
    for i in range(LONGS):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        differing = differing + F.bit_count(
            x.bitwiseOR(F.shiftright(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    by_chance = 2.0 ** -BIT_COUNT
    return ((MINIMA - differing) / F.lit(float(MINIMA)) - by_chance) / (1 - by_chance)


def sketches(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text) the ``SKETCH`` smallest hashes of its set, and how far they reach."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, found in _in_blocks(batch):
                # The highest bit flipped, signed numbers sort as the unsigned ones did.
                sets = [(s ^ np.uint64(1 << 63)).view(np.int64) for s in found]
                yield pa.RecordBatch.from_arrays(
                    [ids, _lists([s[:SKETCH] for s in sets]), pa.array(
                        [int(s[SKETCH - 1]) if len(s) > SKETCH else WHOLE for s in sets],
                        pa.int64())], names=["doc_id", "least", "reach"])

    return docs.select("doc_id", "text").mapInArrow(
        sketch, "doc_id long, least array<long>, reach long")


def may_link(a: str, b: str) -> Column:
    """Whether two sketches (``least``, ``reach``) allow the similarity that makes a link.

    Up to the shorter reach both sketches are whole, and so is the union there. Where both hold
    their whole sets the answer is exact. Else the union counts at least ``SKETCH`` hashes, which
    bounds the error to allow for.
    """
    part = SIMILARITY / 100
    least = part - SLACK * (part * (1 - part) / SKETCH) ** 0.5
    reach = F.least(f"{a}_reach", f"{b}_reach")
    sizes = [F.size(f"{name}_least") for name in (a, b)]
    both = F.size(F.array_intersect(f"{a}_least", f"{b}_least"))

    def within(name: str) -> Column:
        return F.size(F.filter(f"{name}_least", lambda h: h <= reach))

    # Each is solved for the common hashes, so that these are counted once:
    # both / (sum of sizes - both) >= s is both >= s / (1 + s) * (sum of sizes).
    exact = (100 * F.least(*sizes) >= SIMILARITY * F.greatest(*sizes)) & (
        (100 + SIMILARITY) * both >= SIMILARITY * (sizes[0] + sizes[1]))
    sampled = both >= least / (1 + least) * (within(a) + within(b))
    return F.when(reach == WHOLE, exact).otherwise(sampled)


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough.

    Partners of one document meet it in groups of ``TOGETHER``: a document's text is sent once
    for each group and not once for each pair, and a document with many partners is spread.
    """
    groups = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.greatest(F.lit(1), F.ceil(
        F.col("n") / TOGETHER))).alias("salt"))
    seats = groups.select("a", "salt", F.col("b").alias("id"), F.lit(False).alias("centre")).union(
        groups.select("a", "salt", F.col("a").alias("id"), F.lit(True).alias("centre")).distinct())
    seats = stage(seats, "near-seats")
    ids = seats.select("id").distinct()
    texts = docs.join(small(ids), docs.doc_id == ids.id, "left_semi").select("doc_id", "text")
    met = seats.join(texts, seats.id == texts.doc_id).select("a", "salt", "id", "centre", "text")

    def confirm(group: pa.Table) -> pa.Table:
        texts = [t or b"" for t in group["text"].cast(pa.binary()).to_pylist()]
        sets = [s for block in _blocks(texts) for s in shingle_hashes(block)]
        central = group["centre"].to_pylist()
        centre = sets[central.index(True)]
        near = []
        for i, is_centre in enumerate(central):
            if not is_centre:
                both = len(np.intersect1d(centre, sets[i], assume_unique=True))
                if 100 * both >= SIMILARITY * (len(centre) + len(sets[i]) - both):
                    near.append(i)
        found = group.take(pa.array(near, pa.int64()))
        return pa.table({"a": found["a"], "b": found["id"]})

    return met.groupBy("a", "salt").applyInArrow(confirm, "a long, b long")


def _estimated(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs that are similar enough by their packed bits, with the estimate."""
    a = bits.select(F.col("doc_id").alias("a"), F.col("bits").alias("a_bits"))
    b = bits.select(F.col("doc_id").alias("b"), F.col("bits").alias("b_bits"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", estimate("a_bits", "b_bits").alias(
        "estimate")).where(F.col("estimate") >= LEAST_ESTIMATE)


def _with_count(pairs: DataFrame) -> DataFrame:
    counts = pairs.groupBy("a").agg(F.count("*").alias("n"))
    return pairs.join(counts, "a")


def united(candidates: DataFrame, labels: DataFrame, docs: DataFrame) -> DataFrame:
    """``labels`` (id, component) after all candidates (a, b, estimate) were looked at.

    A round confirms the likeliest pairs of each document and of each two components, and the
    links found unite components, so that most other pairs need not be looked at: both sides are
    in one component already. The rounds go on until no pair of two components is left.
    """
    factor = 1
    while True:
        la = labels.select(F.col("id").alias("a"), F.col("component").alias("la"))
        lb = labels.select(F.col("id").alias("b"), F.col("component").alias("lb"))
        open_pairs = stage(candidates.join(la, "a", "left").join(lb, "b", "left").select(
            "a", "b", "estimate", F.coalesce("la", "a").alias("la"),
            F.coalesce("lb", "b").alias("lb")).where("la <> lb"), "near-open")
        if not open_pairs.take(1):
            return labels
        of_one = Window.partitionBy("b").orderBy(F.desc("estimate"), "a")
        of_two = Window.partitionBy("low", "high").orderBy(F.desc("estimate"), "a", "b")
        picked = open_pairs.withColumn("nth", F.row_number().over(of_one)).where(
            F.col("nth") <= PAIRS * factor)
        picked = picked.withColumns({"low": F.least("la", "lb"), "high": F.greatest("la", "lb")})
        picked = stage(picked.withColumn("nth", F.row_number().over(of_two)).where(
            F.col("nth") <= PAIRS_OF_COMPONENTS * factor), "near-picked")
        near = confirmed(_with_count(picked.select("a", "b")), docs)
        linked = stage(near.join(picked, ["a", "b"]).select("a", "b", "la", "lb"), "near-links")
        if linked.take(1):
            merged = components(linked.select(F.col("la").alias("a"), F.col("lb").alias("b")))
            merged = merged.toDF("was", "now")
            known = labels.union(linked.select("a", "la")).union(linked.select("b", "lb")).distinct()
            labels = stage(known.join(merged, known.component == merged.was, "left").select(
                "id", F.coalesce("now", "component").alias("component")), "near-labels")
        candidates = open_pairs.join(picked.select("a", "b"), ["a", "b"], "left_anti").select(
            "a", "b", "estimate")
        factor *= MORE


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its component of linked documents.

    Two documents are linked if their sets of five-word shingles have similarity 0.75 or more.
    Returns doc_id, n_shingles, component_id (smallest doc_id reachable) and kept (that is the
    document itself). Texts that are null, empty or without words have no shingle, are linked
    with nothing and kept; so are rows without doc_id, whose component is null. Rows that share
    a doc_id count as one document. An empty table gives no rows; texts are read whole.

    Documents of one and the same set are one class, found by its key, so copies never pair up.
    Classes that share a band meet its centre first, which unites a group in about as
    many pairs as it has members; then, where a band still holds several components, those
    outside its largest one are compared with all of other components, by their bits and, where
    these allow a link, by the smallest hashes of their sets. No pair of a band is left out: it is
    confirmed, or its estimate is too low, or its two sides are in one component already.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stage(signatures(docs), "near-signatures")
    full = signed.where("n_shingles > 0 and doc_id is not null")
    classes = stage(full.groupBy("k1", "k2", "n_shingles").agg(
        F.min("doc_id").alias("rep")), "near-classes")
    reps = full.join(classes.select("rep").distinct(), full.doc_id == F.col("rep"), "left_semi") \
        .dropDuplicates(["doc_id"])
    members = reps.select(F.explode("bands").alias("key"), "doc_id")
    shared = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = stage(members.join(shared, "key"), "near-bands")
    # A band's centre is the member that meets the most others over all of its bands: what the
    # members of a group are edited from rather than one of the edits.
    degrees = members.groupBy("doc_id").agg(F.sum("n").alias("degree"))
    centres = members.join(degrees, "doc_id").groupBy("key").agg(
        (-F.max(F.struct("degree", (-F.col("doc_id")).alias("d")))["d"]).alias("a"))
    members = stage(members.select("key", "doc_id").join(centres, "key"), "near-bands")

    bits = stage(reps.select("doc_id", "bits"), "near-bits")
    stars = stage(_estimated(members.where("doc_id <> a").select(
        "a", F.col("doc_id").alias("b")).distinct(), bits), "near-stars")
    labels = united(stars, docs.sparkSession.createDataFrame([], "id long, component long"), docs)

    named = stage(members.join(labels, members.doc_id == labels.id, "left").select(
        "key", "doc_id", F.coalesce("component", "doc_id").alias("label")), "near-named")
    held = named.groupBy("key", "label").agg(F.count("*").alias("n"))
    largest = held.groupBy("key").agg(
        F.count("*").alias("labels"), F.max(F.struct("n", "label")).alias("top")).where(
        "labels > 1").select("key", F.col("top.label").alias("main"))
    in_open = stage(named.join(largest, "key"), "near-open-bands")
    ids = in_open.select(F.col("doc_id").alias("id")).distinct()
    texts = docs.join(small(ids), docs.doc_id == ids.id, "left_semi")
    looked_at = stage(sketches(texts).dropDuplicates(["doc_id"]).join(bits, "doc_id"),
                      "near-sketches")
    open_bands = in_open.join(looked_at, "doc_id")
    outside = open_bands.where("label <> main").select(
        "key", F.col("doc_id").alias("a"), F.col("label").alias("a_label"),
        *[F.col(name).alias(f"a_{name}") for name in ("bits", "least", "reach")])
    others = open_bands.select(
        "key", F.col("doc_id").alias("b"), "label",
        *[F.col(name).alias(f"b_{name}") for name in ("bits", "least", "reach")])
    likeness = estimate("a_bits", "b_bits")
    rest = outside.join(others, (outside.key == others.key) & (F.col("a_label") != F.col("label"))
                        & (likeness >= LEAST_ESTIMATE) & may_link("a", "b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
        likeness.alias("estimate")).distinct()
    rest = stage(rest.join(stars, ["a", "b"], "left_anti"), "near-rest")
    labels = united(rest, labels, docs)
    in_class = classes.join(labels, classes.rep == labels.id, "left").select(
        "k1", "k2", "n_shingles", F.coalesce("component", "rep").alias("component"))
    keys = ["k1", "k2", "n_shingles"]
    found = signed.join(in_class, keys, "left")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return found.select("doc_id", "n_shingles", F.when(linked, F.col("component")).otherwise(
        F.col("doc_id")).alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
