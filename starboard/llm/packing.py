"""Packing documents into sequences by bin completion.

Pieces of one length are interchangeable, so the search works on how many pieces of each length
there are and not on pieces: around the largest length left, fillings of the rest of a sequence
are enumerated, dominated ones are dropped, and a branch and bound over them, with best-fit
decreasing as the incumbent, stops where the waste so far exceeds what the incumbent wastes or
after ``NODES`` steps. A choice is a filling and for how many sequences it is used. The plan is
then a small table by which every piece finds its place.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starboard.llm import byte_bpe
from starboard.llm.common import runs
from starboard.session import stage

CAPACITY = 1024
# Bytes of text encoded together.
RUN_BYTES = 1 << 20
END_OF_TEXT = 2
# Pieces of one length are numbered in parts: of at least so many pieces, and so many parts in all
# at most beside one for each length.
LEAST_TOGETHER, MOST_PARTS = 256, 8192
# Fillings tried first around one largest piece, and steps of the branch and bound.
FILLINGS, NODES = 24, 4000
# Fixed value: how a byte-level vocabulary of this kind splits a text.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# The same for texts without two white space characters in a row, where the look-ahead, which
# takes a slower engine, decides nothing.
SINGLE_SPACES = SPLIT.replace(r"|\s+(?!\S)", "")
TWO_SPACES = re.compile(r"\s\s")

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _ranks(vocabulary: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ids of a byte-level vocabulary file, whose ids are also the order of its merges, by the
    bytes they stand for, and the ids of its added tokens, which stand for themselves."""
    with open(vocabulary, encoding="utf-8") as file:
        content = json.load(file)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"]: t["id"] for t in content.get("added_tokens", ())}
    return {bytes(byte_of[c] for c in token): i
            for token, i in content["model"]["vocab"].items() if token not in special}, special


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, by a vocabulary file.

    The ids are those that the tokenizers library gives for the file; the string of an added
    token, such as ``<|endoftext|>``, is that one token.
    """

    def __init__(self, vocabulary: str):
        import tiktoken

        ranks, special = _ranks(vocabulary)
        self.ranks, self.special, self.matrices = ranks, special, None
        # Without any special token every position is looked at; then one that no text can hold.
        special = special or {"\0" * 64: max(ranks.values()) + 1}
        self.full, self.single = (tiktoken.Encoding(
            "vocabulary", pat_str=split, mergeable_ranks=ranks, special_tokens=special)
            for split in (SPLIT, SINGLE_SPACES))

    def encode(self, text: str) -> bytes:
        chosen = self.full if TWO_SPACES.search(text) else self.single
        try:
            return chosen.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
        except ValueError:
            # Its pattern engine gives up on white space runs of some hundred thousand characters.
            self.matrices = self.matrices or byte_bpe.Encoder(self.ranks, SPLIT)
            parts = re.split("(" + "|".join(map(re.escape, self.special)) + ")", text) \
                if self.special else [text]
            return b"".join(
                self.special[part].to_bytes(4, "little") if part in self.special
                else next(self.matrices.encode([part])) for part in parts)


def cut(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every row of (doc_id, text): ids with the end-of-text id behind them, cut into
    pieces of ``capacity`` if there are more, of which the first takes what is left over."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        end = np.array([END_OF_TEXT], dtype="<u4").tobytes()
        for batch in batches:
            for begin, until in runs(batch.column(1), RUN_BYTES):
                part = batch.slice(begin, until - begin)
                rows = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                        strict=True):
                    ids = (encoder.encode(text) if text is not None else b"") + end
                    n = len(ids) // 4
                    first = (n - 1) % capacity + 1
                    start, stop, piece = 0, first, 0
                    while start < n:
                        rows.append((doc_id, piece, start, stop - start,
                                     zlib.crc32(ids[start * 4:stop * 4])))
                        start, stop, piece = stop, stop + capacity, piece + 1
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        split, PIECES)


def fillings(counts: list[int], room: int, limit: int = FILLINGS) -> list[tuple[int, ...]]:
    """Up to ``limit`` promising ways to fill ``room`` with available lengths, the fullest first.

    Larger pieces are tried first, one piece that fills the room ends the search, and what can
    still be put in is put in. ``undominated`` gives the ways that this passes over.
    """
    found: list[tuple[int, tuple[int, ...]]] = []
    used: dict[int, int] = {}
    there = [length for length in range(1, room + 1) if counts[length] > 0]

    def largest(room: int, most: int) -> int:
        at = bisect.bisect_right(there, min(room, most)) - 1
        while at >= 0 and counts[there[at]] <= used.get(there[at], 0):
            at -= 1
        return there[at] if at >= 0 else 0

    def greedy(room: int, most: int, chosen: tuple[int, ...]) -> bool:
        """Put in the largest that fits, again and again."""
        taken = []
        while length := largest(room, most):
            used[length] = used.get(length, 0) + 1
            taken.append(length)
            room, most = room - length, length
        for length in taken:
            used[length] -= 1
        found.append((room, (*chosen, *taken)))
        return room == 0

    def fill(room: int, most: int, chosen: tuple[int, ...], tries: int) -> bool:
        """True if the room was filled without waste."""
        if tries == 1:
            return greedy(room, most, chosen)
        length = largest(room, most)
        if not length:
            found.append((room, chosen))
            return room == 0
        for _ in range(tries):
            if not length or len(found) >= limit:
                break
            used[length] = used.get(length, 0) + 1
            full = fill(room - length, length, (*chosen, length), tries // 2)
            used[length] -= 1
            if full:
                return True
            length = largest(length - 1, length - 1)
        return False

    if not fill(room, room, (), 8):
        # Two pieces that fill the room are sought over all lengths.
        for a in range(room // 2 + 1, room):
            b = room - a
            if counts[a] > 0 and counts[b] > 0:
                found.append((0, (a, b)))
                break
    found.sort(key=lambda f: (f[0], [-x for x in f[1]]))
    return list(dict.fromkeys(chosen for _, chosen in found))


def undominated(counts: list[int], room: int) -> Iterator[tuple[int, ...] | None]:
    """All undominated ways to fill ``room``, large pieces first; None for each dominated one.

    A filling is dominated if some of its pieces, or none, can be replaced by one larger piece
    left out: one that fills as much as several of them, or more and still fits.
    """
    there = [length for length in range(room, 0, -1) if counts[length] > 0]

    def dominated(way: tuple[int, ...], waste: int) -> bool:
        # Bit n of these: pieces of the filling, any number or at least two, can sum to n.
        any_number, one, several = 1, 0, 0
        for length in way:
            several |= (several | one) << length
            one |= 1 << length
            any_number |= any_number << length
        reach = several
        for more in range(1, waste + 1):
            reach |= any_number << more
        used = Counter(way)
        return any(reach >> length & 1 for length in there if counts[length] > used[length])

    def fill(at: int, room: int, chosen: tuple[int, ...]) -> Iterator[tuple[int, ...] | None]:
        while at < len(there):
            for n in range(min(counts[there[at]], room // there[at]), 0, -1):
                yield from fill(at + 1, room - n * there[at], chosen + (there[at],) * n)
            at += 1
        yield None if dominated(chosen, room) else chosen

    return fill(0, room, ())


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) \
        -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: fillings of sequences and how often each is used.

    The longest piece left goes where it leaves least room. That sequence then has the least
    room of those it fits, so it takes pieces of the length until none fits any more.
    """
    # Room left: (filling, sequences) of those with that room.
    open_: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    for length in sorted((x for x, n in counts.items() if n > 0), reverse=True):
        left, room = counts[length], length
        while left:
            while room < capacity and not open_[room]:
                room += 1
            # A new sequence has all the room; empty ones are not listed.
            way, times = open_[room].pop() if open_[room] else ((), left)
            each = room // length
            full = min(times, left // each)
            if full:
                open_[room - each * length].append((way + (length,) * each, full))
            left, rest = left - each * full, times - full
            if rest and left < each:
                if left:
                    open_[room - left * length].append((way + (length,) * left, 1))
                    left, rest = 0, rest - 1
                if rest and way:
                    open_[room].append((way, rest))
    return [filling for fillings_ in open_ for filling in fillings_]


def plan(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) \
        -> list[tuple[tuple[int, ...], int]]:
    """Fillings of sequences and how often each is used; every piece counted is in one.

    ``counts``: pieces per length. Best-fit decreasing is the incumbent, so the plan never has
    more sequences than it. If it has more than the sum of lengths requires, fillings around the
    largest length left are branched on, from the last choice backwards, as long as the waste so
    far leaves room for a better plan: first promising ones, as often as the counts allow, then
    all undominated ones, also once. The search ends after ``nodes`` steps, its only cap; a
    dominated filling looked at is a step too.
    """
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        left[length] = n
    total = sum(length * n for length, n in enumerate(left))
    least = -(-total // capacity)
    best = best_fit(counts, capacity)
    best_bins = sum(times for _, times in best)
    if best_bins == least:
        return best

    def most(way: tuple[int, ...]) -> int:
        return min(left[length] // k for length, k in Counter(way).items())

    def options() -> Iterator[tuple[tuple[int, ...], int] | None]:
        """Choices around the largest length left: a filling and how often, None if dominated."""
        length = capacity
        while not left[length]:
            length -= 1
        others = left.copy()
        others[length] -= 1
        room = capacity - length
        promising = fillings(others, room)
        for way in promising:
            yield (length, *way), most((length, *way))
        for way in undominated(others, room):
            if way is None:
                yield None
                continue
            times = most((length, *way))
            if way not in promising:
                yield (length, *way), times
            if times > 1:
                yield (length, *way), 1

    def take(way: tuple[int, ...], times: int) -> None:
        for length in way:
            left[length] -= times

    # One frame per choice: (choices still to try, the filling chosen, how often).
    stack: list[tuple[Iterator, tuple[int, ...], int]] = []
    bins = waste = steps = 0
    ways = options()
    while steps < nodes:
        steps += 1
        choice = next(ways, ())
        if choice is None:
            continue
        if choice:
            way, times = choice
            loss = (capacity - sum(way)) * times
            # Sequences needed at least, if all that is wasted so far stays wasted.
            if -(-(total + waste + loss) // capacity) >= best_bins:
                continue
            take(way, times)
            stack.append((ways, way, times))
            bins, waste = bins + times, waste + loss
            if any(left):
                ways = options()
                continue
            best, best_bins = [(way, times) for _, way, times in stack], bins
            if best_bins == least:
                return best
        if not stack:
            return best
        ways, way, times = stack.pop()
        take(way, -times)
        bins, waste = bins - times, waste - (capacity - sum(way)) * times
    return best


def places(fills: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """The plan as rows (length, low, high, each, first_sequence, offset): pieces of a length
    numbered low to high - 1 stand, ``each`` to a sequence, from that sequence and offset on."""
    rows, next_number, sequence = [], {}, 0
    for way, times in fills:
        offset, at = 0, 0
        while at < len(way):
            length, each = way[at], 1
            while at + each < len(way) and way[at + each] == length:
                each += 1
            low = next_number.get(length, 0)
            next_number[length] = low + each * times
            rows.append((length, low, low + each * times, each, sequence, offset))
            offset += each * length
            at += each
        sequence += times
    return rows


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every row of ``docs`` (doc_id, text) with its place in a sequence.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset. A null or empty
    text is one piece of the end-of-text id. Repeated rows are packed each; which of several
    equal pieces takes which place does not matter. An empty table gives no rows.

    The text is read once and not moved; the driver holds at most ``capacity`` counts, the plan
    made of them, and a number for each part, of which there are ``capacity`` and ``MOST_PARTS``
    at most.
    """
    spark = docs.sparkSession
    cut_up = stage(cut(docs, vocabulary, capacity), "pieces")
    counts = {row["length"]: row["n"] for row in cut_up.groupBy("length").agg(
        F.count("*").alias("n")).collect()}
    together = max(LEAST_TOGETHER, sum(counts.values()) // MOST_PARTS)
    parts = F.broadcast(spark.createDataFrame(
        [(length, -(-n // together)) for length, n in counts.items()],
        "length long, parts long"))
    pieces = cut_up.join(parts, "length").withColumn("part", F.pmod(
        F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("parts")).cast("int")).drop("parts")
    dealt = pieces.groupBy("length", "part").agg(F.count("*").alias("n")).collect()
    before: dict[int, int] = {}
    first = []
    for row in sorted(dealt, key=lambda r: (r["length"], r["part"])):
        first.append((row["length"], row["part"], before.get(row["length"], 0)))
        before[row["length"]] = before.get(row["length"], 0) + row["n"]
    table = places(plan(counts, capacity))
    firsts = F.broadcast(spark.createDataFrame(first, "length long, part int, first long"))
    seats = F.broadcast(spark.createDataFrame(
        table, "length long, low long, high long, each long, sequence long, place long"))
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    numbered = pieces.withColumn("nth", F.row_number().over(inside) - 1).join(
        firsts, ["length", "part"]).withColumn("number", F.col("first") + F.col("nth"))
    joined = numbered.join(seats, "length").where(
        (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high")))
    turn = F.col("number") - F.col("low")
    return joined.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(turn / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("place") + F.pmod(turn, F.col("each")) * F.col("length")).cast("long")
        .alias("offset"))
