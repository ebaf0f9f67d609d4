"""Alignment of the tokens that two tokenizers give the same text, and counts of aligned ids.

Tokens of both sides are the byte offsets at which they end. Diagonal run skipping walks both end
arrays: at the current shift between the two indices exponential probing compares stretches of
twice the length each time as long as they are equal, which skips one-to-one stretches; where
they differ, the group is resolved locally by moving the side that ends first until both end
together, and the shift is what this leaves. Many stretches ("lanes", which start where both
sides end together) are walked in step, so every comparison is one of whole arrays.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starboard.llm.byte_bpe import Encoder
from starboard.llm.common import BROADCAST_ROWS, runs
from starboard.llm.packing import SPLIT
from starboard.session import stage

# Bytes of text aligned together, and tokens after which a lane may end; both change no result.
RUN_BYTES, LANE = 1 << 20, 256
SCHEMA = ("_row long, doc_id long, n_a long, n_b long, n_groups long, groups string, "
          "links array<long>")
# A link is one number, the id of side a above this many bits and the id of side b below.
BITS = 32


def lanes(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Rows (a, b): tokens of both sides before a place where both end, the first being (0, 0)
    and the last the end of both, with at least ``LANE`` tokens of side a between them."""
    at = np.append(np.arange(LANE - 1, len(ends_a) - 1, LANE), len(ends_a) - 1)
    there = np.minimum(np.searchsorted(ends_b, ends_a[at]), len(ends_b) - 1)
    both = ends_b[there] == ends_a[at]
    return np.vstack([[[0, 0]], np.stack([at[both], there[both]], axis=1) + 1])


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of both sides, whether the other side has a token that ends with it.

    The arrays hold increasing offsets and the same last one; both are empty or neither is.
    """
    cut_a, cut_b = np.zeros(len(ends_a), dtype=bool), np.zeros(len(ends_b), dtype=bool)
    if not len(ends_a):
        return cut_a, cut_b
    borders = lanes(ends_a, ends_b)
    a, shift = borders[:-1, 0].copy(), borders[:-1, 1] - borders[:-1, 0]
    stop_a, stop_b = borders[1:, 0], borders[1:, 1]
    while len(a):
        # One-to-one stretches: lanes whose whole window is equal go on with one twice as wide.
        probing, width = np.arange(len(a)), 2
        while len(probing):
            at = a[probing, None] + np.arange(width)
            other = at + shift[probing, None]
            inside = (at < stop_a[probing, None]) & (other < stop_b[probing, None])
            same = inside & (ends_a[np.where(inside, at, 0)] == ends_b[np.where(inside, other, 0)])
            length = np.where(same.all(axis=1), width, same.argmin(axis=1))
            run = np.arange(width) < length[:, None]
            cut_a[at[run]] = True
            cut_b[other[run]] = True
            a[probing] += length
            probing, width = probing[length == width], 2 * width
        going = a < stop_a
        a, shift, stop_a, stop_b = a[going], shift[going], stop_a[going], stop_b[going]
        # Irregular groups: the side that ends first takes its next token until both end.
        b, open_ = a + shift, np.arange(len(a))
        while len(open_):
            left, right = ends_a[a[open_]], ends_b[b[open_]]
            equal = left == right
            done = open_[equal]
            cut_a[a[done]] = True
            cut_b[b[done]] = True
            a[open_] += left <= right
            b[open_] += right <= left
            open_ = open_[~equal]
        shift = b - a
        going = a < stop_a
        a, shift, stop_a, stop_b = a[going], shift[going], stop_a[going], stop_b[going]
    return cut_a, cut_b


def linked(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of both sides of all pairs of tokens whose byte ranges overlap, in text order.

    Between two neighbouring ends of either side lies a stretch of one token of each side; two
    stretches never belong to the same pair.
    """
    last = int(ends_a[-1]) if len(ends_a) else 0
    in_a, in_b = np.zeros(last + 1, dtype=bool), np.zeros(last + 1, dtype=bool)
    in_a[ends_a], in_b[ends_b] = True, True
    ends = np.flatnonzero(in_a | in_b)
    of_a, of_b = in_a[ends], in_b[ends]
    return np.cumsum(of_a) - of_a, np.cumsum(of_b) - of_b


class BytePairs:
    """Side a: a byte-level vocabulary file of the tokenizers library, without special tokens."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        special = {t["content"] for t in content.get("added_tokens", ())}
        ranks = {bytes(byte_of[c] for c in token): i
                 for token, i in content["model"]["vocab"].items() if token not in special}
        self.bytes_of = [b""] * (max(content["model"]["vocab"].values()) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        # An encoding with one special token that is never allowed is faster than one without.
        self.encoding = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks,
                                          special_tokens={"\0" * 64: len(self.bytes_of)})

        self.ranks, self.matrices = ranks, None

    def _one(self, text: str) -> np.ndarray:
        try:
            return self.encoding.encode_to_numpy(text, disallowed_special=())
        except ValueError:
            # Its pattern engine gives up on white space runs of some hundred thousand characters.
            self.matrices = self.matrices or Encoder(self.ranks, SPLIT)
            return np.frombuffer(next(self.matrices.encode([text])), dtype="<u4")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._one(" " + text) for text in texts]


class Pieces:
    """Side b: a model file of the sentencepiece library, which adds the leading space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
            else piece.replace("▁", " ").encode() for i, piece in enumerate(pieces)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, dtype=np.int64)
                for ids in self.model.encode(texts, out_type=int, num_threads=1)]


class Aligner:
    """Rows of tokens, groups and links of texts by two tokenizers."""

    def __init__(self, first: BytePairs, second: Pieces):
        self.sides = first, second
        self.sizes = [np.array([len(b) for b in side.bytes_of], dtype=np.int64)
                      for side in self.sides]
        # Ids as text with what may follow: ',' inside a side, '|' between sides, ';' at the end.
        most = max(len(side.bytes_of) for side in self.sides)
        self.written = [f"{i}{end}" for i in range(most) for end in ",|;"]

    def rows(self, texts: list[str | None]) -> tuple[list[list], np.ndarray, np.ndarray]:
        """Per text n_a, n_b, n_groups and groups; the links of all texts; and how many links
        each text has."""
        there = [i for i, text in enumerate(texts) if text]
        encoded = [side.encode([texts[i] for i in there]) for side in self.sides]
        same = []
        for i, first, second in zip(there, *encoded, strict=True):
            wanted = b" " + texts[i].encode()
            # Side a is byte-level and cannot lose a byte; side b may have normalised the text.
            same.append(int(self.sizes[0][first].sum()) == len(wanted) and b"".join(
                map(self.sides[1].bytes_of.__getitem__, second.tolist())) == wanted)
        there = [i for i, ok in zip(there, same, strict=True) if ok]
        encoded = [[x for x, ok in zip(side, same, strict=True) if ok] for side in encoded]
        counts = [np.array([len(x) for x in side], dtype=np.int64) for side in encoded]
        ids = [np.concatenate([np.zeros(0, dtype=np.int64), *side]).astype(np.int64)
               for side in encoded]
        ends = [np.cumsum(size[x]) for size, x in zip(self.sizes, ids, strict=True)]
        cuts = align(*ends)
        pairs = linked(*ends)
        # Group g holds the tokens of a side from its cut g - 1 on, the cut included.
        past = [np.append(0, np.flatnonzero(cut) + 1) for cut in cuts]
        group = [np.cumsum(cut) - cut for cut in cuts]
        codes = np.zeros(len(ids[0]) + len(ids[1]), dtype=np.int64)
        codes[np.arange(len(ids[0])) + past[1][group[0]]] = ids[0] * 3 + cuts[0]
        codes[np.arange(len(ids[1])) + past[0][group[1] + 1]] = ids[1] * 3 + 2 * cuts[1]
        last = [np.cumsum(count) for count in counts]
        groups_by = np.append(0, group[0][last[0] - 1] + 1) if there else np.zeros(1, dtype=int)
        links_by = np.append(0, np.searchsorted(pairs[0], last[0]))
        rows: list[list] = [[0, 0, 0, ""] for _ in texts]
        n_links = np.zeros(len(texts), dtype=np.int64)
        start = 0
        for k, i in enumerate(there):
            stop = start + int(counts[0][k] + counts[1][k])
            text = "".join(map(self.written.__getitem__, codes[start:stop].tolist()))
            rows[i] = [int(counts[0][k]), int(counts[1][k]),
                       int(groups_by[k + 1] - groups_by[k]), text[:-1]]
            n_links[i] = links_by[k + 1] - links_by[k]
            start = stop
        return rows, ids[0][pairs[0]] << BITS | ids[1][pairs[1]], n_links


def align_documents(docs: DataFrame, byte_pairs: str, pieces: str) -> DataFrame:
    """Tokens of both tokenizers for every row of ``docs`` (doc_id, text), put side by side.

    Returns _row (a number of the row), doc_id, n_a, n_b, n_groups, groups (as a1,a2|b1;a3|b2,b3)
    and links (all pairs of tokens that overlap, in text order, each as the id of the first
    tokenizer shifted by ``BITS`` plus that of the second). A text that is null, empty, or that
    the joined bytes of either side's tokens do not give back, has no tokens. Strings of special
    tokens are text, repeated rows are rows of their own, very long texts are walked whole in
    linear time, and extra columns are left out. An empty table gives no rows.

    ``byte_pairs`` and ``pieces`` are vocabulary files that every executor can read. Stage the
    result before using it twice: ``_row`` and the work of encoding are not repeated then.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(BytePairs(byte_pairs), Pieces(pieces))
        for batch in batches:
            for start, stop in runs(batch.column(2), RUN_BYTES):
                part = batch.slice(start, stop - start)
                rows, linked_ids, n_links = aligner.rows(part.column(2).to_pylist())
                links = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(n_links)).astype(np.int32)),
                    pa.array(linked_ids))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     *[pa.array(x, pa.int64()) for x in columns[:3]],
                     pa.array(columns[3], pa.string()), links],
                    names=["_row", "doc_id", "n_a", "n_b", "n_groups", "groups", "links"])

    return docs.select(F.monotonically_increasing_id().alias("_row"),
                       F.col("doc_id").cast("long").alias("doc_id"),
                       "text").mapInArrow(run, SCHEMA)


def _links(aligned: DataFrame) -> DataFrame:
    return aligned.select("_row", F.explode("links").alias("link"))


def link_counts(aligned: DataFrame) -> DataFrame:
    """(link, a, b, n, best) of every linked pair of ids: links that hold it over all documents,
    and whether no other pair of the same ``b`` has more. Written once."""
    counted = stage(_links(aligned).groupBy("link").agg(F.count("*").alias("n")).select(
        "link", F.shiftright("link", BITS).cast("int").alias("a"),
        F.col("link").bitwiseAND(F.lit((1 << BITS) - 1)).cast("int").alias("b"), "n"), "pairs")
    # One row per id of side b: bounded by its vocabulary.
    highest = F.broadcast(counted.groupBy("b").agg(F.max("n").alias("highest")))
    return stage(counted.join(highest, "b").select(
        "link", "a", "b", "n", (F.col("n") == F.col("highest")).alias("best")), "counts")


def frequent_from(counts: DataFrame, most: int = BROADCAST_ROWS) -> int:
    """The least power of two that at most ``most`` pairs reach with their count."""
    power = F.length(F.bin("n")) - 1
    held = {row[0]: row[1] for row in counts.groupBy(power).count().collect()}
    above, least = 0, max(held, default=0) + 1
    while least > 0 and above + held.get(least - 1, 0) <= most:
        least -= 1
        above += held.get(least, 0)
    return 1 << least


def score(aligned: DataFrame, counts: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``aligned`` without links, with n_links, n_best (links whose pair is a best one) and
    count_sum (sum of the counts of the links' pairs).

    Counts of the most frequent pairs, at most ``most``, are broadcast; links of other pairs are
    folded per document and joined, and as these pairs are the rare ones no join key is hot.
    """
    least = frequent_from(counts, most)
    known = counts.select("link", "n", "best")
    head = F.broadcast(known.where(F.col("n") >= least))
    rare = F.when(F.col("n").isNull(), F.col("link"))
    folded = stage(
        _links(aligned).join(head, "link", "left").groupBy("_row", rare.alias("link"))
        .agg(F.count("*").alias("k"), F.sum("n").alias("sum"),
             F.count_if("best").alias("n_best")), "folded")
    rest = folded.where("link is not null").select("_row", "link", "k").join(
        known.where(F.col("n") < least), "link")

    def best(flag: Column) -> Column:
        return F.when(flag, F.col("k")).otherwise(0)

    scored = folded.where("link is null").select("_row", "k", "sum", "n_best").union(
        rest.select("_row", "k", (F.col("k") * F.col("n")).alias("sum"),
                    best(F.col("best")).alias("n_best"))
    ).groupBy("_row").agg(F.sum("k").alias("n_links"), F.sum("n_best").alias("n_best"),
                          F.sum("sum").alias("count_sum"))
    return aligned.drop("links").join(scored, "_row", "left").fillna(
        0, ["n_links", "n_best", "count_sum"]).drop("_row")
