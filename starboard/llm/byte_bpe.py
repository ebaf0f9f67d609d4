"""Byte-level BPE in length-bucketed, padded matrices.

A text is cut by the vocabulary's pattern; every cut piece is encoded on its own. The distinct
pieces of a batch that are not known yet are dealt to buckets by length, each a matrix with one
row per piece, padded. In every round each row merges its leftmost pair of least rank: ranks come
from a hashed table of id pairs, are looked up for the pairs that a merge has made only, and the
row is then compacted. Rows without a pair left are done and go from the matrix. Where the pairs
that a merge makes rank above the merged one, as they do in a trained vocabulary, all equal pairs
of a row are merged in the same round: merging them one by one would choose just them.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starboard.llm.common import runs

#: No pair: above every rank.
NONE = np.int32(2**31 - 1)
# Cells of one matrix, bytes of text encoded together, and bytes held for pieces whose ids are
# remembered: they bound memory and change no result.
CELLS, RUN_BYTES, REMEMBERED_BYTES = 1 << 20, 1 << 22, 1 << 26
# Columns of a matrix end at these lengths; from the last one on each doubles.
BUCKETS = (4, 6, 8, 10, 12, 16, 24, 32, 48, 64)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks, which are also the ids, of a file with a token in base 64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank)
                for token, rank in (line.split() for line in lines if line.strip())}


class Merges:
    """Rank of every pair of ids whose joined bytes are a token, in an open hash table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.byte_id = np.full(256, -1, dtype=np.int32)
        for token, rank in ranks.items():
            if len(token) == 1:
                self.byte_id[token[0]] = rank
        if (self.byte_id < 0).any():
            raise ValueError("a byte-level vocabulary has all 256 bytes")
        pairs: list[tuple[int, int]] = []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append((left << 32 | right, rank))
        keys = np.array([k for k, _ in pairs], dtype=np.uint64)
        values = np.array([v for _, v in pairs], dtype=np.int32)
        self.bits = max(int(2 * len(keys) - 1).bit_length(), 1) if pairs else 1
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1), dtype=np.uint64)
        self.ranks = np.full(1 << self.bits, NONE, dtype=np.int32)
        slot = self._slot(keys)
        while len(keys):
            # Of the keys that want one free slot the first gets it; the others go on.
            free = self.keys[slot] == np.uint64(2**64 - 1)
            _, first = np.unique(slot, return_index=True)
            chosen = np.zeros(len(keys), dtype=bool)
            chosen[first] = True
            chosen &= free
            self.keys[slot[chosen]], self.ranks[slot[chosen]] = keys[chosen], values[chosen]
            keys, values = keys[~chosen], values[~chosen]
            slot = (slot[~chosen] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; ``NONE`` where the joined bytes are no token or an id is -1."""
        keys = left.astype(np.int64).astype(np.uint64) << np.uint64(32) | right.astype(
            np.uint32).astype(np.uint64)
        out = np.full(len(keys), NONE, dtype=np.int32)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._slot(keys[at])
        while len(at):
            there = self.keys[slot]
            hit = there == keys[at]
            out[at[hit]] = self.ranks[slot[hit]]
            on = ~hit & (there != np.uint64(2**64 - 1))
            at, slot = at[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out

    def merge(self, rows: np.ndarray) -> np.ndarray:
        """Ids of rows of ids, padded with -1 behind, once no pair is left to merge."""
        out = rows.copy()
        number = np.arange(len(rows))
        n, width = rows.shape
        ids = rows
        ranks = self.of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        while len(number):
            least = ranks.min(axis=1)
            done = least == NONE
            if done.any():
                out[number[done]] = -1
                out[number[done], :ids.shape[1]] = ids[done]
                number, ids, ranks, least = number[~done], ids[~done], ranks[~done], least[~done]
                if not len(number):
                    break
            row, at = np.nonzero(ranks == least[:, None])
            # Of overlapping pairs every second one, counted from the first of its run.
            start = np.ones(len(at), dtype=bool)
            start[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
            head = np.flatnonzero(start)
            run = np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
            row, at = row[run % 2 == 0], at[run % 2 == 0]
            merged, left, right = self._apply(ids, row, at, least)
            # Pairs made by a merge that rank below it come before the other equal pairs, also
            # the pair with the next token where that is about to be merged itself.
            wrong = np.minimum(left, right) < least[row]
            next_to = np.flatnonzero((row[1:] == row[:-1]) & (at[1:] == at[:-1] + 2))
            if len(next_to):
                r = row[next_to]
                wrong[next_to] |= self.of(least[r], ids[r, at[next_to] + 2]) < least[r]
            if wrong.any():
                first = np.ones(len(row), dtype=bool)
                first[1:] = row[1:] != row[:-1]
                keep = first | ~np.isin(row, row[wrong])
                row, at = row[keep], at[keep]
                merged, left, right = self._apply(ids, row, at, least)
            ids, ranks = self._compact(merged, ranks, row, at, left, right)
        return out

    def _apply(self, ids, row, at, least):
        """Ids with the merged ones in place and -2 behind each, and the ranks of the pairs that
        every merged id makes with its left and right neighbour."""
        merged = ids.copy()
        merged[row, at] = least[row]
        merged[row, at + 1] = -2
        before = np.where(at > 0, merged[row, at - 1], -1)
        # The place before a merged pair may be the hole of another one.
        before = np.where(before == -2, merged[row, np.maximum(at - 2, 0)], before)
        width = ids.shape[1]
        behind = np.where(at + 2 < width, merged[row, np.minimum(at + 2, width - 1)], -1)
        own = least[row]
        return merged, self.of(before, own), self.of(own, behind)

    def _compact(self, merged, ranks, row, at, left, right):
        """The rows without holes, as narrow as the longest, and the ranks of their pairs."""
        n, width = merged.shape
        pair = np.full((n, width), NONE, dtype=np.int32)
        pair[:, :-1] = ranks
        pair[row, at] = right
        has_left = at > 0
        r, a = row[has_left], at[has_left] - 1
        a = np.where(merged[r, a] == -2, a - 1, a)
        pair[r, a] = left[has_left]
        stay = merged >= 0
        size = stay.sum(axis=1)
        widest = max(int(size.max()), 2)
        ids = np.full((n, widest), -1, dtype=np.int32)
        out = np.full((n, widest), NONE, dtype=np.int32)
        place = np.arange(widest) < size[:, None]
        ids[place], out[place] = merged[stay], pair[stay]
        return ids, out[:, :-1]


def bucket_of(length: int) -> int:
    """Columns of the matrix for a piece of so many bytes."""
    for columns in BUCKETS:
        if length <= columns:
            return columns
    return 1 << (length - 1).bit_length()


class Encoder:
    """Ids of texts by ranks and a pattern, without special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.findall = regex.compile(pattern).findall
        self.whole = ranks
        self.merges = Merges(ranks)
        self.known: dict[str, bytes] = {}
        self.held = 0

    def pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of every piece as little-endian unsigned 32-bit numbers."""
        found: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.whole.get(piece)
            if whole is not None:
                found[i] = whole.to_bytes(4, "little")
            elif piece:
                buckets.setdefault(bucket_of(len(piece)), []).append(i)
        for columns, members in buckets.items():
            share = max(CELLS // columns, 1)
            for start in range(0, len(members), share):
                chosen = members[start:start + share]
                data = [pieces[i] for i in chosen]
                sizes = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
                rows = np.full((len(data), int(sizes.max())), -1, dtype=np.int32)
                rows[np.arange(rows.shape[1]) < sizes[:, None]] = self.merges.byte_id[
                    np.frombuffer(b"".join(data), dtype=np.uint8)]
                rows = self.merges.merge(rows)
                ends = np.cumsum((rows >= 0).sum(axis=1)) * 4
                flat, at = rows[rows >= 0].astype("<u4").tobytes(), 0
                for i, end in zip(chosen, ends.tolist(), strict=True):
                    found[i], at = flat[at:end], end
        return found

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of every text as little-endian unsigned 32-bit numbers; none for null.

        Pieces are remembered up to a bound; the ids do not depend on what is remembered.
        """
        if self.held > REMEMBERED_BYTES:
            self.known, self.held = {}, 0
        cut = [self.findall(text) if text else [] for text in texts]
        new = list({piece for pieces in cut for piece in pieces} - self.known.keys())
        ids = self.pieces([piece.encode() for piece in new])
        self.known.update(zip(new, ids, strict=True))
        self.held += sum(len(piece) + len(i) + 150 for piece, i in zip(new, ids, strict=True))
        for pieces in cut:
            yield b"".join(map(self.known.__getitem__, pieces))


def encode(docs: DataFrame, ranks: str, pattern: str, column: str = "text",
           ids: str = "ids") -> DataFrame:
    """``docs`` with the column ``ids``: the ids of the whole text, as array<int>.

    ``ranks`` is a rank file that every executor can read, ``pattern`` cuts a text into the
    pieces that are encoded one by one. A null or empty text has no ids; strings of special
    tokens are text. A column named like ``ids`` is replaced. Very long texts are encoded whole,
    in time that grows with their length. An empty table gives no rows; every row is encoded by
    itself, also repeated ones, so nothing is moved between tasks.
    """
    kept = docs.drop(ids)
    schema = T.StructType([*kept.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(read_ranks(ranks), pattern)
        for batch in batches:
            at = batch.schema.get_field_index(column)
            for start, stop in runs(batch.column(at), RUN_BYTES):
                part = batch.slice(start, stop - start)
                found = list(encoder.encode(part.column(at).to_pylist()))
                sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                flat = np.frombuffer(b"".join(found), dtype="<i4")
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, lists], names=[*part.schema.names, ids])

    return kept.mapInArrow(run, schema)


def decode(tokens: DataFrame, ranks: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``tokens`` with the bytes that the ids stand for in ``column``; null ids give null.

    An id that the file does not have fails the job, as there is no right answer for it.
    """
    kept = tokens.drop(column)
    schema = T.StructType([*kept.schema.fields, T.StructField(column, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = {rank: token for token, rank in read_ranks(ranks).items()}.__getitem__
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            offsets, flat = lists.offsets.to_numpy().tolist(), lists.values
            there = lists.is_valid().to_pylist()
            data = [b"".join(map(bytes_of, flat[a:b].to_numpy(zero_copy_only=False).tolist()))
                    if ok else None for a, b, ok in zip(offsets, offsets[1:], there, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(data, pa.binary())], names=[*batch.schema.names, column])

    return kept.mapInArrow(run, schema)


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of rows with ids and their bytes."""
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return tokens.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
