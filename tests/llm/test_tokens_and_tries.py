"""Byte-level BPE, token alignment and prefix tries against plain versions."""

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from starboard.llm import alignment, byte_bpe, prefix_trie, queries
from starboard.llm.common import table

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
LETTERS = "abcdefghijklmnopqrstuvwxyz ABC'  \n\t12,.éß中文字😀"
SPECIAL = "a <|endoftext|> b </s> <s>"


def texts(n, seed=1):
    draw = random.Random(seed)
    made = ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 200))) for _ in range(n)]
    return [*made, None, "", " ", "a", SPECIAL, "▁ written", "ﬁne", "x" * 5000, "ab" * 3000,
            "=-" * 2000, "中" * 3000, " " * 4000 + "x", "\x1c\x85　​", made[0], made[0]]


def documents(spark, rows):
    """Ids with a null, a repeated one and a clashing extra column."""
    ids = [None, 7, 7, *range(100, 100 + len(rows))][:len(rows)]
    data = [(i, t, [1]) for i, t in zip(ids, rows, strict=True)]
    return spark.createDataFrame(data, "doc_id long, text string, ids array<int>")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# --- byte-level BPE

def reference_encoding():
    import public_tokenizers
    import tiktoken

    ranks = byte_bpe.read_ranks(queries.vocabulary("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def bpe(docs):
    import public_tokenizers

    path = queries.vocabulary("byte_bpe_50k.tiktoken")
    return byte_bpe.decode(byte_bpe.encode(docs, path, public_tokenizers.PATTERN), path)


def test_encode_and_decode(spark):
    rows = texts(300)
    encoding = reference_encoding()
    docs = documents(spark, rows)
    got = Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in bpe(docs).collect())
    assert got == Counter(
        (d.doc_id, tuple(encoding.encode_ordinary(d.text or "")), (d.text or "").encode())
        for d in docs.collect())
    assert bpe(docs.limit(0)).count() == 0


def test_matrices_merge_as_one_pair_at_a_time_does():
    """Also for a made-up vocabulary, where a merge can make a pair of lower rank."""
    draw = random.Random(4)
    for _ in range(60):
        tokens = {bytes([b]) for b in range(256)}
        while len(tokens) < 300:
            tokens.add(bytes(draw.choice(b"abc") for _ in range(draw.randint(2, 6))))
        order = sorted(tokens)
        draw.shuffle(order)
        ranks = {token: i for i, token in enumerate(order)}
        encoder = byte_bpe.Encoder(ranks, r"\S+")
        pieces = [bytes(draw.choice(b"abc") for _ in range(draw.randint(1, 40)))
                  for _ in range(40)]
        for piece, got in zip(pieces, encoder.pieces(pieces), strict=True):
            parts = [piece] if piece in ranks else [piece[i:i + 1] for i in range(len(piece))]
            while True:
                pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(
                    zip(parts, parts[1:], strict=False)) if a + b in ranks]
                if not pairs:
                    break
                at = min(pairs)[1]
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            assert np.frombuffer(got, "<u4").tolist() == [ranks[p] for p in parts]


def test_forgetting_pieces_changes_no_id(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(byte_bpe, "REMEMBERED_BYTES", 100)
    monkeypatch.setattr(byte_bpe, "CELLS", 64)
    encoding = reference_encoding()
    ranks = byte_bpe.read_ranks(queries.vocabulary("byte_bpe_50k.tiktoken"))
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    rows = texts(40, 9)
    for start in range(0, len(rows), 7):
        part = rows[start:start + 7]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(part)] == [
            encoding.encode_ordinary(t or "") for t in part]


def test_every_kind_of_character_is_cut_as_the_library_does():
    import public_tokenizers

    encoding = reference_encoding()
    ranks = byte_bpe.read_ranks(queries.vocabulary("byte_bpe_50k.tiktoken"))
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    points = [c for c in [*range(0x3100), *range(0x3100, 0x110000, 61)]
              if not 0xD800 <= c < 0xE000]
    rows = [f"x{chr(c)}9{chr(c)}  {chr(c)} {chr(c)}y" for c in points]
    for text, ids in zip(rows, encoder.encode(rows), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoding.encode_ordinary(text)


def test_very_long_pieces():
    import public_tokenizers

    encoding = reference_encoding()
    ranks = byte_bpe.read_ranks(queries.vocabulary("byte_bpe_50k.tiktoken"))
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    draw = random.Random(3)
    rows = ["eyJ" * 300_000, "a" * 1_000_000, "".join(
        draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))]
    for text, ids in zip(rows, encoder.encode(rows), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoding.encode_ordinary(text)


def test_unknown_ids_and_vocabularies_without_bytes_fail(spark):
    path = queries.vocabulary("byte_bpe_50k.tiktoken")
    rows = spark.createDataFrame([([50_300],)], "ids array<int>")
    with pytest.raises(Exception, match="KeyError"):
        byte_bpe.decode(rows, path).collect()
    with pytest.raises(ValueError, match="256"):
        byte_bpe.Merges({b"a": 0})


@tables
def test_op11(spark):
    encoding = reference_encoding()
    expected = Counter()
    for row in table(spark, SF, "documents").collect():
        ids = encoding.encode_ordinary(row.text or "")
        expected[row.doc_id, len(ids), sha(" ".join(map(str, ids))),
                 sha((row.text or "").encode())] += 1
    got = queries.op11_byte_bpe(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == expected


# --- alignment

def plain_alignment(rows):
    """Per text (n_a, n_b, n_groups, groups) and links, by all pairs of byte ranges."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary())
    tokenizer.encode_special_tokens = True
    first = alignment.BytePairs(queries.vocabulary()).bytes_of
    second = alignment.Pieces(queries.vocabulary("piece_bpe_32k.model"))
    out = []
    for text in rows:
        wanted = (" " + (text or "")).encode()
        a = tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.model.encode(text or "")
        sides = [(a, [first[i] for i in a]), (b, [second.bytes_of[i] for i in b])]
        if not text or any(b"".join(data) != wanted for _, data in sides):
            out.append(((0, 0, 0, ""), []))
            continue
        spans = []
        for ids, data in sides:
            ends = np.cumsum([len(x) for x in data]).tolist()
            spans.append(list(zip(ids, [0, *ends], ends, strict=False)))
        both = {e for _, _, e in spans[0]} & {e for _, _, e in spans[1]}
        groups = []
        for side in spans:
            lists = [[]]
            for i, _, end in side:
                lists[-1].append(str(i))
                if end in both:
                    lists.append([])
            groups.append(lists[:-1])
        links, at = [], 0
        for i, start, end in spans[0]:
            while spans[1][at][2] <= start:
                at += 1
            links += [(i, j) for j, s, e in spans[1][at:at + end - start] if s < end and e > start]
        text = ";".join(",".join(x) + "|" + ",".join(y) for x, y in zip(*groups, strict=True))
        out.append(((len(a), len(b), len(groups[0]), text), links))
    return out


def plain_scores(rows):
    plain = plain_alignment(rows)
    counts = Counter(link for _, links in plain for link in links)
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [(*head[:3], len(links), sum(counts[k] == highest[k[1]] for k in links),
             sum(counts[k] for k in links), head[3]) for head, links in plain]


def align(docs):
    return alignment.align_documents(
        docs, queries.vocabulary(), queries.vocabulary("piece_bpe_32k.model"))


@pytest.mark.parametrize("lane", [1, 3, 256])
def test_runs_are_skipped_whatever_the_lanes(monkeypatch, lane):
    monkeypatch.setattr(alignment, "LANE", lane)
    draw = np.random.default_rng(lane)
    for n in [1, 2, 5, 40, 3000]:
        ends = [np.unique(np.append(draw.integers(1, 3 * n + 1, n), 3 * n)) for _ in "ab"]
        cuts = alignment.align(*ends)
        for own, other, cut in [(*ends, cuts[0]), (*reversed(ends), cuts[1])]:
            assert cut.tolist() == np.isin(own, other).tolist()
    assert [c.tolist() for c in alignment.align(np.zeros(0, int), np.zeros(0, int))] == [[], []]


@pytest.mark.parametrize("most", [0, 50, 10**6])
def test_groups_links_and_scores(spark, most):
    rows = texts(120, 5)
    docs = documents(spark, rows)
    aligned = queries.stage(align(docs), "aligned")
    counts = alignment.link_counts(aligned)
    got = alignment.score(aligned, counts, most).collect()
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert Counter((r.doc_id, *[r[n] for n in names]) for r in got) == Counter(
        (d.doc_id, *row) for d, row in zip(docs.collect(), plain_scores(rows), strict=True))


def test_alignment_of_nothing_and_of_very_long_texts(spark):
    docs = documents(spark, [None, ""])
    for chosen, n in ((docs, 2), (docs.limit(0), 0)):
        aligned = queries.stage(align(chosen), "aligned")
        got = alignment.score(aligned, alignment.link_counts(aligned)).collect()
        assert len(got) == n and all(r.n_links == r.count_sum == 0 for r in got)
    aligner = alignment.Aligner(alignment.BytePairs(queries.vocabulary()),
                                alignment.Pieces(queries.vocabulary("piece_bpe_32k.model")))
    for text in ("eyJ" * 100_000, " " * 500_000 + "x", "word " * 100_000):
        rows, _, links = aligner.rows([text])
        a, b, groups, _ = rows[0]
        assert a and b and groups and links[0] == a + b - groups


@tables
def test_op12(spark):
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    scored = plain_scores([r.text for r in rows])
    expected = Counter((r.doc_id, *s[:6], sha(s[6]) if s[6] else "")
                       for r, s in zip(rows, scored, strict=True))
    got = queries.op12_alignment(spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                           "groups_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == expected


# --- prefix trie

def plain_trie(conversations):
    """Nodes of {conv_id: [(role, text), ...]}."""
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(set)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    leaves, saved = Counter(), Counter()
    for path, held in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(held) - 1) * len(path[-1][1].encode()) if path else 0
    return Counter(
        (min(held), len(path), min(members[path[:-1]]) if path else None, len(held),
         len(children[path]), leaves[path], saved[path],
         sha(",".join(str(c) for c in sorted(held) if len(conversations[c]) == len(path))))
        for path, held in members.items())


def spliced(rows):
    """The conversations that the query is to build, from rows (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256"]
TURNS = "conv_id long, turn long, role string, text string"


def conversation_rows():
    """Null and tied turns, null roles and texts, equal conversations, a long one, repeated rows."""
    draw = random.Random(8)
    rows = []
    for c in range(60):
        for t in range(draw.randint(1, 12)):
            rows.append((c, t, draw.choice(["user", "assistant", None]),
                         draw.choice(["ok", "é", "", None, "yes"])))
    rows += [(c, t, "user", "same") for c in (70, 71, 72, 75) for t in range(70)]
    rows += [(72, 70 + t, "user", f"{t}") for t in range(45)]
    rows += [(80, None, "user", "b"), (80, None, "user", "a"), (80, 1, "x", "y"), (80, 1, "x", "y"),
             (None, 0, "user", "lost"), (10**12 + 1, 0, "user", "ok")]
    return rows


@pytest.mark.parametrize("widths", [(8, 16, 32), (2,), (1, 3)])
def test_trie(spark, widths):
    rows = [r for r in conversation_rows() if widths[0] > 2 or r[1] is None or r[1] < 9]
    frame = spark.createDataFrame(rows, TURNS)
    turns = queries.stage(prefix_trie.ordered_turns(frame), "ordered")
    nodes = prefix_trie.prefix_trie(*queries.spliced(turns), widths=widths)
    got = Counter(tuple(r) for r in nodes.select(*NODE).collect())
    assert got == plain_trie(spliced(rows))
    ids = {r.turn_id is None for r in nodes.where("depth = 0").collect()}
    assert ids == {True}


def test_positions_over_many_parts(spark):
    """A conversation with most rows is cut over several parts and still numbered in order."""
    rows = [(1, t, "user", "x") for t in range(2000)] + [(2, 0, "user", "x"), (3, 5, None, None)]
    frame = spark.createDataFrame(rows, TURNS).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = prefix_trie.ordered_turns(frame).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r.conv_id, r.position, r.n_turns) for r in got) == [
        *[(1, t, 2000) for t in range(2000)], (2, 0, 1), (3, 0, 1)]


def test_tries_without_turns(spark):
    none = spark.createDataFrame([], TURNS)
    turns = queries.stage(prefix_trie.ordered_turns(none), "ordered")
    assert prefix_trie.prefix_trie(*queries.spliced(turns)).count() == 0
    only = spark.createDataFrame([(4, 0), (9, 0)], "conv_id long, n_turns long")
    got = prefix_trie.prefix_trie(turns, only).select(*NODE).collect()
    assert [tuple(r) for r in got] == [(4, 0, None, 2, 0, 1, 0, sha("4,9"))]


@tables
def test_op13(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select(
        "conv_id", "turn", "role", "text").collect()]
    got = queries.op13_prefix_trie(spark, SF)
    assert got.columns == NODE
    assert Counter(tuple(r) for r in got.collect()) == plain_trie(spliced(rows))
