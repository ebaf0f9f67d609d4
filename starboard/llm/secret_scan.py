"""Secret scans through a trigram index.

From each rule's regular expression a Boolean query over trigrams is derived by walking the
parsed pattern: every match holds one string of each of some sets, and of that string all
trigrams. An inverted index holds, for the trigrams that the rules ask for, the documents having
them; intersecting its postings by the query leaves few candidates, which the regular expression
then verifies. A rule without mandatory trigrams scans every text.
"""

from __future__ import annotations

import re._constants as kinds_of
import re._parser as patterns
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starboard.llm.common import small
from starboard.session import stage

# Strings that a part of a pattern is written out to at most, and repeats that are written out.
WRITTEN, REPEATS = 64, 4


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched leftmost and non-overlapping; a match fails unless its
    ``group`` has ``shortest`` characters."""

    kind: str
    pattern: str
    group: int = 0
    shortest: int = 0


# The base rules, in the order of their kinds.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                   r"([A-Za-z0-9+/_.=-]+)", 1, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Runs of fewer than 24 fail anyway, and such a run cannot hide a longer one.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Further public token formats.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    # Headers are of bounded length, or a long run of "eyJ" would be tried from each of them on to
    # its end.
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,2048}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

Strings = frozenset[str]


def trigrams(word: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(word[i:i + 3] for i in range(len(word) - 2)))


def _shortest(strings: Strings) -> Strings:
    """Without strings that hold another one: who has one of all has one of these."""
    return frozenset(s for s in strings if not any(o != s and o in s for o in strings))


def _demand(strings: Strings | None) -> list[Strings]:
    """What holding one of the strings demands: nothing if one of them has no trigram."""
    if not strings or min(map(len, strings)) < 3:
        return []
    return [_shortest(strings)]


def _chars(members: list) -> Strings | None:
    """The characters of a class in lower case; None if it has many or is a negation."""
    found: set[str] = set()
    for kind, value in members:
        if kind is kinds_of.LITERAL:
            found.add(chr(value).lower())
        elif kind is kinds_of.RANGE and value[1] - value[0] < WRITTEN:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return frozenset(found) if len(found) <= WRITTEN // 4 else None


def _product(left: Strings | None, right: Strings | None) -> Strings | None:
    if left is None or right is None or len(left) * len(right) > WRITTEN:
        return None
    return frozenset(a + b for a in left for b in right)


def _part(kind, value) -> tuple[Strings | None, list[Strings]]:
    """All strings that a part of a pattern matches, in lower case, if they are few; and sets of
    strings of which every match holds one each."""
    if kind is kinds_of.LITERAL:
        return frozenset({chr(value).lower()}), []
    if kind is kinds_of.IN:
        return _chars(value), []
    if kind is kinds_of.AT or kind in (kinds_of.ASSERT, kinds_of.ASSERT_NOT):
        return frozenset({""}), []
    if kind is kinds_of.SUBPATTERN:
        return _sequence(value[-1])
    if kind is kinds_of.ATOMIC_GROUP:
        return _sequence(value)
    if kind is kinds_of.BRANCH:
        parts = [_sequence(way) for way in value[1]]
        strings = [exact for exact, _ in parts]
        if None not in strings and len(frozenset().union(*strings)) <= WRITTEN:
            return frozenset().union(*strings), []
        # One set of each way; a way without any leaves the branch without demand.
        demands = [min(_demand(exact) + needs, key=len, default=None) for exact, needs in parts]
        if None in demands or sum(map(len, demands)) > WRITTEN:
            return None, []
        return None, [_shortest(frozenset().union(*demands))]
    if kind in (kinds_of.MAX_REPEAT, kinds_of.MIN_REPEAT, kinds_of.POSSESSIVE_REPEAT):
        least, most, inner = value
        exact, needs = _sequence(inner)
        if most <= REPEATS:
            written, whole = frozenset({""}), frozenset() if least else frozenset({""})
            for times in range(1, int(most) + 1):
                written = _product(written, exact)
                if written is None:
                    break
                whole |= written if times >= least else frozenset()
            if written is not None and len(whole) <= WRITTEN:
                return whole, []
        return None, (_demand(exact) + needs) if least else []
    return None, []


def _sequence(parts) -> tuple[Strings | None, list[Strings]]:
    run: Strings | None = frozenset({""})
    demands: list[Strings] = []
    unbroken = True
    for kind, value in parts:
        exact, needs = _part(kind, value)
        longer = _product(run, exact)
        if longer is None:
            unbroken = False
            demands += _demand(run) + needs
            longer = exact if exact is not None else frozenset({""})
        run = longer
    return (run, []) if unbroken else (None, demands + _demand(run))


def trigram_query(pattern: str) -> tuple[Strings, ...]:
    """Sets of strings, in lower case: every match of the pattern holds one string of each set.

    Empty if the pattern has no mandatory trigrams. The parts of the pattern that can be written
    out to few strings are; what stands beside parts that cannot starts anew.
    """
    exact, needs = _sequence(patterns.parse(pattern))
    return tuple(dict.fromkeys(_demand(exact) + needs))


def any_trigram(wanted: list[str]) -> str:
    """A pattern for any of the trigrams, by first and second character, so that a position
    without one is left after few comparisons."""
    def plain(c: str) -> str:
        return f"\\x{ord(c):02x}"

    tree: dict[str, dict[str, set[str]]] = {}
    for t in wanted:
        tree.setdefault(t[0], {}).setdefault(t[1], set()).add(t[2])
    return "|".join(
        plain(a) + "(?:" + "|".join(
            f"{plain(b)}[{''.join(map(plain, sorted(ends)))}]" for b, ends in sorted(rest.items()))
        + ")" for a, rest in sorted(tree.items()))


def postings(texts: DataFrame, wanted: list[str]) -> DataFrame:
    """(trigram, row): the inverted index, for the wanted trigrams only.

    A look-ahead finds trigrams at every position, overlapping ones too.
    """
    found = F.regexp_extract_all(F.lower("text"), F.lit(f"(?=({any_trigram(wanted)}))"), F.lit(1))
    return texts.select("row", F.explode(F.array_distinct(found)).alias("trigram"))


def matching(held: Column, query: tuple[Strings, ...]) -> Column:
    """Whether an array of trigrams satisfies a query."""
    def word(string: str) -> Column:
        return reduce(Column.__and__, [F.array_contains(held, t) for t in trigrams(string)])

    return reduce(Column.__and__, [
        reduce(Column.__or__, [word(string) for string in sorted(strings)]) for strings in query])


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(row, kinds): rows whose postings satisfy a rule's query, with the kinds to verify.

    Postings are intersected by row, so a frequent trigram is spread over all tasks, and a row
    brings at most the trigrams that the rules ask for.
    """
    held = index.groupBy("row").agg(F.collect_set("trigram").alias("held"))
    found = [F.when(matching(F.col("held"), trigram_query(rule.pattern)), rule.kind)
             for rule in rules]
    return held.select("row", F.array_compact(F.array(*found)).alias("kinds")).where(
        F.size("kinds") > 0)


def asked_trigrams(rules: tuple[Rule, ...]) -> list[str]:
    """The trigrams that the rules' queries look up."""
    return sorted({t for rule in rules for strings in trigram_query(rule.pattern)
                   for string in strings for t in trigrams(string)})


def write_index(docs: DataFrame, path: str, rules: tuple[Rule, ...] = BASE + MORE) -> None:
    """Write the inverted index of (doc_id, text) for later scans of the same documents."""
    postings(_texts(docs), asked_trigrams(rules)).write.parquet(path)


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row): a row's key is a hash of both."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce("text", F.lit("")).alias("text"))
    return texts.withColumn("row", F.xxhash64("doc_id", "text"))


def spans(text: Column, rule: Rule) -> Column:
    """Spans (kind, start, end) of a rule's matches in code points, end exclusive.

    Every match is taken with the gap before it, anchored where the last one ended, so the
    lengths add up to positions and a text is walked once.
    """
    whole = rf"\G((?s:.*?))({rule.pattern})"
    gaps = F.regexp_extract_all(text, F.lit(whole), F.lit(1))
    matches = F.regexp_extract_all(text, F.lit(whole), F.lit(2))
    value = F.regexp_extract_all(text, F.lit(whole), F.lit(2 + rule.group))
    steps = F.arrays_zip(gaps.alias("gap"), matches.alias("match"), value.alias("value"))
    walked = F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), F.array().cast(
            "array<struct<start:int,end:int,n:int>>").alias("found")),
        lambda state, s: F.struct(
            (state["at"] + F.length(s["gap"]) + F.length(s["match"])).alias("at"),
            F.concat(state["found"], F.array(F.struct(
                (state["at"] + F.length(s["gap"])).alias("start"),
                (state["at"] + F.length(s["gap"]) + F.length(s["match"])).alias("end"),
                F.length(s["value"]).alias("n")))).alias("found")))["found"]
    return F.transform(F.filter(walked, lambda s: s["n"] >= rule.shortest), lambda s: F.struct(
        F.lit(rule.kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE,
                 index: str | None = None) -> DataFrame:
    """(doc_id, spans) for every row of ``docs`` (doc_id, text): where secrets stand.

    spans are structs (kind, start, end) in code points, by start and then by the rules' order;
    a text that is null, empty or clean has an empty list. Repeated rows each have theirs, an
    empty table gives no rows, and texts of any length are read whole, in time that grows with
    their length. ``index`` is the path of an index that ``write_index`` has made of the same
    documents, for the same rules or more; without it one is written for this scan.

    The index moves row keys and trigrams; the text stays where it is read as long as the
    candidates are few enough to be broadcast, and is joined with them beyond that. Rows that
    share a key are verified alike, so a chance match adds only work.
    """
    spark: SparkSession = docs.sparkSession
    texts = _texts(docs)
    indexed = tuple(r for r in rules if trigram_query(r.pattern))
    chosen = F.array().cast("array<string>")
    if indexed:
        asked = asked_trigrams(indexed)
        stored = (stage(postings(texts, asked), "secret-index") if index is None
                  else spark.read.schema("row long, trigram string").parquet(index))
        hits = stage(candidates(stored, indexed), "secret-candidates")
        texts = texts.join(small(hits), "row", "left")
        chosen = F.coalesce("kinds", chosen)

    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    found = []
    for rule in rules:
        wanted = F.array_contains(chosen, rule.kind) if rule in indexed else \
            F.col("text").rlike(rule.pattern)
        found.append(F.when(wanted, spans(F.col("text"), rule)).otherwise(none))
    order = F.array(*[F.lit(rule.kind) for rule in rules])
    ranked = F.transform(F.concat(*found), lambda s: F.struct(
        s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s.alias("s")))
    return texts.select("doc_id", F.transform(F.array_sort(ranked), lambda r: r["s"])
                        .alias("spans"))
