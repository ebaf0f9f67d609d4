"""Language identification by cross-parsing.

For every language a suffix automaton holds all substrings of labelled text. A text is parsed
word by word into phrases, each the longest one from there that the automaton knows; the
language whose text needs the fewest phrases per letter wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starboard.llm.common import runs, table

UNKNOWN = "und"
# Bounds of the labelled sample: documents per language, characters of each and, in all, letters
# of distinct words per language. The languages told apart are those of the labelled rows. A
# language with less than THIN of the letters of the richest does not bound the others, and none
# bounds them below FEW_LETTERS.
SAMPLE_DOCS = 64
SAMPLE_CHARS = 4000
SAMPLE_LETTERS = 24_000
THIN, FEW_LETTERS = 0.5, 2000
# Parsed words that a Python worker remembers before it starts anew.
REMEMBERED = 300_000
# Bytes of text parsed together.
PORTION = 1_000_000

# Letters are the characters of the categories L*; fractions or Roman numerals are none.
_WORD = regex.compile(r"\p{L}+")
_READY: dict[int, tuple] = {}


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    return _WORD.findall(text.lower())


def suffix_automaton(words: list[str]) -> tuple[list[dict[str, int]], list[int]]:
    """Transitions and failure links of the smallest automaton of all substrings of the words."""
    follow: list[dict[str, int]] = [{}]
    link, longest = [-1], [0]
    for word in words:
        last = 0
        for c in word:
            if c in follow[last]:
                q = follow[last][c]
                if longest[q] == longest[last] + 1:
                    last = q
                    continue
                last = _split(follow, link, longest, last, q, c)
                continue
            new = len(follow)
            follow.append({})
            link.append(0)
            longest.append(longest[last] + 1)
            p = last
            while p >= 0 and c not in follow[p]:
                follow[p][c] = new
                p = link[p]
            if p >= 0:
                q = follow[p][c]
                link[new] = q if longest[q] == longest[p] + 1 else \
                    _split(follow, link, longest, p, q, c)
            last = new
    return follow, link


def _split(follow, link, longest, p, q, c) -> int:
    """Give the substrings of state ``q`` that end after state ``p`` a state of their own."""
    copy = len(follow)
    follow.append(dict(follow[q]))
    link.append(link[q])
    longest.append(longest[p] + 1)
    link[q] = copy
    while p >= 0 and follow[p].get(c) == q:
        follow[p][c] = copy
        p = link[p]
    return copy


class Automaton:
    """The transitions as one table of states by letters, walked by many words at once."""

    def __init__(self, words: list[str]):
        follow, _ = suffix_automaton(words)
        letters = sorted({c for w in words for c in w})
        self.code = np.zeros(0x110000, dtype=np.int16)  # 0 is a letter never seen
        for i, c in enumerate(letters):
            self.code[ord(c)] = i + 1
        self.next = np.full((len(follow), len(letters) + 1), -1, dtype=np.int32)
        for state, ways in enumerate(follow):
            for c, to in ways.items():
                self.next[state, self.code[ord(c)]] = to

    def phrases(self, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Number of longest known phrases of each word; a letter never seen is one by itself.

        Words are code points from ``starts`` on, the longest first.
        """
        codes = self.code[points]
        count = np.zeros(len(starts), dtype=np.int64)
        state = np.zeros(len(starts), dtype=np.int32)
        for at in range(int(sizes[0]) if len(sizes) else 0):
            n = np.searchsorted(-sizes, -at, side="left")  # words longer than ``at``
            letter, now = codes[starts[:n] + at], state[:n]
            further = self.next[now, letter]
            ended = further < 0
            anew = np.where(ended, self.next[0, letter], further)
            count[:n] += (ended & (now > 0)).astype(np.int64) + (anew < 0)
            state[:n] = np.maximum(anew, 0)
        return count + (state > 0)


def labelled(docs: DataFrame) -> DataFrame:
    """Rows that may be learnt from: a language is given and the id is not held out."""
    return docs.where(F.col("lang").isNotNull() & ~held_out())


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame) -> dict[str, list[str]]:
    """Distinct words of a bounded labelled sample per language, the input of the automata.

    Per language the documents are dealt by hash to ``SAMPLE_DOCS`` seats and each seat takes
    one, so the sample is spread over all rows and the same on every run.
    """
    rows = labelled(docs).select("lang", F.xxhash64("doc_id").alias("h"))
    seats = rows.groupBy("lang", F.pmod("h", F.lit(SAMPLE_DOCS)).alias("seat")).agg(
        F.min(F.shiftright("h", 1)).alias("h"))
    chosen = F.broadcast(seats.select(F.col("lang").alias("l"), F.col("seat").alias("s"),
                                      F.col("h").alias("low")))
    h = F.xxhash64("doc_id")
    full = labelled(docs).withColumns({"s": F.pmod(h, F.lit(SAMPLE_DOCS)),
                                       "h": F.shiftright(h, 1)})
    texts = full.join(chosen, (full.lang == chosen.l) & (full.s == chosen.s)
                      & (full.h == chosen.low)).select(
        "lang", F.substring("text", 1, SAMPLE_CHARS).alias("text"), "h")
    texts = texts.groupBy("lang", "h").agg(F.min("text").alias("text"))
    sample: dict[str, dict[str, None]] = {}
    for row in texts.orderBy("lang", "h").collect():
        kept = sample.setdefault(row["lang"], {})
        for word in words_of(row["text"] or ""):
            kept[word] = None
    fitted = {}
    for lang, words in sample.items():
        letters, chosen_words = 0, []
        for word in words:
            if letters + len(word) > SAMPLE_LETTERS:
                break
            letters += len(word)
            chosen_words.append(word)
        fitted[lang] = chosen_words
    return {lang: words for lang, words in evened(fitted).items() if words}


def evened(fitted: dict[str, list[str]]) -> dict[str, list[str]]:
    """Words of each language up to the letters of the one with the least that is not thin.

    More text knows longer phrases, so languages are compared on the same amount. One with less
    than ``THIN`` of the letters of the richest is not waited for: it keeps what it has, which
    knows shorter phrases, and takes nothing from the others.
    """
    letters = {lang: sum(map(len, words)) for lang, words in fitted.items()}
    least = max(min((n for n in letters.values() if n >= THIN * max(letters.values())), default=0),
                FEW_LETTERS)
    result = {}
    for lang, words in sorted(fitted.items()):
        taken, kept_words = 0, []
        for word in words:
            if taken >= least:
                break
            kept_words.append(word)
            taken += len(word)
        result[lang] = kept_words
    return result


def _automata(sample: dict[str, list[str]]) -> tuple[list[str], list[Automaton]]:
    """Built once in each Python worker."""
    key = hash(tuple((lang, tuple(words)) for lang, words in sample.items()))
    if key not in _READY:
        _READY.clear()
        _READY[key] = (list(sample), [Automaton(w) for w in sample.values()])
    return _READY[key]


class Parser:
    """Phrases per language of whole texts; words already parsed are remembered."""

    def __init__(self, sample: dict[str, list[str]]):
        self.langs, self.automata = _automata(sample)
        self.seen: dict[str, int] = {}
        self.counts = np.zeros((REMEMBERED, len(self.langs)), dtype=np.int64)

    def _learn(self, unknown: set[str]) -> None:
        """Parse new words; texts with more of them than are remembered widen the table."""
        words = sorted(unknown, key=len, reverse=True)
        have = len(self.seen)
        if have + len(words) > len(self.counts):
            wider = np.zeros((have + len(words), len(self.langs)), np.int64)
            wider[:have] = self.counts[:have]
            self.counts = wider
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        starts = np.cumsum(sizes) - sizes
        for i, automaton in enumerate(self.automata):
            self.counts[have:have + len(words), i] = automaton.phrases(points, starts, sizes)
        self.seen.update(zip(words, range(have, have + len(words)), strict=True))

    def parse(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The language of each text and how sure that is: the share of the second language's
        phrases in both, so that 0.5 is a tie."""
        lists = [words_of(t) if isinstance(t, str) else [] for t in texts]
        unknown = {w for words in lists for w in words if w not in self.seen}
        if len(self.seen) + len(unknown) > REMEMBERED:
            self.seen, unknown = {}, {w for words in lists for w in words}
        self._learn(unknown)
        found = []
        for words in lists:
            if not words or not self.langs:
                found.append((UNKNOWN, 0.0))
                continue
            at = np.fromiter(map(self.seen.__getitem__, words), np.int64, len(words))
            rate = self.counts[at].sum(axis=0) / sum(map(len, words))
            order = np.argsort(rate, kind="stable")
            best = rate[order[0]]
            second = rate[order[1]] if len(order) > 1 else 1.0
            found.append((self.langs[order[0]], float(second / (best + second))))
        return found


def identify(docs: DataFrame, sample: dict[str, list[str]]) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs`` (doc_id, text).

    A text that is null or has no letter is ``und`` with score 0, as is every text when nothing
    was learnt. Ties go to the language that comes first by name. Repeated rows each have a
    row; texts are read whole; an empty table gives no rows. Only doc_id and text are read.
    """
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(sample)
        for batch in batches:
            for start, stop in runs(batch.column(1), PORTION):
                found = parser.parse(batch.column(1).slice(start, stop - start).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start),
                     pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64())],
                    names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        predict, "doc_id long, lang_pred string, score double")


def fit_documents(spark, sf_dir: str) -> dict[str, list[str]]:
    """The sample learnt from the documents table, whatever rows it is applied to."""
    return fit(table(spark, sf_dir, "documents"))
