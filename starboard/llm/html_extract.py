"""Main text of web pages by differencing with the page of the nearest URL.

Pages of a host are put in the order of their URL paths, and each is paired with the neighbour
whose path shares the longest prefix. The two pages' lines are aligned by their longest common
subsequence: shared lines are the site's template and are deleted, the others are kept, on pages
with and without a marked article. Marks overrule that for single lines only: a shared line inside
a marked article is the page's own content (two pages may carry the same article) and comes back, a
line that is not shared but stands in a menu, header, footer, sidebar, notice, advert, form or
comment goes. A page with a marked article and no neighbour to compare gives its article.
"""

from __future__ import annotations

import bisect
import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starboard.llm.common import range_borders, range_of

PAGES_PER_RANGE = 400
RANGES_PER_TASK = 4
TEMPLATE, BODY, ARTICLE = 0, 1, 2

# What elements mean, by HTML's own vocabulary.
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img input
 ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr""".split())
VOID = frozenset("""area base br col embed hr img input link meta param source track wbr""".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
UNSEEN = frozenset("""head script style textarea title noscript template iframe svg math object
 canvas select button option datalist audio video""".split())
CHROME = frozenset("nav header footer aside form menu dialog".split())
CHROME_ROLES = frozenset("""navigation banner contentinfo complementary search form menu menubar
 dialog alert""".split())
CHROME_NAMES = frozenset("""ad ads advert adverts advertisement advertising banner sponsor
 sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer
 header masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter
 subscribe signup login social share sharing comment comments respond reply replies disqus related
 recommended pagination pager widget toolbar""".split())
HEADINGS = frozenset("header masthead banner".split())  # in an article, its own head
# Words that may stand beside one of these in a name without giving it another meaning.
PLAIN_NAMES = frozenset("""area bar block body bottom box button buttons container content inner item
 items left link links list main outer panel primary right secondary section site text title top
 wrap wrapper""".split())
ARTICLE_NAMES = frozenset("""article articlebody article-body article-content post-content
 entry-content main-content""".split())
ARTICLE_TAGS = frozenset("article main".split())
CLOSES_P = frozenset("""address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5
 h6 header hr main menu nav ol p pre section table ul""".split())
CLOSES_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
               "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<end2>/?)(?P<tag2>[A-Za-z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)"""
    r"""|[^<]+|<""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[a-z]+", re.I)
_WHITE = re.compile(r"\s+")


def _names_chrome(value: str, inside: int) -> bool:
    """Whether a class or id names a part of the template.

    Inside an article all words of a name have to: ``related-posts`` may be a list of links, but
    ``related-work`` and ``share-price`` are as likely its own sections.
    """
    for token in value.split():
        words = _NAME.findall(token)
        named = [w in CHROME_NAMES and not (w in HEADINGS and inside == ARTICLE) for w in words]
        if any(named) and (inside != ARTICLE or all(
                chrome or w in PLAIN_NAMES for w, chrome in zip(words, named, strict=True))):
            return True
    return False


class _Open:
    """The open elements, innermost last, each with the kind to go back to.

    How many are open by tag and where those stand that are no inline ones is kept beside them,
    so that no page makes a step look through all of them.
    """

    def __init__(self):
        self.stack: list[tuple[str, int]] = []
        self.count: Counter[str] = Counter()
        self.blocks: list[int] = []
        self.unseen = 0

    def push(self, tag: str, kind: int) -> None:
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, kind))
        self.count[tag] += 1
        self.unseen += tag in UNSEEN

    def cut(self, at: int) -> int:
        """Close the elements from ``at`` on; returns the kind to go back to."""
        kind = self.stack[at][1]
        for tag, _ in self.stack[at:]:
            self.count[tag] -= 1
            self.unseen -= tag in UNSEEN
        del self.stack[at:]
        while self.blocks and self.blocks[-1] >= at:
            self.blocks.pop()
        return kind

    def innermost(self, tag: str) -> int | None:
        """Place of the innermost open element of a tag. What is passed over is about to be cut."""
        if not self.count[tag]:
            return None
        at = len(self.stack) - 1
        while self.stack[at][0] != tag:
            at -= 1
        return at

    def ended_by(self, closing: tuple[str, ...]) -> int | None:
        """Place of the element that the next one ends: one of ``closing`` with only inline ones
        inside it."""
        if self.blocks and self.stack[self.blocks[-1]][0] in closing:
            return self.blocks[-1]
        return None


def _meaning(tag: str, rest: str, inside: int) -> int | None:
    """TEMPLATE or ARTICLE if the element says so; None if it is as what surrounds it."""
    if tag in UNSEEN:
        return TEMPLATE
    if tag in CHROME and not (tag == "header" and inside == ARTICLE):
        return TEMPLATE
    if rest and ("=" in rest or "hidden" in rest):
        for name, a, b, c in _ATTRIBUTE.findall(rest):
            name, value = name.lower(), (a or b or c).lower()
            if name == "hidden" or name == "aria-hidden" and value == "true" \
                    or name == "style" and "display:none" in value.replace(" ", ""):
                return TEMPLATE
            if name == "role" and value in CHROME_ROLES:
                return TEMPLATE
            if name == "role" and value in ("main", "article"):
                return ARTICLE
            if name in ("class", "id") and tag not in ("html", "body", "article", "main") \
                    and _names_chrome(value, inside):
                return TEMPLATE
            if name in ("class", "id") and not ARTICLE_NAMES.isdisjoint(value.split()):
                return ARTICLE
    return ARTICLE if tag in ARTICLE_TAGS else None


def page_lines(source: str) -> list[tuple[str, int]]:
    """Text lines of a page (one per block, white space folded) with what they stand in."""
    lines: list[tuple[str, int]] = []
    open_ = _Open()
    kind, parts = BODY, []

    def flush() -> None:
        if parts:
            text = _WHITE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                lines.append((text, kind))
            parts.clear()

    position = 0
    while position < len(source):
        token = _TOKEN.match(source, position)
        position = token.end()
        tag = token["tag"] or token["tag2"]
        if not tag:
            piece = token[0]
            if piece[0] != "<" or piece == "<":
                if kind != TEMPLATE or not open_.unseen:
                    parts.append(piece)
            elif piece.startswith("<![CDATA["):
                parts.append(html.escape(piece[9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if token["end"] or token["end2"]:
            at = open_.innermost(tag)
            if tag not in INLINE:
                flush()
            if at is not None:
                if any(k != kind for _, k in open_.stack[at:]):
                    flush()
                kind = open_.cut(at)
            continue
        rest = token["rest"] or token["rest2"] or ""
        meaning = _meaning(tag, rest, kind)
        if tag == "br":
            parts.append(" ")
            continue
        if tag == "body":  # also ends a head left open
            flush()
            kind = BODY
            open_ = _Open()
            continue
        if tag not in INLINE:
            flush()
            closing = ("p",) if tag in CLOSES_P else CLOSES_SAME.get(tag, ())
            ended = open_.ended_by(closing)
            if ended is not None:
                kind = open_.cut(ended)
        if tag in VOID or rest.endswith("/") and tag not in RAW and tag not in ARTICLE_TAGS:
            continue
        open_.push(tag, kind)
        if kind != TEMPLATE and meaning is not None and meaning != kind:
            flush()
            kind = meaning
        if tag in RAW:
            ending = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, position)
            if ending:
                position = ending.end()
                kind = open_.cut(len(open_.stack) - 1)
            else:
                position = len(source)
    flush()
    return lines


def shared_lines(own: list[str], other: list[str]) -> set[int]:
    """Positions in ``own`` of a longest common subsequence of lines with ``other``.

    Equal starts and ends are matched first; between them only lines that both pages have take
    part, so the table stays small on pages that differ.
    """
    start = 0
    while start < len(own) and start < len(other) and own[start] == other[start]:
        start += 1
    end = 0
    while end < len(own) - start and end < len(other) - start \
            and own[-1 - end] == other[-1 - end]:
        end += 1
    found = set(range(start)) | set(range(len(own) - end, len(own)))
    theirs = set(other[start:len(other) - end])
    mine = [i for i in range(start, len(own) - end) if own[i] in theirs]
    ours = {own[i] for i in mine}
    rest = [line for line in other[start:len(other) - end] if line in ours]
    if not mine or not rest:
        return found
    return found | {mine[i] for i in _subsequence([own[i] for i in mine], rest)}


def _subsequence(a: list[str], b: list[str]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence, by matches and not by cells: for each
    line of ``a`` its places in ``b`` extend the chain that ends lowest (Hunt and Szymanski)."""
    places: dict[str, list[int]] = {}
    for j, line in enumerate(b):
        places.setdefault(line, []).append(j)
    ends: list[int] = []
    chains: list[tuple] = []
    for i, line in enumerate(a):
        for j in reversed(places[line]):
            at = bisect.bisect_left(ends, j)
            chain = (i, chains[at - 1] if at else None)
            if at == len(ends):
                ends.append(j)
                chains.append(chain)
            else:
                ends[at], chains[at] = j, chain
    found, chain = [], chains[-1] if chains else None
    while chain:
        found.append(chain[0])
        chain = chain[1]
    return found


def main_text(lines: list[str], kinds: list[int], neighbour: list[str] | None) -> str:
    """The page's own lines: those not shared, but for single lines that a mark overrules.

    A shared line inside a marked article is restored, as two pages may carry one article; an
    unshared line of a menu, advert or the like is vetoed, as these change from page to page.
    Without a neighbour nothing is compared, so a marked article is then all that is known.
    """
    if neighbour is None:
        own = set() if ARTICLE in kinds else set(range(len(lines)))
    else:
        own = set(range(len(lines))) - shared_lines(lines, neighbour)
    keep = [i for i in range(len(lines)) if kinds[i] == ARTICLE or kinds[i] == BODY and i in own]
    return "\n\n".join(lines[i] for i in keep)


def _alike(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _ordered(pages: DataFrame) -> DataFrame:
    """page_id, url, html with host, path and one key that orders them."""
    url = F.coalesce(F.col("url"), F.lit(""))
    bare = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url",
        F.coalesce("html", F.lit("")).alias("html"),
        F.lower(F.regexp_extract(bare, r"^[^/?#]*", 0)).alias("host"),
        F.regexp_extract(bare, r"^[^/?#]*(.*)$", 1).alias("path")).withColumn(
        "key", F.concat_ws(" ", "host", "path", F.lpad(
            F.coalesce(F.col("page_id").cast("string"), F.lit("")), 20, "0")))


def extract_pages(pages: DataFrame, pages_per_range: int = PAGES_PER_RANGE) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html).

    text has the main text's blocks in page order, joined by two line ends, empty if there is
    none or html is null. A page alone on its host has no neighbour and loses no shared lines.
    Pages without url form a host of their own. Ties in nearness go to the page before; copies
    beside a page are passed over, and the next page of its range with other lines is taken.
    Repeated rows each have a row, an empty table gives no rows, pages are read whole, in time
    that grows with their length, whatever elements they leave open.

    Pages are parsed where they are read and only their lines move, once, to a range of the
    order (host, path, page_id); a host of any size spreads over many ranges. The first and
    last page of a range are also sent to the range next to it, so every page meets both
    neighbours, whatever the ranges are.
    """
    rows = _ordered(pages)
    keys = _ordered(pages.withColumn("html", F.lit(""))).select("key")
    borders = range_borders(keys, pages_per_range)
    edges = keys.withColumn("home", range_of(F.col("key"), borders)).groupBy("home").agg(
        F.min("key").alias("first"), F.max("key").alias("last")).collect()  # one row per range
    edges = sorted(edges, key=lambda e: e["home"])
    visits: dict[str, list[int]] = {}
    for before, after in zip(edges, edges[1:], strict=False):
        visits.setdefault(before["last"], []).append(after["home"])
        visits.setdefault(after["first"], []).append(before["home"])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [page_lines(h) for h in batch["html"]]
            out = batch.drop(columns="html")
            out["lines"] = [[line for line, _ in f] for f in found]
            out["kinds"] = [[kind for _, kind in f] for f in found]
            guests = [visits.get(k, ()) for k in out["key"]]
            out["guest"] = False
            yield out
            at = [i for i, g in enumerate(guests) for _ in g]
            if at:
                extra = out.iloc[at].copy()
                extra["range"] = [r for g in guests for r in g]
                extra["guest"] = True
                yield extra

    def difference(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["key", "guest"], kind="stable").reset_index(drop=True)
        lines = [list(x) for x in group["lines"]]
        # A copy tells nothing: past it the next page with other lines is looked at.
        n, before, after = len(lines), [-1] * len(lines), [len(lines)] * len(lines)
        for i in range(1, n):
            before[i] = before[i - 1] if lines[i - 1] == lines[i] else i - 1
        for i in range(n - 2, -1, -1):
            after[i] = after[i + 1] if lines[i + 1] == lines[i] else i + 1
        texts = []
        for i in range(n):
            if group["guest"][i]:
                texts.append("")
                continue
            best, near = -1, None
            for j in (before[i], after[i]):
                if 0 <= j < n and group["host"][j] == group["host"][i]:
                    alike = _alike(group["path"][i] or "", group["path"][j] or "")
                    if alike > best:
                        best, near = alike, lines[j]
            texts.append(main_text(lines[i], list(group["kinds"][i]), near))
        group["text"] = texts
        own = group[~group["guest"].astype(bool)]
        return pd.DataFrame({"page_id": own["page_id"], "url": own["url"], "text": own["text"],
                             "n_chars": [len(t) for t in own["text"]]})

    parsed = rows.withColumn("range", range_of(F.col("key"), borders)).mapInPandas(
        parse, "page_id long, url string, host string, path string, key string, range int,"
               " lines array<string>, kinds array<int>, guest boolean")
    # A few ranges to a task, however many there are; the session's number would not grow.
    tasks = max(len(edges) // RANGES_PER_TASK, 1)
    return parsed.repartition(tasks, "range").groupBy("range").applyInPandas(
        difference, "page_id long, url string, text string, n_chars long")
