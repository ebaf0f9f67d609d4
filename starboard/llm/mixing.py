"""Mixing sources to target weights by iterative proportional fitting.

Token totals per cell (source, language, topic) are raked: scaled in turn until the totals of
each source, language and topic have their target shares. A cell's factor, scaled so that none
exceeds 1, is the probability with which each of its documents is kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REST = "*"  # every value without a target of its own
MOST_CELLS = 1_000_000


@dataclass(frozen=True)
class Targets:
    """Target shares per margin; values not named share ``REST`` if it is given, and go else.

    A share of None (``AS_IS``) is the one the value has in the documents; the others of its
    margin share what it leaves. The named values bound the number of cells, and so what the
    driver holds.
    """

    source: dict[str, float | None] = field(default_factory=lambda: {REST: 1.0})
    lang: dict[str, float | None] = field(default_factory=lambda: {REST: 1.0})
    topic: dict[str, float | None] = field(default_factory=lambda: {REST: 1.0})


AS_IS = None


# The production mix: the dominant source is held back, languages other than English gain.
PRODUCTION = Targets(
    source={"src0": 0.25, REST: 0.75},
    lang={"en": 0.55, "fr": 0.17, "de": 0.17, "es": 0.11},
    topic={"prose": 0.90, REST: 0.10},
)
# The same for tables that may hold other languages or none given: these keep their share. A share
# of their own would make the few documents of a rare language the measure of all others.
EVERY_LANGUAGE = replace(PRODUCTION, lang={**PRODUCTION.lang, REST: AS_IS})


def n_tokens(text: Column) -> Column:
    """Words between white space, the measure of a document's weight; 1 at least."""
    return F.greatest(F.size(F.split(F.trim(F.coalesce(text, F.lit(""))), r"\s+")), F.lit(1)) \
        .cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic by the text's form: notices, contacts, markup, notes or prose."""
    body = F.lower(F.coalesce(text, F.lit("")))
    symbols = F.length(F.regexp_replace(body, r"[\p{L}\p{N}\s.,]+", ""))
    return (F.when(body.rlike("licen[sc]e|copyright|all rights reserved"), "notices")
            .when(symbols * 10 > F.length(body), "markup")
            # One character before the sign shows an address; a run of them would be tried from
            # each of its characters on.
            .when(body.rlike(r"[\w.+-]@[\w-]++\.\w|\d{3}[ -]\d{4}"), "contacts")
            .when(F.length(body) < 200, "notes").otherwise("prose"))


def folded(value: Column, shares: dict[str, float | None]) -> Column:
    named = [name for name in shares if name != REST]
    return F.when(value.isin(named), value).otherwise(REST) if named else F.lit(REST)


def rake(cells: dict[tuple[str, str, str], float], targets: Targets, rounds: int = 200,
         close: float = 1e-9) -> dict[tuple[str, str, str], float]:
    """Weights per cell whose margins have the target shares, as far as the cells allow.

    A target whose value has no tokens leaves its share to the others of its margin.
    """
    margins = []
    for at, shares in enumerate((targets.source, targets.lang, targets.topic)):
        there: dict[str, float] = {}
        for cell, tokens in cells.items():
            if tokens > 0:
                there[cell[at]] = there.get(cell[at], 0.0) + tokens
        as_is = {name for name, share in shares.items() if share is AS_IS and name in there}
        set_to = {name: share for name, share in shares.items()
                  if share is not AS_IS and share > 0 and name in there}
        # Shares are of the tokens of the values that have a target.
        whole = sum(there[name] for name in (*as_is, *set_to))
        margin = {name: there[name] / whole for name in as_is}
        left = 1.0 - sum(margin.values()) if set_to else 0.0
        total = sum(set_to.values())
        margins.append(margin | {name: share / total * left for name, share in set_to.items()})
    weights = {cell: float(tokens) if tokens > 0 and all(
        cell[i] in margins[i] for i in range(3)) else 0.0 for cell, tokens in cells.items()}
    whole = sum(weights.values())
    if not whole:
        return dict.fromkeys(cells, 0.0)
    weights = {cell: w / whole for cell, w in weights.items()}
    for _ in range(rounds):
        furthest = 0.0
        for at, shares in enumerate(margins):
            sums: dict[str, float] = {}
            for cell, w in weights.items():
                sums[cell[at]] = sums.get(cell[at], 0.0) + w
            factor = {name: shares[name] / s for name, s in sums.items()
                      if s > 0 and name in shares}
            furthest = max([furthest, *(abs(f - 1) for f in factor.values())])
            weights = {cell: w * factor.get(cell[at], 0.0) for cell, w in weights.items()}
        if furthest < close:
            break
    return weights


def keep_shares(cells: dict[tuple[str, str, str], float],
                weights: dict[tuple[str, str, str], float]) -> dict[tuple[str, str, str], float]:
    """Probability per cell: weight over tokens, scaled so that the largest is 1."""
    ratio = {cell: weights[cell] / tokens if tokens else 0.0 for cell, tokens in cells.items()}
    most = max(ratio.values(), default=0.0)
    return {cell: r / most if most else 0.0 for cell, r in ratio.items()}


def mix(docs: DataFrame, targets: Targets = PRODUCTION, seed: int = 7) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, lang, source) with its calibrated probability.

    Returns doc_id, topic, tokens, keep_share and kept. A document is kept if a number from its
    doc_id's hash is below the share of its cell, so the choice is the same on every run and
    rows of one doc_id in one cell share it. Null source, language or doc_id are values like
    others, null text is empty; an empty table gives no rows. Cells whose values have neither a
    target nor a rest are dropped (share 0), which is what a target of nothing means.

    The text is read twice, first for the cells' totals, and never moved.
    """
    kinds = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), topic_of(F.col("text")).alias("topic"),
        n_tokens(F.col("text")).alias("tokens"),
        folded(F.col("source"), targets.source).alias("s"),
        folded(F.col("lang"), targets.lang).alias("l"))
    kinds = kinds.withColumn("t", folded(F.col("topic"), targets.topic))
    bound = (len(targets.source) + 1) * (len(targets.lang) + 1) * (len(targets.topic) + 1)
    if bound > MOST_CELLS:
        raise ValueError(f"the targets name {bound} cells; at most {MOST_CELLS} are raked")
    sums = kinds.groupBy("s", "l", "t").agg(F.sum("tokens").alias("tokens")).collect()
    cells = {(r["s"], r["l"], r["t"]): float(r["tokens"]) for r in sums}
    shares = keep_shares(cells, rake(cells, targets))
    rows = [(*cell, share) for cell, share in shares.items()]
    chosen = F.broadcast(docs.sparkSession.createDataFrame(
        rows, "s string, l string, t string, keep_share double"))
    drawn = (F.xxhash64("doc_id", F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1))
             / F.lit(float(1 << 52)))
    return kinds.join(chosen, ["s", "l", "t"], "left").select(
        "doc_id", "topic", "tokens", F.coalesce("keep_share", F.lit(0.0)).alias("keep_share"),
        (drawn < F.coalesce("keep_share", F.lit(0.0))).alias("kept"))
