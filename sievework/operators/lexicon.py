"""Weighted lexicon scoring of text lanes, with tiers, categories and audits.

A lexicon is a small fixed table of (category, label, term, weight). Because it is small and known when the query is
planned, its terms become expressions of one projection: no cross join, no shuffle. In each lane the first term of a
label wins, so a label counts once a lane however many of its terms occur."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import once
from ..functions.columns import ascii_lower, excerpt, keep_rows, ladder


@dataclass(frozen=True)
class Term:
    category: str
    label: str
    term: str
    weight: int


@dataclass(frozen=True)
class Lane:
    name: str
    column: str
    multiplier: int


def hits(lanes: list[Lane], lexicon: list[Term]) -> Column:
    """array<struct<lane, category, label, term, weight>> in order of lane and lexicon."""
    found = []
    for lane in lanes:
        text = F.col(f"low_{lane.name}")
        by_label: dict[str, list[Term]] = {}
        for t in lexicon:
            by_label.setdefault(t.label, []).append(t)
        for terms in by_label.values():
            steps = [(text.contains(t.term), F.struct(F.lit(lane.name).alias("lane"), F.lit(t.category).alias("category"), F.lit(t.label).alias("label"), F.lit(t.term).alias("term"), F.lit(t.weight * lane.multiplier).alias("weight"))) for t in terms]
            found.append(ladder(*steps))
    return F.array_compact(F.array(*found))


def score(docs: DataFrame, key: str, lanes: list[Lane], lexicon: list[Term], negatives: list[Term], strong: int = 36, possible: int = 14) -> DataFrame:
    """key, score, tier, hits, lanes_hit, labels, negative_labels, excerpt of the first hit."""
    low = docs.select(key, *[F.col(x.column).alias(f"raw_{x.name}") for x in lanes], *[ascii_lower(F.coalesce(F.col(x.column), F.lit(""))).alias(f"low_{x.name}") for x in lanes])
    found = low.withColumn("hits", hits(lanes, lexicon))
    negative = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(F.col(f"low_{x.name}").contains(t.term), F.lit(t.label)) for x in lanes for t in negatives]))))
    total = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["weight"])
    first = F.get("hits", F.lit(0))
    shown = ladder(*[(first["lane"] == x.name, excerpt(F.col(f"raw_{x.name}"), first["term"])) for x in lanes], otherwise="")
    return found.select(
        key,
        total.alias("score"),
        tier(total, strong, possible).alias("tier"),
        "hits",
        F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["lane"]))).alias("lanes_hit"),
        F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["label"]))).alias("labels"),
        negative.alias("negative_labels"),
        shown.alias("excerpt"),
    )


@dataclass(frozen=True)
class Signal:
    """A pattern that counts for a label, with a proximity of its own inside."""

    label: str
    pattern: str
    weight: int


def signal_hits(lanes: list[Lane], signals: list[Signal], prefix: str = "raw_") -> Column:
    """array<struct<lane, label, term, weight>> in order of lane and signal. A label counts once a lane, by the first of its
    patterns that matches; term is that pattern's first match as it stands in the text."""
    found = []
    for lane in lanes:
        text = F.col(f"{prefix}{lane.name}")
        by_label: dict[str, list[Signal]] = {}
        for s in signals:
            by_label.setdefault(s.label, []).append(s)
        for own in by_label.values():
            steps = [(text.rlike(s.pattern), F.struct(F.lit(lane.name).alias("lane"), F.lit(s.label).alias("label"), F.regexp_extract(text, s.pattern, 0).alias("term"), F.lit(s.weight * lane.multiplier).alias("weight"))) for s in own]
            found.append(ladder(*steps))
    return F.array_compact(F.array(*found))


def signal_score(docs: DataFrame, key: str, lanes: list[Lane], signals: list[Signal], strong: int = 36, possible: int = 14) -> DataFrame:
    """key, score, tier, hits of the signals in all lanes."""
    raw = docs.select(key, *[F.coalesce(F.col(x.column), F.lit("")).alias(f"raw_{x.name}") for x in lanes])
    found = once(raw, hits=signal_hits(lanes, signals))
    total = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["weight"])
    return found.select(key, total.alias("score"), tier(total, strong, possible).alias("tier"), "hits")


# The signals of a screen for single cells in mass spectrometry.
_MS = r"(?:proteom\w*|mass\s+spectrom\w*|LC[- ]?MS|MS/MS)"
_ONE = r"(?:single|individual)\s+(?:cells?|oocytes?|blastomeres?|neurons?|bacteri(?:um|a)|hepatocytes?|zygotes?|sperm(?:\s+cells?)?|egg\s+cells?)"
_FIBRE = r"(?:single|individual)\s+(?:(?:skeletal|cardiac)\s+)?(?:(?:muscle|myo)\s*)?(?:fibers?|fibres?|myofibers?|myofibres?)"
_IMAGING, _RESOLVED = r"(?:MALDI(?:[- ]?MSI)?|mass\s+spectrom(?:etry|etric)\s+imaging)", r"single[- ]cell(?:ular)?(?:\s+resolution)?"
SINGLE_CELL_SIGNALS = [
    Signal("individual_biological_cell_proteomics", rf"(?i)\b{_ONE}\b.{{0,100}}\b{_MS}\b", 12),
    Signal("proteomics_individual_biological_cell", rf"(?i)\b{_MS}\b.{{0,100}}\b{_ONE}\b", 12),
    Signal("one_cell_sample", r"(?i)\b(?:1|one)[- ]cell\s+(?:sample|well|proteom\w*)s?\b", 9),
    Signal("single_muscle_fibre_proteomics", rf"(?i)\b{_FIBRE}\b.{{0,120}}\b{_MS}\b", 12),
    Signal("single_muscle_fibre_proteomics", rf"(?i)\b{_MS}\b.{{0,120}}\b{_FIBRE}\b", 12),
    Signal("single_cell_maldi_msi", rf"(?is)\b{_IMAGING}\b.{{0,300}}\b{_RESOLVED}\b", 10),
    Signal("single_cell_maldi_msi", rf"(?is)\b{_RESOLVED}\b.{{0,300}}\b{_IMAGING}\b", 10),
]


def tier(total: Column, strong: int = 36, possible: int = 14) -> Column:
    return ladder((total >= strong, "strong"), (total >= possible, "possible"), (total > 0, "weak"), otherwise="none")


def tier_rank(c) -> Column:
    return ladder((F.col(c) == "strong", 3), (F.col(c) == "possible", 2), (F.col(c) == "weak", 1), otherwise=0)


def _of(category: str):
    return lambda h: h["category"] == category


def categorized(scored: DataFrame, categories: list[str]) -> DataFrame:
    """One sorted label array for each category, and a profile and priority by which of them are empty."""
    out = scored
    for c in categories:
        out = out.withColumn(c, F.array_sort(F.array_distinct(F.transform(F.filter("hits", _of(c)), lambda h: h["label"]))))
    has = {c: F.size(c) > 0 for c in categories}
    explicit, method, biological, adjacent = categories
    profile = ladder(
        (has[explicit] & has[method], "explicit+method"), (has[explicit] & has[biological], "explicit+biological"), (has[explicit], "explicit_only"),
        (has[method] & has[biological], "method+biological"), (has[method], "method_only"), (has[biological], "biological_only"), (has[adjacent], "adjacent_only"), otherwise="none",
    )
    priority = ladder((has[explicit], "A_specific"), (has[method], "B_method"), (has[biological], "C_broad"), (has[adjacent], "D_adjacent"), otherwise="E_none")
    return out.withColumn("profile", profile).withColumn("priority", priority)


def audit_summary(rows: DataFrame) -> DataFrame:
    """One row of conditional counts."""
    count = lambda c, n: F.count_if(c).alias(n)
    return rows.agg(
        F.count("*").alias("candidates"), count(F.col("tier") == "strong", "strong"), count(F.col("tier") == "possible", "possible"), count(F.col("tier") == "weak", "weak"),
        count(F.size("negative_labels") > 0, "with_negatives"), count(F.col("priority") == "A_specific", "specific"), count(F.size("lanes_hit") > 1, "multi_lane"),
    )


def recall(expected: DataFrame, scored: DataFrame, key: str) -> DataFrame:
    """Every expected row with whether it was recovered; missing ones have score 0 and tier none."""
    found = keep_rows(scored.select(key, "score", "tier", F.array_join("lanes_hit", ";").alias("lanes")), F.col("score") > 0)
    return expected.join(found, key, "left").select(
        key, "expected_positive", F.col("score").isNotNull().alias("recovered"), F.coalesce("score", F.lit(0).cast("long")).alias("score"), F.coalesce("tier", F.lit("none")).alias("tier"), F.coalesce("lanes", F.lit("")).alias("lanes")
    )

