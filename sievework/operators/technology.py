"""Canonical keys of technologies, modalities, acquisitions and channels, and a tree of technologies.

The tree is labelled by intervals: a technology lies below another exactly when its interval lies inside the other's, so a test
is two comparisons however deep the tree is, and the labels are literals of the plan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.columns import col, ladder, norm, norm_key

# Technologies by their alphanumeric lower-case name; those of the second row may end in "plex".
TECHNOLOGIES = {"tmtpro": "tmtpro", "tmt": "tmt", "plexdia": "plexdia", "scope2": "scope2", "scopems": "scope-ms", "pscope": "pscope", "npop": "npop", "mpop": "mpop", "surequant": "surequant", "cellenone": "cellenone", "dia": "dia", "dda": "dda", "prm": "prm"}
PLEXES = ("tmtpro18", "tmtpro16", "tmt11", "tmt10", "tmt8", "tmt6")
# Each technology and the more general one that it belongs to.
BELONGS_TO = {"tmtpro18": "tmtpro", "tmtpro16": "tmtpro", "tmtpro": "tmt", "tmt11": "tmt", "tmt10": "tmt", "tmt8": "tmt", "tmt6": "tmt"}
# Modalities of a family, by key.
LABEL_FREE = ("label_free", "label_free_single_cell")
UNRESOLVED = ("modality_unresolved", "single_cell_modality_unresolved")
ACQUISITIONS = ("dia", "dda", "prm")


def intervals(parents: Mapping[str, str]) -> dict[str, tuple[int, int]]:
    """Preorder number of each node and the greatest number below it. A cycle raises ValueError."""
    nodes = sorted({*parents, *parents.values()})
    below = {n: [c for c in nodes if parents.get(c) == n] for n in nodes}
    spans: dict[str, tuple[int, int]] = {}
    todo = [(n, False) for n in reversed(nodes) if n not in parents]
    entered: dict[str, int] = {}
    while todo:
        node, left = todo.pop()
        if left:
            spans[node] = (entered[node], len(entered) - 1)
            continue
        entered[node] = len(entered)
        todo += [(node, True), *((c, False) for c in reversed(below[node]))]
    if len(spans) < len(nodes):
        raise ValueError(f"in a cycle: {sorted(set(nodes) - set(spans))}")
    return spans


_SPANS = intervals(BELONGS_TO)
_LEAVES = [n for n in _SPANS if n not in BELONGS_TO.values()]


def _looked_up(c: Column, values: Mapping, kind: str) -> Column:
    pairs = [x for k, v in values.items() for x in (F.lit(k), F.lit(v).cast(kind))]
    return F.try_element_at(F.create_map(*pairs), c)


def span(key) -> Column:
    """lo, hi of a technology's interval, null outside the tree."""
    return F.struct(*[_looked_up(col(key), {n: s[i] for n, s in _SPANS.items()}, "int").alias(name) for i, name in enumerate(("lo", "hi"))])


def more_general(key) -> Column:
    """All technologies that one belongs to, empty outside the tree."""
    above = {}
    for n in BELONGS_TO:
        above[n], up = [], n
        while up in BELONGS_TO:
            up = BELONGS_TO[up]
            above[n].append(up)
    pairs = [x for n, ups in above.items() for x in (F.lit(n), F.array(*[F.lit(u) for u in ups]))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(key)), F.array().cast("array<string>"))


def inside(a: Column, b: Column) -> Column:
    """Interval a is b or lies inside it; false where one is missing."""
    return F.coalesce((a["lo"] >= b["lo"]) & (a["hi"] <= b["hi"]), F.lit(False))


def relation(a, b) -> Column:
    """equal, child (a belongs to b), parent, incompatible (two different ends of the tree) or unknown; both by key."""
    a, b = col(a), col(b)
    ends = a.isin(*_LEAVES) & b.isin(*_LEAVES)
    return ladder((a == b, "equal"), (inside(span(a), span(b)), "child"), (inside(span(b), span(a)), "parent"), (ends, "incompatible"), otherwise="unknown")


def technology_key(c) -> Column:
    """The canonical key of a technology's name; an unknown name stays, in lower case."""
    known = TECHNOLOGIES | {p + end: p for p in PLEXES for end in ("", "plex")}
    return F.coalesce(_looked_up(norm_key(norm(c)), known, "string"), F.lower(norm(c)))


def acquisition_key(c) -> Column:
    short = norm_key(norm(c))
    return F.when(short.isin(*ACQUISITIONS), short).otherwise(F.lower(norm(c)))


def channel_key(c) -> Column:
    return F.regexp_replace(F.replace(F.upper(norm(c)), F.lit("TMT"), F.lit("")), r"\s+", "")


def modality_key(c) -> Column:
    words = F.regexp_replace(F.regexp_replace(F.lower(norm(c)), "[^a-z0-9]+", "_"), "^_|_$", "")
    return F.when(words == "labelfree", "label_free").otherwise(words)


def family(key) -> Column:
    """label_free, reporter, unresolved, or the modality's own key."""
    key = col(key)
    return ladder((key.isin(*LABEL_FREE), "label_free"), (F.contains(key, F.lit("reporter")), "reporter"), (key.isin(*UNRESOLVED), "unresolved"), otherwise=key)


def modality_family(c) -> Column:
    return family(modality_key(c))
