"""Places of pattern matches in texts, and what follows from them: masking, proximity, sections, screens.

A match gets a mark on either side by one replacement; splitting at the marks gives the pieces between matches, and the
running totals of their lengths are the places. Everything is built from expressions, a text is read once a pattern, and
only places and matches leave its row, never the text. Places count characters from 0, `to` is behind the last one.

Texts are nulls as the empty text; the two control characters that serve as marks count as spaces. Patterns match at
least one character and have no groups that the caller refers to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ascii_lower, col, ladder, norm, text_of

OPEN, CLOSE = "\x01", "\x02"


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once, however often later columns mention them: a generator of one row, through which
    the optimizer does not carry expressions."""
    kept = [c for c in df.columns if c not in columns]
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*kept, F.explode(F.array(made)).alias("_made")).select(*kept, "_made.*")


def let(value: Column, of) -> Column:
    """What `of` makes of a value that is computed once, however often it is mentioned: within lambdas nothing else sees to that."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def plain(text) -> Column:
    """The text without the marks."""
    return F.translate(text_of(text), OPEN + CLOSE, "  ")


def _split(text, pattern: str) -> Column:
    return F.split(F.regexp_replace(col(text), f"(?:{pattern})", f"{OPEN}$0{CLOSE}"), OPEN)


def pieces(text, pattern: str) -> Column:
    """The text in front of the first match, then each match with a closing mark and what follows it. Most texts have none of
    most patterns; these are searched, and neither copied nor split."""
    return F.when(col(text).rlike(pattern), _split(text, pattern)).otherwise(F.array(col(text)))


def matched(piece: Column) -> Column:
    return F.substring_index(piece, CLOSE, 1)


def running_totals(lengths: Column, block: int = 64) -> Column:
    """For each element the sum of those before it. Blocks bound what is copied when a total is appended."""
    nothing = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))

    def totals(xs: Column) -> Column:
        return F.aggregate(xs, nothing, lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.concat(s["out"], F.array(s["sum"])).alias("out")))

    def blocks(xs: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(xs) - 1, F.lit(0)), F.lit(block))
        return F.transform(starts, lambda at: totals(F.slice(xs, at + 1, F.lit(block))))

    def joined(inner: Column) -> Column:
        before = totals(F.transform(inner, lambda b: b["sum"]))["out"]
        return F.flatten(F.zip_with(inner, before, lambda b, base: F.transform(b["out"], lambda x: x + base)))

    return let(lengths, lambda xs: F.when(F.size(xs) > block, let(blocks(xs), joined)).otherwise(totals(xs)["out"]))


def with_spans(df: DataFrame, text, **patterns: str) -> DataFrame:
    """For each name an array of (at, to, match) of all matches of its pattern, in order. A piece leaves its length and its match
    behind, so a text is carried on once and not with every pattern; a text without a match leaves nothing."""
    none = F.array().cast("array<struct<n:int,match:string>>")
    # a piece is one character shorter without its closing mark; the first has none, and no match
    piece = lambda p, i: F.struct((F.length(p) - F.when(i > 0, 1).otherwise(0)).alias("n"), F.when(i > 0, matched(p)).otherwise("").alias("match"))
    cut = once(df, **{f"_p_{n}": F.when(col(text).rlike(p), F.transform(_split(text, p), piece)).otherwise(none) for n, p in patterns.items()})
    cut = once(cut, **{f"_t_{n}": running_totals(F.transform(f"_p_{n}", lambda p: p["n"])) for n in patterns})
    span = lambda p, t: F.struct(t.alias("at"), (t + F.length(p["match"])).alias("to"), p["match"].alias("match"))
    found = {n: F.slice(F.zip_with(f"_p_{n}", f"_t_{n}", span), F.lit(2), F.size(f"_p_{n}")) for n in patterns}
    return once(cut, **found).drop(*[f"_{x}_{n}" for x in "pt" for n in patterns])


def masked(df: DataFrame, text: str, masks: Sequence[tuple[str, str]], log: str = "masked_hits") -> DataFrame:
    """Replace the matches of each pattern by as many spaces, pattern after pattern, in the column `text`; `log` gets
    (kind, match) of all that was masked, by pattern and place. All other characters keep their places."""
    df = df.withColumn(text, plain(text))
    df = df.withColumn(log, F.array().cast("array<struct<kind:string,match:string>>"))
    for kind, pattern in masks:
        df = once(df, _cut=pieces(text, pattern))
        hits = F.slice("_cut", F.lit(2), F.size("_cut"))
        blank = F.transform(hits, lambda p: F.concat(F.repeat(F.lit(" "), F.length(matched(p))), F.substring_index(p, CLOSE, -1)))
        found = F.transform(hits, lambda p: F.struct(F.lit(kind).alias("kind"), norm(matched(p)).alias("match")))  # noqa: B023
        cut = F.size("_cut") > 1
        whole = F.element_at("_cut", 1)
        df = df.withColumns({text: F.when(cut, F.concat(whole, F.array_join(blank, ""))).otherwise(whole), log: F.when(cut, F.concat(log, found)).otherwise(F.col(log))}).drop("_cut")
    return once(df, **{text: F.col(text), log: F.col(log)})


def window_text(text, at: Column, to: Column, radius: int) -> Column:
    """The surroundings of a place, white space collapsed."""
    start = F.greatest(at - radius, F.lit(0))
    return norm(F.substring(col(text), start + 1, to + radius - start))


BLOCK_BYTES = 4 << 20  # of the optimizer's size of a table, whose places are sorted in a task


def parts_of(df: DataFrame) -> int:
    """A number of tasks in proportion to a table, at least the session's number of shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(least, min(size // BLOCK_BYTES + 1, 1 << 14)) if size < 1 << 60 else least


# --- sections --------------------------------------------------------------------------------------------------------

# Lines that begin a list of references, and those that begin what follows it.
REFERENCE_HEADINGS = "references|bibliography|literature cited"
MAJOR_HEADINGS = (
    "methods|online methods|materials and methods|data availability|code availability|reporting summary|acknowledgements?|author contributions?|"
    "extended data|supplementary information|additional information|ethics declaration|inclusion and ethics statement|online content"
)


def heading_line(names: str) -> str:
    """A line that holds one of the names and nothing else; only \\n ends lines."""
    return rf"(?imd)^[ \t]*(?:{names})[ \t]*$"


def without_sections(df: DataFrame, text: str, off: str = heading_line(REFERENCE_HEADINGS), on: str = heading_line(MAJOR_HEADINGS), share: float = 0.2) -> DataFrame:
    """Take out what lies between a heading of `off` and the next of `on`, or the end. Headings of `off` in the first `share`
    of the text do nothing. Adds removed (boolean). The kept parts are joined by a line break, without white space at their
    ends; a text from which nothing is taken stays as it is.

    Headings are few, so the state behind each is found among them alone: those that change the state alternate."""
    df = with_spans(df.withColumn(text, plain(text)), text, _off=off, _on=on)
    least = F.floor(F.length(text) * F.lit(share)).cast("int")
    ends = F.transform(F.filter("_off", lambda s: s["at"] >= least), lambda s: F.struct(s["at"].alias("at"), F.lit(False).alias("on")))
    events = F.array_sort(F.concat(ends, F.transform("_on", lambda s: F.struct(s["at"].alias("at"), F.lit(True).alias("on")))))
    df = once(df, _events=events)
    turns = F.filter("_events", lambda e, i: e["on"] != F.when(i == 0, True).otherwise(F.get("_events", i - 1)["on"]))
    df = once(df, _turns=F.transform(turns, lambda e: e["at"]))
    starts = F.concat(F.array(F.lit(0)), F.filter("_turns", lambda t, i: i % 2 == 1))
    stops = F.concat(F.filter("_turns", lambda t, i: i % 2 == 0), F.array(F.length(text)))
    kept = F.zip_with(starts, F.slice(stops, F.lit(1), F.size(starts)), lambda a, b: F.substring(F.col(text), a + 1, b - a))
    parts = F.transform(F.filter(kept, lambda p: p != ""), lambda p: F.regexp_replace(p, r"[ \t\n\r\f\x0B]+$", ""))
    whole = F.regexp_replace(F.array_join(parts, "\n"), r"^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$", "")
    removed = F.size("_turns") > 0
    return once(df, **{text: F.when(removed, whole).otherwise(F.col(text)), "removed": removed}).drop("_off", "_on", "_events", "_turns")


# --- screens ---------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A pattern and its score. near: characters around a match in which the screen's context has to be, 0 for none."""

    kind: str
    pattern: str
    score: int
    near: int = 0


@dataclass(frozen=True)
class Screen:
    """masks: phrases that look like evidence and are none. strong and weak rules; the context that some of them need; a
    pattern of titles. direct: kinds of plain mentions; procedural: kinds that settle a text alone."""

    masks: tuple[tuple[str, str], ...]
    strong: tuple[Rule, ...]
    weak: tuple[Rule, ...]
    context: str
    title: str
    direct: frozenset[str] = field(default_factory=frozenset)
    procedural: frozenset[str] = field(default_factory=frozenset)
    title_score: int = 12
    around: int = 420  # characters of the surroundings that tell one hit from another
    told_by: int = 220


def hits(df: DataFrame, key: Sequence[str], text: str, screen: Screen, carry: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """One row for each distinct hit of the masked text, with the columns to carry: kind, score, strong, match, n (places).
    A text without any has one row of nulls. parts: how many tasks texts are dealt to.

    Hits of a kind with the same match and the same beginning of their surroundings count once. A rule with `near` needs a
    match of the context wholly within so many characters of its own. The hits of a text, each at the front of that range,
    and its contexts, each at its own front, are sorted together once from behind; the last context seen is the only one that
    can lie in the range first."""
    rules = [*screen.strong, *screen.weak]
    df = with_spans(df.select(*key, *carry, text), text, _context=screen.context, **{f"_r{i}": r.pattern for i, r in enumerate(rules)})
    kind = "array<struct<rule:int,front:int,at:int,to:int,match:string,told:bigint>>"

    def rows(i: int) -> Column:
        r = rules[i]
        told = lambda s: F.xxhash64(ascii_lower(F.substring(window_text(text, s["at"], s["to"], r.near or screen.around), 1, screen.told_by)))
        return F.transform(f"_r{i}", lambda s: F.struct(F.lit(i), s["at"] - r.near, s["at"], s["to"], norm(s["match"]), told(s))).cast(kind)

    contexts = F.transform("_context", lambda s: F.struct(F.lit(-1), s["at"], s["at"], s["to"], F.lit(""), F.lit(0))).cast(kind)
    nothing = F.array(F.struct(F.lit(-2), F.lit(0), F.lit(0), F.lit(0), F.lit(""), F.lit(0))).cast(kind)
    found = df.select(*key, *carry, F.inline(F.concat(nothing, contexts, *[rows(i) for i in range(len(rules))])))
    found = found.repartition(parts, *key) if parts else found
    behind = Window.partitionBy(*key).orderBy(F.col("front").desc(), F.col("rule")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = found.withColumn("context_to", F.last(F.when(F.col("rule") == -1, F.col("to")), ignorenulls=True).over(behind))
    at = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("rule") + 1)
    near = F.when(F.col("rule") >= 0, at([r.near for r in rules]))
    found = found.where((F.col("rule") == -2) | (near == 0) | (F.col("context_to") <= F.col("to") + near))
    distinct = found.groupBy(*key, *carry, "rule", ascii_lower("match").alias("match"), "told").agg(F.count("*").alias("n"))
    real = lambda c: F.when(F.col("rule") >= 0, c)
    return distinct.select(
        *key, *carry, real(at([r.kind for r in rules])).alias("kind"), real(at([r.score for r in rules])).alias("score"), real(F.col("rule") < len(screen.strong)).alias("strong"),
        real(F.col("match")).alias("match"), real(F.col("n")).alias("n"),
    )


def screened(df: DataFrame, key: Sequence[str], text: str, title: Column, screen: Screen) -> DataFrame:
    """key, n_strong, n_direct, n_procedural, n_contextual, n_weak (distinct hits), n_masked (what was masked in text and title),
    title_hit, tier (high, moderate, weak, none), verdict (yes, uncertain, weak, no), max_score.

    A title or a procedural hit settles a text; two direct mentions, or one and a contextual hit, speak for it; any other hit
    is weak."""
    parts = parts_of(df)
    df = df.select(*key, F.col(text).alias("_text"), plain(title).alias("_title"))
    df = masked(masked(df, "_text", screen.masks, "_text_log"), "_title", screen.masks, "_title_log")
    df = df.withColumns({"n_masked": (F.size("_text_log") + F.size("_title_log")).cast("long"), "title_hit": F.col("_title").rlike(screen.title)})
    found = hits(df, key, "_text", screen, ("n_masked", "title_hit"), parts)
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    strong, direct, procedural = F.col("strong"), F.col("kind").isin(*screen.direct), F.col("kind").isin(*screen.procedural)
    sums = found.groupBy(*key, "n_masked", "title_hit").agg(
        count(strong).alias("n_strong"), count(strong & direct).alias("n_direct"), count(strong & procedural).alias("n_procedural"), count(strong & ~direct & ~procedural).alias("n_contextual"),
        count(~strong).alias("n_weak"), F.coalesce(F.max(F.when(strong, F.col("score"))), F.lit(0)).alias("best"),
    )
    n = F.col
    tier = ladder(
        (n("title_hit") | (n("n_procedural") > 0), "high"), ((n("n_direct") >= 2) | ((n("n_direct") > 0) & (n("n_contextual") > 0)), "moderate"), ((n("n_strong") > 0) | (n("n_weak") > 0), "weak"), otherwise="none"
    )
    verdict = ladder((n("tier") == "high", "yes"), (n("tier") == "moderate", "uncertain"), (n("tier") == "weak", "weak"), otherwise="no")
    score = F.when(n("title_hit"), F.greatest(n("best"), F.lit(screen.title_score))).otherwise(n("best")).cast("long")
    return sums.withColumns({"tier": tier, "max_score": score}).withColumn("verdict", verdict).drop("best")


# --- segments of keys ------------------------------------------------------------------------------------------------


def key_segments(df: DataFrame, text: str, pattern: str, radius: int = 500) -> DataFrame:
    """One row for each mention of a key (a match of the pattern): no (from 1), mention (upper case), segment: the text
    around it, which ends at the mentions before and behind it and `radius` characters away. Text of one key never gets into
    the segment of another."""
    df = with_spans(df.withColumn(text, plain(text)), text, _m=pattern)

    def segment(s: Column, i: Column) -> Column:
        left = F.greatest(F.when(i > 0, F.get("_m", i - 1)["to"]).otherwise(0), s["at"] - radius)
        right = F.least(F.coalesce(F.get("_m", i + 1)["at"], F.length(text)), s["to"] + radius)
        return F.struct((i + 1).cast("long").alias("no"), F.upper(s["match"]).alias("mention"), norm(F.substring(F.col(text), left + 1, right - left)).alias("segment"))

    kept = [c for c in df.columns if c not in (text, "_m")]
    return df.select(*kept, F.inline(F.transform("_m", segment)))


def mapped(segment, key, template: str) -> Column:
    """How often a pattern that differs by row is found: `{key}` in the template stands for the row's key, taken literally."""
    literal = F.regexp_replace(col(key), r"([^A-Za-z0-9_])", r"\\$1")
    return F.regexp_count(col(segment), F.replace(F.lit(template), F.lit("{key}"), literal))


# --- nearest roles ---------------------------------------------------------------------------------------------------


def nearest_roles(df: DataFrame, key: Sequence[str], text: str, members: str, roles: Sequence[tuple[str, str]], radius: int = 150) -> DataFrame:
    """One row for each member (a match of `members`): no (from 1), member, role, distance, side (after or before).

    The nearest role behind a member counts if it ends within the radius and in front of the next member; only without one
    the nearest in front of it, behind the member before. Ties go to the role that comes first in the list. Members and roles
    of a text are sorted together once for each side; of every role the last match seen is the nearest one. Places of roles go
    along as one number each, and texts are dealt to as many tasks as their table has blocks, so what a task sorts does not grow."""
    names = [n for n, _ in roles]
    parts = parts_of(df)
    df = with_spans(df.select(*key, plain(text).alias(text)), text, _m=members, **{f"_r{i}": p for i, (_, p) in enumerate(roles)})
    kind = "array<struct<role:int,no:bigint,at:int,to:int,match:string,before:int,behind:int>>"
    member = F.transform(
        "_m",
        lambda s, i: F.struct(F.lit(-1), i + 1, s["at"], s["to"], s["match"], F.when(i > 0, F.get("_m", i - 1)["to"]).otherwise(0), F.coalesce(F.get("_m", i + 1)["at"], F.length(text))),
    ).cast(kind)
    matches = [F.transform(f"_r{i}", lambda s: F.struct(F.lit(i), F.lit(0), s["at"], s["to"], F.lit(""), F.lit(0), F.lit(0))).cast(kind) for i in range(len(roles))]  # noqa: B023
    events = df.select(*key, F.inline(F.concat(member, *matches))).repartition(parts, *key)
    of, is_member = F.col("role"), F.col("role") == -1
    along = lambda *order: Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    behind = along(F.when(is_member, F.col("to")).otherwise(F.col("at")).desc(), is_member)
    ahead = along(F.when(is_member, F.col("at")).otherwise(F.col("to")), is_member)
    packed = F.shiftleft(F.col("at").cast("long"), 32) + F.col("to")
    last = lambda i, w: F.last(F.when(of == i, packed), ignorenulls=True).over(w)
    at_of, to_of = (lambda c: F.shiftright(c, 32)), (lambda c: F.pmod(c, F.lit(1 << 32)))
    events = events.withColumns({f"after_{i}": last(i, behind) for i in range(len(roles))})
    events = events.withColumns({f"before_{i}": last(i, ahead) for i in range(len(roles))}).where(is_member)
    place = lambda d, i: F.struct(d.cast("long").alias("distance"), F.lit(i).alias("role"))
    after = [F.when(to_of(F.col(f"after_{i}")) <= F.least(F.col("to") + radius, F.col("behind")), place(at_of(F.col(f"after_{i}")) - F.col("to"), i)) for i in range(len(roles))]
    before = [F.when(at_of(F.col(f"before_{i}")) >= F.greatest(F.col("at") - radius, F.col("before")), place(F.col("at") - to_of(F.col(f"before_{i}")), i)) for i in range(len(roles))]
    nearest = lambda found: F.array_min(F.array_compact(F.array(*found)))
    picked = events.select(*key, "no", F.col("match").alias("member"), nearest(after).alias("a"), nearest(before).alias("b"))
    found = F.coalesce("a", "b")
    side = ladder((F.col("a").isNotNull(), "after"), (F.col("b").isNotNull(), "before"), otherwise=F.lit(None).cast("string"))
    return picked.select(*key, "no", "member", F.when(side.isNotNull(), F.get(F.array(*[F.lit(n) for n in names]), found["role"])).alias("role"), F.when(side.isNotNull(), found["distance"]).alias("distance"), side.alias("side"))


# The vocabulary of a screen for single-cell proteomics.
_PROTEOMICS, _SPECTROMETRY, _LCMS = "proteom(?:e|es|ics|ic)", r"mass\s+spectrom(?:etry|etric)", "LC[- ]?MS(?:/MS)?"
_COUNT = r"(?:\d[\d,]*|>\s*\d[\d,]*|~\s*\d[\d,]*)\s+(?:proteins?|protein\s+groups?)"
_NAMED = r"(?:[A-Za-z0-9+._-]+\s+){0,3}"
_CELLS = "(?:cells?|oocytes?|neurons?|blastomeres?|bacteria|bacterium)"
_BY_MS = rf"(?:{_PROTEOMICS}|{_SPECTROMETRY}|{_LCMS}|MS/MS)"
SINGLE_CELL = Screen(
    masks=(
        ("single_cell_transcriptomics", r"(?i)\bsingle[- ]cell(?:ular)?\s+(?:RNA[- ]?seq(?:uencing)?|transcriptom(?:e|es|ics|ic)|genom(?:e|es|ics|ic)|ATAC[- ]?seq|epigenom(?:e|es|ics|ic))\b"),
        ("single_nucleus_omics", r"(?is)\bsingle[- ]nucle(?:us|i)\b.{0,80}\b(?:RNA|transcriptom|sequenc|omics?|ATAC)\b"),
        ("single_cell_resolution", r"(?i)\bsingle[- ]cell(?:ular)?\s+resolution\b"),
        ("single_cell_derived", r"(?i)\bsingle[- ]cell[- ]derived\b"),
        ("single_cell_line", r"(?i)\bsingle[- ]cell[- ]line(?:s)?\b"),
        ("single_cell_type", r"(?i)\bsingle[- ]cell[- ]type(?:s)?\b"),
        ("single_cell_culture", r"(?i)\bsingle[- ]cell[- ]culture(?:s)?\b"),
        ("single_cell_clone", r"(?i)\bsingle[- ]cell[- ]clone(?:s)?\b"),
        ("cell_type_specific", r"(?i)\bcell[- ]type[- ]specific\b"),
        ("cell_specific_proteomics", rf"(?i)\bcell[- ]specific\s+{_PROTEOMICS}\b"),
        ("single_shot", r"(?i)\bsingle[- ]shot\b"),
        ("single_sample", r"(?i)\bsingle[- ]sample\b"),
        ("single_cell_equivalent", r"(?i)\bsingle[- ]cell[- ]equivalent(?:s)?\b"),
        ("near_single_cell", r"(?i)\bnear[- ]single[- ]cell\b"),
        ("single_multicellular_structure", r"(?i)\bsingle\s+(?:muscle\s+fib(?:er|re)|tubule|islet|worm|organoid|follicle|crypt|glomerulus|embryo|spheroid|colony)s?\b"),
    ),
    strong=(
        Rule("explicit_single_cell_proteomics", rf"(?i)\bsingle[- ]cell\s+{_PROTEOMICS}\b", 10),
        Rule("explicit_single_cell_mass_spectrometry", rf"(?i)\bsingle[- ]cell(?:ular)?\s+(?:{_SPECTROMETRY}|{_LCMS})\b", 10),
        Rule("proteins_per_single_cell", rf"(?is)\b{_COUNT}\b.{{0,120}}\b(?:per|from|in)\s+(?:an?\s+)?(?:individual\s+)?single[- ]cell\b", 10),
        Rule("single_cell_protein_count", rf"(?is)\b(?:individual\s+)?single[- ]cell\b.{{0,140}}\b{_COUNT}\b", 10),
        Rule("one_cell_per_well_or_sample", r"(?i)\b(?:one|1)\s+(?:single\s+)?cell\s+per\s+(?:well|reaction|sample|injection)\b", 9),
        Rule("individual_cells_analyzed_by_ms", rf"(?is)\bindividual\s+(?:single\s+)?{_NAMED}{_CELLS}\b.{{0,140}}\b(?:analy[sz](?:ed|ing)?|measure(?:d|ment)?|profile(?:d|ing)?|process(?:ed|ing)?)\b.{{0,180}}\b{_BY_MS}\b", 9, 500),
        Rule("ms_analysis_of_individual_cells", rf"(?is)\b{_BY_MS}\b.{{0,180}}\bindividual\s+(?:single\s+)?{_NAMED}{_CELLS}\b", 9, 500),
        Rule("single_cells_prepared_for_ms", rf"(?is)\bsingle[- ]{_NAMED}{_CELLS}\b.{{0,120}}\b(?:sort(?:ed|ing)?|isolate(?:d|ion)?|pick(?:ed|ing)?|dispens(?:ed|ing)?|deposit(?:ed|ing)?|lyse(?:d|lysis)|digest(?:ed|ion)?)\b.{{0,220}}\b{_BY_MS}\b", 9, 500),
        Rule("single_named_cell_proteomics", rf"(?is)\bsingle\s+{_NAMED}(?:cell|oocyte|neuron|blastomere|bacterium)\b.{{0,180}}\b(?:{_PROTEOMICS}|mass\s+spectrom|LC[- ]?MS)\b", 9, 500),
    ),
    weak=(Rule("generic_single_cell", r"(?i)\b(?:single[- ]cells?|individual\s+cells?)\b", 3, 320),),
    context=rf"(?i)\b(?:{_PROTEOMICS}|{_SPECTROMETRY}|{_LCMS}|nanoLC[- ]?MS|MS/MS|Orbitrap|timsTOF|Astral|mass\s+spectrometer)\b",
    title=rf"(?is)\b(?:single[- ]cell.{{0,80}}{_PROTEOMICS}|single[- ]cell.{{0,80}}{_SPECTROMETRY}|{_PROTEOMICS}.{{0,80}}single[- ]cell)\b",
    direct=frozenset({"explicit_single_cell_proteomics", "explicit_single_cell_mass_spectrometry"}),
    procedural=frozenset({"proteins_per_single_cell", "single_cell_protein_count", "one_cell_per_well_or_sample", "individual_cells_analyzed_by_ms", "ms_analysis_of_individual_cells", "single_cells_prepared_for_ms", "single_named_cell_proteomics"}),
)
