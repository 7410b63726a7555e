"""Denial constraints over sample sheets in long form: what must not stand together in a row or a sheet.

A constraint is a code, its severity and a test over the values of a row by header. All constraints are compiled into one
pass: cells (sheet, row, col, header, value) are gathered by conditional aggregates into one list a header and row, bounded by
the row's cells, and each test that holds gives a row of the result. Constraints that speak of a whole sheet compare counts of
its distinct values, so no sheet is gathered anywhere.

Headers may repeat; a test sees all values of one in the order of their columns, or the first concrete one (the first at all
where none is). Missing headers and null values count as empty cells. White space is collapsed, case is ignored."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ladder, norm, text_of
from .spans import once

# Cells that say nothing, and the headers of a sheet that the constraints read.
RESERVED = ("", "not available", "not applicable", "unknown", "pooled", "anonymized")
SOURCE, DATA_FILE, ACQUISITION = "source name", "comment[data file]", "comment[proteomics data acquisition method]"
ORGANISM, PART, INDIVIDUAL, LINE, TYPE, STAGE = (f"characteristics[{x}]" for x in ("organism", "organism part", "individual", "cell line", "cell type", "developmental stage"))
ACCESSION, CELLOSAURUS, DISEASE, SEX, MATERIAL = (f"characteristics[{x}]" for x in ("cellosaurus accession", "cellosaurus name", "disease", "sex", "material type"))
ROLE, CELLS, CELL_ID, ISOLATION = (f"characteristics[{x}]" for x in ("sample type", "cells per well", "cell identifier", "single cell isolation protocol"))
INSTRUMENT, DISSOCIATION, LCM, CHIP, FLUIDICS = (f"comment[{x}]" for x in ("instrument", "dissociation method", "lcm microscope model", "nanopots chip version", "microfluidics chip type"))
CLEAVAGE, MODIFICATION = "comment[cleavage agent details]", "comment[modification parameters]"
ALIASES = (PART, LINE, TYPE, STAGE)

LISTED = "\x01listed"  # no header of a sheet: the alias that concatenated_values() gives a row

Value = Callable[[str], Column]


def tidy(c) -> Column:
    """norm(), whose pattern is tried only on texts with white space that it changes."""
    t = text_of(c)
    odd = either(*[t.contains(x) for x in ("  ", "\t", "\n", "\r", "\f", "\x0b")])
    return F.when(odd, norm(c)).otherwise(F.trim(t))


def concrete(value: Column) -> Column:
    return ~F.lower(value).isin(*RESERVED)


def low(value: Column) -> Column:
    return F.lower(value)


@dataclass(frozen=True)
class Constraint:
    """test: of first(header) and every(header) for a row. shown: the value that is reported."""

    code: str
    family: str
    severity: str
    test: Callable[[Value, Value], Column]
    shown: Callable[[Value, Value], Column]


def either(*tests: Column) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def _key(value: Column) -> Column:
    return F.regexp_replace(low(value), "[^a-z0-9]", "")


def _duplicates_row(v: Value) -> Column:
    return either(*[concrete(v(INDIVIDUAL)) & concrete(v(h)) & (low(v(INDIVIDUAL)) == low(v(h))) for h in ALIASES])


def _from_line(v: Value) -> Column:
    donor, line = _key(F.regexp_replace(v(INDIVIDUAL), "(?i)[_ -]?donor$", "")), _key(v(LINE))
    named = v(INDIVIDUAL).rlike("(?i)(?:^|[_ -])donor$") & concrete(v(LINE)) & concrete(v(INDIVIDUAL))
    return named & (F.length(donor) >= 3) & (F.length(line) >= 3) & (F.substring(donor, 1, 3) == F.substring(line, 1, 3))


def _is_bulk(v: Value) -> Column:
    return v(SOURCE).rlike(r"(?i)(?:^|[\s_-])bulk(?:[\s_-]|$)") & low(v(ROLE)).isin("", "not available", "single cell")


def _without_cells(v: Value) -> Column:
    plain = ("", "not available", "not applicable", "pooled")
    return low(v(CELLS)).isin(*plain) & low(v(CELL_ID)).isin(*plain)


def _is_empty(v: Value) -> Column:
    return low(v(ROLE)).isin("empty", "blank", "negative control") | (low(v(CELLS)) == "0") | F.contains(low(v(SOURCE)), F.lit("blank"))


def _is_exact_zero(v: Value) -> Column:
    return low(v(ROLE)).isin("empty", "blank", "negative control") & (low(v(CELLS)) == "0") & (low(v(CELL_ID)) == "empty")


def _has_identity(v: Value) -> Column:
    named = [concrete(v(h)) for h in (INDIVIDUAL, TYPE, LINE, ACCESSION, CELLOSAURUS)]
    material = low(v(MATERIAL)).isin("cell", "cell line", "tissue", "biofluid", "primary cell")
    return either(*named, material, concrete(v(CELL_ID)) & (low(v(CELL_ID)) != "empty"))


def _truncated(value: Column) -> Column:
    prose = value.rlike(r"(?i)(?:\[[0-9]+\].*\b(?:and|then|as)\b|\b(?:figure|fig\.?|prepared|described)\b)")
    return concrete(value) & prose & ((F.length(value) > 35) | (F.length(F.substring_index(value, " ", -1)) == 1))


def _repeated(values: Column) -> Column:
    real = F.transform(F.filter(values, concrete), low)
    return F.size(real) > F.size(F.array_distinct(real))


_INDEPENDENT, _DEPENDENT = "independent", "dependent acquisition"
_LEAK = "individual_semantic_leakage_requires_projection_normalization"
_NARROW = "narrow_metadata_field_contains_truncated_protocol_prose"


def _has(value: Column, part: str) -> Column:
    return F.contains(low(value), F.lit(part))


CONSTRAINTS = (
    Constraint(_LEAK + ":duplicates_row", "individual", "warning", lambda v, a: _duplicates_row(v), lambda v, a: v(INDIVIDUAL)),
    Constraint(_LEAK + ":synthesized_from_cell_line", "individual", "warning", lambda v, a: _from_line(v) & ~_duplicates_row(v), lambda v, a: v(INDIVIDUAL)),
    Constraint("explicit_bulk_source_role_requires_projection_normalization", "bulk", "warning", lambda v, a: _is_bulk(v) & _without_cells(v), lambda v, a: v(SOURCE)),
    Constraint("explicit_bulk_source_role_conflicts_with_concrete_single_cell_identity", "bulk", "blocker", lambda v, a: _is_bulk(v) & ~_without_cells(v) & (low(v(ROLE)) == "single cell"), lambda v, a: v(SOURCE)),
    Constraint("data_file_name_explicit_dda_conflicts_with_dia_metadata", "acquisition", "blocker", lambda v, a: v(DATA_FILE).rlike(r"(?i)(?:^|[_\-.])DDA(?:top\d+)?(?:[_\-.]|$)") & _has(v(ACQUISITION), _INDEPENDENT), lambda v, a: v(DATA_FILE)),
    Constraint("data_file_name_explicit_dia_conflicts_with_dda_metadata", "acquisition", "blocker", lambda v, a: v(DATA_FILE).rlike(r"(?i)(?:^|[_\-.])DIA(?:[_\-.]|$)") & _has(v(ACQUISITION), _DEPENDENT) & ~_has(v(ACQUISITION), _INDEPENDENT), lambda v, a: v(DATA_FILE)),
    Constraint("wide_window_acquisition_mislabeled_as_dia", "acquisition", "blocker", lambda v, a: v(DATA_FILE).rlike(r"(?i)(?:^|[_\-.])WWA(?:\d|[_\-.]|$)") & _has(v(ACQUISITION), _INDEPENDENT), lambda v, a: v(DATA_FILE)),
    Constraint("empty_control_carries_contextual_biological_metadata", "empty", "warning", lambda v, a: _is_empty(v) & either(*[concrete(v(h)) for h in (PART, DISEASE, STAGE, SEX)]), lambda v, a: v(SOURCE)),
    Constraint("explicit_zero_cell_control_identity_requires_projection_normalization", "empty", "warning", lambda v, a: _is_empty(v) & _has_identity(v) & _is_exact_zero(v), lambda v, a: v(SOURCE)),
    Constraint("empty_control_has_concrete_biological_identity", "empty", "blocker", lambda v, a: _is_empty(v) & _has_identity(v) & ~_is_exact_zero(v), lambda v, a: v(SOURCE)),
    Constraint("sample_type_study_sample_requires_projection_normalization", "role", "warning", lambda v, a: low(v(ROLE)) == "study sample", lambda v, a: v(ROLE)),
    Constraint("lcm_microscope_model_without_lcm_isolation", "instrument", "blocker", lambda v, a: concrete(v(LCM)) & ~(_has(v(ISOLATION), "laser capture") | (low(v(ISOLATION)) == "lcm")), lambda v, a: v(LCM)),
    Constraint("q_exactive_row_uses_generic_cid_instead_of_hcd", "instrument", "blocker", lambda v, a: _has(v(INSTRUMENT), "q exactive") & (_has(v(DISSOCIATION), "ms:1000133") | (low(v(DISSOCIATION)) == "cid")), lambda v, a: v(DISSOCIATION)),
    Constraint(_NARROW + ":chip", "prose", "blocker", lambda v, a: _truncated(v(CHIP)), lambda v, a: v(CHIP)),
    Constraint(_NARROW + ":fluidics", "prose", "blocker", lambda v, a: _truncated(v(FLUIDICS)), lambda v, a: v(FLUIDICS)),
    Constraint(_NARROW + ":lcm", "prose", "blocker", lambda v, a: _truncated(v(LCM)), lambda v, a: v(LCM)),
    Constraint("duplicate_repeated_cleavage_agent", "chemistry", "blocker", lambda v, a: _repeated(a(CLEAVAGE)), lambda v, a: F.array_join(a(CLEAVAGE), ";")),
    Constraint("duplicate_repeated_modification_parameter", "chemistry", "blocker", lambda v, a: _repeated(a(MODIFICATION)), lambda v, a: F.array_join(a(MODIFICATION), ";")),
)
HEADERS = (SOURCE, DATA_FILE, ACQUISITION, PART, INDIVIDUAL, LINE, TYPE, STAGE, ACCESSION, CELLOSAURUS, DISEASE, SEX, MATERIAL, ROLE, CELLS, CELL_ID, ISOLATION, INSTRUMENT, DISSOCIATION, LCM, CHIP, FLUIDICS, CLEAVAGE, MODIFICATION)


def gathered(cells: DataFrame, headers: Sequence[str] = HEADERS) -> tuple[DataFrame, Value, Value]:
    """One row for each row of a sheet, and access to the first and to all values of a header."""
    place = {h: i for i, h in enumerate(headers)}
    # a header's number goes to its row, not its name; cells under other headers leave only the row
    number = F.array_position(F.array(*[F.lit(h) for h in headers]), F.lower(tidy("header"))).cast("int") - 1
    named = cells.select("sheet", "row", "col", number.alias("place"), tidy("value").alias("value"))
    cell = F.when(F.col("place") >= 0, F.struct("place", "col", "value"))
    rows = named.groupBy("sheet", "row").agg(F.sort_array(F.collect_list(cell)).alias("_cells"))
    of = lambda i: F.transform(F.filter("_cells", lambda c: c["place"] == i), lambda c: c["value"])
    rows = once(rows, **{f"every_{i}": of(i) for i in place.values()}).drop("_cells")
    first = {f"first_{i}": F.coalesce(F.get(F.filter(f"every_{i}", concrete), F.lit(0)), F.get(f"every_{i}", F.lit(0)), F.lit("")) for i in place.values()}
    return once(rows, **first), lambda h: F.col(f"first_{place[h]}"), lambda h: F.col(f"every_{place[h]}")


def violations(cells: DataFrame, constraints: Sequence[Constraint] = CONSTRAINTS, headers: Sequence[str] = HEADERS, marks: DataFrame | None = None) -> DataFrame:
    """sheet, row, family, severity, code, value of every constraint that a row breaks. marks: columns by sheet and row that
    tests may look at as well."""
    rows, first, every = gathered(cells, headers)
    if marks is not None:
        rows = rows.join(marks, ["sheet", "row"], "left")
    said = lambda c: F.struct(F.lit(c.family).alias("family"), F.lit(c.severity).alias("severity"), F.lit(c.code).alias("code"), c.shown(first, every).alias("value"))
    found = F.array_compact(F.array(*[F.when(c.test(first, every), said(c)) for c in constraints]))
    return rows.select("sheet", "row", F.inline(found))


def concatenated_values(cells: DataFrame, header: str = INDIVIDUAL, aliases: Sequence[str] = ALIASES) -> DataFrame:
    """sheet, row, alias, value: rows whose value lists (`A | B`) exactly all values that the sheet has under another header. The
    first such alias counts. Sets are compared by their sizes and what they share."""
    named = cells.select("sheet", "row", "col", F.lower(tidy("header")).alias("header"), tidy("value").alias("value"))
    sheet_values = named.where(F.col("header").isin(*aliases) & concrete(F.col("value"))).select("sheet", F.col("header").alias("alias"), low(F.col("value")).alias("token")).distinct()
    sizes = sheet_values.groupBy("sheet", "alias").agg(F.count("*").alias("n_values")).where("n_values >= 2")
    real = F.when(concrete(F.col("value")), F.struct("col", "value"))
    lists = named.where(F.col("header") == header).groupBy("sheet", "row").agg(F.coalesce(F.min(real), F.min(F.struct("col", "value")))["value"].alias("value"))
    tokens = F.array_distinct(F.filter(F.transform(F.split("value", r"\|"), lambda x: low(norm(x))), lambda x: ~x.isin(*RESERVED)))
    asked = lists.withColumn("tokens", tokens).where((F.size("tokens") >= 2) & concrete(F.col("value")))
    shared = asked.select("sheet", "row", "value", F.size("tokens").alias("n"), F.explode("tokens").alias("token")).join(sheet_values, ["sheet", "token"]).groupBy("sheet", "row", "value", "n", "alias").agg(F.count("*").alias("n_shared"))
    same = shared.join(sizes, ["sheet", "alias"]).where("n_shared = n and n_shared = n_values")
    order = ladder(*[(F.col("alias") == h, i) for i, h in enumerate(aliases)])
    best = same.groupBy("sheet", "row", "value").agg(F.min(F.struct(order.alias("order"), "alias"))["alias"].alias("alias"))
    return best.select("sheet", "row", "alias", "value")


def collapsed(cells: DataFrame, project: DataFrame, header: str, kind: str) -> DataFrame:
    """sheet, value: sheets with one value under a header, while their project (sheet, kind, value) has several."""
    several = project.where((F.col("kind") == kind) & concrete(norm("value"))).groupBy("sheet").agg(F.countDistinct(norm("value")).alias("n")).where("n > 1")
    ours = cells.where(F.lower(tidy("header")) == header).select("sheet", tidy("value").alias("value")).distinct().where(concrete(F.col("value")))
    ours = ours.groupBy("sheet").agg(F.min("value").alias("value"), F.max("value").alias("last"))
    return ours.where("value = last").join(several, "sheet", "left_semi").select("sheet", "value")


def guarded(cells: DataFrame, project: DataFrame) -> DataFrame:
    """sheet, row (null for a sheet as a whole), family, severity, code, value of all eight families. A row has one reason why its
    individual is none: a value of its own row, then a list of the sheet's values, then a name made from the cell line."""
    # the alias comes as one more cell: gathered rows are wide, and would have to be sorted to be joined
    lists = concatenated_values(cells).select("sheet", "row", F.lit(-1).cast(cells.schema["col"].dataType).alias("col"), F.lit(LISTED).alias("header"), F.col("alias").alias("value"))
    all_cells = cells.select("sheet", "row", "col", "header", "value").unionByName(lists)
    listed = Constraint(_LEAK + ":dataset_values_concatenated", "individual", "warning", lambda v, a: (v(LISTED) != "") & ~_duplicates_row(v), lambda v, a: v(INDIVIDUAL))
    made = _LEAK + ":synthesized_from_cell_line"
    unlisted = [replace(c, test=lambda v, a, t=c.test: t(v, a) & (v(LISTED) == "")) if c.code == made else c for c in CONSTRAINTS]
    found = violations(all_cells, [listed, *unlisted], (*HEADERS, LISTED))
    say = lambda df, family, severity, code: df.select("sheet", "row", F.lit(family).alias("family"), F.lit(severity).alias("severity"), F.lit(code).alias("code"), "value")
    whole = lambda df: df.withColumn("row", F.lit(None).cast(cells.schema["row"].dataType))
    return (
        found.unionByName(say(whole(collapsed(cells, project, ORGANISM, "organisms")), "project", "blocker", "multiorganism_project_collapsed_to_single_candidate_organism"))
        .unionByName(say(whole(collapsed(cells, project, PART, "organismParts")), "project", "warning", "multi_organism_part_project_collapsed_to_single_candidate_part"))
    )
