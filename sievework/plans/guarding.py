"""The sheet guard over whole tables.

Stand-ins on the test tables: a customer is a sheet and its project, an order is a row; the columns of the orders give the
cells (dates, prices, priorities and states pick from the values that the constraints tell apart), repeated headers among
them. The SQL reads the wide rows, the operator the long form."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import guards as g
from ..registry import query
from ..sources.tables import table

_DAY, _MONTH = "day(o_orderdate)", "month(o_orderdate)"
# expressions that both engines read
CELLS = [
    (g.SOURCE, f"CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN concat('lane bulk ', o_orderkey) WHEN '5' THEN concat('Blank_', o_orderkey) ELSE concat('cell ', o_orderkey) END"),
    (g.ROLE, f"CASE WHEN o_orderstatus = 'P' THEN 'Empty' WHEN {_MONTH} % 4 = 0 THEN 'study sample' ELSE 'single  cell' END"),
    (g.CELLS, "CASE WHEN o_orderstatus = 'P' THEN '0' WHEN o_totalprice < 200000 THEN 'not applicable' ELSE '1' END"),
    (g.CELL_ID, f"CASE WHEN o_orderstatus = 'P' AND {_DAY} % 2 = 0 THEN 'empty' WHEN o_totalprice < 250000 THEN 'Not available' ELSE concat('c', o_custkey) END"),
    (g.PART, f"CASE WHEN {_DAY} % 6 = 5 THEN '' ELSE concat('Part ', CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE {_MONTH} % 2 END) END"),
    (g.INDIVIDUAL, f"CASE {_DAY} % 5 WHEN 0 THEN concat('part ', {_MONTH} % 2) WHEN 1 THEN 'part 1 | PART 0' WHEN 2 THEN 'HeLa-S3_donor' WHEN 3 THEN 'unknown' ELSE concat('P', o_custkey) END"),
    (g.LINE, f"CASE WHEN {_DAY} % 3 = 0 THEN 'he-la' ELSE 'not available' END"),
    (g.MATERIAL, "CASE o_orderstatus WHEN 'F' THEN 'Cell' ELSE 'other' END"),
    (g.DATA_FILE, f"concat('run', CASE {_MONTH} % 3 WHEN 0 THEN '_DDAtop20' WHEN 1 THEN '-dia' ELSE '.WWA4' END, '.raw')"),
    (g.ACQUISITION, f"CASE WHEN {_DAY} % 2 = 0 THEN 'NT=Data-independent acquisition' ELSE 'NT=Data-Dependent acquisition' END"),
    (g.INSTRUMENT, "CASE WHEN o_totalprice < 300000 THEN 'Q Exactive Plus' ELSE 'timsTOF' END"),
    (g.DISSOCIATION, f"CASE {_DAY} % 4 WHEN 0 THEN 'NT=CID;AC=MS:1000133' WHEN 1 THEN 'cid' ELSE 'HCD' END"),
    (g.LCM, f"CASE WHEN {_DAY} % 7 = 0 THEN 'Zeiss PALM as described in the text b' ELSE 'not applicable' END"),
    (g.ISOLATION, f"CASE {_MONTH} % 3 WHEN 0 THEN 'Laser capture microdissection' WHEN 1 THEN 'LCM' ELSE 'FACS' END"),
    (g.CHIP, f"CASE WHEN {_DAY} % 11 = 0 THEN 'nanoPOTS chip[2] (Figure S2) and then prepared f' ELSE 'v1' END"),
    (g.CLEAVAGE, "CASE o_orderstatus WHEN 'O' THEN 'Trypsin' ELSE 'Lys-C' END"),
    (g.CLEAVAGE, "CASE WHEN o_totalprice < 150000 THEN 'trypsin ' ELSE 'not available' END"),
    (g.ORGANISM, "CASE WHEN o_custkey % 4 = 0 AND o_orderstatus = 'F' THEN 'Mus musculus' ELSE 'Homo sapiens' END"),
]


def cells(spark, sf_dir):
    made = F.array(*[F.struct(F.lit(i).alias("col"), F.lit(h).alias("header"), F.expr(x).cast("string").alias("value")) for i, (h, x) in enumerate(CELLS)])
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("sheet"), F.col("o_orderkey").alias("row"), F.inline(made))


def project(spark, sf_dir):
    kinds = [("organisms", "concat('taxon ', c_nationkey % 2)"), ("organisms", "'Homo sapiens'"), ("organismParts", "concat('p', CASE WHEN c_acctbal < 0 THEN 1 ELSE 2 END)"), ("organismParts", "'p1'")]
    made = F.array(*[F.struct(F.lit(k).alias("kind"), F.expr(x).alias("value")) for k, x in kinds])
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sheet"), F.inline(made))


_N = "lower(trim(regexp_replace({x}, ' +', ' ', 'g')))"
_WIDE = ", ".join(f"trim(regexp_replace(({x})::VARCHAR, ' +', ' ', 'g')) AS v{i}" for i, (_, x) in enumerate(CELLS))
_AT = {h: f"v{i}" for i, (h, _) in reversed(list(enumerate(CELLS)))}
_RES = "('', 'not available', 'not applicable', 'unknown', 'pooled', 'anonymized')"


def _real(h: str) -> str:
    return f"lower({_AT[h]}) NOT IN {_RES}"


_V = _AT
_EMPTY = f"(lower({_V[g.ROLE]}) = 'empty' OR {_V[g.CELLS]} = '0' OR contains(lower({_V[g.SOURCE]}), 'blank'))"
_ZERO = f"(lower({_V[g.ROLE]}) = 'empty' AND {_V[g.CELLS]} = '0' AND lower({_V[g.CELL_ID]}) = 'empty')"
_KNOWN = f"({_real(g.INDIVIDUAL)} OR {_real(g.LINE)} OR lower({_V[g.MATERIAL]}) = 'cell' OR ({_real(g.CELL_ID)} AND lower({_V[g.CELL_ID]}) <> 'empty'))"
_BULK = f"(contains({_V[g.SOURCE]}, ' bulk ') AND lower({_V[g.ROLE]}) = 'single cell')"
_NO_CELL = f"(lower({_V[g.CELLS]}) = 'not applicable' AND lower({_V[g.CELL_ID]}) = 'not available')"
_INDEP = f"contains(lower({_V[g.ACQUISITION]}), 'independent')"
_SAME = f"({_real(g.INDIVIDUAL)} AND ((lower({_V[g.PART]}) = lower({_V[g.INDIVIDUAL]}) AND {_real(g.PART)}) OR (lower({_V[g.LINE]}) = lower({_V[g.INDIVIDUAL]}) AND {_real(g.LINE)})))"
_LISTED = "(listed AND NOT " + _SAME + ")"
_L = g._LEAK
_CHECKS = [
    ("individual", "warning", f"{_L}:duplicates_row", _SAME, _V[g.INDIVIDUAL]),
    ("individual", "warning", f"{_L}:dataset_values_concatenated", _LISTED, _V[g.INDIVIDUAL]),
    ("individual", "warning", f"{_L}:synthesized_from_cell_line", f"{_V[g.INDIVIDUAL]} = 'HeLa-S3_donor' AND {_real(g.LINE)} AND NOT {_SAME}", _V[g.INDIVIDUAL]),
    ("bulk", "warning", "explicit_bulk_source_role_requires_projection_normalization", f"{_BULK} AND {_NO_CELL}", _V[g.SOURCE]),
    ("bulk", "blocker", "explicit_bulk_source_role_conflicts_with_concrete_single_cell_identity", f"{_BULK} AND NOT {_NO_CELL}", _V[g.SOURCE]),
    ("acquisition", "blocker", "data_file_name_explicit_dda_conflicts_with_dia_metadata", f"contains({_V[g.DATA_FILE]}, 'DDA') AND {_INDEP}", _V[g.DATA_FILE]),
    ("acquisition", "blocker", "data_file_name_explicit_dia_conflicts_with_dda_metadata", f"contains({_V[g.DATA_FILE]}, 'dia') AND NOT {_INDEP}", _V[g.DATA_FILE]),
    ("acquisition", "blocker", "wide_window_acquisition_mislabeled_as_dia", f"contains({_V[g.DATA_FILE]}, 'WWA') AND {_INDEP}", _V[g.DATA_FILE]),
    ("empty", "warning", "empty_control_carries_contextual_biological_metadata", f"{_EMPTY} AND {_real(g.PART)}", _V[g.SOURCE]),
    ("empty", "warning", "explicit_zero_cell_control_identity_requires_projection_normalization", f"{_EMPTY} AND {_KNOWN} AND {_ZERO}", _V[g.SOURCE]),
    ("empty", "blocker", "empty_control_has_concrete_biological_identity", f"{_EMPTY} AND {_KNOWN} AND NOT {_ZERO}", _V[g.SOURCE]),
    ("role", "warning", "sample_type_study_sample_requires_projection_normalization", f"{_V[g.ROLE]} = 'study sample'", _V[g.ROLE]),
    ("instrument", "blocker", "lcm_microscope_model_without_lcm_isolation", f"{_real(g.LCM)} AND {_V[g.ISOLATION]} = 'FACS'", _V[g.LCM]),
    ("instrument", "blocker", "q_exactive_row_uses_generic_cid_instead_of_hcd", f"starts_with({_V[g.INSTRUMENT]}, 'Q') AND {_V[g.DISSOCIATION]} <> 'HCD'", _V[g.DISSOCIATION]),
    ("prose", "blocker", "narrow_metadata_field_contains_truncated_protocol_prose:chip", f"{_V[g.CHIP]} <> 'v1'", _V[g.CHIP]),
    ("prose", "blocker", "narrow_metadata_field_contains_truncated_protocol_prose:lcm", _real(g.LCM), _V[g.LCM]),
    ("chemistry", "blocker", "duplicate_repeated_cleavage_agent", f"{_V[g.CLEAVAGE]} = 'Trypsin' AND v16 = 'trypsin'", f"{_V[g.CLEAVAGE]} || ';' || v16"),
]
_ROWS = " UNION ALL ".join(f"SELECT sheet, \"row\", '{f}' AS family, '{s}' AS severity, '{c}' AS code, {shown} AS value FROM l WHERE {test}" for f, s, c, test, shown in _CHECKS)


@query(f"""WITH w AS (SELECT o_custkey AS sheet, o_orderkey AS "row", {_WIDE} FROM orders),
    parts AS (SELECT sheet, list_sort(list(DISTINCT lower({_V[g.PART]})) FILTER ({_real(g.PART)})) AS has FROM w GROUP BY sheet),
    l AS (SELECT w.*, {_V[g.INDIVIDUAL]} = 'part 1 | PART 0' AND has = ['part 0', 'part 1'] AS listed FROM w JOIN parts USING (sheet)),
    one AS (SELECT sheet, min({_V[g.ORGANISM]}) AS organism, count(DISTINCT {_V[g.ORGANISM]}) AS n_organisms, min({_V[g.PART]}) FILTER ({_real(g.PART)}) AS part, count(DISTINCT {_V[g.PART]}) FILTER ({_real(g.PART)}) AS n_parts FROM w GROUP BY sheet)
    {_ROWS} UNION ALL SELECT sheet, NULL, 'project', 'blocker', 'multiorganism_project_collapsed_to_single_candidate_organism', organism FROM one JOIN customer ON c_custkey = sheet WHERE n_organisms = 1
    UNION ALL SELECT sheet, NULL, 'project', 'warning', 'multi_organism_part_project_collapsed_to_single_candidate_part', part FROM one JOIN customer ON c_custkey = sheet WHERE n_parts = 1 AND c_acctbal >= 0""")
def scientific_guard(spark, sf_dir):
    """All constraints of eight families over every row and sheet: the rows that break them, as blockers and warnings."""
    return g.guarded(cells(spark, sf_dir), project(spark, sf_dir))


@query("""WITH p AS (SELECT o_custkey AS sheet, o_orderkey AS "row", trim(CASE WHEN day(o_orderdate) % 6 = 5 THEN '' ELSE 'Part ' || CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE month(o_orderdate) % 2 END END) AS part, day(o_orderdate) % 5 = 1 AS asks FROM orders),
    s AS (SELECT sheet FROM p WHERE part <> '' GROUP BY sheet HAVING count(DISTINCT part) = 2)
    SELECT sheet, "row", 'characteristics[organism part]' AS alias, 'part 1 | PART 0' AS value FROM p JOIN s USING (sheet) WHERE asks""")
def individual_leakage(spark, sf_dir):
    """Rows whose individual lists exactly the values that the sheet has under another header."""
    return g.concatenated_values(cells(spark, sf_dir))
