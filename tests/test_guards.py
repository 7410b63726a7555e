"""The sheet guard on hand-made sheets: each family, its severities, and what must not be reported."""

import pytest

from sievework.operators import guards as g


def sheet(spark, *rows, sheet_no=1):
    """Rows as lists of (header, value); headers may repeat."""
    return spark.createDataFrame([(sheet_no, r, c, h, v) for r, cells in enumerate(rows, 2) for c, (h, v) in enumerate(cells)], "sheet int, row int, col int, header string, value string")


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "sheet int, kind string, value string")


def codes(cells, project):
    return sorted((r.row or 0, r.severity, r.code) for r in g.guarded(cells, project).collect())


def test_contradictions_of_a_row(spark):
    first = [
        (g.SOURCE, "x"), (g.ORGANISM, "Homo sapiens"), (g.PART, "Embryo"), (g.INDIVIDUAL, " embryo "), (g.LINE, "HeLa"), (g.MATERIAL, "cell"), (g.ROLE, "Study  sample"), (g.CELLS, "1"), (g.CELL_ID, "x1"), (g.ISOLATION, "manual aspiration"),
        (g.DATA_FILE, "foo_DDAtop20.raw"), (g.ACQUISITION, "NT=Data-independent acquisition"), (g.INSTRUMENT, "NT=Q Exactive Plus"), (g.DISSOCIATION, "NT=CID;AC=MS:1000133"), (g.LCM, "Zeiss PALM MicroBeam"),
        (g.CHIP, "nanoPOTS chip[2] (Figure S2) and then prepared f"),
    ]
    blank = [(g.SOURCE, "Blank 1"), (g.PART, "brain"), (g.LINE, "HeLa"), (g.ROLE, "empty"), (g.CELLS, "0"), (g.CELL_ID, "blank_1"), (g.DATA_FILE, "foo_WWA4.raw"), (g.ACQUISITION, "NT=Data-independent acquisition"), (g.ORGANISM, "Homo sapiens")]
    project = spark.createDataFrame([(1, "organisms", "Homo sapiens"), (1, "organisms", "Xenopus laevis"), (1, "organismParts", "a"), (1, "organismParts", "b"), (2, "organisms", "x")], "sheet int, kind string, value string")
    assert codes(sheet(spark, first, blank), project) == [
        (0, "blocker", "multiorganism_project_collapsed_to_single_candidate_organism"),
        (2, "blocker", "data_file_name_explicit_dda_conflicts_with_dia_metadata"),
        (2, "blocker", "lcm_microscope_model_without_lcm_isolation"),
        (2, "blocker", "narrow_metadata_field_contains_truncated_protocol_prose:chip"),
        (2, "blocker", "q_exactive_row_uses_generic_cid_instead_of_hcd"),
        (2, "warning", "individual_semantic_leakage_requires_projection_normalization:duplicates_row"),
        (2, "warning", "sample_type_study_sample_requires_projection_normalization"),
        (3, "blocker", "empty_control_has_concrete_biological_identity"),
        (3, "blocker", "wide_window_acquisition_mislabeled_as_dia"),
        (3, "warning", "empty_control_carries_contextual_biological_metadata"),
    ]


def test_repeated_headers(spark, nothing):
    chemistry = [(g.SOURCE, "x"), (g.CLEAVAGE, "NT=Trypsin"), (g.CLEAVAGE, "nt=trypsin "), (g.MODIFICATION, "a"), (g.MODIFICATION, "b"), (g.MODIFICATION, "not available"), (g.MODIFICATION, "not available")]
    assert codes(sheet(spark, chemistry), nothing) == [(2, "blocker", "duplicate_repeated_cleavage_agent")]
    # the first concrete value of a repeated header counts
    role = [(g.SOURCE, "x"), (g.ROLE, "not available"), (g.ROLE, "study sample")]
    assert codes(sheet(spark, role), nothing) == [(2, "warning", "sample_type_study_sample_requires_projection_normalization")]


def test_empty_controls_and_bulk(spark, nothing):
    zero = [(g.SOURCE, "blank"), (g.ROLE, "empty"), (g.CELLS, "0"), (g.CELL_ID, "empty"), (g.INDIVIDUAL, "donor1"), (g.MATERIAL, "cell")]
    assert codes(sheet(spark, zero), nothing) == [(2, "warning", "explicit_zero_cell_control_identity_requires_projection_normalization")]
    bulk = [(g.SOURCE, "PC3_parental_bulk_library"), (g.ROLE, "single cell"), (g.CELLS, "not applicable"), (g.CELL_ID, None)]
    conflict = [(g.SOURCE, "PC3 bulk"), (g.ROLE, "single cell"), (g.CELLS, "1"), (g.CELL_ID, "cell_1")]
    plain = [(g.SOURCE, "bulky"), (g.ROLE, "single cell"), (g.CELLS, "1")]
    assert codes(sheet(spark, bulk, conflict, plain), nothing) == [
        (2, "warning", "explicit_bulk_source_role_requires_projection_normalization"),
        (3, "blocker", "explicit_bulk_source_role_conflicts_with_concrete_single_cell_identity"),
    ]


def test_leakage_has_one_reason(spark, nothing):
    both = "animal hemisphere |  Uterine  cervix | unknown"
    rows = [
        [(g.PART, "animal hemisphere"), (g.INDIVIDUAL, both)], [(g.PART, "uterine cervix"), (g.INDIVIDUAL, "uterine cervix")], [(g.PART, "unknown"), (g.INDIVIDUAL, "animal hemisphere | brain")],
        [(g.LINE, "He-La"), (g.INDIVIDUAL, "hela_S3 donor")], [(g.LINE, "K5"), (g.INDIVIDUAL, "K5 donor")], [(g.TYPE, "t"), (g.INDIVIDUAL, "P1")], [(g.INDIVIDUAL, "a | b"), (g.STAGE, "a")],
    ]
    leak = "individual_semantic_leakage_requires_projection_normalization"
    assert codes(sheet(spark, *rows), nothing) == [(2, "warning", f"{leak}:dataset_values_concatenated"), (3, "warning", f"{leak}:duplicates_row"), (5, "warning", f"{leak}:synthesized_from_cell_line")]
    other = sheet(spark, [(g.PART, "brain"), (g.INDIVIDUAL, both)], sheet_no=2)  # another sheet's values count for nothing
    assert [(r.sheet, r.row, r.alias) for r in g.concatenated_values(sheet(spark, *rows).union(other)).collect()] == [(1, 2, g.PART)]


def test_empty_sheets(spark, nothing):
    cells = sheet(spark, [(g.SOURCE, "x")])
    assert codes(cells, nothing) == codes(cells.limit(0), nothing) == []


def test_wide_rows_are_not_joined(spark, nothing):
    """What a sheet's lists say of a row comes as one of its cells; rows are gathered under their headers' numbers."""
    cells = sheet(spark, [(" Characteristics[Individual]\t", "a  |\tb"), (g.PART, "a")], [(g.PART, "b"), ("other", "x")])
    found = g.guarded(cells, nothing)
    assert "LeftOuter" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.row, r.code.rpartition(":")[2], r.value) for r in found.collect()] == [(2, "dataset_values_concatenated", "a | b")]
    rows, first, _ = g.gathered(sheet(spark, [("other", "x")]))
    assert rows.select(first(g.PART)).collect()[0][0] == ""
