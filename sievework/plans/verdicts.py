"""Verdict queries: routes, exclusions, chains, juries, states, scopes, accessions and paths.

Stand-ins on the test tables: every order is a record. What is measured of it and its lines (quantities, discounts, taxes, days,
flags, price, priority) gives each axis its value: the sum of two measures, a pair of its own for each axis, picks from the
axis's values. Pages are paths and candidates of a crawl."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ..operators import verdicts as vd
from ..registry import query
from ..sources.tables import table

# Axes of the stand-in records and their values.
AXES = {
    "cell": ["direct", "implied", "contradictory", "absent", "unclear"],
    "ms": ["direct", "implied", "absent", "unclear"],
    "triage": ["likely_true_scp", "possible_true_scp", "unlikely"],
    "priority": ["A_specific", "B_method", "C_broad", "D_adjacent"],
    "final": ["yes", "no", "uncertain"],
    "model": ["yes", "no", "uncertain"],
    "route": ["include_candidate", "review_high", "review_medium", "review_low"],
    "review_flag": ["", "repository_qwen_overcall", "contradictory_cell_evidence", "other"],
    "evidence_flag": ["individual_cell_language", "ms_proteomics_language", "benchmark_language", "explicit_pooling_language", "none"],
    "mode": ["enriched_existing_sdrf", "validated_existing_sdrf", "generated"],
    "completeness": ["locally_valid", "incomplete_required_metadata", "incomplete_template_isolation_method_gap", "incomplete_sample_to_file_or_channel_mapping", "incomplete_repository_archive_contents_mapping", "other"],
    "linkage": ["partial", "none", "complete"],
    "blocker": ["Template gap", "single_cell_required missing", "bigbio_required_value_unresolved:x", "data_file unknown", "isolation open", "branch 2", "semantic clash", "something"],
    "label": ["Single-cell data", "low input run", "5 fractions", "clinical MSA", "yeast KO", "KO strain", "species mix", "DDA versus DIA", "window 4", "", "other"],
    "accession": ["PXD012345", " pxd000001 ", "PXD12345", "MSV000083508", "msv1", "PXD01234x", "MSV", ""],
}
REVIEW_AXES = {"composition": ["one", "multiple", "mixed_design"], "pooling": ["absent", "present", "absent"], "population_only": ["no", "no", "yes"], "target": ["yes", "yes", "no"], "cells": ["yes", "yes", "no"], "identity": ["yes", "yes", "no"], "benchmark": ["no", "yes"]}
AXES |= {f"{reviewer}_{axis}": values for reviewer in "cj" for axis, values in REVIEW_AXES.items()}
BOOLS = {"single": 3, "population": 7, "control": 4, "asked": 2, "raw_samples": 2, "valid": 3, "audited": 2}  # one in n is true
COUNTS = {"n_primary": 8, "conflicts": 4, "contradictory": 3, "clean": 2, "errors": 3}

_SUMS = {
    "quantity": "cast(l_quantity AS bigint)", "discount": "cast(round(l_discount * 100) AS bigint)", "tax": "cast(round(l_tax * 100) AS bigint)", "shipped": "day(l_shipdate)",
    "returned": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END", "lines": "1",
}
_OWN = {"price": "cast(floor(o_totalprice) AS bigint)", "ordered": "day(o_orderdate)", "urgency": "cast(substr(o_orderpriority, 1, 1) AS bigint)", "state": "instr('FOP', o_orderstatus)"}
_PAIRS = combinations([*_SUMS, *_OWN], 2)
PAIR = {axis: next(_PAIRS) for axis in [*AXES, *BOOLS, *COUNTS]}


def _mix(axis: str) -> str:
    return " + ".join(PAIR[axis])


_COLUMNS = [f"{v}[1 + ({_mix(n)}) % {len(v)}] AS {n}" for n, v in AXES.items()]
_COLUMNS += [f"({_mix(n)}) % {k} = 0 AS {n}" for n, k in BOOLS.items()] + [f"({_mix(n)}) % {k} AS {n}" for n, k in COUNTS.items()]
_MEASURED = f"""m AS (SELECT l_orderkey, {", ".join(f"sum({x})::BIGINT AS {n}" for n, x in _SUMS.items())} FROM lineitem GROUP BY l_orderkey),
    o AS (SELECT o_orderkey, {", ".join(f"coalesce({n}, 0) AS {n}" for n in _SUMS)}, {", ".join(f"{x} AS {n}" for n, x in _OWN.items())} FROM orders LEFT JOIN m ON o_orderkey = l_orderkey)"""
RECORDS = f"{_MEASURED}, r AS (SELECT o_orderkey, {', '.join(_COLUMNS)} FROM o)"


def records(spark, sf_dir, *names: str):
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(*[F.expr(f"sum({x})").alias(n) for n, x in _SUMS.items()])
    orders = table(spark, sf_dir, "orders").select("o_orderkey", *[F.expr(x).alias(n) for n, x in _OWN.items()])
    measured = orders.join(lines, "o_orderkey", "left").fillna(0, list(_SUMS))
    mix = {n: sum((F.col(c) for c in pair[1:]), F.col(pair[0])) for n, pair in PAIR.items()}
    made = {n: F.element_at(F.array(*[F.lit(x) for x in v]), (1 + mix[n] % len(v)).cast("int")) for n, v in AXES.items()}
    made |= {n: mix[n] % k == 0 for n, k in BOOLS.items()} | {n: mix[n] % k for n, k in COUNTS.items()}
    return measured.select("o_orderkey", *[made[n].alias(n) for n in names])


@query(f"""WITH {RECORDS} SELECT o_orderkey, CASE cell || '/' || ms WHEN 'direct/direct' THEN 'direct_cell_and_ms' WHEN 'implied/direct' THEN 'plausible_cell_and_direct_ms' WHEN 'direct/implied' THEN 'plausible_but_both_not_direct'
    WHEN 'implied/implied' THEN 'plausible_but_both_not_direct' ELSE CASE WHEN cell = 'contradictory' THEN 'contradictory_cell_evidence' WHEN cell = 'absent' AND ms = 'direct' THEN 'ms_without_individual_cell_evidence'
    WHEN ms = 'absent' THEN 'insufficient_cell_or_ms_evidence' ELSE 'uncertain_repository_evidence' END END AS evidence,
    CASE WHEN triage <> 'unlikely' AND (cell IN ('absent', 'contradictory') OR ms = 'absent') THEN 'overcall_vs_structured_evidence' ELSE 'consistent_or_conservative' END AS consistency FROM r""")
def repository_evidence(spark, sf_dir):
    r = records(spark, sf_dir, "cell", "ms", "triage")
    return r.select("o_orderkey", vd.repository_evidence("cell", "ms").alias("evidence"), vd.overcall("triage", "cell", "ms").alias("consistency"))


@query(f"""WITH {RECORDS} SELECT o_orderkey, CASE WHEN final = 'yes' THEN 'include_candidate' WHEN priority = 'A_specific' THEN 'review_high' WHEN priority = 'B_method' THEN 'review_medium' WHEN priority = 'C_broad' AND model = 'yes' THEN 'review_medium'
    WHEN priority = 'C_broad' AND model = 'uncertain' THEN 'review_low' ELSE 'likely_non_scp' END AS publication_route,
    CASE priority WHEN 'A_specific' THEN if(cell = 'direct' AND ms = 'direct', 'include_candidate', 'review_high') WHEN 'B_method' THEN CASE WHEN ms <> 'direct' THEN 'likely_non_scp' WHEN cell = 'implied' THEN 'review_medium' ELSE 'review_low' END
    WHEN 'C_broad' THEN CASE WHEN cell = 'direct' AND ms = 'direct' THEN 'review_medium' WHEN cell = 'implied' AND ms IN ('direct', 'implied') THEN 'review_low' ELSE 'likely_non_scp' END ELSE 'likely_non_scp' END AS repository_route FROM r""")
def candidate_routes(spark, sf_dir):
    r = records(spark, sf_dir, "priority", "final", "model", "cell", "ms")
    return r.select("o_orderkey", vd.publication_route("priority", "final", "model").alias("publication_route"), vd.repository_route("priority", "cell", "ms").alias("repository_route"))


def _reviewer_sql(p: str) -> str:
    alone = "(single AND NOT population)"
    excused = f"({alone} AND {p}_target = 'yes')"
    whole = (
        f"{p}_cells = 'yes' AND {p}_target = 'yes' AND {p}_identity = 'yes' AND ({p}_composition <> 'multiple' OR {alone}) AND ({p}_pooling = 'absent' OR {alone}) AND ({p}_population_only = 'no' OR {excused})"
    )
    return f"""{p}1 AS (SELECT *, CASE WHEN population AND NOT single THEN 'passage_scoped_population_target_anchor' WHEN {p}_pooling = 'present' AND NOT {alone} THEN 'destructive_pooling_before_identity'
        WHEN {p}_population_only = 'yes' AND NOT {excused} THEN 'population_samples_only' END AS {p}_hard,
        CASE WHEN NOT ({whole}) THEN NULL WHEN {p}_composition = 'multiple' OR {p}_pooling = 'present' OR {p}_population_only = 'yes' THEN 'complete_target_single_cell_ms_chain_corrected_by_passage_scope'
        WHEN control THEN 'complete_target_single_cell_ms_chain_with_separate_controls' ELSE 'complete_target_single_cell_ms_chain' END AS {p}_chain FROM {'r' if p == 'c' else 'c2'}),
    {p}2 AS (SELECT *, CASE WHEN {p}_hard IS NOT NULL OR ({p}_cells = 'no' AND {p}_target <> 'yes') THEN 'exclude' WHEN {p}_chain IS NOT NULL THEN 'include' WHEN {p}_benchmark = 'yes' AND {p}_target <> 'yes' THEN 'exclude' ELSE 'uncertain' END AS {p}_decision,
        CASE WHEN {p}_hard IS NOT NULL THEN 'structured_exclusion_axis:' || {p}_hard WHEN {p}_cells = 'no' AND {p}_target <> 'yes' THEN 'structured_exclusion_axis:no_individual_cell_samples'
        WHEN {p}_chain IS NOT NULL AND {p}_benchmark = 'yes' THEN 'structured_single_cell_chain_overrides_inconsistent_benchmark_only' WHEN {p}_chain IS NOT NULL THEN {p}_chain
        WHEN {p}_benchmark = 'yes' AND {p}_target <> 'yes' THEN 'structured_exclusion_axis:benchmark_only_without_single_cell_targets' ELSE 'insufficient_or_mixed_target_sample_axes' END AS {p}_basis FROM {p}1)"""


_REVIEWED = f"{RECORDS}, {_reviewer_sql('c')}, {_reviewer_sql('j')}"
_SEEN = [f"{p}_{a}" for p in "cj" for a in REVIEW_AXES]


def _reviewed(spark, sf_dir, *more: str):
    return records(spark, sf_dir, *_SEEN, "single", "population", "control", *more)


@query(f"WITH {_REVIEWED} SELECT o_orderkey, c_hard AS exclusion, c_chain AS chain, c_decision AS decision, c_basis AS basis FROM c2")
def qc_decision(spark, sf_dir):
    """Hard exclusions, the complete chain and the decision of one reviewer."""
    one = vd.Reviewer("c_")
    return _reviewed(spark, sf_dir).select("o_orderkey", one.exclusion.alias("exclusion"), one.chain.alias("chain"), one.verdict.alias("v")).select("o_orderkey", "exclusion", "chain", "v.decision", "v.basis")


@query(f"""WITH {_REVIEWED}, f AS (SELECT *, evidence_flag IN ('benchmark_language', 'explicit_pooling_language') AS risky, least(n_primary, 6) + CASE WHEN evidence_flag IN ('individual_cell_language', 'ms_proteomics_language') THEN 2
    WHEN evidence_flag <> 'none' THEN 3 ELSE 0 END + raw_samples::INT AS strength, route IN ('include_candidate', 'review_high') AS wanted FROM c2)
    SELECT o_orderkey, strength, CASE WHEN c_decision = 'uncertain' AND wanted AND strength >= 4 THEN 'high_recall_uncertain_with_direct_evidence' WHEN c_decision = 'uncertain' AND risky THEN 'uncertain_with_population_or_benchmark_risk'
    WHEN wanted AND c_decision = 'exclude' THEN 'high_recall_route_vs_exclude' WHEN route = 'review_low' AND c_decision = 'include' THEN 'weak_route_vs_include'
    WHEN c_decision = 'include' AND (risky OR review_flag IN ('repository_qwen_overcall', 'contradictory_cell_evidence')) THEN 'include_despite_risk_flag' END AS reason FROM f""")
def jury_trigger(spark, sf_dir):
    r = _reviewed(spark, sf_dir, "route", "review_flag", "evidence_flag", "n_primary", "raw_samples")
    r = r.select("o_orderkey", "route", F.array("review_flag").alias("review"), F.array("evidence_flag").alias("evidence"), "n_primary", "raw_samples", vd.Reviewer("c_").verdict["decision"].alias("decision"))
    r = r.withColumn("strength", vd.evidence_strength("n_primary", "evidence", "raw_samples"))
    return r.select("o_orderkey", "strength", vd.jury_reason(F.col("decision"), "route", "review", "evidence", F.col("strength")).alias("reason"))


@query(f"""WITH {_REVIEWED} SELECT o_orderkey, CASE WHEN NOT asked THEN c_decision WHEN c_decision = j_decision AND c_decision <> 'uncertain' THEN c_decision WHEN c_decision = 'uncertain' AND j_decision <> 'uncertain' THEN j_decision
    WHEN j_decision = 'uncertain' AND c_decision <> 'uncertain' THEN c_decision WHEN (c_hard IS NULL) <> (j_hard IS NULL) THEN 'exclude' WHEN (c_chain IS NOT NULL AND j_decision = 'exclude' AND j_hard IS NULL) OR (j_chain IS NOT NULL AND c_decision = 'exclude' AND c_hard IS NULL)
    THEN 'include' ELSE 'uncertain' END AS decision, CASE WHEN NOT asked THEN 'critic_only' WHEN c_decision = j_decision AND c_decision <> 'uncertain' THEN 'critic_jury_agree' WHEN c_decision = 'uncertain' AND j_decision <> 'uncertain' THEN 'jury_resolved_critic_uncertainty'
    WHEN j_decision = 'uncertain' AND c_decision <> 'uncertain' THEN 'critic_resolved_jury_uncertainty' WHEN c_hard IS NOT NULL AND j_hard IS NULL THEN 'critic_hard_sample_unit_exclusion' WHEN j_hard IS NOT NULL AND c_hard IS NULL THEN 'jury_hard_sample_unit_exclusion'
    WHEN c_chain IS NOT NULL AND j_decision = 'exclude' AND j_hard IS NULL THEN 'critic_complete_chain_overrides_soft_jury_exclusion' WHEN j_chain IS NOT NULL AND c_decision = 'exclude' AND c_hard IS NULL THEN 'jury_complete_chain_overrides_soft_critic_exclusion'
    ELSE 'critic_jury_disagree_or_unresolved' END AS how FROM j2""")
def pairwise_decision(spark, sf_dir):
    both = vd.combined(vd.Reviewer("c_"), vd.Reviewer("j_"), "asked")
    return _reviewed(spark, sf_dir, "asked").select("o_orderkey", both.alias("v")).select("o_orderkey", "v.decision", "v.how")


@query(f"""WITH {RECORDS} SELECT o_orderkey, CASE WHEN conflicts > 0 THEN 'blocked_semantic_conflict' WHEN contradictory > 0 THEN 'blocked_branch_conflict' WHEN clean > 0 THEN 'blocked_mapping_incomplete' ELSE 'blocked_internal_evidence' END AS missing_state,
    CASE WHEN blocker IN ('Template gap', 'single_cell_required missing') THEN 'blocked_bigbio_template' WHEN blocker = 'data_file unknown' THEN 'blocked_mapping_incomplete' WHEN blocker IN ('bigbio_required_value_unresolved:x', 'isolation open') THEN 'blocked_metadata_incomplete'
    WHEN blocker = 'branch 2' THEN 'blocked_branch_conflict' WHEN blocker = 'semantic clash' THEN 'blocked_semantic_conflict' ELSE 'blocked_internal_evidence' END AS blocker_state FROM r""")
def blocked_states(spark, sf_dir):
    r = records(spark, sf_dir, "conflicts", "contradictory", "clean", "blocker")
    return r.select("o_orderkey", vd.missing_candidate_state("conflicts", "contradictory", "clean").alias("missing_state"), vd.blocker_state(F.array(F.lit(""), F.col("blocker"))).alias("blocker_state"))


@query(f"""WITH {RECORDS} SELECT o_orderkey, CASE WHEN valid THEN 'ready' WHEN mode <> 'generated' AND audited AND linkage <> 'complete' THEN 'resolved_linkage_validation_regression' WHEN mode <> 'generated' THEN 'existing_structural_review'
    WHEN completeness LIKE '%metadata' THEN 'denovo_required_metadata' WHEN completeness LIKE '%gap' THEN 'denovo_template_gap' WHEN completeness LIKE '%channel_mapping' THEN 'denovo_mapping' WHEN completeness LIKE '%contents_mapping' THEN 'denovo_archive' ELSE 'other_incomplete' END AS lane,
    mode <> 'generated' AND valid AND errors = 0 AND completeness = 'locally_valid' AS advisory FROM r""")
def triage_lane(spark, sf_dir):
    r = records(spark, sf_dir, "valid", "mode", "completeness", "audited", "linkage", "errors")
    return r.select("o_orderkey", vd.triage_lane("valid", "mode", "completeness", "audited", "linkage").alias("lane"), vd.linkage_is_advisory("mode", "valid", "errors", "completeness", ["locally_valid"]).alias("advisory"))


@query(f"""WITH {RECORDS} SELECT o_orderkey, CASE label WHEN 'Single-cell data' THEN 'single_cell' WHEN 'low input run' THEN 'low_input' WHEN '5 fractions' THEN 'fractionation' WHEN 'clinical MSA' THEN 'clinical' WHEN 'yeast KO' THEN 'yeast' WHEN 'KO strain' THEN 'yeast'
    WHEN 'species mix' THEN 'species_mix' WHEN 'DDA versus DIA' THEN 'dda_dia' WHEN 'window 4' THEN 'window_optimization' END AS scope, regexp_full_match(upper(trim(accession)), 'PXD[0-9]{{6,}}') AS is_pxd, regexp_full_match(upper(trim(accession)), 'MSV[0-9]+') AS is_msv FROM r""")
def scope_and_accession(spark, sf_dir):
    r = records(spark, sf_dir, "label", "accession")
    return r.select("o_orderkey", vd.scope_kind("label").alias("scope"), vd.is_accession("accession", "PXD", 6).alias("is_pxd"), vd.is_accession("accession", "MSV", 1).alias("is_msv"))


@query(r"""SELECT page_id, NOT regexp_matches(url, '/de/|page=3') AND regexp_matches(url, 'html$|/en/') AS selected, regexp_extract(url, '^([a-z]+)://', 1) = 'https' AND regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1) = regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1)
    AND coalesce(nullif(regexp_extract(url, '^[a-z]+://[^/:?#]*:([0-9]+)', 1), ''), '443') = '443' AND starts_with(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/en/') AS inside FROM pages""")
def crawl_scope(spark, sf_dir):
    """Paths kept by patterns, and pages under the English root of their own host over https."""
    root = F.concat(F.lit("https://"), F.regexp_extract("url", "^[a-z]+://([^/:?#]*)", 1), F.lit("/en/"))
    return table(spark, sf_dir, "pages").select("page_id", vd.path_selected("url", ["html$", "/en/"], ["/de/", "page=3"]).alias("selected"), vd.under_root(root, "url").alias("inside"))
