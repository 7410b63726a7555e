"""Verdict ladders over structured evidence: routes, exclusions, chains, juries, states and scopes.

Every rule is a column expression over values of one row, so a whole ladder is one projection and moves no data. An axis is
a column of lower-case words; a missing one counts as the empty word and meets no rule that asks for a value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.columns import ascii_lower, col, ladder, norm, text_of

# Flags of the evidence of a packet, and of a review, that raise the risk of an inclusion.
POPULATION_FLAGS = ("explicit_pooling_language", "multi_cell_count_language", "population_or_bulk_language", "benchmark_language")
RISK_FLAGS = ("repository_qwen_overcall", "contradictory_cell_evidence", "negative_context_present", "adjacent_discovery_label")
# Words in blockers, in the order in which they decide the state.
BLOCKER_STATES = (
    (("template", "single_cell_required"), "blocked_bigbio_template"),
    (("bigbio_required_value_unresolved", "bigbio_required_column_missing"), "blocked_metadata_incomplete"),
    (("mapping", "data_file", "repository_scope", "multiorganism", "acquisition"), "blocked_mapping_incomplete"),
    (("metadata", "isolation", "placeholder", "individual_", "empty_control", "truncated_protocol", "organism_part_project", "bulk_source_role"), "blocked_metadata_incomplete"),
    (("branch", "relation"), "blocked_branch_conflict"),
    (("semantic",), "blocked_semantic_conflict"),
)
# Lanes of incomplete sheets without a sheet of their own.
DENOVO_LANES = {
    "incomplete_required_metadata": "denovo_required_metadata",
    "incomplete_template_isolation_method_gap": "denovo_template_gap",
    "incomplete_sample_to_file_or_channel_mapping": "denovo_mapping",
    "incomplete_repository_archive_contents_mapping": "denovo_archive",
}
EXISTING_MODES = ("enriched_existing_sdrf", "validated_existing_sdrf")
# Patterns of scopes, in order; the texts are searched in lower case.
SCOPES = (
    (r"\bsingle[- ]cell\b", "single_cell"),
    (r"\b(?:dilution|low[- ]input|low amount|low-amount|benchmark)\b", "low_input"),
    (r"fraction", "fractionation"),
    (r"clinical|msa", "clinical"),
    (r"yeast|knockout|(?:^| )ko(?: |$)", "yeast"),
    (r"species|mix", "species_mix"),
    (r"dda.*dia|dia.*dda", "dda_dia"),
    (r"window", "window_optimization"),
)


def axis(c) -> Column:
    return ascii_lower(norm(c))


def repository_evidence(cell, ms) -> Column:
    """One of seven classes from how directly a repository shows cells and how directly it shows the measurement."""
    cell, ms = axis(cell), axis(ms)
    hinted = cell.isin("direct", "implied")
    return ladder(
        ((cell == "direct") & (ms == "direct"), "direct_cell_and_ms"), (hinted & (ms == "direct"), "plausible_cell_and_direct_ms"), (hinted & (ms == "implied"), "plausible_but_both_not_direct"),
        (cell == "contradictory", "contradictory_cell_evidence"), ((cell == "absent") & (ms == "direct"), "ms_without_individual_cell_evidence"), (ms == "absent", "insufficient_cell_or_ms_evidence"),
        otherwise="uncertain_repository_evidence",
    )


def overcall(triage, cell, ms) -> Column:
    """Whether a class claims more than its own axes."""
    bold = axis(triage).isin("likely_true_scp", "possible_true_scp")
    return F.when(bold & (axis(cell).isin("absent", "contradictory") | (axis(ms) == "absent")), "overcall_vs_structured_evidence").otherwise("consistent_or_conservative")


def publication_route(priority, final, model) -> Column:
    priority, final, model = col(priority), col(final), col(model)
    broad = priority == "C_broad"
    return ladder(
        (final == "yes", "include_candidate"), (priority == "A_specific", "review_high"), (priority == "B_method", "review_medium"),
        (broad & (model == "yes"), "review_medium"), (broad & (model == "uncertain"), "review_low"), otherwise="likely_non_scp",
    )


def repository_route(priority, cell, ms) -> Column:
    priority, cell, ms = col(priority), axis(cell), axis(ms)
    both = (cell == "direct") & (ms == "direct")
    by_priority = {
        "A_specific": ladder((both, "include_candidate"), otherwise="review_high"),
        "B_method": ladder(((cell == "implied") & (ms == "direct"), "review_medium"), (ms == "direct", "review_low"), otherwise="likely_non_scp"),
        "C_broad": ladder((both, "review_medium"), ((cell == "implied") & ms.isin("direct", "implied"), "review_low"), otherwise="likely_non_scp"),
    }
    return ladder(*[(priority == p, route) for p, route in by_priority.items()], otherwise="likely_non_scp")


class Reviewer:
    """The verdicts of one reviewer. Axes are columns named `prefix` + axis; single, population and control say whether the
    packet's passages hold an anchor of that kind, whatever the reviewer saw in them."""

    def __init__(self, prefix: str = "", single="single", population="population", control="control"):
        a = lambda name: axis(prefix + name)
        single, population, control = (F.coalesce(col(c), F.lit(False)) for c in (single, population, control))
        alone = single & ~population  # passages speak for single targets only
        composition, pooling, people, target, cells, raw_benchmark = (a(x) for x in ("composition", "pooling", "population_only", "target", "cells", "benchmark"))
        excused = alone & (target == "yes")
        #: why the sample unit rules the record out; null if it does not
        self.exclusion = ladder(
            (population & ~single, "passage_scoped_population_target_anchor"),
            ((composition == "multiple") & population & ~single, "target_ms_sample_contains_multiple_cells"),
            ((pooling == "present") & ~alone, "destructive_pooling_before_identity"),
            ((people == "yes") & ~excused, "population_samples_only"),
        )
        fits = composition.isin("one", "mixed_design") | ((composition == "multiple") & alone)
        unpooled = (pooling == "absent") | ((pooling == "present") & alone)
        whole = (cells == "yes") & (target == "yes") & fits & (a("identity") == "yes") & unpooled & ((people == "no") | ((people == "yes") & excused))
        corrected = (composition == "multiple") | (pooling == "present") | (people == "yes")
        #: how the chain from one cell to one measurement is complete; null if it is not
        self.chain = F.when(
            whole, ladder((corrected, "complete_target_single_cell_ms_chain_corrected_by_passage_scope"), (control, "complete_target_single_cell_ms_chain_with_separate_controls"), otherwise="complete_target_single_cell_ms_chain")
        )
        as_verdict = lambda decision, basis: F.struct(F.lit(decision).alias("decision"), (basis if isinstance(basis, Column) else F.lit(basis)).alias("basis"))
        axis_of = lambda basis: F.concat(F.lit("structured_exclusion_axis:"), basis if isinstance(basis, Column) else F.lit(basis))
        #: struct<decision, basis>
        self.verdict = ladder(
            (self.exclusion.isNotNull(), as_verdict("exclude", axis_of(self.exclusion))),
            ((cells == "no") & (target != "yes"), as_verdict("exclude", axis_of("no_individual_cell_samples"))),
            (whole & (raw_benchmark == "yes"), as_verdict("include", "structured_single_cell_chain_overrides_inconsistent_benchmark_only")),
            (whole, as_verdict("include", self.chain)),
            ((raw_benchmark == "yes") & (target != "yes"), as_verdict("exclude", axis_of("benchmark_only_without_single_cell_targets"))),
            otherwise=as_verdict("uncertain", "insufficient_or_mixed_target_sample_axes"),
        )


def evidence_strength(n_primary, flags, raw_samples) -> Column:
    """Points: up to six passages, language of cells and of the measurement, any risk language, samples found before."""
    has = lambda *names: F.arrays_overlap(col(flags), F.array(*[F.lit(n) for n in names]))
    points = lambda condition, n: F.when(condition, n).otherwise(0)
    return (
        F.least(col(n_primary), F.lit(6)) + points(has("individual_cell_language"), 2) + points(has("ms_proteomics_language"), 2) + points(has(*POPULATION_FLAGS), 3) + points(col(raw_samples), 1)
    )


def jury_reason(decision: Column, route, review_flags, evidence_flags, strength: Column) -> Column:
    """Why a second reviewer is asked; null if none is."""
    route, any_of = col(route), lambda flags, names: F.arrays_overlap(col(flags), F.array(*[F.lit(n) for n in names]))
    risky = any_of(evidence_flags, POPULATION_FLAGS)
    wanted = route.isin("include_candidate", "review_high")
    return ladder(
        ((decision == "uncertain") & wanted & (strength >= 4), "high_recall_uncertain_with_direct_evidence"), ((decision == "uncertain") & risky, "uncertain_with_population_or_benchmark_risk"),
        (wanted & (decision == "exclude"), "high_recall_route_vs_exclude"), ((route == "review_low") & (decision == "include"), "weak_route_vs_include"),
        ((decision == "include") & (risky | any_of(review_flags, RISK_FLAGS)), "include_despite_risk_flag"),
    )


def combined(critic: Reviewer, jury: Reviewer, asked) -> Column:
    """struct<decision, how> of two reviewers: agreement, then the one that knows, then hard exclusions, then chains."""
    c, j = critic.verdict["decision"], jury.verdict["decision"]
    sure = lambda x: x.isin("include", "exclude")
    c_hard, j_hard = critic.exclusion.isNotNull(), jury.exclusion.isNotNull()
    made = lambda decision, how: F.struct((decision if isinstance(decision, Column) else F.lit(decision)).alias("decision"), F.lit(how).alias("how"))
    return ladder(
        (~col(asked), made(c, "critic_only")), ((c == j) & sure(c), made(c, "critic_jury_agree")),
        ((c == "uncertain") & sure(j), made(j, "jury_resolved_critic_uncertainty")), ((j == "uncertain") & sure(c), made(c, "critic_resolved_jury_uncertainty")),
        (c_hard & ~j_hard, made("exclude", "critic_hard_sample_unit_exclusion")), (j_hard & ~c_hard, made("exclude", "jury_hard_sample_unit_exclusion")),
        (critic.chain.isNotNull() & (j == "exclude") & ~j_hard, made("include", "critic_complete_chain_overrides_soft_jury_exclusion")),
        (jury.chain.isNotNull() & (c == "exclude") & ~c_hard, made("include", "jury_complete_chain_overrides_soft_critic_exclusion")),
        otherwise=made("uncertain", "critic_jury_disagree_or_unresolved"),
    )


def missing_candidate_state(conflicts, contradictory, clean) -> Column:
    return ladder(
        (col(conflicts) > 0, "blocked_semantic_conflict"), (col(contradictory) > 0, "blocked_branch_conflict"), (col(clean) > 0, "blocked_mapping_incomplete"), otherwise="blocked_internal_evidence"
    )


def blocker_state(blockers) -> Column:
    """The state of the first family of words that any blocker of the array holds."""
    text = ascii_lower(F.concat_ws(" ", col(blockers)))
    has = lambda words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: text.contains(w))
    return ladder(*[(has(words), state) for words, state in BLOCKER_STATES], otherwise="blocked_internal_evidence")


def triage_lane(valid, mode, completeness, audited_valid, audited_linkage) -> Column:
    """What is to be done with a sheet after a run. The audit columns are null where there was no audit."""
    regressed = F.coalesce(col(audited_valid), F.lit(False)) & F.coalesce(col(audited_linkage).isin("partial", "none"), F.lit(False))
    existing = col(mode).isin(*EXISTING_MODES)
    return ladder(
        (col(valid), "ready"), (existing & regressed, "resolved_linkage_validation_regression"), (existing, "existing_structural_review"),
        *[(col(completeness) == c, lane) for c, lane in DENOVO_LANES.items()], otherwise="other_incomplete",
    )


def linkage_is_advisory(mode, valid, errors, completeness, accepted: list[str]) -> Column:
    """Existing sheets that are valid and complete may name files that the inventory lacks; generated ones may not."""
    return col(mode).isin(*EXISTING_MODES) & F.coalesce(col(valid), F.lit(False)) & (F.coalesce(col(errors), F.lit(0)) == 0) & col(completeness).isin(*accepted)


def scope_kind(label) -> Column:
    low = ascii_lower(text_of(label))
    return ladder(*[(low.rlike(pattern), kind) for pattern, kind in SCOPES])


def is_accession(c, prefix: str, digits: int) -> Column:
    """The prefix in any case and at least so many digits, nothing else."""
    return F.translate(F.trim(text_of(c)), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ").rlike(f"^{prefix}[0-9]{{{digits},}}$")


def path_selected(path, include: list[str], exclude: list[str]) -> Column:
    """Excluding patterns win; without including ones everything else is selected."""
    any_of = lambda patterns: F.exists(F.array(*[F.lit(p) for p in patterns]), lambda p: F.call_function("rlike", col(path), p)) if patterns else F.lit(False)
    return ~any_of(exclude) & (any_of(include) if include else F.lit(True))


def under_root(root, candidate) -> Column:
    """Same scheme, host and port (the scheme's own where none is given), and a path that begins with the root's."""
    part = lambda u, name: F.coalesce(F.try_parse_url(u, F.lit(name)), F.lit(""))
    port = lambda u: F.coalesce(F.nullif(F.regexp_extract(part(u, "AUTHORITY"), r":(\d+)$", 1), F.lit("")), ladder((part(u, "PROTOCOL") == "https", "443"), (part(u, "PROTOCOL") == "http", "80"), otherwise=""))
    r, c = col(root), col(candidate)
    return (part(r, "PROTOCOL") == part(c, "PROTOCOL")) & (part(r, "HOST") == part(c, "HOST")) & (port(r) == port(c)) & part(c, "PATH").startswith(part(r, "PATH"))
