"""Claims that publications make about the open fields of a study, with their places in the text.

Only explicit wording counts: every rule is a pattern that names one value of one field. A publication that names exactly one
value of a field makes a claim; one that names several makes none, and each value is a row of the conflict. All of it is decided
within the row of the publication, so texts are not shuffled: the fields asked of a study are the small side of one join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ladder, norm, text_of
from .spans import once, plain, window_text, with_spans


@dataclass(frozen=True)
class ClaimRule:
    rule: str
    field: str
    value: str
    status: str
    pattern: str


ISOLATION, DISSOCIATION = "characteristics[single cell isolation protocol]", "comment[dissociation method]"
SUPPORTED, UNSUPPORTED, CONFLICT = "supported_vocabulary", "unsupported_vocabulary", "conflict_unresolved"
# What a claim rests on, and why there is none.
ONE_VALUE = "single_explicit_value_for_publication_and_blocker_field"
SEVERAL_VALUES = "multiple_distinct_values_for_same_publication_and_blocker_field"
# The wording of each value; patterns do not look at case.
SINGLE_CELL = tuple(
    ClaimRule(rule, field, value, status, f"(?i){pattern}")
    for rule, field, value, status, pattern in (
        ("isolation_manual_picking_v1", ISOLATION, "manual picking", SUPPORTED, r"\bmanual(?:ly)?\s+(?:pick(?:ed|ing)?|isolat(?:ed|ion)|dissect(?:ed|ion|ing)?)\b|\b(?:individual|single)\s+cells?\s+(?:were\s+)?(?:picked|transferred)\b|\bmicropipett(?:e|ing)\b.*\b(?:single|individual)\s+cells?\b"),
        ("isolation_facs_v1", ISOLATION, "FACS", SUPPORTED, r"\bFACS\b|\bfluorescence[- ]activated\s+cell\s+sort(?:ing|ed)?\b"),
        ("isolation_cellenone_v1", ISOLATION, "cellenONE", SUPPORTED, r"\bcellenONE\b"),
        ("isolation_lcm_v1", ISOLATION, "laser capture microdissection", SUPPORTED, r"\blaser\s+capture\s+microdissection\b|\bLCM\b.{0,80}\b(?:cell|tissue)\b"),
        ("isolation_nanopots_v1", ISOLATION, "nanoPOTS", SUPPORTED, r"\bnanoPOTS\b"),
        ("isolation_droplet_microfluidics_v1", ISOLATION, "droplet microfluidics", SUPPORTED, r"\bdroplet\s+microfluidic(?:s)?\b"),
        ("isolation_acoustic_droplet_v1", ISOLATION, "acoustic droplet ejection", SUPPORTED, r"\bacoustic\s+droplet\s+ejection\b"),
        ("isolation_microfluidics_v1", ISOLATION, "microfluidics", SUPPORTED, r"(?<!droplet )\bmicrofluidic(?:s)?\b"),
        ("isolation_transvaginal_puncture_v1", ISOLATION, "transvaginal puncture", UNSUPPORTED, r"\boocytes?\s+(?:were\s+)?obtained\s+by\s+transvaginal\s+puncture\b|\btransvaginal\s+puncture\b.{0,120}\boocytes?\b"),
        ("isolation_microaspiration_v1", ISOLATION, "microaspiration", UNSUPPORTED, r"\bmicroaspirat(?:e|ed|ion|ing)\b"),
        ("isolation_patch_clamp_aspiration_v1", ISOLATION, "patch-clamp aspiration", UNSUPPORTED, r"\bpatch[- ]clamp\b.{0,120}\baspirat(?:e|ed|ion|ing)\b"),
        ("isolation_capillary_microsampling_v1", ISOLATION, "capillary microsampling", UNSUPPORTED, r"\bcapillary\s+microsampl(?:e|ed|ing)\b"),
        ("dissociation_hcd_v1", DISSOCIATION, "HCD", SUPPORTED, r"\bHCD\b|\bhigher[- ]energy\s+collisional\s+dissociation\b|\bbeam[- ]type\s+collision[- ]induced\s+dissociation\b"),
        ("dissociation_cid_v1", DISSOCIATION, "CID", SUPPORTED, r"\bCID\b|(?<!beam-type )\bcollision[- ]induced\s+dissociation\b"),
        ("dissociation_etd_v1", DISSOCIATION, "ETD", SUPPORTED, r"\bETD\b|\belectron\s+transfer\s+dissociation\b"),
        ("dissociation_ecd_v1", DISSOCIATION, "ECD", SUPPORTED, r"\bECD\b|\belectron\s+capture\s+dissociation\b"),
        ("dissociation_uvpd_v1", DISSOCIATION, "UVPD", SUPPORTED, r"\bUVPD\b|\bultraviolet\s+photodissociation\b"),
    )
)
REFERENCES = r"(?im)^\s*REFERENCES\s*$"


def listed_fields(c) -> Column:
    """The names in a JSON array, or between semicolons; white space collapsed, without blank ones."""
    text = F.trim(text_of(c))
    parsed = F.when(F.startswith(text, F.lit("[")), F.from_json(text, "array<string>"))
    return F.filter(F.transform(F.coalesce(parsed, F.split(text, ";")), lambda x: norm(x)), lambda x: x != "")


def outcomes(publications: DataFrame, blockers: DataFrame, rules: Sequence[ClaimRule] = SINGLE_CELL, ends: str = REFERENCES, radius: int = 240, shown: int = 3) -> DataFrame:
    """publications: accession, identity, text; blockers: accession, fields (see listed_fields) -> a row for each publication and
    field asked of its accession: accession, identity, text_sha256 (of the whole text, null as empty), field, outcome (claim,
    conflict, no_claim, unsupported_field) and claims: value, status, rules, n_matches, the first `shown` spans, and the
    surroundings of the first.

    Accessions meet without regard to case and outer white space; several rows of one unite their fields. Publications of
    which nothing is asked have no row; equal publications have one each. A text counts up to the first match of `ends`."""
    acc = F.upper(norm("accession")).alias("accession")
    asked = blockers.select(acc, F.explode(listed_fields("fields")).alias("f")).groupBy("accession", F.lower("f").alias("key")).agg(F.min("f").alias("f"))
    asked = asked.where("accession <> ''").groupBy("accession").agg(F.array_sort(F.collect_list("f")).alias("asked"))
    texts = publications.select(acc, "identity", text_of("text").alias("text")).join(asked, "accession")
    texts = once(texts, body=plain(F.split("text", ends, 2)[0]), text_sha256=F.sha2("text", 256)).drop("text")
    found = with_spans(texts, "body", **{f"r{i}": r.pattern for i, r in enumerate(rules)})

    def claim(value: str, of: list[tuple[int, ClaimRule]]) -> Column:
        spans = F.concat(*[F.col(f"r{i}") for i, _ in of])
        named = F.array_sort(F.array_compact(F.array(*[F.when(F.size(f"r{i}") > 0, F.lit(r.rule)) for i, r in of])))
        first = F.get(spans, F.lit(0))
        return F.struct(
            F.lit(value).alias("value"), F.lit(of[0][1].status).alias("status"), named.alias("rules"), F.size(spans).cast("long").alias("n_matches"),
            F.slice(spans, 1, shown).alias("spans"), F.when(F.size(spans) > 0, window_text("body", first["at"], first["to"], radius)).alias("context"),
        )

    numbered = list(enumerate(rules))
    by_field = {}
    for field in sorted({r.field.lower() for r in rules}):
        values = sorted({r.value for r in rules if r.field.lower() == field})
        made = [claim(v, [(i, r) for i, r in numbered if r.value == v and r.field.lower() == field]) for v in values]
        by_field[field] = F.filter(F.array(*made), lambda c: c["n_matches"] > 0)
    found = once(found, _by=F.create_map(*[x for f, c in by_field.items() for x in (F.lit(f), c)]))
    rows = found.select("accession", "identity", "text_sha256", F.explode("asked").alias("field"), "_by")
    none = F.slice(F.element_at(F.map_values("_by"), 1), 1, 0)
    rows = rows.withColumn("known", F.map_contains_key("_by", F.lower("field"))).withColumn("claims", F.coalesce(F.try_element_at("_by", F.lower("field")), none))
    n = F.size("claims")
    outcome = ladder((~F.col("known"), "unsupported_field"), (n == 0, "no_claim"), (n == 1, "claim"), otherwise="conflict")
    return rows.select("accession", "identity", "text_sha256", "field", outcome.alias("outcome"), "claims")


def audited(found: DataFrame) -> DataFrame:
    """A row for each value of a claim or conflict: what the outcome is, where the value is first named, and why it counts or not."""
    rows = found.select("accession", "identity", "text_sha256", "field", "outcome", F.explode("claims").alias("c"))
    one = F.col("outcome") == "claim"
    return rows.select(
        "accession", "identity", "text_sha256", "field", "c.value", F.when(one, F.col("c.status")).otherwise(CONFLICT).alias("status"), F.array_join("c.rules", ";").alias("rules"), "c.n_matches",
        F.get("c.spans", F.lit(0))["at"].cast("long").alias("at"), F.get("c.spans", F.lit(0))["to"].cast("long").alias("to"), "c.context", one.alias("accepted"), F.when(one, ONE_VALUE).otherwise(SEVERAL_VALUES).alias("reason"),
    )


def artifacts(found: DataFrame) -> DataFrame:
    """claim_id, accession, field, document: each claim as a JSON document with its spans, named by the document's hash. The
    hash of the publication's text is part of it, so the claim inherits its source and is no source of its own."""
    made = found.where("outcome = 'claim'").select("accession", "field", F.to_json(F.struct("accession", "identity", "text_sha256", "field", F.get("claims", F.lit(0)).alias("claim"))).alias("document"))
    return made.select(F.sha2("document", 256).alias("claim_id"), "accession", "field", "document")


def summary(found: DataFrame) -> DataFrame:
    """One row: claims, their accessions, those of supported and of other vocabulary, and fields without one, by cause."""
    n = lambda o: F.count_if(F.col("outcome") == o)
    status = F.when(F.col("outcome") == "claim", F.get("claims", F.lit(0))["status"])
    return found.agg(
        n("claim").alias("claims"), F.count_distinct(F.when(F.col("outcome") == "claim", F.col("accession"))).alias("accessions"), F.count_if(status == SUPPORTED).alias("supported"),
        F.count_if(status == UNSUPPORTED).alias("unsupported"), n("conflict").alias("conflicting_fields"), n("no_claim").alias("no_claim_fields"), n("unsupported_field").alias("unsupported_fields"),
    )
