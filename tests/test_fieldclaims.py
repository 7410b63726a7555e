"""Claims about open fields: the wording of the field against plain Python, and what makes a claim or a conflict."""

import json
import re

from sievework.operators import fieldclaims as fc

I, D = fc.ISOLATION, fc.DISSOCIATION
TEXTS = [
    "The oocytes were obtained by transvaginal puncture with an 18-gauge needle. Peptides were measured on a Q Exactive HF-X.",
    "Peptide analysis was performed on a Q Exactive HF-X Hybrid Quadrupole-Orbitrap in data-dependent mode.",
    "Spectra were acquired using higher-energy collisional dissociation (HCD).",
    "Some cells were isolated by manual picking. Others by fluorescence-activated cell sorting (FACS), facs again.",
    "MS/MS used beam-type collision-induced dissociation for fragmentation.",
    "Single cells were isolated using droplet microfluidics before processing; 37 wells.",
    "Microfluidic chips,\nLCM of fixed \ntissue; LCM of the tissue",
    "FACS first. cid.\n  \n references  \nUVPD and nanoPOTS",
    "REFERENCES\nFACS",
    "micropipette\nsingle cells; micropipetting of single cells \U0001f600 patch clamp, then aspirated",
    "\U0001f600 ÉTUDE nanoPOTS " + "x " * 200 + "cellenone",
    "",
    None,
]


def run(spark, texts, fields=f"{I};{D}"):
    pubs = spark.createDataFrame([("pxd1", i, t, "extra") for i, t in enumerate(texts)], "accession string, identity long, text string, fields string")
    asked = spark.createDataFrame([("PXD1 ", fields), (" pxd1", None), (None, I), ("PXD9", I)], "accession string, fields string")
    return fc.outcomes(pubs, asked)


def plain_rows(i, text):
    """Value, status, rules, count and first place of each value, by plain loops."""
    body = text or ""
    end = re.search(fc.REFERENCES, body)
    body = body[: end.start()] if end else body
    for field in (I, D):
        hits = {}
        for r in fc.SINGLE_CELL:
            if r.field == field and (m := list(re.finditer(r.pattern, body, re.A))):
                hits[r.value] = (r, m)
        for value, (r, m) in hits.items():
            one = len(hits) == 1
            a, b = m[0].span()
            context = " ".join(body[max(0, a - 240) : b + 240].split())
            yield i, field, value, r.status if one else fc.CONFLICT, r.rule, len(m), a, b, context, one


def test_wording_against_plain_python(spark):
    got = fc.audited(run(spark, TEXTS)).collect()
    mine = sorted((r.identity, r.field, r.value, r.status, r.rules, r.n_matches, r.at, r.to, r.context, r.accepted) for r in got)
    want = sorted(x for i, t in enumerate(TEXTS) for x in plain_rows(i, t))
    assert mine == want
    named = {(r[0], r[2]) for r in mine if r[-1]}
    assert {(0, "transvaginal puncture"), (2, "HCD"), (4, "HCD"), (5, "droplet microfluidics"), (7, "FACS"), (7, "CID")} <= named
    assert {r[2] for r in mine if r[0] == 3} == {"manual picking", "FACS"} and not any(r[-1] for r in mine if r[0] == 3)
    assert not any(r[0] in (1, 8, 11, 12) for r in mine)


def test_outcomes_of_asked_fields(spark):
    rows = run(spark, [TEXTS[0]], f'["{D}", "Other  field", " ", "{I.upper()}"]').collect()
    assert {r.field: r.outcome for r in rows} == {D: "no_claim", "Other field": "unsupported_field", I.upper(): "claim"}
    assert all(r.claims == [] for r in rows if r.outcome != "claim")
    assert run(spark, [TEXTS[0]], " ; ").count() == 0
    assert run(spark, [TEXTS[0]], None).count() == 0
    # a broken JSON list is read as names between semicolons
    assert [r.field for r in run(spark, [TEXTS[0]], f"[x; {D}").orderBy("field").collect()] == ["[x", D]
    # equal publications have a row each
    assert run(spark, [TEXTS[2]] * 3, D).count() == 3


def test_artifacts_and_summary(spark):
    found = run(spark, TEXTS)
    docs = fc.artifacts(found).collect()
    claims = [r for r in fc.audited(found).collect() if r.accepted]
    assert len(docs) == len(claims) == len({d.claim_id for d in docs})
    first = next(json.loads(d.document) for d in docs if '"transvaginal puncture"' in d.document)
    assert first["accession"] == "PXD1" and first["identity"] == 0 and first["claim"]["spans"][0]["match"] == "oocytes were obtained by transvaginal puncture"
    many = run(spark, ["FACS " * 10], I).first().claims[0]
    assert (many.n_matches, len(many.spans)) == (10, 3)
    s = fc.summary(found).first()
    assert (s.claims, s.accessions, s.unsupported) == (len(claims), 1, sum(r.status == fc.UNSUPPORTED for r in claims))
    assert s.claims + s.conflicting_fields + s.no_claim_fields + s.unsupported_fields == 2 * len(TEXTS)
    empty = fc.summary(run(spark, TEXTS, "")).first()
    assert tuple(empty) == (0,) * 7


def test_a_very_long_text(spark):
    text = "word " * 400_000 + "cellenONE " + "word " * 100_000
    (row,) = fc.audited(run(spark, [text], I)).collect()
    assert (row.value, row.at, row.to, row.accepted) == ("cellenONE", 2_000_000, 2_000_009, True)
