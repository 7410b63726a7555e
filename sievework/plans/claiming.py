"""Claims of publications about open fields.

Stand-ins on the test tables: documents are publications, source and language together their study, and the language says which
fields are open. The tables hold invented prose, so these queries' rules (PROSE) name function words and endings where
`fieldclaims.SINGLE_CELL` has the wording of its field; the tests hold that against plain Python."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fieldclaims as fc
from ..operators.fieldclaims import ClaimRule
from ..registry import query
from ..sources.tables import table

PROSE = (
    ClaimRule("the_ing", "article[kind]", "the", fc.SUPPORTED, "[ \n]the [a-z]+ing[ ,.\n]"),
    ClaimRule("la_long", "article[kind]", "la", fc.SUPPORTED, "[ \n]la [a-z]{5,9}[ ,.\n]"),
    ClaimRule("that_ed", "article[kind]", "the", fc.SUPPORTED, "[ \n]that [a-z]+ed[ ,.\n]"),
    ClaimRule("les_eaux", "article[kind]", "les", fc.UNSUPPORTED, "[ \n]les [a-z]+eaux[ ,.\n]"),
    ClaimRule("die_ung", "Ending", "ung", fc.SUPPORTED, "[ \n]die [a-z]+ung[ ,.\n]"),
    ClaimRule("of_tion", "Ending", "tion", fc.UNSUPPORTED, "[ \n]of [a-z]+tion[ ,.\n]"),
    ClaimRule("to_ness", "Ending", "ness", fc.SUPPORTED, "[ \n]to [a-z]+ness[ ,.\n]"),
)
ENDS = "\nThe [a-z]+ion"
# expressions that both engines read
STUDY = "concat(coalesce(source, ''), '-', coalesce(lang, ''))"
OPEN = """CASE lang WHEN 'en' THEN 'Article[kind]; ending ;' WHEN 'de' THEN '["ENDING", " odd  one ", ""]' WHEN 'fr' THEN '[article[kind]' WHEN 'es' THEN ' ; article[kind]' ELSE '' END"""


def found(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    publications = docs.select(F.expr(STUDY).alias("accession"), F.col("doc_id").alias("identity"), "text")
    return fc.outcomes(publications, docs.select(F.expr(STUDY).alias("accession"), F.expr(OPEN).alias("fields")).distinct(), PROSE, ENDS)


_FIELDS = "('en', 'Article[kind]'), ('en', 'ending'), ('de', 'ENDING'), ('de', 'odd one'), ('fr', '[article[kind]'), ('es', 'article[kind]')"
_WS = r"[ \t\n\r\f\x0B]+"
_PLACES = " UNION ALL ".join(
    f"SELECT doc_id, {i} AS i, '{r.rule}' AS rule, lower('{r.field}') AS key, '{r.value}' AS value, '{r.status}' AS status, length(regexp_replace(body, '(?s)(?:{r.pattern}).*', ''))::BIGINT AS pos, regexp_extract_all(body, '{r.pattern}') AS m FROM b"
    for i, r in enumerate(PROSE)
)
_FOUND = f"""b AS (SELECT doc_id, upper({STUDY}) AS accession, lang, regexp_replace(translate(coalesce(text, ''), chr(1) || chr(2), '  '), '(?s){ENDS}.*', '') AS body, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
    fields(lang, field) AS (VALUES {_FIELDS}), p AS ({_PLACES}),
    v AS (SELECT doc_id, key, value, min(status) AS vocabulary, string_agg(rule, ';' ORDER BY rule) AS rules, sum(len(m))::BIGINT AS n_matches, arg_min(pos, i) AS pos, arg_min(pos + length(m[1]), i) AS "to" FROM p WHERE len(m) > 0 GROUP BY ALL),
    a AS (SELECT b.*, field, lower(field) AS key FROM b JOIN fields USING (lang)),
    k AS (SELECT doc_id, key, count(*) AS n FROM v GROUP BY ALL),
    o AS (SELECT a.*, CASE WHEN a.key NOT IN (SELECT key FROM p) THEN 'unsupported_field' WHEN n IS NULL THEN 'no_claim' WHEN n = 1 THEN 'claim' ELSE 'conflict' END AS outcome FROM a LEFT JOIN k USING (doc_id, key))"""


@query(f"""WITH {_FOUND} SELECT accession, doc_id AS identity, text_sha256, field, value, if(outcome = 'claim', vocabulary, 'conflict_unresolved') AS status, rules, n_matches, pos AS "at", "to",
    trim(regexp_replace(substr(body, greatest(pos - 240, 0) + 1, "to" + 240 - greatest(pos - 240, 0)), '{_WS}', ' ', 'g')) AS context, outcome = 'claim' AS accepted,
    if(outcome = 'claim', '{fc.ONE_VALUE}', '{fc.SEVERAL_VALUES}') AS reason FROM o JOIN v USING (doc_id, key)""")
def publication_claims(spark, sf_dir):
    """Values of open fields that a publication names: claims where it is one, conflicts where there are several."""
    return fc.audited(found(spark, sf_dir))


@query(f"""WITH {_FOUND} SELECT count(*) FILTER (outcome = 'claim') AS claims, count(DISTINCT accession) FILTER (outcome = 'claim') AS accessions, count(*) FILTER (outcome = 'claim' AND vocabulary = 'supported_vocabulary') AS supported,
    count(*) FILTER (outcome = 'claim' AND vocabulary = 'unsupported_vocabulary') AS unsupported, count(*) FILTER (outcome = 'conflict') AS conflicting_fields, count(*) FILTER (outcome = 'no_claim') AS no_claim_fields,
    count(*) FILTER (outcome = 'unsupported_field') AS unsupported_fields FROM (SELECT DISTINCT o.doc_id, field, outcome, accession, CASE WHEN outcome = 'claim' THEN vocabulary END AS vocabulary FROM o LEFT JOIN v USING (doc_id, key))""")
def claim_summary(spark, sf_dir):
    return fc.summary(found(spark, sf_dir))
