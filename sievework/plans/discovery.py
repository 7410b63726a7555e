"""Discovery queries: lexicon scores of documents, tiers, recall audits, sources and identities.

Stand-ins on the test tables: the first line of a document is its title, the text its description, the source its
metadata; equal texts are aliases; labels of quality 1 are the known positives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ascii_lower, excerpt, flags, keep_rows, norm
from ..operators import lexicon as lx
from ..registry import query
from ..sources.tables import table

# The preset lexicon of the test tables.
LEXICON = [
    lx.Term("explicit", "license", "released under", 12), lx.Term("explicit", "license", "licensed under", 12), lx.Term("explicit", "license", "license", 8),
    lx.Term("explicit", "contact", "@", 9), lx.Term("method", "english", "the thing", 6), lx.Term("method", "english", " the ", 4), lx.Term("method", "german", " und ", 4),
    lx.Term("method", "french", " les ", 4), lx.Term("biological", "spanish", " que ", 3), lx.Term("biological", "ending", "tion", 2), lx.Term("adjacent", "table", " | ", 1), lx.Term("adjacent", "source", "src1", 1),
]
NEGATIVES = [lx.Term("negative", "noise", "***", 0), lx.Term("negative", "noise", "$$$", 0), lx.Term("negative", "shouting", "!!", 0)]
LANES = [lx.Lane("title", "title", 3), lx.Lane("description", "text", 2), lx.Lane("metadata", "source", 1)]
CATEGORIES = ["explicit", "method", "biological", "adjacent"]
AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_LEX = ", ".join(f"({i}, '{t.category}', '{t.label}', '{t.term}', {t.weight})" for i, t in enumerate(LEXICON))
_NEG = ", ".join(f"('{t.label}', '{t.term}')" for t in NEGATIVES)
SCORED = f"""
    lex(ord, category, label, term, weight) AS (VALUES {_LEX}), neg(label, term) AS (VALUES {_NEG}),
    lanes AS (
        SELECT doc_id, 1 AS lane_no, 'title' AS lane, 3 AS m, translate(split_part(text, chr(10), 1), {AZ}) AS t FROM documents UNION ALL
        SELECT doc_id, 2, 'description', 2, translate(text, {AZ}) FROM documents UNION ALL
        SELECT doc_id, 3, 'metadata', 1, translate(source, {AZ}) FROM documents),
    raw AS (SELECT doc_id, lane, category, label, weight * m AS w, row_number() OVER (PARTITION BY doc_id, lane, label ORDER BY ord) AS rn
            FROM lanes JOIN lex ON contains(t, term)),
    hit AS (SELECT * FROM raw WHERE rn = 1),
    negs AS (SELECT doc_id, string_agg(DISTINCT label, ';' ORDER BY label) AS negative_labels FROM lanes JOIN neg ON contains(t, term) GROUP BY doc_id),
    agg AS (SELECT doc_id, sum(w)::BIGINT AS score, string_agg(DISTINCT lane, ';' ORDER BY lane) AS lanes_hit, string_agg(DISTINCT label, ';' ORDER BY label) AS labels,
                   bool_or(category = 'explicit') AS e, bool_or(category = 'method') AS me, bool_or(category = 'biological') AS b, bool_or(category = 'adjacent') AS a, count(DISTINCT lane) AS n_lanes
            FROM hit GROUP BY doc_id),
    scored AS (SELECT d.doc_id, coalesce(score, 0) AS score, CASE WHEN score >= 36 THEN 'strong' WHEN score >= 14 THEN 'possible' WHEN score > 0 THEN 'weak' ELSE 'none' END AS tier,
                      coalesce(lanes_hit, '') AS lanes_hit, coalesce(labels, '') AS labels, coalesce(negative_labels, '') AS negative_labels, coalesce(n_lanes, 0) AS n_lanes,
                      CASE WHEN e AND me THEN 'explicit+method' WHEN e AND b THEN 'explicit+biological' WHEN e THEN 'explicit_only' WHEN me AND b THEN 'method+biological' WHEN me THEN 'method_only'
                           WHEN b THEN 'biological_only' WHEN a THEN 'adjacent_only' ELSE 'none' END AS profile,
                      CASE WHEN e THEN 'A_specific' WHEN me THEN 'B_method' WHEN b THEN 'C_broad' WHEN a THEN 'D_adjacent' ELSE 'E_none' END AS priority
               FROM documents d LEFT JOIN agg USING (doc_id) LEFT JOIN negs USING (doc_id))
"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("title", F.substring_index("text", "\n", 1))
    return lx.categorized(lx.score(docs, "doc_id", LANES, LEXICON, NEGATIVES), CATEGORIES)


@query(f"WITH {SCORED} SELECT doc_id, score, tier, lanes_hit, labels, negative_labels FROM scored")
def lexicon_score(spark, sf_dir):
    return scored(spark, sf_dir).select("doc_id", "score", "tier", *[F.array_join(c, ";").alias(c) for c in ("lanes_hit", "labels", "negative_labels")])


@query(f"WITH {SCORED} SELECT doc_id, negative_labels, score FROM scored WHERE negative_labels <> ''")
def negative_context(spark, sf_dir):
    rows = scored(spark, sf_dir).select("doc_id", F.array_join("negative_labels", ";").alias("negative_labels"), "score")
    return keep_rows(rows, F.col("negative_labels") != "")


@query(f"WITH {SCORED} SELECT source, tier, count(*) AS n, sum(score)::BIGINT AS total FROM scored JOIN documents USING (doc_id) GROUP BY source, tier")
def tier_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return scored(spark, sf_dir).join(docs, "doc_id").groupBy("source", "tier").agg(F.count("*").alias("n"), F.sum("score").alias("total"))


@query(f"WITH {SCORED} SELECT doc_id, profile, priority FROM scored")
def candidate_profile(spark, sf_dir):
    return scored(spark, sf_dir).select("doc_id", "profile", "priority")


@query(f"""WITH {SCORED} SELECT count(*) AS candidates, count(*) FILTER (tier = 'strong') AS strong, count(*) FILTER (tier = 'possible') AS possible, count(*) FILTER (tier = 'weak') AS weak,
    count(*) FILTER (negative_labels <> '') AS with_negatives, count(*) FILTER (priority = 'A_specific') AS specific, count(*) FILTER (n_lanes > 1) AS multi_lane FROM scored""")
def candidate_audit_summary(spark, sf_dir):
    return lx.audit_summary(scored(spark, sf_dir))


def _expected(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("expected_positive"))


_RECALL = f"""{SCORED}, audit AS (SELECT l.doc_id, quality = 1 AS expected_positive, coalesce(s.score, 0) > 0 AS recovered, CASE WHEN s.score > 0 THEN s.score ELSE 0 END AS score,
    CASE WHEN s.score > 0 THEN s.tier ELSE 'none' END AS tier, CASE WHEN s.score > 0 THEN s.lanes_hit ELSE '' END AS lanes FROM labels l LEFT JOIN scored s USING (doc_id))"""


@query(f"WITH {_RECALL} SELECT * FROM audit")
def recall_audit(spark, sf_dir):
    return lx.recall(_expected(spark, sf_dir), scored(spark, sf_dir), "doc_id")


@query(f"WITH {_RECALL} SELECT count(*) FILTER (expected_positive) AS expected, count(*) FILTER (expected_positive AND recovered) AS recovered, round(count(*) FILTER (expected_positive AND recovered) / count(*) FILTER (expected_positive), 6) AS recall FROM audit")
def recall_summary(spark, sf_dir):
    got = recall_audit(spark, sf_dir).agg(F.count_if("expected_positive").alias("expected"), F.count_if(F.col("expected_positive") & F.col("recovered")).alias("recovered"))
    return got.withColumn("recall", F.when(F.col("expected") > 0, F.round(F.col("recovered") / F.col("expected"), 6)).otherwise(0.0))


@query(f"WITH {_RECALL} SELECT doc_id, substr(text, 1, 80) AS head FROM audit JOIN documents USING (doc_id) WHERE expected_positive AND tier NOT IN ('strong', 'possible')")
def missed_positives(spark, sf_dir):
    missed = keep_rows(recall_audit(spark, sf_dir).select("doc_id", "expected_positive", "tier"), F.col("expected_positive") & ~F.col("tier").isin("strong", "possible"))
    return table(spark, sf_dir, "documents").select("doc_id", F.substring("text", 1, 80).alias("head")).join(missed.select("doc_id"), "doc_id", "left_semi")


@query("""SELECT 'document' AS kind, source AS scope, count(*) AS n FROM documents GROUP BY source UNION ALL
    SELECT 'page', regexp_extract(url, '^[a-z]+://([^/?#]+)', 1), count(*) FROM pages GROUP BY 2 UNION ALL SELECT 'conversation', role, count(*) FROM conversations GROUP BY role""")
def source_scope_union(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("source").alias("scope"))
    pages = table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("scope"))
    turns = table(spark, sf_dir, "conversations").select(F.lit("conversation").alias("kind"), F.col("role").alias("scope"))
    return docs.unionByName(pages).unionByName(turns).groupBy("kind", "scope").agg(F.count("*").alias("n"))


@query("SELECT doc_id, source FROM documents WHERE source NOT IN ('src0', 'src1') AND md5(text) NOT IN (SELECT md5(text) FROM documents WHERE source IN ('src0', 'src1'))")
def registry_supplement_anti(spark, sf_dir):
    """Supplement rows whose alias the primary sources do not have."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.md5("text").alias("alias"))
    primary = docs.where(F.col("source").isin("src0", "src1")).select("alias").distinct()
    return docs.where(~F.col("source").isin("src0", "src1")).join(primary, "alias", "left_anti").select("doc_id", "source")


@query("""WITH d AS (SELECT doc_id, md5(text) AS alias, min(doc_id) OVER (PARTITION BY md5(text)) AS canonical, count(*) OVER (PARTITION BY md5(text)) AS n FROM documents)
    SELECT doc_id, canonical, n AS aliases, doc_id <> canonical AND canonical IN (SELECT doc_id FROM labels WHERE quality = 1) AS suppressed FROM d WHERE n > 1""")
def identity_suppression(spark, sf_dir):
    """An alias row is dropped only if its canonical row is itself a known positive; the audit keeps every row. Counts per
    alias come from a partial aggregate, not from a window that would gather a hot alias."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("alias"))
    groups = docs.groupBy("alias").agg(F.min("doc_id").alias("canonical"), F.count("*").alias("aliases")).where("aliases > 1")
    positive = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("canonical"), F.lit(True).alias("positive")).distinct()
    marked = groups.join(positive, "canonical", "left")
    return docs.join(marked, "alias").select("doc_id", "canonical", "aliases", ((F.col("doc_id") != F.col("canonical")) & F.coalesce("positive", F.lit(False))).alias("suppressed"))


@query(f"WITH {SCORED} SELECT doc_id, tier, score FROM scored WHERE tier IN ('strong', 'possible')")
def min_tier_export(spark, sf_dir):
    return keep_rows(scored(spark, sf_dir).select("doc_id", "tier", "score"), lx.tier_rank("tier") >= 2).orderBy("doc_id")


@query(f"""WITH t AS (SELECT doc_id, text, instr(translate(text, {AZ}), 'license') AS p FROM documents)
    SELECT doc_id, CASE WHEN p > 0 THEN translate(substr(text, greatest(p - 100, 1), p + 7 + 140 - greatest(p - 100, 1)), chr(10) || chr(13) || chr(9), '   ') ELSE substr(text, 1, 240) END AS excerpt FROM t""")
def excerpt_window(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", excerpt("text", "license").alias("excerpt"))


@query("""SELECT doc_id, concat_ws(';', CASE WHEN regexp_matches(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+') THEN 'mail' END, CASE WHEN regexp_matches(text, '[0-9]{3}-[0-9]{4}') THEN 'phone' END,
    CASE WHEN regexp_matches(text, '(?i)licensed? under[^\\n]{0,100}(apache|mit)') THEN 'license' END) AS signals FROM documents""")
def regex_signals(spark, sf_dir):
    t = F.col("text")
    found = flags(mail=t.rlike("[A-Za-z0-9._]+@[A-Za-z0-9.]+"), phone=t.rlike("[0-9]{3}-[0-9]{4}"), license=t.rlike("(?i)licensed? under[^\\n]{0,100}(apache|mit)"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(found, ";").alias("signals"))


@query(f"""WITH n AS (SELECT page_id, regexp_replace(regexp_replace(translate(url, {AZ}), '#.*$', ''), '\\?.*$', '') AS u FROM pages)
    SELECT page_id, regexp_replace(regexp_replace(regexp_replace(u, '^https?://', ''), '^(www|m)\\.', ''), '(/|/index\\.html|\\.html)$', '') AS canonical FROM n""")
def url_normalize(spark, sf_dir):
    u = F.regexp_replace(F.regexp_replace(ascii_lower("url"), "#.*$", ""), r"\?.*$", "")
    u = F.regexp_replace(F.regexp_replace(F.regexp_replace(u, "^https?://", ""), r"^(www|m)\.", ""), r"(/|/index\.html|\.html)$", "")
    return table(spark, sf_dir, "pages").select("page_id", u.alias("canonical"))


@query(r"""WITH s AS (SELECT page_id, regexp_replace(html, '(?is)<(script|style|nav|footer|head)[^>]*>.*?</(script|style|nav|footer|head)>|<!--.*?-->', ' ', 'g') AS h FROM pages)
    SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(h, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '[ \t\n\r\f\x0B]+', ' ', 'g')) AS text FROM s""")
def html_to_text(spark, sf_dir):
    h = F.regexp_replace("html", "(?is)<(script|style|nav|footer|head)[^>]*>.*?</(script|style|nav|footer|head)>|<!--.*?-->", " ")
    h = F.regexp_replace(h, "<[^>]*>", " ")
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        h = F.replace(h, F.lit(a), F.lit(b))
    return table(spark, sf_dir, "pages").select("page_id", norm(h).alias("text"))


# seven patterns for five labels, as in lexicon.SINGLE_CELL_SIGNALS; the tables' words take the place of its vocabulary
SIGNALS = [
    lx.Signal("word_then_mail", r"[a-z]+tion[ ,.][^\n]{0,100}[a-z0-9._]+@[a-z0-9]+\.", 12),
    lx.Signal("mail_then_word", r"[a-z0-9._]+@[a-z0-9.]+ [^\n]{0,100}[a-z]+ing[ ,.]", 12),
    lx.Signal("licensed", "[Ll]icensed? under the [A-Z]|MIT License", 9),
    lx.Signal("ung_and_keit", "[a-z]+ung [^\n]{0,120}[a-z]+keit[ .,]", 12),
    lx.Signal("ung_and_keit", "[a-z]+keit [^\n]{0,120}[a-z]+ung[ .,]", 12),
    lx.Signal("the_far_from_and", " the (?:.|\n){0,300} and the ", 10),
    lx.Signal("the_far_from_and", " and the (?:.|\n){0,300} of the ", 10),
]
_TEXTS = {"title": "split_part(text, chr(10), 1)", "text": "text"}
_SIGNAL_LANES = [lx.Lane("title", "title", 4), lx.Lane("text", "text", 1)]
_SIGNAL_HITS = ", ".join(
    "CASE " + " ".join(f"WHEN regexp_matches({_TEXTS[lane.name]}, '{s.pattern}') THEN {{'lane': '{lane.name}', 'label': '{s.label}', 'term': regexp_extract({_TEXTS[lane.name]}, '{s.pattern}'), 'weight': {s.weight * lane.multiplier}}}" for s in SIGNALS if s.label == label) + " END"
    for lane in _SIGNAL_LANES
    for label in dict.fromkeys(s.label for s in SIGNALS)
)


@query(f"""WITH h AS (SELECT doc_id, list_filter([{_SIGNAL_HITS}], lambda x: x IS NOT NULL) AS hits FROM documents), s AS (SELECT doc_id, hits, coalesce(list_sum(list_transform(hits, lambda x: x.weight)), 0)::BIGINT AS score FROM h)
    SELECT doc_id, score, CASE WHEN score >= 36 THEN 'strong' WHEN score >= 14 THEN 'possible' WHEN score > 0 THEN 'weak' ELSE 'none' END AS tier,
           array_to_string(list_transform(hits, lambda x: x.lane || ':' || x.label || '=' || x.weight), ';') AS labels, md5(array_to_string(list_transform(hits, lambda x: x.term), '|')) AS terms_md5 FROM s""")
def scored_signals(spark, sf_dir):
    """Signals of all lanes with their weights, and the tier of their sum."""
    docs = table(spark, sf_dir, "documents").withColumn("title", F.substring_index("text", "\n", 1))
    found = lx.signal_score(docs, "doc_id", _SIGNAL_LANES, SIGNALS)
    labels = F.array_join(F.transform("hits", lambda h: F.concat(h["lane"], F.lit(":"), h["label"], F.lit("="), h["weight"].cast("string"))), ";")
    return found.select("doc_id", "score", "tier", labels.alias("labels"), F.md5(F.array_join(F.transform("hits", lambda h: h["term"]), "|")).alias("terms_md5"))
