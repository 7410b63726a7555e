"""Curation queries: passages, budgets, segments, votes, routes and partitions.

Stand-ins on the test tables: paragraphs of documents and turns of conversations are passages; labels and lexicon tiers
are votes; order lines are annotations of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import flags, join_first_seen, ladder, norm
from ..operators import evidence as ev
from ..registry import query
from ..sources.tables import table
from .discovery import SCORED, scored

# Anchor terms of the test tables.
ANCHORS = {"license": ["license", "licensed", "released"], "common": ["the ", "and ", "und ", "les ", "que "], "ending": ["tion", "ing", "ment"]}

_NORM = r"trim(regexp_replace(x, '[ \t\n\r\f\x0B]+', ' ', 'g'))"
_TERMS = " + ".join(
    "least({n}, 5) + CASE WHEN {n} > 0 THEN 2 ELSE 0 END".format(n="(" + " + ".join(f"contains(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{w}')::INT" for w in terms) + ")")
    for terms in ANCHORS.values()
)
PASSAGES = rf"""cut AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
    par AS (SELECT doc_id, pos, {_NORM} AS text FROM cut WHERE {_NORM} <> ''), scoredp AS (SELECT doc_id, pos, text, {_TERMS} AS score FROM par)"""


def _passages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", ev.paragraphs("text").alias("items"))
    return docs.select("doc_id", ev.passage_scores(F.col("items"), ANCHORS).alias("items"))


@query(f"WITH {PASSAGES}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS rank FROM scoredp) SELECT doc_id, rank, pos::BIGINT AS pos, score::BIGINT AS score, md5(text) AS text_md5 FROM r WHERE rank <= 3")
def passage_top_k(spark, sf_dir):
    top = _passages(spark, sf_dir).select("doc_id", F.posexplode(F.slice(ev.ranked(F.col("items")), 1, 3)).alias("rank", "p"))
    return top.select("doc_id", (F.col("rank") + 1).cast("long").alias("rank"), F.col("p.pos").cast("long").alias("pos"), F.col("p.score").cast("long").alias("score"), F.md5("p.text").alias("text_md5"))


@query()
def evidence_budget_pack(spark, sf_dir):
    """At most 6 distinct passages within 900 characters, best first; one that does not fit is skipped. The fold depends
    on order, so its rows are checked against plain Python in the tests."""
    items = _passages(spark, sf_dir).select("doc_id", ev.ranked(F.col("items")).alias("items"))
    picked = ev.distinct_by_text(items, "items").select("doc_id", ev.budget_pack(F.col("items"), 6, 900).alias("out"))
    return picked.select("doc_id", F.size("out").cast("long").alias("n_passages"), F.aggregate("out", F.lit(0).cast("long"), lambda a, p: a + F.length(p["text"])).alias("chars"), F.array_join(F.transform("out", lambda p: p["pos"].cast("string")), ",").alias("positions"))


@query("""WITH s AS (SELECT doc_id, string_split(text, 'tion') AS p FROM documents), e AS (SELECT doc_id, p, unnest(range(1, len(p))) AS no FROM s WHERE len(p) > 1)
    SELECT doc_id, no AS mention_no, right(p[no], 80) || 'tion' || left(p[no + 1], 80) AS segment FROM e""")
def neighbor_segments(spark, sf_dir):
    return ev.segments(table(spark, sf_dir, "documents"), "doc_id", "text", "tion", 80)


@query(r"""WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(replace(text, chr(10), ' '), '. '), lambda x: trim(regexp_replace(x, '[ \t\n\r\f\x0B]+', ' ', 'g'))), lambda x: x <> '') AS p FROM documents),
    e AS (SELECT doc_id, p, unnest(range(1, len(p))) AS no FROM s) SELECT doc_id, no AS pair_no, md5(p[no] || ' ' || p[no + 1]) AS pair_md5 FROM e""")
def sentence_pairs(spark, sf_dir):
    parts = F.filter(F.transform(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), r"\. "), norm), lambda x: x != "")
    docs = table(spark, sf_dir, "documents").select("doc_id", parts.alias("p")).where(F.size("p") > 1)
    pairs = F.zip_with(F.slice("p", 1, F.size("p") - 1), F.slice("p", 2, F.size("p") - 1), lambda a, b: F.md5(F.concat(a, F.lit(" "), b)))
    return docs.select("doc_id", F.posexplode(pairs).alias("i", "pair_md5")).select("doc_id", (F.col("i") + 1).cast("long").alias("pair_no"), "pair_md5")


_VOTES = f"""{SCORED}, v AS (SELECT s.doc_id, CASE WHEN quality = 1 THEN 'support' WHEN quality = 0 THEN 'contradict' ELSE 'uncertain' END AS a,
    CASE WHEN toxic = 1 THEN 'contradict' WHEN toxic = 0 THEN 'support' ELSE 'uncertain' END AS b,
    CASE WHEN tier IN ('strong', 'possible') THEN 'support' WHEN tier = 'none' THEN 'contradict' ELSE 'uncertain' END AS c, negative_labels <> '' AS risk FROM scored s LEFT JOIN labels l ON s.doc_id = l.doc_id),
    n AS (SELECT *, (a = 'contradict')::INT + (b = 'contradict')::INT + (c = 'contradict')::INT AS neg, (a = 'support')::INT + (b = 'support')::INT + (c = 'support')::INT AS pos FROM v),
    d AS (SELECT doc_id, CASE WHEN neg >= 2 OR (risk AND neg >= 1) THEN 'fail' WHEN pos >= 2 AND neg = 0 THEN 'pass' WHEN neg >= 1 THEN 'warn' ELSE 'uncertain' END AS decision FROM n)"""


@query(f"WITH {_VOTES} SELECT doc_id, decision FROM d")
def vote_consensus(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    rows = scored(spark, sf_dir).join(labels, "doc_id", "left")
    votes = F.array(
        ladder((F.col("quality") == 1, "support"), (F.col("quality") == 0, "contradict"), otherwise="uncertain"),
        ladder((F.col("toxic") == 1, "contradict"), (F.col("toxic") == 0, "support"), otherwise="uncertain"),
        ladder((F.col("tier").isin("strong", "possible"), "support"), (F.col("tier") == "none", "contradict"), otherwise="uncertain"),
    )
    return rows.select("doc_id", ev.consensus(votes, F.size("negative_labels") > 0).alias("decision"))


@query(f"""WITH {_VOTES} SELECT source, CASE min(CASE decision WHEN 'fail' THEN 0 WHEN 'warn' THEN 1 WHEN 'pass' THEN 2 ELSE 3 END) WHEN 0 THEN 'fail' WHEN 1 THEN 'warn' WHEN 2 THEN 'pass' ELSE 'not_reviewed' END AS overall,
    count(*) FILTER (decision = 'pass') AS n_pass, count(*) FILTER (decision = 'fail') AS n_fail FROM d JOIN documents USING (doc_id) GROUP BY source""")
def overall_decision(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    rows = vote_consensus(spark, sf_dir).join(docs, "doc_id")
    return rows.groupBy("source").agg(ev.overall(F.col("decision")).alias("overall"), F.count_if(F.col("decision") == "pass").alias("n_pass"), F.count_if(F.col("decision") == "fail").alias("n_fail"))


@query(f"""WITH {_VOTES} SELECT s.doc_id, CASE WHEN decision = 'pass' AND tier = 'strong' THEN 'include' WHEN decision = 'pass' THEN 'include_review_low' WHEN decision = 'fail' AND tier IN ('strong', 'possible') THEN 'review_high'
    WHEN decision = 'fail' THEN 'exclude' WHEN tier IN ('strong', 'possible') THEN 'review_medium' ELSE 'review_low' END AS route FROM d JOIN scored s USING (doc_id)""")
def route_ladder(spark, sf_dir):
    rows = vote_consensus(spark, sf_dir).join(scored(spark, sf_dir).select("doc_id", "tier"), "doc_id")
    good, d = F.col("tier").isin("strong", "possible"), F.col("decision")
    route = ladder(((d == "pass") & (F.col("tier") == "strong"), "include"), (d == "pass", "include_review_low"), ((d == "fail") & good, "review_high"), (d == "fail", "exclude"), (good, "review_medium"), otherwise="review_low")
    return rows.select("doc_id", route.alias("route"))


@query(f"""WITH {SCORED} SELECT s.doc_id, concat_ws(';', CASE WHEN l.doc_id IS NULL THEN 'unlabelled' END, CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN negative_labels <> '' THEN 'noise' END,
    CASE WHEN quality = 0 AND tier IN ('strong', 'possible') THEN 'overcall' END, CASE WHEN n_lanes <= 1 THEN 'single_lane' END) AS flags FROM scored s LEFT JOIN labels l ON s.doc_id = l.doc_id""")
def review_flags(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumn("has_label", F.lit(True))
    rows = scored(spark, sf_dir).join(labels, "doc_id", "left")
    found = flags(
        unlabelled=F.col("has_label").isNull(), toxic=F.col("toxic") == 1, noise=F.size("negative_labels") > 0,
        overcall=(F.col("quality") == 0) & F.col("tier").isin("strong", "possible"), single_lane=F.size("lanes_hit") <= 1,
    )
    return rows.select("doc_id", F.array_join(found, ";").alias("flags"))


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'repository_only' ELSE 'publication_backed' END AS part FROM documents d LEFT JOIN labels l USING (doc_id)")
def content_partition(spark, sf_dir):
    """Lossless: every document is in exactly one part."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.lit("publication_backed").alias("part"))
    return table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left").select("doc_id", F.coalesce("part", F.lit("repository_only")).alias("part"))


@query(f"WITH {_VOTES} SELECT s.doc_id, s.tier, d.decision, length(t.text)::BIGINT AS n FROM scored s JOIN d USING (doc_id) JOIN documents t ON t.doc_id = s.doc_id")
def guarded_three_way_join(spark, sf_dir):
    """Three tables on one key; a key that one of them lacks fails the query instead of losing the row."""
    a = scored(spark, sf_dir).select("doc_id", "tier", F.lit(1).alias("in_a"))
    b = vote_consensus(spark, sf_dir).withColumn("in_b", F.lit(1))
    c = table(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("long").alias("n"), F.lit(1).alias("in_c"))
    whole = a.join(b, "doc_id", "full").join(c, "doc_id", "full")
    whole = whole.where(F.when(F.col("in_a").isNull() | F.col("in_b").isNull() | F.col("in_c").isNull(), F.raise_error(F.lit("the tables have different keys"))).otherwise(F.lit(True)).cast("boolean"))
    return whole.select("doc_id", "tier", "decision", "n")


@query("""SELECT o_custkey, count(*) AS n, string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority) AS priorities, string_agg(DISTINCT o_orderstatus, '; ' ORDER BY o_orderstatus) AS statuses,
    round(sum(o_totalprice), 2) AS total, min(o_orderkey) AS first_order FROM orders GROUP BY o_custkey""")
def dataset_summary_concat(spark, sf_dir):
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), "; ")
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n"), joined("o_orderpriority").alias("priorities"), joined("o_orderstatus").alias("statuses"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.min("o_orderkey").alias("first_order")
    )


@query("""WITH f AS (SELECT o_custkey, o_orderpriority AS v, min(o_orderkey) AS ord FROM orders GROUP BY ALL) SELECT o_custkey, string_agg(v, '; ' ORDER BY ord) AS priorities FROM f GROUP BY o_custkey""")
def first_seen_distinct(spark, sf_dir):
    """Pre-aggregated to one row a value, so a group holds no more than its distinct values."""
    firsts = table(spark, sf_dir, "orders").groupBy("o_custkey", F.col("o_orderpriority").alias("v")).agg(F.min("o_orderkey").alias("ord"))
    return firsts.groupBy("o_custkey").agg(F.collect_list(F.struct("ord", "v")).alias("vs")).select("o_custkey", join_first_seen("vs").alias("priorities"))


@query("SELECT source, string_agg(DISTINCT lang, ';' ORDER BY lang) AS langs, count(DISTINCT lang) AS n_langs FROM documents GROUP BY source")
def sorted_distinct(spark, sf_dir):
    got = table(spark, sf_dir, "documents").groupBy("source").agg(F.array_sort(F.collect_set("lang")).alias("l"))
    return got.select("source", F.array_join("l", ";").alias("langs"), F.size("l").cast("long").alias("n_langs"))


@query("""WITH s AS (SELECT o_custkey, bool_or(o_orderstatus = 'F') AS f, bool_or(o_orderstatus = 'O') AS o, bool_or(o_orderstatus = 'P') AS p FROM orders GROUP BY o_custkey)
    SELECT o_custkey, CASE WHEN f AND NOT o AND NOT p THEN 'complete' WHEN f THEN 'partial' WHEN p THEN 'in_progress' ELSE 'open' END AS status FROM s""")
def status_lattice(spark, sf_dir):
    has = lambda v: F.bool_or(F.col("o_orderstatus") == v)
    s = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(has("F").alias("f"), has("O").alias("o"), has("P").alias("p"))
    status = ladder((F.col("f") & ~F.col("o") & ~F.col("p"), "complete"), (F.col("f"), "partial"), (F.col("p"), "in_progress"), otherwise="open")
    return s.select("o_custkey", status.alias("status"))


@query("SELECT l_orderkey, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN max(l_returnflag) END AS flag, CASE WHEN count(DISTINCT l_linestatus) = 1 THEN max(l_linestatus) END AS status FROM lineitem GROUP BY l_orderkey")
def unique_or_null(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(ev.unique_or_null(F.col("l_returnflag")).alias("flag"), ev.unique_or_null(F.col("l_linestatus")).alias("status"))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY length(text) DESC, turn) AS in_lane FROM conversations),
    f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY (in_lane > 1)::INT, length(text) DESC, turn) AS rank FROM r) SELECT conv_id, turn, role, rank FROM f WHERE rank <= 4""")
def lane_top1_fill(spark, sf_dir):
    """The best turn of each role first, then the best of the rest, 4 in all: one sort of each conversation's turns."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct((-F.length("text")).alias("size"), "turn", "role"))).alias("ts"))
    roles = F.transform("ts", lambda t: t["role"])
    lanes = F.transform("ts", lambda t, i: F.struct((F.array_position(roles, t["role"]) != i + 1).alias("later"), t["size"].alias("size"), t["turn"].alias("turn"), t["role"].alias("role")))
    top = turns.select("conv_id", F.posexplode(F.slice(F.sort_array(lanes), 1, 4)).alias("i", "t"))
    return top.select("conv_id", F.col("t.turn").alias("turn"), F.col("t.role").alias("role"), (F.col("i") + 1).cast("long").alias("rank"))


@query()
def chunk_overlap_pack(spark, sf_dir):
    """Paragraphs in chunks of at most 600 characters, the last one repeated at the front of the next."""
    docs = table(spark, sf_dir, "documents").select("doc_id", ev.chunks(ev.paragraphs("text"), 600).alias("c"))
    return docs.select("doc_id", F.posexplode("c").alias("i", "chunk")).select("doc_id", F.col("i").cast("long").alias("chunk_no"), F.length("chunk").cast("long").alias("chars"), F.md5("chunk").alias("chunk_md5"))
