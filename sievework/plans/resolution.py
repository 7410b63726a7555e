"""Resolution queries: claims, support, conflicts, matching, identity and lineage.

Stand-ins on the test tables: an event is a claim of its user (subject) that its type (predicate) has the object
value modulo 3; the day is the lineage and the week the family; order lines and orders are records to match."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import ladder, stable_id
from ..operators import claims as cl
from ..registry import query
from ..sources.tables import table

_CLAIMS = """c AS (SELECT event_id, user_id AS subject, event_type AS predicate, (event_id % 3)::BIGINT AS object, least(1.0, greatest(0.0, abs(value) / 100.0)) AS v,
    strftime(ts, '%Y-%m-%d') AS lineage, (extract(day FROM ts)::BIGINT - 1) // 7 AS family FROM events)"""
_SUPPORT = f"""{_CLAIMS}, b AS (SELECT subject, predicate, object, family, lineage, max(v) AS v, count(*) AS n FROM c GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY subject, predicate, object, family ORDER BY v DESC, lineage) AS k FROM b),
    f AS (SELECT subject, predicate, object, family, least(sum(CASE WHEN k <= 3 THEN v ELSE 0 END), 1.5) AS s, max(v) AS best, sum(n) AS n FROM r GROUP BY ALL),
    sup AS (SELECT subject, predicate, object, round(sum(s), 6) AS support, count(*) AS families, max(best) AS best, sum(n)::BIGINT AS claims FROM f GROUP BY ALL)"""
_RISK = "CASE WHEN predicate IN ('purchase', 'signup') THEN 'high' WHEN predicate = 'click' THEN 'medium' ELSE 'low' END"
_STATUS = f"""{_SUPPORT}, st AS (SELECT *, CASE WHEN {_RISK} = 'high' AND families >= 2 AND support >= 1.2 AND best >= 0.7 THEN 'accepted' WHEN {_RISK} = 'medium' AND support >= 0.9 AND best >= 0.5 THEN 'accepted'
    WHEN {_RISK} = 'low' AND support >= 0.5 THEN 'accepted' WHEN support >= 0.4 THEN 'review' ELSE 'rejected' END AS status FROM sup)"""


def claims_of(spark, sf_dir):
    v = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.abs("value") / 100.0))
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("subject"), F.col("event_type").alias("predicate"), (F.col("event_id") % 3).alias("object"), v.alias("v"),
        F.date_format("ts", "yyyy-MM-dd").alias("lineage"), F.floor((F.dayofmonth("ts") - 1) / 7).alias("family"),
    )


def _support(spark, sf_dir):
    return cl.support(claims_of(spark, sf_dir), ["subject", "predicate", "object"], "lineage", "family", "v")


def _status(spark, sf_dir):
    p = F.col("predicate")
    risk = ladder((p.isin("purchase", "signup"), "high"), (p == "click", "medium"), otherwise="low")
    return _support(spark, sf_dir).withColumn("status", cl.acceptance(risk, F.col("best"), F.col("support"), F.col("families")))


@query(f"WITH {_CLAIMS} SELECT subject, predicate, object, count(*) AS claims, count(DISTINCT lineage) AS lineages, min(event_id) AS first_claim FROM c GROUP BY ALL")
def claim_signature_groups(spark, sf_dir):
    return claims_of(spark, sf_dir).groupBy("subject", "predicate", "object").agg(F.count("*").alias("claims"), F.countDistinct("lineage").alias("lineages"), F.min("event_id").alias("first_claim"))


@query(f"WITH {_SUPPORT} SELECT * FROM sup")
def lineage_support_score(spark, sf_dir):
    return _support(spark, sf_dir)


@query(f"WITH {_STATUS} SELECT subject, predicate, object, status FROM st")
def acceptance_gate(spark, sf_dir):
    return _status(spark, sf_dir).select("subject", "predicate", "object", "status")


@query(f"""WITH {_STATUS}, n AS (SELECT subject, predicate, count(*) AS n, count(*) FILTER (status = 'accepted') AS k FROM st GROUP BY ALL)
    SELECT subject, predicate, object, CASE WHEN n = 1 THEN status WHEN k = 1 AND status = 'accepted' THEN 'accepted' WHEN k = 1 THEN 'rejected' ELSE 'conflicted' END AS status FROM st JOIN n USING (subject, predicate)""")
def functional_conflicts(spark, sf_dir):
    return cl.functional_conflicts(_status(spark, sf_dir), ["subject", "predicate"]).select("subject", "predicate", "object", "status")


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT l_returnflag) > 1 AS conflicting, string_agg(DISTINCT l_returnflag, ';' ORDER BY l_returnflag) AS roles FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def exclusive_role_conflicts(spark, sf_dir):
    got = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("l_returnflag")).alias("r"))
    return got.where("n > 1").select("l_orderkey", "l_linenumber", "n", (F.size("r") > 1).alias("conflicting"), F.array_join("r", ";").alias("roles"))


@query("""WITH p AS (SELECT o_orderkey, l_partkey, l_suppkey, l_linenumber, 1 + 2 * (l_returnflag = 'R')::INT + 2 * (l_linestatus = o_orderstatus)::INT AS score FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_discount < 0.08),
    t AS (SELECT *, max(score) OVER (PARTITION BY o_orderkey) AS top FROM p) SELECT o_orderkey, l_partkey, l_suppkey, l_linenumber, score::BIGINT AS score FROM t WHERE score = top""")
def best_score_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_orderkey", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_discount")
    score = (1 + 2 * (F.col("l_returnflag") == "R").cast("int") + 2 * (F.col("l_linestatus") == F.col("o_orderstatus")).cast("int")).cast("long")
    return cl.best_matches(orders, lines, ["k"], "o_orderkey", score, F.col("l_discount") >= 0.08).select("o_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "score")


@query("""WITH s AS (SELECT l_orderkey, l_suppkey, sum(l_quantity)::BIGINT AS score FROM lineitem GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, l_suppkey) AS k,
    lead(score) OVER (PARTITION BY l_orderkey ORDER BY score DESC, l_suppkey) AS second FROM s)
    SELECT l_orderkey, l_suppkey, score, CASE WHEN score >= 30 AND score - coalesce(second, 0) >= 10 THEN 'member' WHEN score >= 20 THEN 'candidate' ELSE 'unassigned' END AS assignment FROM r WHERE k = 1""")
def best_with_margin(spark, sf_dir):
    """The two best from one aggregate: sorted pairs of an order are few."""
    sums = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.sum("l_quantity").cast("long").alias("score"))
    top = sums.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("neg"), "l_suppkey"))).alias("s"))
    best, second = F.get("s", F.lit(0)), F.get("s", F.lit(1))
    margin = -best["neg"] - F.coalesce(-second["neg"], F.lit(0).cast("long"))
    kind = ladder(((-best["neg"] >= 30) & (margin >= 10), "member"), (-best["neg"] >= 20, "candidate"), otherwise="unassigned")
    return top.select("l_orderkey", best["l_suppkey"].alias("l_suppkey"), (-best["neg"]).alias("score"), kind.alias("assignment"))


_PAIRS = """m AS (SELECT DISTINCT l_suppkey AS o, l_partkey AS i FROM lineitem), n AS (SELECT o, count(*) AS n FROM m GROUP BY o),
    p AS (SELECT x.o AS a, y.o AS b, count(*) AS shared FROM m x JOIN m y ON x.i = y.i AND x.o < y.o GROUP BY ALL HAVING count(*) >= {least}),
    q AS (SELECT a, b, shared, na.n AS n_a, nb.n AS n_b FROM p JOIN n na ON na.o = a JOIN n nb ON nb.o = b)"""


def _members(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


@query(f"WITH {_PAIRS.format(least=1)} SELECT a, b, shared, round(shared / (n_a + n_b - shared), 6) AS jaccard, CASE WHEN shared / (n_a + n_b - shared) >= 0.2 THEN 'duplicate' WHEN shared / least(n_a, n_b) >= 0.3 THEN 'same_study' ELSE 'related' END AS relation FROM q")
def pair_overlap_relations(spark, sf_dir):
    r = cl.set_relations(_members(spark, sf_dir), "l_suppkey", "l_partkey", 1)
    j = F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))
    kind = ladder((j >= 0.2, "duplicate"), (F.col("shared") / F.least("n_a", "n_b") >= 0.3, "same_study"), otherwise="related")
    return r.select("a", "b", "shared", F.round(j, 6).alias("jaccard"), kind.alias("relation"))


@query(f"WITH {_PAIRS.format(least=2)} SELECT a, b, shared, round(shared / least(n_a, n_b), 6) AS containment, CASE WHEN n_a <= n_b THEN a ELSE b END AS contained FROM q WHERE shared / least(n_a, n_b) >= 0.25")
def containment_relations(spark, sf_dir):
    r = cl.set_relations(_members(spark, sf_dir), "l_suppkey", "l_partkey", 2, 25)
    share = F.col("shared") / F.least("n_a", "n_b")
    return r.where(share >= 0.25).select("a", "b", "shared", F.round(share, 6).alias("containment"), F.when(F.col("n_a") <= F.col("n_b"), F.col("a")).otherwise(F.col("b")).alias("contained"))


@query("""WITH RECURSIVE up AS (SELECT event_id AS node, event_id // 2 AS root, 1 AS depth FROM events WHERE event_id >= 2 UNION ALL SELECT node, root // 2, depth + 1 FROM up WHERE root >= 2)
    SELECT node, root, max(depth)::BIGINT AS depth, false AS cyclic FROM up WHERE root = 1 GROUP BY node, root""")
def lineage_ancestry(spark, sf_dir):
    """Parent of an event: half its number. Pointer jumping instead of one join a generation."""
    parents = table(spark, sf_dir, "events").where("event_id >= 2").select(F.col("event_id").alias("child"), F.floor(F.col("event_id") / 2).alias("parent"))
    return cl.lineage_roots(parents)


@query("SELECT event_id, 'claim:' || substr(sha256(lower(user_id::VARCHAR) || chr(31) || lower(event_type) || chr(31) || strftime(ts, '%Y-%m-%d')), 1, 24) AS claim_id FROM events")
def content_addressed_ids(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", stable_id("claim", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd")).alias("claim_id"))


@query(f"WITH {_STATUS} SELECT subject, count(*) AS groups, sum(claims)::BIGINT AS claims, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'review') AS review, count(*) FILTER (status = 'rejected') AS rejected FROM st GROUP BY subject")
def accession_view(spark, sf_dir):
    of = lambda s: F.count_if(F.col("status") == s).alias(s)
    return _status(spark, sf_dir).groupBy("subject").agg(F.count("*").alias("groups"), F.sum("claims").alias("claims"), of("accepted"), of("review"), of("rejected"))


@query(f"WITH {_STATUS} SELECT subject, predicate, object, support FROM st WHERE status = 'review'")
def review_queue(spark, sf_dir):
    return _status(spark, sf_dir).where("status = 'review'").select("subject", "predicate", "object", "support").orderBy("subject", "predicate", "object")
