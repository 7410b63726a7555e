"""Contexts and branches of studies, and relations of technologies.

Stand-ins on the test tables: a customer is a study, an order a context of it, and each supplier that a customer buys from a branch;
a line states four facts of both. Quantities and tables pick a fact's status, a supplier's balance its branch's state and its
nation the cluster. The SQL pairs every context with every branch and counts afterwards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alignment as al
from ..operators import pairing
from ..operators import technology as tech
from ..operators.spans import parts_of
from ..registry import query
from ..sources.tables import table

# expressions that both engines read
_QUANTITY = "cast(l_quantity AS int)"
_CENTS = "cast(round(l_discount * 100) AS int)"
FACTS = [
    (al.MODALITY, "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Label-Free' WHEN '2' THEN 'label free  single cell' WHEN '3' THEN 'Reporter multiplexed single-cell' WHEN '4' THEN 'targeted_reporter' ELSE 'modality unresolved' END"),
    (al.CHEMISTRY, f"CASE {_QUANTITY} % 9 WHEN 0 THEN 'TMT' WHEN 1 THEN 'TMTpro' WHEN 2 THEN 'TMTpro 18-plex' WHEN 3 THEN 'tmtpro16' WHEN 4 THEN 'TMT 10plex' WHEN 5 THEN 'SCoPE-MS' WHEN 6 THEN 'In-House  Tag' ELSE '' END"),
    (al.ACQUISITION, "CASE o_orderstatus WHEN 'F' THEN ' DIA ' WHEN 'O' THEN 'dda' ELSE 'Wide Window' END"),
]
ROLE = "CASE cast(round(l_tax * 100) AS int) % 4 WHEN 0 THEN 'HAS_ANALYTICAL_CHANNEL' WHEN 1 THEN 'HAS_CARRIER_CHANNEL' WHEN 2 THEN 'HAS_BLANK_CHANNEL' ELSE 'HAS_REFERENCE_CHANNEL' END"
CHANNEL = f"concat('TMT ', 126 + {_CENTS}, CASE WHEN l_linenumber % 2 = 0 THEN 'n' ELSE '' END)"
STATUS = f"CASE WHEN {_QUANTITY} = 50 THEN 'conflicted' WHEN {_QUANTITY} = 49 THEN 'unresolved' WHEN {_QUANTITY} < 10 THEN 'hypothesis_only' ELSE 'accepted_resolved' END"
METHOD = "CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN 'hygiene' ELSE '' END"
CONFLICT = "CASE WHEN l_returnflag = 'N' THEN concat('k', l_linenumber) ELSE '' END"
STATE = "CASE WHEN s_acctbal < 0 THEN 'contradictory_hypothesis' WHEN s_acctbal < 1500 THEN 'unresolved_hypothesis' ELSE 'canonical_branch_candidate' END"


def lines(spark, sf_dir):
    """What each line states of its context and its branch, with the branch's state and cluster; the predicates of what is
    stated; the studies with very many contexts; the number of groups of studies, one for about a megabyte of lines."""
    stating = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    of = stating.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    values = [F.expr(x).alias(f"value{i}") for i, (_, x) in enumerate(FACTS)] + [F.expr(CHANNEL).alias("channel"), F.expr(ROLE).alias("role")]
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("node"), F.expr(STATE).alias("state"), F.format_string("n%03d", "s_nationkey").alias("cluster"))
    of = of.join(pairing.sides_of(suppliers), F.col("l_suppkey") == F.col("node"), "left")
    named = [F.col("o_custkey").alias("scope"), F.col("o_orderkey").alias("context"), F.col("l_suppkey").alias("branch")]
    told = of.select(*named, F.expr(STATUS).alias("status"), F.expr(METHOD).alias("method"), F.expr(CONFLICT).alias("conflict"), *values, "sides")
    large = pairing.large_of(orders.select(F.col("o_custkey").alias("scope")))
    return told, {f"value{i}": p for i, (p, _) in enumerate(FACTS)} | {"channel": "role"}, large, 4 * parts_of(stating)


_SIMPLE = "regexp_replace(lower(v), '[^a-z0-9]', '', 'g')"
_KEYS = f"""CASE p WHEN 'HAS_MODALITY' THEN CASE WHEN contains(lower(v), 'label') THEN 'label_free' WHEN contains(lower(v), 'reporter') THEN 'reporter' ELSE 'unresolved' END
    WHEN 'USES_CHEMISTRY' THEN CASE WHEN {_SIMPLE} = 'scopems' THEN 'scope-ms' WHEN {_SIMPLE} LIKE 'tmt%' THEN replace({_SIMPLE}, 'plex', '') ELSE replace(lower(v), '  ', ' ') END
    WHEN 'HAS_ACQUISITION' THEN lower(trim(v)) ELSE p || ':' || upper(replace(v, 'TMT ', '')) END"""
_NODES = """SELECT scope, {node} AS node, {sets}, bool_or((status IN ('conflicted', 'unresolved') AND method <> '') OR (status = 'conflicted' AND conflict <> '')) AS dirty FROM f GROUP BY ALL"""
_KINDS = {"modalities": "p = 'HAS_MODALITY'", "chemistries": "p = 'USES_CHEMISTRY'", "acquisitions": "p = 'HAS_ACQUISITION'", "channels": "p LIKE '%CHANNEL'"}
_LISTS = ", ".join(f"coalesce(list_sort(list(DISTINCT k) FILTER (status IN ('hypothesis_only', 'accepted_resolved') AND v <> '' AND {t})), []) AS {s}" for s, t in _KINDS.items())
_NAMED = " || '|' || ".join(f"array_to_string({s}, ',')" for s in _KINDS)
_STATED = " UNION ALL ".join(f"SELECT scope, ctx, br, status, method, conflict, {p} AS p, {x} AS v FROM l" for p, x in [*((f"'{p}'", x) for p, x in FACTS), (ROLE, CHANNEL)])
_BELOW = "(x = y OR (x = 'tmt' AND y LIKE 'tmt%') OR (y = 'tmt' AND x LIKE 'tmt%') OR (x = 'tmtpro' AND y LIKE 'tmtpro%') OR (y = 'tmtpro' AND x LIKE 'tmtpro%'))"
_MET = "list_filter({a}.chemistries, lambda x: len(list_filter({b}.chemistries, lambda y: " + _BELOW + ")) > 0)"
_KNOWN = "list_filter({s}.modalities, lambda x: x <> 'unresolved')"
_TMT = "len(list_filter({s}.chemistries, lambda x: x LIKE 'tmt%')) > 0"
_OF = "list_distinct(list_transform({x}, lambda r: string_split(r, ':')[2]))"
_ALIGNED = f"""l AS (SELECT *, o_custkey AS scope, o_orderkey AS ctx, l_suppkey AS br, {STATUS} AS status, {METHOD} AS method, {CONFLICT} AS conflict FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    f AS (SELECT *, {_KEYS} AS k FROM ({_STATED})),
    c AS (SELECT *, {_NAMED} AS profile FROM ({_NODES.format(node="ctx", sets=_LISTS)}) WHERE len(modalities || chemistries || acquisitions || channels) > 0),
    b AS (SELECT n.*, {_NAMED} AS profile, {STATE} AS state, 'n' || lpad(s_nationkey::VARCHAR, 3, '0') AS cluster FROM ({_NODES.format(node="br", sets=_LISTS)}) n JOIN supplier ON s_suppkey = node),
    m AS (SELECT c.scope, c.node AS ctx, b.node AS br, c.profile AS c_profile, c.dirty AS c_dirty, b.profile AS b_profile, b.dirty AS b_dirty, b.state AS b_state, b.cluster,
        list_sort(list_intersect({_KNOWN.format(s="c")}, {_KNOWN.format(s="b")})) AS mo, list_sort(list_distinct({_MET.format(a="c", b="b")} || {_MET.format(a="b", b="c")})) AS ch, list_sort(list_intersect(c.acquisitions, b.acquisitions)) AS ac,
        list_sort(list_intersect(c.channels, b.channels)) AS ro, len({_KNOWN.format(s="c")}) > 0 AND len({_KNOWN.format(s="b")}) > 0 AS two_mo, {_TMT.format(s="c")} AND {_TMT.format(s="b")} AS two_ch,
        len(c.acquisitions) > 0 AND len(b.acquisitions) > 0 AS two_ac, list_intersect({_OF.format(x="c.channels")}, {_OF.format(x="b.channels")}) AS chans FROM c JOIN b USING (scope)),
    q AS (SELECT *, list_sort(list_filter(chans, lambda x: NOT list_contains({_OF.format(x="ro")}, x))) AS taken, len(mo) = 0 AND two_mo AS no_mo, len(ch) = 0 AND two_ch AS no_ch, len(ac) = 0 AND two_ac AS no_ac FROM m),
    s AS (SELECT *, 35 * (len(mo) > 0)::INT + 35 * (len(ch) > 0)::INT + 15 * (len(ac) > 0)::INT + least(15, 5 * len(ro)) AS score, 100 * no_mo::INT + 60 * no_ch::INT + 15 * no_ac::INT + least(60, 30 * len(taken)) AS against FROM q),
    e AS (SELECT *, score >= 55 AND against < 50 AND NOT c_dirty AND NOT b_dirty AND b_state = 'canonical_branch_candidate' AS eligible FROM s),
    w AS (SELECT scope, ctx, count(DISTINCT cluster) AS n_clusters, min(cluster) AS the_cluster FROM e WHERE eligible GROUP BY ALL),
    t AS (SELECT e.*, CASE WHEN eligible AND n_clusters = 1 THEN the_cluster END AS chosen, CASE WHEN b_dirty OR b_state = 'contradictory_hypothesis' THEN 'branch_contradictory' WHEN against >= 50 THEN 'contradictory' WHEN c_dirty AND score >= 30 THEN 'context_conflicted_candidate'
        WHEN b_state = 'unresolved_hypothesis' AND score >= 30 THEN 'branch_unresolved_candidate' WHEN eligible AND n_clusters = 1 THEN 'unique_compatible_candidate' WHEN eligible THEN 'ambiguous_compatible_candidate'
        WHEN score >= 30 THEN 'weak_candidate' ELSE 'insufficient_evidence' END AS status FROM e LEFT JOIN w USING (scope, ctx))"""
_SAID = "array_to_string(list_filter([{}], lambda x: x IS NOT NULL) || {}, ';')"
_MATCHED = _SAID.format(", ".join(f"CASE WHEN len({a}) > 0 THEN '{n}:' || array_to_string({a}, ',') END" for n, a in (("modality", "mo"), ("chemistry", "ch"), ("acquisition", "ac"))), "ro")
_CLASHED = _SAID.format("CASE WHEN no_mo THEN 'label_free_vs_reporter_modality' END, CASE WHEN no_ch THEN 'incompatible_reporter_chemistry' END, CASE WHEN no_ac THEN 'different_acquisition' END", "list_transform(taken, lambda x: 'reporter_role:' || x)")


@query(f"""WITH {_ALIGNED} SELECT scope, c_profile, c_dirty, b_profile, b_dirty, b_state, count(*) AS n_pairs, round(score / 100, 2) AS score, round(against / 100, 2) AS conflict_score, {_MATCHED} AS matched, {_CLASHED} AS conflicts, status, max(chosen) AS cluster
    FROM t GROUP BY ALL""")
def context_branch_alignment(spark, sf_dir):
    """Every pair of a context's and a branch's profile of a study, with score, contradictions and status."""
    counted = pairing.alignments(*lines(spark, sf_dir)).withColumn("n_pairs", F.col("c_n") * F.col("b_n")).drop("c_n", "b_n")
    return counted.select("scope", "c_profile", "c_dirty", "b_profile", "b_dirty", "b_state", "n_pairs", "score", "conflict_score", "matched", "conflicts", "status", "cluster")


_RANK = "list_position([" + ", ".join(f"'{s}'" for s in al.STATUSES) + "], status)"


@query(f"""WITH {_ALIGNED}, r AS (SELECT scope, ctx, arg_min(status, {_RANK} * 1000 - score) AS status, round(max(score) FILTER (k = best) / 100, 2) AS score, max(chosen) AS cluster, count(*) FILTER (status IN ('unique_compatible_candidate', 'ambiguous_compatible_candidate')) AS n_compatible,
        count(*) FILTER (status IN ('weak_candidate', 'context_conflicted_candidate', 'branch_unresolved_candidate')) AS n_weak, count(*) FILTER (status IN ('contradictory', 'branch_contradictory')) AS n_contradictory
        FROM (SELECT *, {_RANK} AS k, min({_RANK}) OVER (PARTITION BY scope, ctx) AS best FROM t) GROUP BY scope, ctx)
    SELECT scope, ctx AS node, status, score, cluster, n_compatible, n_weak, n_contradictory FROM r""")
def context_branch_choice(spark, sf_dir):
    """For each context its best status, the one cluster that is compatible with it, and how many branches are what."""
    return pairing.choices(*lines(spark, sf_dir))


_REL = f"CASE WHEN x = y THEN 'equal' WHEN (y = 'tmt' AND x LIKE 'tmt%') OR (y = 'tmtpro' AND x LIKE 'tmtpro%') THEN 'child' WHEN {_BELOW} THEN 'parent' WHEN x LIKE 'tmt%' AND y LIKE 'tmt%' AND x <> 'tmtpro' AND y <> 'tmtpro' THEN 'incompatible' ELSE 'unknown' END"


@query(f"""WITH s AS (SELECT l_orderkey, l_linenumber, l_suppkey, {FACTS[1][1]} AS v, 'USES_CHEMISTRY' AS p, l_partkey FROM lineitem), k AS (SELECT l_partkey, l_suppkey, {_KEYS} AS key FROM s),
    d AS (SELECT l_partkey, key, count(*) AS n FROM k WHERE key <> '' GROUP BY ALL)
    SELECT l_partkey, x AS technology, y AS other, {_REL} AS relation, n_pairs FROM (SELECT a.l_partkey, a.key AS x, b.key AS y, a.n * b.n AS n_pairs FROM d a JOIN d b ON a.l_partkey = b.l_partkey AND a.key < b.key)""")
def technology_relations(spark, sf_dir):
    """How the technologies that lines of one part name stand to each other; lines of equal technology are one row each."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", tech.technology_key(F.expr(FACTS[1][1])).alias("technology")).where("technology <> ''")
    named = lines.groupBy("l_partkey", "technology").agg(F.count("*").alias("n"))
    other = named.select("l_partkey", F.col("technology").alias("other"), F.col("n").alias("m"))
    pairs = named.join(other, "l_partkey").where("technology < other")
    return pairs.select("l_partkey", "technology", "other", tech.relation("technology", "other").alias("relation"), (F.col("n") * F.col("m")).alias("n_pairs"))
