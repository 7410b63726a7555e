"""Sample-sheet queries: cells, required values, filling, expansion, linkage, states, ledgers and pages.

Stand-ins on the test tables: a supplier's or order's columns are a sheet in long form; order lines are mapping records;
events are attempts and pages of a catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import is_concrete, ladder
from ..operators import sheets as sh
from ..registry import query
from ..sources import tables as src
from ..sources.tables import table

_CELLS = """cells AS (SELECT s_nationkey AS file, 'name' AS header, s_name AS value FROM supplier UNION ALL SELECT s_nationkey, 'balance', CASE WHEN s_acctbal < 0 THEN 'not available' ELSE s_acctbal::VARCHAR END FROM supplier
    UNION ALL SELECT s_nationkey, 'note', CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'ok' END FROM supplier WHERE s_nationkey % 2 = 0)"""
_BAD = "lower(trim(value)) IN ('', 'not available', 'not applicable', 'na', 'n/a', 'nan', 'none', 'null', 'unknown', 'not provided', 'pooled')"


def cells(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    named = lambda h, v: F.struct(F.lit(h).alias("header"), v.alias("value"))
    balance = F.when(F.col("s_acctbal") < 0, F.lit("not available")).otherwise(F.col("s_acctbal").cast("string"))
    note = F.when(F.col("s_nationkey") % 2 == 0, named("note", F.when(F.col("s_suppkey") % 3 == 0, F.lit("")).otherwise(F.lit("ok"))))
    rows = s.select(F.col("s_nationkey").alias("file"), F.explode(F.array_compact(F.array(named("name", F.col("s_name")), named("balance", balance), note))).alias("c"))
    return rows.select("file", "c.header", "c.value")


@query(f"""WITH {_CELLS}, n AS (SELECT file, header, count(*) FILTER ({_BAD}) AS bad, count(*) AS n FROM cells GROUP BY ALL), w(header) AS (VALUES ('name'), ('balance'), ('note'), ('label'))
    SELECT f.file, w.header, CASE WHEN n.n IS NULL THEN 'missing_column' WHEN bad > 0 THEN 'missing_values' ELSE 'ok' END AS state, coalesce(bad, 0) AS n_bad FROM (SELECT DISTINCT file FROM cells) f CROSS JOIN w LEFT JOIN n ON n.file = f.file AND n.header = w.header""")
def required_value_blockers(spark, sf_dir):
    return sh.blockers(cells(spark, sf_dir), ["name", "balance", "note", "label"])


@query(f"WITH {_CELLS} SELECT file, bool_and({_BAD}) AS all_placeholder, bool_or({_BAD}) AS some_placeholder, count(*) AS n FROM cells GROUP BY file")
def placeholder_audit(spark, sf_dir):
    bad = ~is_concrete("value")
    return cells(spark, sf_dir).groupBy("file").agg(F.bool_and(bad).alias("all_placeholder"), F.bool_or(bad).alias("some_placeholder"), F.count("*").alias("n"))


@query("""WITH p AS (SELECT l_orderkey, min(l_returnflag) AS new, count(DISTINCT l_returnflag) AS k FROM lineitem GROUP BY l_orderkey), c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'not available' WHEN o_orderkey % 3 = 1 THEN 'N' ELSE o_orderstatus END AS cur FROM orders)
    SELECT o_orderkey, CASE WHEN cur = 'not available' AND k = 1 THEN new ELSE cur END AS value, CASE WHEN k IS NULL OR k > 1 THEN 'nothing' WHEN cur = 'not available' THEN 'filled' WHEN cur = new THEN 'equal' ELSE 'conflict' END AS action FROM c LEFT JOIN p ON o_orderkey = l_orderkey""")
def row_fill(spark, sf_dir):
    one = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.when(F.min("l_returnflag") == F.max("l_returnflag"), F.max("l_returnflag")).alias("new"))
    k = F.col("o_orderkey") % 3
    current = ladder((k == 0, "not available"), (k == 1, "N"), otherwise=F.col("o_orderstatus"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", current.alias("cur")).join(one, "o_orderkey", "left")
    return rows.select("o_orderkey", sh.fill(F.col("cur"), F.coalesce("new", F.lit(""))).alias("f")).select("o_orderkey", "f.value", "f.action")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_brand || '; ' || p_type END AS value FROM part")
def composite_narrowing(spark, sf_dir):
    """A cell of brand; type narrowed by the brand where the size is even."""
    cell = F.concat("p_brand", F.lit("; "), "p_type")
    new = F.when(F.col("p_size") % 2 == 0, F.lower("p_brand")).otherwise(F.lit("other"))
    return table(spark, sf_dir, "part").select("p_partkey", sh.narrow(cell, new).alias("value"))


@query("""SELECT l_orderkey, count(*) AS n, count(*) >= 2 AND count(DISTINCT l_linenumber) = count(*) AND count(DISTINCT l_linestatus) = 1 AS can_expand FROM lineitem GROUP BY l_orderkey""")
def row_expansion_gate(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.countDistinct("l_linenumber").alias("labels"), F.min("l_linestatus").alias("a"), F.max("l_linestatus").alias("b"))
    return g.select("l_orderkey", "n", ((F.col("n") >= 2) & (F.col("labels") == F.col("n")) & (F.col("a") == F.col("b"))).alias("can_expand"))


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def inventory_anti(spark, sf_dir):
    used = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")).distinct()
    return table(spark, sf_dir, "part").select("p_partkey", "p_name").join(used, "p_partkey", "left_anti")


@query("""WITH f AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem), h AS (SELECT p_partkey FROM part WHERE p_size <= 25)
    SELECT l_orderkey, count(*) AS n_files, count(p_partkey) AS n_linked, CASE WHEN count(p_partkey) = count(*) THEN 'complete' WHEN count(p_partkey) > 0 THEN 'partial' ELSE 'none' END AS state FROM f LEFT JOIN h ON l_partkey = p_partkey GROUP BY l_orderkey""")
def linkage_coverage(spark, sf_dir):
    have = table(spark, sf_dir, "part").where("p_size <= 25").select(F.col("p_partkey").alias("l_partkey"))
    return sh.coverage(table(spark, sf_dir, "lineitem"), have, "l_orderkey", "l_partkey")


@query("""WITH s AS (SELECT o_custkey, o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END AS rank FROM orders WHERE o_totalprice > 1000)
    SELECT o_custkey, arg_min(o_orderkey, rank::BIGINT * 1000000000000 + o_orderkey) AS chosen FROM s GROUP BY o_custkey""")
def source_precedence(spark, sf_dir):
    p = F.col("o_orderpriority")
    rank = ladder((p == "1-URGENT", 1), (p == "2-HIGH", 2), otherwise=3)
    usable = table(spark, sf_dir, "orders").where("o_totalprice > 1000")
    return usable.groupBy("o_custkey").agg(F.min(F.struct(rank.alias("rank"), "o_orderkey")).alias("m")).select("o_custkey", F.col("m.o_orderkey").alias("chosen"))


_LEDGER = "led AS (SELECT DISTINCT user_id, event_type FROM events WHERE event_type = 'error' OR value < 5)"


@query(f"""WITH {_LEDGER}, w AS (SELECT DISTINCT user_id, event_type FROM events) SELECT w.user_id, w.event_type FROM w ANTI JOIN led ON w.user_id = led.user_id AND w.event_type = led.event_type""")
def attempt_ledger_anti(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    ledger = events.where("event_type = 'error' or value < 5").select("user_id", "event_type", F.lit("no_progress").alias("outcome"))
    return sh.without_failed_attempts(events.select("user_id", "event_type").distinct(), ledger, ["user_id", "event_type"])


@query("""WITH s AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'purchase') AS buys, count(*) FILTER (event_type = 'signup') AS signups, max(value) AS best FROM events GROUP BY user_id)
    SELECT user_id, CASE WHEN signups = 0 THEN 'blocked_missing_input' WHEN errors > 2 * buys THEN 'blocked_conflict' WHEN buys >= 10 AND best > 50 THEN 'ready' WHEN buys > 0 THEN 'review' ELSE 'acquire_evidence' END AS state FROM s""")
def decide_case(spark, sf_dir):
    n = lambda t: F.count_if(F.col("event_type") == t)
    s = table(spark, sf_dir, "events").groupBy("user_id").agg(n("error").alias("errors"), n("purchase").alias("buys"), n("signup").alias("signups"), F.max("value").alias("best"))
    state = ladder(
        (F.col("signups") == 0, "blocked_missing_input"), (F.col("errors") > 2 * F.col("buys"), "blocked_conflict"), ((F.col("buys") >= 10) & (F.col("best") > 50), "ready"), (F.col("buys") > 0, "review"), otherwise="acquire_evidence"
    )
    return s.select("user_id", state.alias("state"))


@query("SELECT e.event_id, e.event_type FROM events e WHERE event_type IN (SELECT event_type FROM events WHERE value > 90 GROUP BY event_type HAVING count(DISTINCT user_id) >= 3)")
def cohort_threshold(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    promoted = events.where("value > 90").groupBy("event_type").agg(F.countDistinct("user_id").alias("n")).where("n >= 3").select("event_type")
    return events.select("event_id", "event_type").join(promoted, "event_type", "left_semi").select("event_id", "event_type")


_PAGED = "pg AS (SELECT event_type AS source, event_id // 50 AS page, user_id AS id FROM events)"


def _paged(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.floor(F.col("event_id") / 50).alias("page"), F.col("user_id").alias("id"))


@query(f"WITH {_PAGED} SELECT source, max(page) AS page FROM pg GROUP BY source")
def latest_page(spark, sf_dir):
    return src.latest_page(_paged(spark, sf_dir), "source", "page")


@query(f"WITH {_PAGED} SELECT id, min(page) AS first_page FROM pg GROUP BY id")
def first_seen_ids(spark, sf_dir):
    return src.first_seen(_paged(spark, sf_dir), "id", "page")


@query(f"""WITH {_PAGED}, f AS (SELECT source, id, min(page) AS page FROM pg GROUP BY source, id), n AS (SELECT source, page, count(*) AS n_new FROM f GROUP BY ALL),
    p AS (SELECT d.source, d.page, coalesce(n_new, 0) AS n_new FROM (SELECT DISTINCT source, page FROM pg) d LEFT JOIN n ON n.source = d.source AND n.page = d.page),
    i AS (SELECT *, sum((n_new > 0)::INT) OVER (PARTITION BY source ORDER BY page) AS island FROM p)
    SELECT source, page, n_new, sum((n_new = 0)::INT) OVER (PARTITION BY source, island ORDER BY page)::BIGINT AS stagnant_run FROM i""")
def stagnant_pages(spark, sf_dir):
    return src.stagnant(_paged(spark, sf_dir), "source", "id", "page")


@query("""SELECT user_id, arg_max(event_type, event_id) FILTER (value >= 10) AS last_type, arg_max(props, event_id) FILTER (value >= 50) AS last_props FROM events GROUP BY user_id""")
def upsert_keep_nonempty(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.when(F.col("value") >= 10, F.col("event_type")).otherwise("").alias("last_type"), F.when(F.col("value") >= 50, F.col("props")).otherwise("").alias("last_props")
    )
    return sh.upsert(rows, "user_id", "event_id", ["last_type", "last_props"])


@query("""SELECT coalesce(source, 'all') AS source, coalesce(lang, 'all') AS lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY GROUPING SETS ((), (source), (lang))""")
def grouping_sets_eval(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    sets = docs.groupingSets([[], [F.col("source")], [F.col("lang")]], "source", "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))
    return sets.select(F.coalesce("source", F.lit("all")).alias("source"), F.coalesce("lang", F.lit("all")).alias("lang"), "n", "chars")


@query()
def shard_balance(spark, sf_dir):
    """Parts of each brand over 4 shards by price; the greedy order has no SQL, so the tests compare with plain Python."""
    parts = table(spark, sf_dir, "part").select("p_brand", "p_partkey", F.when(F.col("p_partkey") % 10 != 0, F.col("p_retailprice")).alias("size"))
    return sh.balance(parts, "p_brand", "p_partkey", "size", 4)


@query()
def json_record_walk(spark, sf_dir):
    """Objects of the events' properties with inherited scalars."""
    return sh.records(table(spark, sf_dir, "events"), "event_id", "props")
