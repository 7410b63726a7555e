"""Publication and acquisition queries: keys, dedup, precedence, quarantine, reconciliation, overlays, carried context.

Stand-ins on the test tables: a document's e-mail address, first line or number is its key, in this order; conversations
are sectioned texts; order lines are versions of an order; labels are decisions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import ascii_lower, flags, ladder, overlap_coefficient, tokens
from ..operators.identity import ordered_digest
from ..registry import query
from ..sources.tables import table

_MAIL = r"[A-Za-z0-9._]+@[A-Za-z0-9.]+"
_KEYED = rf"""k AS (SELECT doc_id, source, n_chars, text, CASE WHEN regexp_extract(text, '{_MAIL}') <> '' THEN 'mail:' || lower(regexp_extract(text, '{_MAIL}'))
    WHEN trim(split_part(text, chr(10), 1)) <> '' THEN 'title:' || substr(sha1(lower(trim(split_part(text, chr(10), 1)))), 1, 16) ELSE 'row:' || doc_id::VARCHAR END AS key FROM documents)"""


def keyed(spark, sf_dir):
    mail, title = F.regexp_extract("text", _MAIL, 0), F.trim(F.substring_index("text", "\n", 1))
    key = ladder((mail != "", F.concat(F.lit("mail:"), F.lower(mail))), (title != "", F.concat(F.lit("title:"), F.substring(F.sha1(F.lower(title)), 1, 16))), otherwise=F.concat(F.lit("row:"), F.col("doc_id").cast("string")))
    return table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", "text", key.alias("key"))


@query(f"WITH {_KEYED} SELECT doc_id, key FROM k")
def publication_key(spark, sf_dir):
    return keyed(spark, sf_dir).select("doc_id", "key")


@query(f"WITH {_KEYED} SELECT key, min(doc_id) AS first_doc, count(*) AS n FROM k GROUP BY key")
def publication_dedup(spark, sf_dir):
    """First kept for each key, as a partial aggregate rather than a window over a key that may be hot."""
    return keyed(spark, sf_dir).groupBy("key").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n"))


@query(f"WITH {_KEYED} SELECT key, min(k.doc_id) AS representative, string_agg(DISTINCT source, ';' ORDER BY source) AS sources, count(*) AS n FROM k WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY key")
def missing_manuscript_queue(spark, sf_dir):
    open_ = keyed(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_anti")
    return open_.groupBy("key").agg(F.min("doc_id").alias("representative"), F.array_join(F.array_sort(F.collect_set("source")), ";").alias("sources"), F.count("*").alias("n"))


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) AS k FROM documents) SELECT source, lang, doc_id, n_chars FROM r WHERE k = 1")
def source_registry_best(spark, sf_dir):
    best = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.min(F.struct((-F.col("n_chars")).alias("neg"), "doc_id")).alias("m"))
    return best.select("source", "lang", F.col("m.doc_id").alias("doc_id"), (-F.col("m.neg")).alias("n_chars"))


_TOK = "list_filter(list_distinct(regexp_split_to_array(translate({c}, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), '[^A-Z0-9]+')), lambda x: x <> '')"


@query(f"""WITH t AS (SELECT conv_id, max(CASE WHEN turn = 1 THEN text END) AS a, max(CASE WHEN turn = 2 THEN text END) AS b FROM conversations GROUP BY conv_id),
    s AS (SELECT conv_id, {_TOK.format(c="coalesce(a, '')")} AS x, {_TOK.format(c="coalesce(b, '')")} AS y FROM t), n AS (SELECT conv_id, len(list_intersect(x, y)) AS shared, least(len(x), len(y)) AS least FROM s)
    SELECT conv_id, shared, CASE WHEN least > 0 AND shared / least >= 0.5 THEN 'same' WHEN shared >= 3 AND least > 0 AND shared / least >= 0.3 THEN 'likely' WHEN shared >= 2 THEN 'review' ELSE 'none' END AS class FROM n""")
def overlap_recovery_class(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    at = lambda n: tokens(F.max(F.when(F.col("turn") == n, F.col("text"))))
    pair = turns.groupBy("conv_id").agg(at(1).alias("x"), at(2).alias("y"))
    shared, share = F.size(F.array_intersect("x", "y")), overlap_coefficient("x", "y")
    kind = ladder((share >= 0.5, "same"), ((shared >= 3) & (share >= 0.3), "likely"), (shared >= 2, "review"), otherwise="none")
    return pair.select("conv_id", shared.cast("long").alias("shared"), kind.alias("class"))


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) AND sha256(text) NOT IN (SELECT sha256(text) FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)")
def quarantine_anti(spark, sf_dir):
    """Out by identity or by equal content."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("h"))
    bad = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    hashes = docs.join(bad, "doc_id").select("h").distinct()
    return docs.join(bad, "doc_id", "left_anti").join(hashes, "h", "left_anti").select("doc_id", "source")


@query("""WITH s AS (SELECT source, count(*) FILTER (quality = 1) AS good, count(l.doc_id) AS known, count(*) FILTER (toxic = 1) AS bad, count(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source)
    SELECT source, CASE WHEN good >= 12 THEN 'local_content' WHEN good > 0 THEN 'metadata_only' WHEN bad > 0 THEN 'quarantined_only' ELSE 'unresolved' END AS status, known FROM s""")
def corpus_reconcile(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumn("known", F.lit(1))
    s = table(spark, sf_dir, "documents").join(labels, "doc_id", "left").groupBy("source").agg(F.count_if(F.col("quality") == 1).alias("good"), F.count("known").alias("known"), F.count_if(F.col("toxic") == 1).alias("bad"))
    return s.select("source", ladder((F.col("good") >= 12, "local_content"), (F.col("good") > 0, "metadata_only"), (F.col("bad") > 0, "quarantined_only"), otherwise="unresolved").alias("status"), "known")


@query("""WITH t AS (SELECT page_id, lower(url) AS u FROM pages) SELECT page_id, concat_ws(';', CASE WHEN contains(u, '?') THEN 'query' END, CASE WHEN contains(u, '#') THEN 'fragment' END, CASE WHEN regexp_matches(u, '\\.html?($|[?#])') THEN 'file' END, CASE WHEN starts_with(u, 'https:') THEN 'secure' END) AS categories,
    (CASE WHEN contains(u, '?') THEN 50 ELSE 0 END + CASE WHEN contains(u, '#') THEN 40 ELSE 0 END + CASE WHEN regexp_matches(u, '\\.html?($|[?#])') THEN 30 ELSE 0 END + CASE WHEN starts_with(u, 'https:') THEN 5 ELSE 0 END)::BIGINT AS priority FROM t""")
def path_category_priority(spark, sf_dir):
    u = F.lower("url")
    weights = {"query": 50, "fragment": 40, "file": 30, "secure": 5}
    found = flags(query=u.contains("?"), fragment=u.contains("#"), file=u.rlike(r"\.html?($|[?#])"), secure=u.startswith("https:"))
    total = F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + ladder(*[(x == k, F.lit(v).cast("long")) for k, v in weights.items()], otherwise=F.lit(0).cast("long")))
    return table(spark, sf_dir, "pages").select("page_id", found.alias("c")).select("page_id", F.array_join("c", ";").alias("categories"), total.alias("priority"))


@query("WITH m AS (SELECT l_orderkey, max(l_shipdate) AS d FROM lineitem GROUP BY l_orderkey) SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem JOIN m USING (l_orderkey) WHERE l_shipdate = d")
def history_latest_ties(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    last = lines.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("d"))
    return lines.join(last, "l_orderkey").where(F.col("l_shipdate") == F.col("d")).select("l_orderkey", "l_partkey", "l_linenumber")


@query("""WITH exact AS (SELECT o_orderkey, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey AND o_orderstatus = l_linestatus), one AS (SELECT l_orderkey, min(l_partkey) AS p FROM lineitem GROUP BY l_orderkey HAVING count(*) = 1)
    SELECT o_orderkey, l_partkey, 'exact' AS how FROM exact UNION ALL SELECT o.o_orderkey, p, 'unique' FROM orders o JOIN one ON l_orderkey = o_orderkey WHERE o_orderkey NOT IN (SELECT o_orderkey FROM exact)""")
def history_match_fallback(spark, sf_dir):
    """Exact on key and status; else the only record of the key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_linestatus")
    exact = orders.join(lines, "o_orderkey").where(F.col("o_orderstatus") == F.col("l_linestatus")).select("o_orderkey", "l_partkey", F.lit("exact").alias("how"))
    only = lines.groupBy("o_orderkey").agg(F.min("l_partkey").alias("l_partkey"), F.count("*").alias("n")).where("n = 1")
    rest = orders.join(exact.select("o_orderkey").distinct(), "o_orderkey", "left_anti").join(only, "o_orderkey").select("o_orderkey", "l_partkey", F.lit("unique").alias("how"))
    return exact.unionByName(rest)


@query("SELECT d.doc_id, coalesce(CASE WHEN l.toxic = 1 THEN 'exclude' WHEN l.quality = 1 THEN 'include' END, CASE WHEN n_chars > 3000 THEN 'review' ELSE 'skip' END) AS decision FROM documents d LEFT JOIN labels l USING (doc_id)")
def review_override_join(spark, sf_dir):
    override = ladder((F.col("toxic") == 1, "exclude"), (F.col("quality") == 1, "include"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.select("doc_id", F.coalesce(override, ladder((F.col("n_chars") > 3000, "review"), otherwise="skip")).alias("decision"))


@query("SELECT doc_id, source, n_chars, false AS replaced FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0) UNION ALL SELECT doc_id, 'overlay', 0, true FROM labels WHERE quality = 0")
def packet_overlay_merge(spark, sf_dir):
    overlay = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id", F.lit("overlay").alias("source"), F.lit(0).cast("long").alias("n_chars"), F.lit(True).alias("replaced"))
    base = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", F.lit(False).alias("replaced"))
    return base.join(overlay.select("doc_id"), "doc_id", "left_anti").unionByName(overlay)


@query("""WITH b AS (SELECT doc_id, CASE WHEN n_chars > 2000 THEN 'include' ELSE 'review' END AS before, CASE WHEN quality = 1 AND toxic = 0 THEN 'include' WHEN toxic = 1 THEN 'exclude' ELSE 'review' END AS after FROM documents JOIN labels USING (doc_id))
    SELECT before, after, count(*) AS n FROM b GROUP BY ALL""")
def curation_delta(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    before = ladder((F.col("n_chars") > 2000, "include"), otherwise="review")
    after = ladder(((F.col("quality") == 1) & (F.col("toxic") == 0), "include"), (F.col("toxic") == 1, "exclude"), otherwise="review")
    return rows.select(before.alias("before"), after.alias("after")).groupBy("before", "after").agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT DISTINCT source, lang, md5(text) AS h FROM documents), l AS (SELECT source, string_agg(lang || ':' || h, ',' ORDER BY lang || ':' || h) AS j FROM s GROUP BY source) SELECT source, sha256(j) AS fingerprint FROM l""")
def set_fingerprint(spark, sf_dir):
    """SHA-256 of each source's sorted distinct (lang, content) set."""
    sets = table(spark, sf_dir, "documents").select("source", F.concat_ws(":", "lang", F.md5("text")).alias("s"))
    return ordered_digest(sets, "source", "s")


@query("""WITH c AS (SELECT conv_id, turn, role, text, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS asked FROM conversations)
    SELECT conv_id, turn, asked, md5(coalesce((SELECT min(text) FROM conversations q WHERE q.conv_id = c.conv_id AND q.turn = c.asked), '')) AS section_md5 FROM c WHERE role = 'assistant'""")
def section_carry_forward(spark, sf_dir):
    """Each answer with the last question before it; a conversation is one sectioned text."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    last = lambda c: F.last(F.when(F.col("role") == "user", F.col(c)), ignorenulls=True).over(order)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", last("turn").alias("asked"), last("text").alias("section"))
    return rows.where("role = 'assistant'").select("conv_id", "turn", "asked", F.md5(F.coalesce("section", F.lit(""))).alias("section_md5"))


@query("""WITH c AS (SELECT conv_id, turn, coalesce(lag(text) OVER w, '') || ' ' || text || ' ' || coalesce(lead(text) OVER w, '') AS ctx FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
    n AS (SELECT conv_id, count(*) FILTER (contains(lower(ctx), 'the ')) AS en, count(*) FILTER (contains(lower(ctx), 'und ')) AS de, count(*) AS n FROM c GROUP BY conv_id)
    SELECT conv_id, CASE WHEN en > 0 AND de > 0 THEN 'mixed' WHEN 2 * en >= n THEN 'english' WHEN 2 * de >= n THEN 'german' ELSE 'unresolved' END AS modality FROM n""")
def neighbour_context_class(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    ctx = F.lower(F.concat(F.coalesce(F.lag("text").over(w), F.lit("")), F.lit(" "), F.col("text"), F.lit(" "), F.coalesce(F.lead("text").over(w), F.lit(""))))
    n = table(spark, sf_dir, "conversations").select("conv_id", ctx.alias("ctx")).groupBy("conv_id").agg(F.count_if(F.col("ctx").contains("the ")).alias("en"), F.count_if(F.col("ctx").contains("und ")).alias("de"), F.count("*").alias("n"))
    kind = ladder(((F.col("en") > 0) & (F.col("de") > 0), "mixed"), (2 * F.col("en") >= F.col("n"), "english"), (2 * F.col("de") >= F.col("n"), "german"), otherwise="unresolved")
    return n.select("conv_id", kind.alias("modality"))


@query("""WITH t AS (SELECT doc_id, length(text) AS n, len(string_split(text, chr(10))) AS lines, length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS odd FROM documents)
    SELECT doc_id, CASE WHEN n < 100 THEN 'failed' WHEN odd * 10 > n THEN 'poor' WHEN n < 1000 OR odd > 0 THEN 'warning' ELSE 'good' END AS quality,
    concat_ws(';', CASE WHEN n < 1000 THEN 'short' END, CASE WHEN odd > 0 THEN 'symbols' END, CASE WHEN lines = 1 THEN 'one_line' END) AS reasons FROM t""")
def extraction_quality(spark, sf_dir):
    n, odd = F.length("text"), F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]+", ""))
    quality = ladder((n < 100, "failed"), (odd * 10 > n, "poor"), ((n < 1000) | (odd > 0), "warning"), otherwise="good")
    reasons = flags(short=n < 1000, symbols=odd > 0, one_line=F.size(F.split("text", "\n")) == 1)
    return table(spark, sf_dir, "documents").select("doc_id", quality.alias("quality"), F.array_join(reasons, ";").alias("reasons"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y') WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS published FROM orders")
def partial_date_choice(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    of = lambda p: F.date_format("o_orderdate", p)
    return table(spark, sf_dir, "orders").select("o_orderkey", ladder((k == 0, of("yyyy")), (k == 1, of("yyyy-MM")), otherwise=of("yyyy-MM-dd")).alias("published"))


@query("""WITH t AS (SELECT doc_id, lower(text) AS t FROM documents) SELECT doc_id, CASE WHEN contains(t, 'license') THEN 'policy' WHEN contains(t, '@') THEN 'identity' WHEN contains(t, ' | ') THEN 'table' WHEN contains(t, '***') OR contains(t, '$$$') THEN 'noise' ELSE 'other' END AS family FROM t""")
def blocker_family(spark, sf_dir):
    """An ordered substring dictionary; the first match wins."""
    t = ascii_lower("text")
    family = ladder((t.contains("license"), "policy"), (t.contains("@"), "identity"), (t.contains(" | "), "table"), (t.contains("***") | t.contains("$$$"), "noise"), otherwise="other")
    return table(spark, sf_dir, "documents").select("doc_id", family.alias("family"))


@query("""WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+')) AS mention FROM documents) SELECT lower(mention) AS mention, count(*) AS n, count(DISTINCT doc_id) AS docs FROM m GROUP BY 1""")
def mention_ingest(spark, sf_dir):
    m = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(_MAIL), F.lit(0))).alias("mention"))
    return m.groupBy(F.lower("mention").alias("mention")).agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"))


@query("""WITH o AS (SELECT event_id, user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 12 HOUR THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM o) SELECT user_id, session::BIGINT AS session, count(*) AS n, min(event_id) AS first_event FROM s GROUP BY ALL""")
def event_sessions(spark, sf_dir):
    """Extension: sessions of a user's events with a gap of 12 hours."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    gap = F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(order))
    marked = events.withColumn("new", F.when(gap.isNull() | (gap > 12 * 3600 * 1_000_000), 1).otherwise(0)).withColumn("session", F.sum("new").over(order))
    return marked.groupBy("user_id", "session").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("SELECT p.event_id, (SELECT arg_max(v.event_id, (v.ts, v.event_id)) FROM events v WHERE v.user_id = p.user_id AND v.event_type = 'view' AND v.ts <= p.ts) AS last_view FROM events p WHERE event_type = 'purchase'")
def event_as_of(spark, sf_dir):
    """Extension: each purchase with the latest view up to its time (of equal times the greater id), by one running maximum over the union, which
    needs no join of time ranges."""
    e = table(spark, sf_dir, "events").where("event_type in ('purchase', 'view')")
    order = Window.partitionBy("user_id").orderBy("ts").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    seen = e.select("event_id", "event_type", F.max(F.when(F.col("event_type") == "view", F.struct("ts", "event_id"))).over(order).alias("last"))
    return seen.where("event_type = 'purchase'").select("event_id", F.col("last.event_id").alias("last_view"))


@query("SELECT s_nationkey AS nation, s_suppkey, c_custkey FROM supplier JOIN customer ON s_nationkey = c_nationkey WHERE abs(s_acctbal - c_acctbal) <= 50")
def nearby_values(spark, sf_dir):
    """Extension: a range join by buckets: records of one nation whose balances are within 50. A supplier goes to its own
    bucket and both neighbours; buckets are wider than the distance."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey", "s_acctbal", F.explode(F.array(*[F.floor(F.col("s_acctbal") / 500) + k for k in (-1, 0, 1)])).alias("b"))
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), "c_custkey", "c_acctbal", F.floor(F.col("c_acctbal") / 500).alias("b"))
    return s.join(c, ["nation", "b"]).where(F.abs(F.col("s_acctbal") - F.col("c_acctbal")) <= 50).select("nation", "s_suppkey", "c_custkey")
