"""Merge queries: budgets, packets, guards, agreements, bundles, reconciliations and their grains.

Stand-ins on the test tables: turns of a conversation are evidence blocks, roles their groups; order lines are claims,
suppliers and orders the roots that assert something of a part; events are pages, documents candidates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import ascii_lower, jaccard, ladder, tokens
from ..operators import identity as idn
from ..operators import merges as mg
from ..registry import query
from ..sources.tables import table


def _blocks(spark, sf_dir):
    """conv_id and its turns by role, in order."""
    turns = table(spark, sf_dir, "conversations")
    of = lambda role: F.sort_array(F.collect_list(F.when(F.col("role") == role, F.struct(F.col("turn").alias("id"), "text")))).alias(role)
    return turns.groupBy("conv_id").agg(of("user"), of("assistant"), of("system"))


def _shown(df, out: str):
    chars = F.aggregate(out, F.lit(0).cast("long"), lambda a, x: a + F.length(x["text"]))
    return df.select("conv_id", F.size(out).cast("long").alias("n"), chars.alias("chars"), F.array_join(F.transform(out, lambda x: x["id"].cast("string")), ",").alias("turns"))


@query()
def balanced_merge(spark, sf_dir):
    """Turns of three roles in rotation within 1,500 characters. Which item a group gives depends on all turns before, so the
    tests compare with a plain loop."""
    groups = F.array("assistant", "user", "system")
    return _shown(_blocks(spark, sf_dir).withColumn("out", mg.interleaved(groups, 12, 1500, 100)), "out")


@query()
def quota_merge(spark, sf_dir):
    """Three turns of the assistant, one of the user, then the rest, within 1,500 characters; compared with a plain loop."""
    return _shown(_blocks(spark, sf_dir).withColumn("out", mg.quota(F.col("assistant"), F.col("user"), (3, 1), 1500, 100)), "out")


@query()
def packetize(spark, sf_dir):
    """Lines of documents in packets of at most 400 characters and 5 lines; a fold, compared with a plain loop."""
    docs = table(spark, sf_dir, "documents").select("doc_id", mg.packets(F.split("text", "\n"), 400, 5).alias("no"))
    return docs.select("doc_id", F.size("no").cast("long").alias("n_lines"), (F.element_at("no", -1) + 1).alias("n_packets"), F.array_join(F.transform("no", lambda x: x.cast("string")), ",").alias("numbers"))


@query("""WITH t AS (SELECT doc_id, string_split(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'license') AS p FROM documents)
    SELECT doc_id, CASE len(p) WHEN 1 THEN '' WHEN 2 THEN len(p[1])::VARCHAR ELSE len(p[1]) || ',' || (len(p[1]) + 7 + len(p[2])) END AS places FROM t""")
def capped_hits(spark, sf_dir):
    """The first two places of a term in each document."""
    places = mg.occurrences(ascii_lower("text"), "license", 2)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.transform(places, lambda x: x.cast("string")), ",").alias("places"))


@query()
def spread_centers(spark, sf_dir):
    """Places of three terms, two of each, of which those within 60 characters of a kept one go; compared with a plain loop."""
    low = ascii_lower("text")
    places = F.concat(*[mg.occurrences(low, t, 2) for t in ("the", "license", "tion")])
    docs = table(spark, sf_dir, "documents").select("doc_id", mg.spread(places, 60).alias("kept"))
    return docs.select("doc_id", F.array_join(F.transform("kept", lambda x: x.cast("string")), ",").alias("kept"))


@query(r"""WITH t AS (SELECT doc_id, text, instr(text, 'tion') - 1 AS a FROM documents WHERE contains(text, 'tion'))
    SELECT doc_id, trim(regexp_replace(substr(text, greatest(a - 60, 0) + 1, a + 4 + 60 - greatest(a - 60, 0)), '[ \t\n\r\f\x0B]+', ' ', 'g')) AS shown FROM t""")
def context_window(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where(F.col("text").contains("tion"))
    at = F.instr("text", "tion") - 1
    return docs.select("doc_id", mg.window_around("text", at, at + 4, 60).alias("shown"))


@query(r"""WITH t AS (SELECT doc_id, text, length(text) AS n, instr(text, 'tion') + 1 AS c FROM documents WHERE contains(text, 'tion')),
    w AS (SELECT *, greatest(least(greatest(c - 150, 0), n - 300), 0) AS b FROM t), u AS (SELECT *, least(n, b + 300) AS e, substr(text, b + 1, least(n, b + 300) - b) AS cut FROM w),
    h AS (SELECT *, nullif(least(CASE WHEN instr(cut, '. ') BETWEEN 1 AND 121 THEN instr(cut, '. ') ELSE 999 END, CASE WHEN instr(cut, '; ') BETWEEN 1 AND 121 THEN instr(cut, '; ') ELSE 999 END), 999) AS head FROM u),
    k AS (SELECT *, CASE WHEN b > 0 AND head IS NOT NULL THEN substr(cut, head + 2) ELSE cut END AS cut2 FROM h),
    l AS (SELECT *, greatest(CASE WHEN instr(reverse(cut2), ' .') > 0 THEN length(cut2) - instr(reverse(cut2), ' .') - 1 ELSE -1 END, CASE WHEN instr(reverse(cut2), ' ;') > 0 THEN length(cut2) - instr(reverse(cut2), ' ;') - 1 ELSE -1 END) AS foot FROM k)
    SELECT doc_id, trim(regexp_replace(CASE WHEN e < n AND foot >= 0 AND foot >= length(cut2) - 140 THEN substr(cut2, 1, foot + 1) ELSE cut2 END, '[ \t\n\r\f\x0B]+', ' ', 'g')) AS shown FROM l""")
def clipped_window(spark, sf_dir):
    """300 characters around the first mention, cut back to sentence or clause ends near the edges."""
    docs = table(spark, sf_dir, "documents").where(F.col("text").contains("tion"))
    return docs.select("doc_id", mg.clipped("text", F.instr("text", "tion") + 1, 300).alias("shown"))


@query("""SELECT l_orderkey, count(*) AS claims, CASE WHEN count(DISTINCT l_returnflag || '|' || l_linestatus) = 1 THEN 'promoted' ELSE 'refused' END AS outcome,
    CASE WHEN count(DISTINCT l_returnflag || '|' || l_linestatus) = 1 THEN max(l_discount) END AS confidence FROM lineitem GROUP BY l_orderkey""")
def edge_promotion(spark, sf_dir):
    return mg.promoted(table(spark, sf_dir, "lineitem"), "l_orderkey", ["l_returnflag", "l_linestatus"], "l_discount")


@query("""WITH f AS (SELECT s_nationkey AS k, arg_min(s_name, s_suppkey) AS v FROM supplier GROUP BY 1), p AS (SELECT n_nationkey AS k, n_name AS v FROM nation WHERE n_nationkey % 2 = 0)
    SELECT k, v FROM p UNION ALL SELECT k, v FROM f WHERE k NOT IN (SELECT k FROM p)""")
def insert_or_ignore(spark, sf_dir):
    """Nations of even number are there; suppliers are offered for all."""
    present = table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("v"), F.lit(0).cast("long").alias("ord"))
    new = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_name").alias("v"), F.col("s_suppkey").alias("ord"))
    return mg.insert_or_ignore(present, new, "k", "ord").select("k", "v")


@query("""WITH v AS (SELECT l_partkey AS part, l_suppkey AS root, CASE WHEN l_quantity > 25 THEN '' ELSE l_returnflag END AS value FROM lineitem) SELECT part, CASE WHEN count(DISTINCT value) = 1 THEN max(value) END AS value, count(DISTINCT root) AS roots,
    CASE WHEN count(DISTINCT value) > 1 THEN 'conflict' WHEN count(DISTINCT root) > 1 THEN 'agreed' ELSE 'single_root' END AS state FROM v WHERE value <> '' GROUP BY part""")
def cross_root_agreement(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("root"), F.when(F.col("l_quantity") > 25, "").otherwise(F.col("l_returnflag")).alias("value"))
    return mg.agreed(lines, ["part"], "root", "value")


@query("""WITH c AS (SELECT source, lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE lang WHEN 'es' THEN 1 WHEN 'xx' THEN 2 ELSE 3 END, n DESC, lang) AS k FROM c)
    SELECT source, lang FROM r WHERE k = 1""")
def preferred_or_mode(spark, sf_dir):
    return mg.preferred_or_mode(table(spark, sf_dir, "documents"), "source", "lang", ["es", "xx"])


@query("""WITH g AS (SELECT l_orderkey, count(*) AS n, list_sort(list(DISTINCT l_linenumber)) AS ch FROM lineitem GROUP BY l_orderkey), e AS (SELECT o_orderkey, n, ch, n >= 2 AND len(ch) = n AND o_orderstatus <> 'P' AS ok FROM orders JOIN g ON o_orderkey = l_orderkey)
    SELECT o_orderkey, unnest(CASE WHEN ok THEN list_transform(ch, lambda x: x::VARCHAR) ELSE [NULL] END) AS channel FROM e""")
def row_expansion(spark, sf_dir):
    """An order whose lines have each a number of its own becomes one row for each of them."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.transform(F.sort_array(F.collect_set("l_linenumber")), lambda x: x.cast("string")).alias("channels"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").join(lines, "o_orderkey")
    gate = (F.col("n") >= 2) & (F.size("channels") == F.col("n")) & (F.col("o_orderstatus") != "P")
    return mg.expanded(rows, "channels", gate, "channel").select("o_orderkey", "channel")


@query("""WITH c AS (SELECT s_suppkey AS k, 'name' AS field, s_name AS value FROM supplier UNION ALL SELECT s_suppkey, 'balance', s_acctbal::VARCHAR FROM supplier WHERE s_suppkey % 4 <> 0
    UNION ALL SELECT s_suppkey, 'name', CASE WHEN s_suppkey % 5 = 0 THEN 'other' ELSE upper(s_name) END FROM supplier WHERE s_suppkey % 2 = 0),
    f AS (SELECT k, field, max(value) AS value, count(DISTINCT lower(value)) AS kinds FROM c GROUP BY ALL) SELECT k, field, value FROM f WHERE k NOT IN (SELECT k FROM f WHERE kinds > 1)""")
def record_canonicalization(spark, sf_dir):
    """Cells under headers of several spellings, by field; a record that contradicts itself is left out."""
    cell = lambda h, v: F.struct(F.lit(h).alias("header"), v.alias("value"))
    k = F.col("s_suppkey")
    again = F.when(k % 2 == 0, cell("NAME ", F.when(k % 5 == 0, F.lit("other")).otherwise(F.upper("s_name"))))
    made = F.array_compact(F.array(cell("Supplier-Name", F.col("s_name")), F.when(k % 4 != 0, cell("Acct. Bal", F.col("s_acctbal").cast("string"))), again, cell("comment", F.lit("x"))))
    cells = table(spark, sf_dir, "supplier").select(k.alias("k"), F.explode(made).alias("c")).select("k", "c.header", "c.value")
    return mg.canonical_records(cells, "k", "header", "value", {"suppliername": "name", "name": "name", "acctbal": "balance"})


@query("""SELECT d.doc_id, d.source, coalesce(quality, -1)::BIGINT AS quality, coalesce(n_pages, 0) AS n_pages, coalesce(n_turns, 0) AS n_turns FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) l ON d.doc_id = l.doc_id
    LEFT JOIN (SELECT page_id, count(*) AS n_pages FROM pages GROUP BY 1) p ON p.page_id = d.doc_id LEFT JOIN (SELECT turn, count(*) AS n_turns FROM conversations GROUP BY 1) c ON c.turn = d.doc_id""")
def facet_left_join(spark, sf_dir):
    """A record with what each optional facet has of it; a facet is one row a key before it is joined."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").cast("long").alias("quality"))
    pages = table(spark, sf_dir, "pages").groupBy(F.col("page_id").alias("doc_id")).agg(F.count("*").alias("n_pages"))
    turns = table(spark, sf_dir, "conversations").groupBy(F.col("turn").alias("doc_id")).agg(F.count("*").alias("n_turns"))
    joined = table(spark, sf_dir, "documents").select("doc_id", "source").join(labels, "doc_id", "left").join(pages, "doc_id", "left").join(turns, "doc_id", "left")
    zero = lambda c, v=0: F.coalesce(c, F.lit(v).cast("long")).alias(c)
    return joined.select("doc_id", "source", zero("quality", -1), zero("n_pages"), zero("n_turns"))


@query("""WITH a AS (SELECT doc_id, unnest([md5(text), 'doc:' || doc_id]) AS alias FROM documents), x AS (SELECT alias, min(doc_id) AS canonical FROM a GROUP BY alias)
    SELECT e.event_id, x.canonical FROM events e LEFT JOIN x ON x.alias = 'doc:' || (e.event_id % 700)""")
def alias_crosswalk(spark, sf_dir):
    """Any alias of a record leads to its canonical one; events without a known alias keep none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(F.md5("text"), F.concat(F.lit("doc:"), F.col("doc_id")))).alias("alias"))
    walk = docs.groupBy("alias").agg(F.min("doc_id").alias("canonical"))
    asked = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("doc:"), F.col("event_id") % 700).alias("alias"))
    return asked.join(walk, "alias", "left").select("event_id", "canonical")


@query("""SELECT n_name, p_brand, o_orderstatus, count(*) AS n, sum(l_quantity)::BIGINT AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""")
def bundle_join(spark, sf_dir):
    """Five tables of one bundle: lines with their order, part, supplier and nation. Spark orders the joins by size."""
    t = lambda n: table(spark, sf_dir, n)
    lines = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    nations = t("supplier").select("s_suppkey", "s_nationkey").join(t("nation").select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    joined = lines.join(nations, F.col("l_suppkey") == F.col("s_suppkey")).join(t("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    joined = joined.join(t("orders").select("o_orderkey", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("n_name", "p_brand", "o_orderstatus").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))


@query("SELECT source, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'fr') AS fr, count(*) FILTER (lang = 'es') AS es, count(DISTINCT md5(text)) AS texts FROM documents GROUP BY source")
def review_pivot(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    wide = docs.groupBy("source").pivot("lang", ["en", "de", "fr", "es"]).agg(F.count("doc_id"))
    texts = docs.groupBy("source").agg(F.countDistinct(F.md5("text")).alias("texts"))
    return wide.na.fill(0).join(texts, "source")


@query("""SELECT d.source, CASE WHEN bool_or(quality = 1 AND toxic = 0) THEN 'yes' WHEN bool_or(quality = 1) THEN 'uncertain' ELSE 'no' END AS class, bool_or(toxic = 1) AS any_toxic, sum(quality)::BIGINT AS total,
    string_agg(DISTINCT lang, '; ' ORDER BY lang) AS langs, count(*) FILTER (quality = 1) AS n_good, count(*) FILTER (toxic = 1) AS n_toxic FROM labels l JOIN documents d ON d.doc_id = l.doc_id GROUP BY d.source""")
def annotation_summary(spark, sf_dir):
    """Any, priority, sum, count and distinct values over the annotations of a group, in one aggregate."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), "doc_id")
    rank = ladder(((F.col("quality") == 1) & (F.col("toxic") == 0), 0), (F.col("quality") == 1, 1), otherwise=2)
    sums = rows.groupBy("source").agg(
        F.min(rank).alias("rank"), F.bool_or(F.col("toxic") == 1).alias("any_toxic"), F.sum("quality").cast("long").alias("total"), F.array_join(F.sort_array(F.collect_set("lang")), "; ").alias("langs"),
        F.count_if(F.col("quality") == 1).alias("n_good"), F.count_if(F.col("toxic") == 1).alias("n_toxic"),
    )
    return sums.select("source", ladder((F.col("rank") == 0, "yes"), (F.col("rank") == 1, "uncertain"), otherwise="no").alias("class"), "any_toxic", "total", "langs", "n_good", "n_toxic")


@query("""SELECT count(*) AS files, sum(length(html))::BIGINT AS chars, count(*) FILTER (page_id NOT IN (SELECT doc_id FROM labels)) AS removable, coalesce(sum(length(html)) FILTER (page_id NOT IN (SELECT doc_id FROM labels)), 0)::BIGINT AS freed,
    round(count(*) FILTER (page_id IN (SELECT doc_id FROM labels)) / count(*), 6) AS kept_share FROM pages""")
def removable_totals(spark, sf_dir):
    """Sizes of all files and of those that no retained record names, and the share that stays."""
    kept = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.lit(True).alias("kept")).distinct()
    files = table(spark, sf_dir, "pages").select("page_id", F.length("html").cast("long").alias("size")).join(kept, "page_id", "left")
    gone = F.col("kept").isNull()
    sums = files.agg(F.count("*").alias("files"), F.sum("size").alias("chars"), F.count_if(gone).alias("removable"), F.coalesce(F.sum(F.when(gone, F.col("size"))), F.lit(0).cast("long")).alias("freed"))
    return sums.withColumn("kept_share", F.round((F.col("files") - F.col("removable")) / F.nullif(F.col("files"), F.lit(0)), 6))


@query("SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def stale_records(spark, sf_dir):
    """Generated records that the last run did not see."""
    return table(spark, sf_dir, "customer").select("c_custkey").distinct().join(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("""SELECT user_id, count(*) AS candidates, count(DISTINCT sha256(props)) AS hashes, CASE WHEN count(DISTINCT sha256(props)) = 1 THEN arg_min(event_id, CASE event_type WHEN 'purchase' THEN 0 WHEN 'view' THEN 1 ELSE 2 END * 1000000000 + event_id) END AS chosen FROM events GROUP BY user_id""")
def same_hash_guard(spark, sf_dir):
    """The first candidate by kind, only where all candidates have the same content."""
    kind = ladder((F.col("event_type") == "purchase", 0), (F.col("event_type") == "view", 1), otherwise=2)
    events = table(spark, sf_dir, "events").select("user_id", "event_id", kind.alias("kind"), F.sha2("props", 256).alias("h"))
    sums = events.groupBy("user_id").agg(F.count("*").alias("candidates"), F.countDistinct("h").alias("hashes"), F.min(F.struct("kind", "event_id")).alias("m"))
    return sums.select("user_id", "candidates", "hashes", F.when(F.col("hashes") == 1, F.col("m.event_id")).alias("chosen"))


@query("SELECT event_type AS source, event_id // 50 AS page, count(*) AS n, count(*) < 10 OR event_id // 50 = (SELECT max(event_id) // 50 FROM events) AS is_last FROM events GROUP BY 1, 2")
def last_pages(spark, sf_dir):
    """A page is the last by its metadata (the number of pages), or because it is short."""
    paged = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.floor(F.col("event_id") / 50).alias("page"))
    total = paged.agg(F.max("page").alias("final"))
    sums = paged.groupBy("source", "page").agg(F.count("*").alias("n"))
    return sums.crossJoin(F.broadcast(total)).select("source", "page", "n", ((F.col("n") < 10) | (F.col("page") == F.col("final"))).alias("is_last"))  # one row of totals


@query("SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 25")
def first_accessions(spark, sf_dir):
    """The feature is a limit: the first 25 records by key."""
    return table(spark, sf_dir, "documents").select("doc_id", "source").orderBy("doc_id").limit(25)


@query("""WITH f AS (SELECT l_suppkey, min(l_orderkey * 8 + l_linenumber) AS seen FROM lineitem GROUP BY 1) SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, dense_rank() OVER (ORDER BY seen, l_suppkey) AS group_no FROM lineitem JOIN f USING (l_suppkey)""")
def group_order(spark, sf_dir):
    """Groups numbered by their first appearance. The numbering sorts one row a group; rows get theirs by a join."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    first = lines.groupBy("l_suppkey").agg(F.min(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seen"))
    numbered = first.select("l_suppkey", F.row_number().over(Window.orderBy("seen", "l_suppkey")).cast("long").alias("group_no"))
    return lines.join(numbered, "l_suppkey")


@query("""SELECT o_orderkey, ntile(4) OVER w AS quarter, round(percent_rank() OVER w, 6) AS pr, round(cume_dist() OVER w, 6) AS cd, count(*) OVER (PARTITION BY o_custkey ORDER BY epoch(o_orderdate)::BIGINT RANGE BETWEEN 7776000 PRECEDING AND CURRENT ROW) AS in_90_days,
    round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS mean_of_3 FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def window_extensions(spark, sf_dir):
    """Extension: ranks, a range of time and a sliding frame over the orders of a customer."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("timestamp").alias("at"))
    w = Window.partitionBy("o_custkey").orderBy("at", "o_orderkey")
    days = Window.partitionBy("o_custkey").orderBy(F.unix_timestamp("at")).rangeBetween(-90 * 86400, 0)
    return o.select(
        "o_orderkey", F.ntile(4).over(w).cast("long").alias("quarter"), F.round(F.percent_rank().over(w), 6).alias("pr"), F.round(F.cume_dist().over(w), 6).alias("cd"),
        F.count("*").over(days).alias("in_90_days"), F.round(F.avg("o_totalprice").over(w.rowsBetween(-2, 0)), 4).alias("mean_of_3"),
    )


@query("""SELECT coalesce(source, 'all') AS source, coalesce(lang, 'all') AS lang, count(*) AS n, count(DISTINCT doc_id) AS docs FROM documents GROUP BY CUBE (source, lang)""")
def cube_counts(spark, sf_dir):
    """Extension: counts over all grains at once."""
    cube = table(spark, sf_dir, "documents").cube("source", "lang").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"))
    return cube.select(F.coalesce("source", F.lit("all")).alias("source"), F.coalesce("lang", F.lit("all")).alias("lang"), "n", "docs")


_BRANCHES = """b AS (SELECT s_suppkey, s_nationkey, s_suppkey % 3 AS modality, s_suppkey % 5 AS chemistry, list_distinct(list(p_brand)) AS files, list_distinct(list(left(p_type, 4))) AS acq FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
    p AS (SELECT x.s_suppkey AS a, y.s_suppkey AS b, CASE WHEN x.modality = y.modality THEN 0.35 ELSE 0.15 END + CASE WHEN x.chemistry = y.chemistry THEN 0.30 ELSE 0.10 END + 0.15 * len(list_intersect(x.acq, y.acq)) / len(list_distinct(x.acq || y.acq))
    + 0.20 * len(list_intersect(x.files, y.files)) / len(list_distinct(x.files || y.files)) AS score FROM b x JOIN b y ON x.s_nationkey = y.s_nationkey AND x.s_suppkey < y.s_suppkey)"""


_CHUNK = 256  # branches of a profile that one row holds


def _branch_profiles(spark, sf_dir):
    """nation, m, c, files, acq (what a score depends on), the branches of which it is true in chunks, and the least of them all."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_partkey").alias("p_partkey"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.substring("p_type", 1, 4).alias("kind"))
    told = lines.join(parts, "p_partkey").groupBy("s_suppkey").agg(F.sort_array(F.collect_set("p_brand")).alias("files"), F.sort_array(F.collect_set("kind")).alias("acq")).join(s, "s_suppkey")
    told = told.where("s_nationkey is not null").withColumns({"m": F.col("s_suppkey") % 3, "c": F.col("s_suppkey") % 5})
    keys = ["s_nationkey", "m", "c", "files", "acq"]
    chunk = F.floor((F.row_number().over(Window.partitionBy(*keys).orderBy("s_suppkey")) - 1) / _CHUNK)
    return told.withColumn("chunk", chunk).groupBy(*keys, "chunk").agg(F.collect_list("s_suppkey").alias("s"), F.min("s_suppkey").alias("first"))


def _profile_pairs(profiles, *kept):
    """Each pair of chunks of a nation once, and each chunk with itself, with the score of their profiles."""
    side = lambda x: profiles.select("s_nationkey", *[F.col(c).alias(f"{c}_{x}") for c in ("m", "c", "files", "acq", "first", *kept)])
    pairs = side("a").join(side("b"), "s_nationkey").where("first_a <= first_b")
    equal = lambda n, yes, no: F.when(F.col(f"{n}_a") == F.col(f"{n}_b"), yes).otherwise(no)
    score = equal("m", 0.35, 0.15) + equal("c", 0.30, 0.10) + 0.15 * jaccard("acq_a", "acq_b") + 0.20 * jaccard("files_a", "files_b")
    return pairs.select("first_a", "first_b", *[f"{c}_{x}" for c in kept for x in "ab"], F.round(score, 6).alias("score"))


@query(f"WITH {_BRANCHES} SELECT a, b, round(score, 6) AS score, round(score, 6) >= 0.72 AS linked FROM p")
def branch_scores(spark, sf_dir):
    """Pairs of branches of one study (suppliers of a nation) with their weighted similarity."""
    pairs = _profile_pairs(_branch_profiles(spark, sf_dir), "s")
    # chunks are few and their pairs are many: rows of chunks are dealt before they become pairs
    dealt = pairs.repartition(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), "first_a", "first_b")
    each = dealt.select("first_a", "first_b", F.explode("s_a").alias("p"), "s_b", "score").select("first_a", "first_b", "p", F.explode("s_b").alias("q"), "score")
    each = each.where("first_a < first_b or p < q")
    return each.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), "score", (F.col("score") >= 0.72).alias("linked"))


@query(f"""WITH RECURSIVE {_BRANCHES}, e AS (SELECT a AS x, b AS y FROM p WHERE round(score, 6) >= 0.72 UNION SELECT b, a FROM p WHERE round(score, 6) >= 0.72),
    r AS (SELECT x AS node, x AS label FROM e UNION SELECT e.y, r.label FROM r JOIN e ON e.x = r.node) SELECT node, min(label) AS component FROM r GROUP BY node""")
def branch_clusters(spark, sf_dir):
    """Branches that a chain of similar ones connects."""
    profiles = _branch_profiles(spark, sf_dir)
    near = _profile_pairs(profiles).where("score >= 0.72").select("first_a", "first_b")
    # chunks that are linked with themselves hold one component each; a branch alone is in none
    own = near.where("first_a = first_b").select(F.col("first_a").alias("first"))
    members = profiles.join(own, "first").select("first", F.explode("s").alias("node"))
    return idn.connected(near.where("first_a < first_b").unionAll(members.where("node != first").select("first", "node")), "first_a", "first_b")


@query("""WITH t AS (SELECT conv_id, turn, list_distinct(list_filter(regexp_split_to_array(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), '[^A-Z0-9]+'), lambda x: x <> '')) AS w FROM conversations)
    SELECT c.conv_id, c.turn, n.turn AS other, round(len(list_intersect(c.w, n.w)) / nullif(least(len(c.w), len(n.w)), 0), 6) AS overlap FROM t c JOIN t n ON c.conv_id = n.conv_id AND n.turn = c.turn + 1""")
def adjacent_overlap(spark, sf_dir):
    """Overlap coefficient of the tokens of each turn and the next."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", tokens("text").alias("t"))
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("turn").alias("other"), F.col("t").alias("u"))
    least = F.nullif(F.least(F.size("t"), F.size("u")), F.lit(0))
    return turns.join(after, ["conv_id", "turn"]).select("conv_id", "turn", "other", F.round(F.size(F.array_intersect("t", "u")) / least, 6).alias("overlap"))
