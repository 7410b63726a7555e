"""Text screens: masking, hits with their surroundings, sections, segments of keys.

Stand-ins on the test tables: documents are publications, their first lines are titles. The tables hold invented prose, so the
screen of these queries (PROSE) has function words and mail addresses where `spans.SINGLE_CELL` has the vocabulary of its
field; it has as many rules of each kind. Patterns name their boundaries, since engines differ on what ends a word."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import spans
from ..operators.spans import Rule
from ..registry import query
from ..sources.tables import table

_NEXT = "of and to in is it for on with be as by at are from".split()
PROSE = spans.Screen(
    masks=tuple((f"the_{w}", f"[ \n](?:the|that|this) {w}[ ,.\n]") for w in _NEXT),
    strong=(
        Rule("the_ending_ion", "[ \n]the [a-z]+ion[ ,.\n]", 10),
        Rule("die_ending_ung", "[ \n]die [a-z]+ung[ ,.\n]", 10),
        Rule("mail_of_domain", r"[a-z0-9._]+@[a-z0-9]+\.com", 10),
        Rule("number_and_word", "[0-9]+ [a-z]+", 10),
        Rule("licensed", "(?:Released|[Ll]icensed) under the [A-Z][A-Za-z]+", 9),
        Rule("and_ending_ing", "[ \n]and [a-z]+ing[ ,.\n]", 9, 500),
        Rule("for_then_was", "[ \n]for [^\n]{0,140} was ", 9, 500),
        Rule("que_then_le", "[ \n]que [^.\n]{0,120} le ", 9, 500),
        Rule("con_then_los", "[ \n]con [^.\n]{0,180} los ", 9, 500),
    ),
    weak=(Rule("with", "[ \n](?:with|avec|mit)[ ,.\n]", 3, 320),),
    context="[ \n](?:on|und|sur|por) (?:the|die|la|el)[ ,.\n]",
    title="(?:ing|ung|tion)[ .,]",
    direct=frozenset({"the_ending_ion", "die_ending_ung"}),
    procedural=frozenset({"licensed", "mail_of_domain", "for_then_was"}),
)
_WS = r"[ \t\n\r\f\x0B]+"
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lit(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _pieces(text: str, pattern: str) -> str:
    return f"string_split(regexp_replace({text}, {_lit(f'({pattern})')}, chr(1) || '\\1' || chr(2), 'g'), chr(1))"


def _plain(text: str) -> str:
    return f"translate(coalesce({text}, ''), chr(1) || chr(2), '  ')"


def _masking(source: str, key: str, text: str, name: str) -> str:
    """CTEs: {name}0 is the plain text, {name}k after k masks, with the number of matches so far and their log."""
    steps = [f"{name}0 AS (SELECT {key}, {_plain(text)} AS t, ''::VARCHAR AS log, 0::BIGINT AS n FROM {source})"]
    for k, (kind, pattern) in enumerate(PROSE.masks, 1):
        shown = f"list_transform(p[2:], lambda x: '{kind}:' || trim(regexp_replace(string_split(x, chr(2))[1], '{_WS}', ' ', 'g')) || ';')"
        steps.append(
            f"""{name}{k} AS (SELECT {key}, p[1] || array_to_string(list_transform(p[2:], lambda x: repeat(' ', length(string_split(x, chr(2))[1])) || string_split(x, chr(2))[2]), '') AS t,
                log || array_to_string({shown}, '') AS log, n + len(p) - 1 AS n FROM (SELECT *, {_pieces("t", pattern)} AS p FROM {name}{k - 1}))"""
        )
    return ", ".join(steps)


def _screening(source: str, key: str, text: str, title: str) -> str:
    """CTEs up to `verdicts`: what spans.screened() gives for the rows of `source`."""
    last, rules = len(PROSE.masks), [*PROSE.strong, *PROSE.weak]
    kinds = [(i, r.pattern) for i, r in enumerate(rules)] + [(-1, PROSE.context)]
    places = " UNION ALL ".join(f"SELECT {key}, {i} AS rule, {_pieces('t', p)} AS p FROM m{last}" for i, p in kinds)
    table_of = ", ".join(f"({i}, '{r.kind}', {r.score}, {i < len(PROSE.strong)}, {r.near}, {r.near or PROSE.around}, {r.kind in PROSE.direct}, {r.kind in PROSE.procedural})" for i, r in enumerate(rules))
    prefix = f"lower(substr(trim(regexp_replace(substr(t, greatest(pos - around, 0) + 1, \"to\" + around - greatest(pos - around, 0)), '{_WS}', ' ', 'g')), 1, {PROSE.told_by}))"
    return f"""{_masking(source, key, text, "m")}, {_masking(source, key, title, "h")},
    rules(rule, kind, score, strong, near, around, direct, procedural) AS (VALUES {table_of}),
    cut AS (SELECT {key}, rule, i, p[i] AS piece FROM ({places}), unnest(range(1, len(p) + 1)) AS u(i)),
    sums AS (SELECT *, string_split(piece, chr(2))[1] AS match, sum(length(piece) - (i > 1)::INT) OVER (PARTITION BY {key}, rule ORDER BY i) - (length(piece) - (i > 1)::INT) AS pos FROM cut),
    found AS (SELECT {key}, rule, pos::BIGINT AS pos, (pos + length(match))::BIGINT AS "to", trim(regexp_replace(match, '{_WS}', ' ', 'g')) AS match FROM sums WHERE i > 1),
    ok AS (SELECT f.*, r.* EXCLUDE rule, t FROM found f JOIN rules r USING (rule) JOIN m{last} USING ({key})
           WHERE near = 0 OR EXISTS (SELECT 1 FROM found c WHERE c.rule = -1 AND c.{key} = f.{key} AND c.pos >= f.pos - near AND c."to" <= f."to" + near)),
    hits AS (SELECT DISTINCT {key}, kind, score, strong, direct, procedural, lower(match), {prefix} FROM ok),
    titles AS (SELECT m.{key}, m.n + h.n AS n_masked, regexp_matches(h.t, {_lit(PROSE.title)}) AS title_hit FROM m{last} m JOIN h{last} h USING ({key})),
    counts AS (SELECT t.{key}, n_masked, title_hit, count(*) FILTER (strong) AS n_strong, count(*) FILTER (strong AND direct) AS n_direct, count(*) FILTER (strong AND procedural) AS n_procedural,
                      count(*) FILTER (strong AND NOT direct AND NOT procedural) AS n_contextual, count(*) FILTER (NOT strong) AS n_weak, coalesce(max(score) FILTER (strong), 0) AS best
               FROM titles t LEFT JOIN hits USING ({key}) GROUP BY ALL),
    tiers AS (SELECT *, CASE WHEN title_hit OR n_procedural > 0 THEN 'high' WHEN n_direct >= 2 OR (n_direct > 0 AND n_contextual > 0) THEN 'moderate' WHEN n_strong > 0 OR n_weak > 0 THEN 'weak' ELSE 'none' END AS tier FROM counts),
    verdicts AS (SELECT * EXCLUDE best, CASE tier WHEN 'high' THEN 'yes' WHEN 'moderate' THEN 'uncertain' WHEN 'weak' THEN 'weak' ELSE 'no' END AS verdict,
                        (CASE WHEN title_hit THEN greatest(best, {PROSE.title_score}) ELSE best END)::BIGINT AS max_score FROM tiers)"""


@query(f"WITH {_masking('documents', 'doc_id', 'text', 'm')} SELECT doc_id, length(t)::BIGINT AS n_chars, md5(t) AS masked_md5, n AS n_masked, log FROM m{len(PROSE.masks)}")
def false_friend_masking(spark, sf_dir):
    """Texts with their false friends blanked, every other character in place, and what was masked, in order."""
    docs = spans.masked(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", PROSE.masks)
    log = F.array_join(F.transform("masked_hits", lambda h: F.concat(h["kind"], F.lit(":"), h["match"], F.lit(";"))), "")
    return docs.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("masked_md5"), F.size("masked_hits").cast("long").alias("n_masked"), log.alias("log"))


@query(f"WITH {_screening('documents', 'doc_id', 'text', 'split_part(text, chr(10), 1)')} SELECT * FROM verdicts")
def publication_hits(spark, sf_dir):
    """Hits of all rules, distinct by their surroundings, in each document, and the tier they give it."""
    return spans.screened(table(spark, sf_dir, "documents"), ["doc_id"], "text", F.substring_index("text", "\n", 1), PROSE)


_OFF, _ON = r"[A-M][a-z]*(?: [a-z]+)?\.", r"[N-Z][a-z]*(?: [a-z]+)?\."


@query(rf"""WITH l AS (SELECT doc_id, {_plain("text")} AS t, string_split({_plain("text")}, chr(10)) AS lines FROM documents),
    e AS (SELECT doc_id, t, i, lines[i] AS line, (sum(length(lines[i]) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(lines[i]) - 1)::BIGINT AS pos FROM l, unnest(range(1, len(lines) + 1)) AS u(i)),
    k AS (SELECT *, CASE WHEN regexp_full_match(line, '[ \t]*{_OFF}[ \t]*') AND pos >= floor(length(t) * 0.2) THEN 0 WHEN regexp_full_match(line, '[ \t]*{_ON}[ \t]*') THEN 1 END AS turn FROM e),
    s AS (SELECT *, coalesce(last_value(turn IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i), 1) AS state FROM k),
    b AS (SELECT *, sum((state <> coalesce(was, 1))::INT) OVER (PARTITION BY doc_id ORDER BY i) AS block FROM (SELECT *, lag(state) OVER (PARTITION BY doc_id ORDER BY i) AS was FROM s)),
    p AS (SELECT doc_id, block, min(i) AS i, regexp_replace(string_agg(line, chr(10) ORDER BY i), '{_WS}$', '') AS part, bool_or(pos > 0 OR line <> '') AS filled FROM b WHERE state = 1 GROUP BY doc_id, block),
    j AS (SELECT doc_id, string_agg(part, chr(10) ORDER BY i) FILTER (filled) AS kept FROM p GROUP BY doc_id), r AS (SELECT doc_id, bool_or(state = 0) AS removed FROM s GROUP BY doc_id)
    SELECT l.doc_id, removed, md5(CASE WHEN removed THEN regexp_replace(regexp_replace(coalesce(kept, ''), '^{_WS}', ''), '{_WS}$', '') ELSE t END) AS kept_md5,
           length(CASE WHEN removed THEN regexp_replace(regexp_replace(coalesce(kept, ''), '^{_WS}', ''), '{_WS}$', '') ELSE t END)::BIGINT AS n_kept FROM l JOIN r USING (doc_id) LEFT JOIN j USING (doc_id)""")
def reference_sections(spark, sf_dir):
    """Texts without what lies between a heading that turns off and one that turns on again. Headings here are lines of one or
    two words, by their first letter."""
    docs = spans.without_sections(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", spans.heading_line(_OFF).replace("i", "", 1), spans.heading_line(_ON).replace("i", "", 1))
    return docs.select("doc_id", "removed", F.md5("text").alias("kept_md5"), F.length("text").cast("long").alias("n_kept"))


_KEY = "[ \n](?:que|with|nicht)[ ,.\n]"
_LABEL = "[a-z]+(?:tion|ung)[^;\n]{0,160} {key}[ ,.]|{key}[ ,]+[a-z]+ing"
_SCOPE = "(?:[0-9]+ |sch|[a-z]+ble )"
_SEGMENTS = f"""c AS (SELECT doc_id, {_plain("text")} AS t, {_pieces(_plain("text"), _KEY)} AS p FROM documents),
    u AS (SELECT doc_id, t, i - 1 AS no, string_split(p[i], chr(2))[1] AS match, (sum(length(p[i]) - (i > 1)::INT) OVER (PARTITION BY doc_id ORDER BY i) - length(p[i]) + (i > 1)::INT)::BIGINT AS pos FROM c, unnest(range(1, len(p) + 1)) AS x(i)),
    v AS (SELECT *, lag(pos + length(match)) OVER w AS before, lead(pos) OVER w AS behind FROM u WHERE no > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY no)),
    g AS (SELECT doc_id, no, upper(match) AS mention, greatest(coalesce(before, 0), pos - 500) AS a, least(coalesce(behind, length(t)), pos + length(match) + 500) AS b, t FROM v),
    segments AS (SELECT doc_id, no, mention, trim(regexp_replace(substr(t, a + 1, b - a), '{_WS}', ' ', 'g')) AS segment FROM g)"""


@query(f"""WITH {_SEGMENTS}, k AS (SELECT *, lower(trim(regexp_replace(mention, '[^A-Z]', '', 'g'))) AS key FROM segments)
    SELECT doc_id, no, key, segment, len(regexp_extract_all(segment, replace({_lit(_LABEL)}, '{{key}}', key)))::BIGINT AS n_mapped, regexp_matches(segment, {_lit(_SCOPE)}) AS out_of_scope FROM k""")
def target_mapping(spark, sf_dir):
    """Each mention's segment, what a pattern made of its own key finds in it, and whether it speaks of another scope."""
    found = spans.key_segments(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", _KEY)
    found = spans.once(found, no=F.col("no"), key=F.lower(F.regexp_replace("mention", "[^A-Z]", "")), segment=F.col("segment"))
    return found.select("doc_id", "no", "key", "segment", spans.mapped("segment", "key", _LABEL).cast("long").alias("n_mapped"), F.col("segment").rlike(_SCOPE).alias("out_of_scope"))


@query(f"""WITH {_SEGMENTS}, rows_of AS (SELECT doc_id || '/' || no AS id, segment FROM segments), {_screening("rows_of", "id", "segment", "''")},
    s AS (SELECT split_part(id, '/', 1)::BIGINT AS doc_id, v.* FROM verdicts v)
    SELECT doc_id, count(*) AS n_segments, sum(n_strong)::BIGINT AS n_strong, sum(n_direct)::BIGINT AS n_direct, sum(n_procedural)::BIGINT AS n_procedural, sum(n_contextual)::BIGINT AS n_contextual, sum(n_weak)::BIGINT AS n_weak, sum(n_masked)::BIGINT AS n_masked FROM s GROUP BY doc_id""")
def segment_scores(spark, sf_dir):
    """The classes of hits in the segments of a document's keys: text of one key counts for no other."""
    found = spans.key_segments(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", _KEY)
    found = spans.screened(found, ["doc_id", "no"], "segment", F.lit(""), PROSE)
    names = ["n_strong", "n_direct", "n_procedural", "n_contextual", "n_weak", "n_masked"]
    return found.groupBy("doc_id").agg(F.count("*").alias("n_segments"), *[F.sum(n).alias(n) for n in names])


_ROLES = [("carrier", "[a-z]+tion"), ("reference", "[a-z]+ung"), ("blank", "[0-9]+"), ("single", "[a-z]+ing")]
_ROLE_PIECES = " UNION ALL ".join(f"SELECT doc_id, {i} AS role, {_pieces(_plain('text'), p)} AS p FROM documents" for i, (_, p) in enumerate([("", _KEY), *_ROLES], -1))


@query(f"""WITH c AS (SELECT doc_id, role, i, p[i] AS piece FROM ({_ROLE_PIECES}), unnest(range(1, len(p) + 1)) AS u(i)),
    s AS (SELECT doc_id, role, i - 1 AS no, string_split(piece, chr(2))[1] AS match, (sum(length(piece) - (i > 1)::INT) OVER (PARTITION BY doc_id, role ORDER BY i) - length(piece) + (i > 1)::INT)::BIGINT AS pos FROM c),
    e AS (SELECT *, pos + length(match) AS stop FROM s WHERE no > 0),
    m AS (SELECT e.*, coalesce(lag(stop) OVER w, 0) AS before, coalesce(lead(pos) OVER w, length({_plain("text")})) AS behind FROM e JOIN documents USING (doc_id) WHERE role = -1 WINDOW w AS (PARTITION BY doc_id ORDER BY no)),
    f AS (SELECT m.doc_id, m.no, 1 AS side, r.pos - m.stop AS distance, r.role FROM m JOIN e r ON r.doc_id = m.doc_id AND r.role >= 0 AND r.pos >= m.stop AND r.stop <= least(m.stop + 150, behind)
          UNION ALL SELECT m.doc_id, m.no, 2, m.pos - r.stop, r.role FROM m JOIN e r ON r.doc_id = m.doc_id AND r.role >= 0 AND r.stop <= m.pos AND r.pos >= greatest(m.pos - 150, before)),
    b AS (SELECT doc_id, no, min((side, distance, role)) AS best FROM f GROUP BY ALL)
    SELECT doc_id, no, match AS member, {[n for n, _ in _ROLES]}[best[3] + 1] AS role, best[2]::BIGINT AS distance, CASE best[1] WHEN 1 THEN 'after' WHEN 2 THEN 'before' END AS side FROM m LEFT JOIN b USING (doc_id, no)""")
def nearest_roles(spark, sf_dir):
    """The role next to each mention, never across another mention."""
    return spans.nearest_roles(table(spark, sf_dir, "documents"), ["doc_id"], "text", _KEY, _ROLES)
