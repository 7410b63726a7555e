"""Joins of loosely written values.

Stand-ins on the test tables: lines of benchmark items are an inventory's names, lines of documents are the values that mention
them; documents carry passages of items, whole and in pieces."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import containment
from ..registry import query
from ..sources.tables import table

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_LINES = "SELECT DISTINCT unnest(string_split(text, chr(10))) AS {n} FROM {t}"
_KEY = "regexp_replace(translate({c}, " + _AZ + "), '[^a-z0-9]', '', 'g')"


@query(f"""WITH names AS (SELECT name, translate(name, {_AZ}) AS low, {_KEY.format(c="name")} AS normal FROM ({_LINES.format(n="name", t="benchmark")})),
    vals AS (SELECT value, {_KEY.format(c="value")} AS normal, list_distinct(list_filter(regexp_extract_all(translate(value, {_AZ}), '[a-z0-9]{{4,}}'), lambda x: NOT regexp_full_match(x, '[0-9]+'))) AS toks FROM ({_LINES.format(n="value", t="documents")})),
    ones AS (SELECT normal, min(name) AS one FROM names WHERE normal <> '' GROUP BY normal HAVING count(*) = 1),
    f AS (SELECT v.*, n.name, o.one FROM vals v LEFT JOIN names n ON n.name = v.value LEFT JOIN ones o ON o.normal = v.normal),
    k AS (SELECT value, count(*) AS n_held, min(c.name) AS held_by FROM f JOIN names c ON list_bool_and(list_transform(toks, lambda x: contains(c.low, x))) WHERE f.name IS NULL AND one IS NULL AND len(toks) > 0 GROUP BY value)
    SELECT md5(value) AS value_md5, CASE WHEN name IS NOT NULL THEN 'exact' WHEN one IS NOT NULL THEN 'normalized' WHEN n_held = 1 THEN 'composite' WHEN n_held > 1 THEN 'ambiguous' ELSE 'none' END AS method,
           md5(coalesce(name, one, CASE WHEN n_held = 1 THEN held_by END)) AS name_md5, CASE WHEN name IS NOT NULL OR one IS NOT NULL THEN 1 ELSE coalesce(n_held, 0) END::BIGINT AS n_candidates
    FROM f LEFT JOIN k USING (value)""")
def join_evidence(spark, sf_dir):
    """Every distinct line of the documents, and the item line that it names: exactly, by its normal form, or by all its long
    tokens; several such lines are counted and none is chosen."""
    lines = lambda name: table(spark, sf_dir, name).select(F.explode(F.split("text", "\n")).alias("line"))
    found = containment.settled(lines("documents"), lines("benchmark"), "line", "line")
    return found.select(F.md5("value").alias("value_md5"), "method", F.md5("name").alias("name_md5"), "n_candidates")
