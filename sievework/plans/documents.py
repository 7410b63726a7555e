"""Walks over nested documents.

Stand-ins on the test tables: an event with its properties and times is a nested JSON document."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import documents as jd
from ..registry import query
from ..sources.tables import table

# an expression that both engines read
_JSON = """concat('{"Event": {"type": "', event_type, '", "Value ": ', CASE WHEN event_type = 'error' THEN '" "' ELSE cast(cast(round(value * 100) AS bigint) AS TEXT) END, '}, "user": {"ID": ', user_id, ', "empty": {}, "blank": " "}, "props": ',
    CASE WHEN user_id % 2 = 0 THEN '{"q": [1, 2]}' ELSE props END, ', "times": ["', event_type, ' at", [', hour(ts), ', {"min": ', minute(ts), '}], []], "bad": ', CASE WHEN event_id % 17 = 0 THEN 'x' ELSE 'null' END, '}')"""
_TREE = f"""d AS (SELECT event_id, {_JSON} AS j FROM events), g AS (SELECT event_id, j::JSON AS j FROM d WHERE json_valid(j)),
    l AS (SELECT event_id, replace(substr(t.fullkey, 3), '"', '') AS path, trim(t.atom ->> '$') AS value FROM g, json_tree(g.j) t WHERE t.atom IS NOT NULL)"""


def documents(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.expr(_JSON.replace("TEXT", "string")).alias("j"))


@query(f"WITH {_TREE} SELECT event_id, path, value FROM l WHERE value <> ''")
def json_leaf_walk(spark, sf_dir):
    """Every scalar of each document, with its path; bad documents have none."""
    return jd.leaves(documents(spark, sf_dir), "j")


@query(f"""WITH {_TREE}, k AS (SELECT event_id, value, CASE WHEN contains(path, 'Value ') THEN 1 WHEN path = 'props.k' THEN 2 WHEN path = 'times[1][1].min' THEN 3 WHEN path = 'user.ID' THEN 4 END AS place FROM l WHERE value <> '')
    SELECT event_id, coalesce(min_by(k.value, place), '') AS value FROM events LEFT JOIN k USING (event_id) GROUP BY event_id""")
def first_registry_value(spark, sf_dir):
    """The first value under any of some names, at any depth."""
    return jd.first_value(documents(spark, sf_dir), ["event_id"], "j", ["id", "K", "value", "min"])
