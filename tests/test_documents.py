"""Walks over JSON against plain recursion."""

import json
import re

from sievework.operators import documents as jd

TEXTS = [
    '{"b": [1, {"c": null, "d": " x  y "}, [], [[2.5]]], "a": {"x": "t", "y": {}}, "w": true, "k.l": "q", "é": "ü"}', '[1, "2", {"Name": ""}, {"NAME": "n"}]', "5", '"text"', "null", "", "bad", "{}", None,
    '{"z": {"name": "deep"}, "na-me": "own", "list": [{"id": "i"}]}', '{"a": {"b": {"c": {"d": {"name": "too deep"}}}}, "id": "  "}', '{"n": 12345678901234567890, "m": -0.25}',
]


def walk(node, path="", steps=(), key="", depth=0, most=jd.DEPTH):
    if isinstance(node, dict) and depth < most:
        for k in sorted(node):
            yield from walk(node[k], f"{path}.{k}" if path else k, (*steps, k), k, depth + 1, most)
    elif isinstance(node, list) and depth < most:
        for i, x in enumerate(node):
            yield from walk(x, f"{path}[{i}]", (*steps, f"{i:010d}"), key, depth + 1, most)
    elif not isinstance(node, (dict, list)) and node is not None:
        value = re.sub(r"\s+", " ", str(node).lower() if isinstance(node, bool) else str(node)).strip()
        if value:
            yield path, steps, key, value


def parsed(text):
    try:
        return json.loads(text)
    except (TypeError, ValueError):
        return None


def test_leaves(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, j string").repartition(3)
    for depth in (jd.DEPTH, 2):
        got = sorted((r.id, r.path, r.value) for r in jd.leaves(df, "j", depth).collect())
        assert got == sorted((i, p, v) for i, t in enumerate(TEXTS) for p, _, _, v in walk(parsed(t), most=depth))


def test_first_value(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, j string")
    names = ["name", "I_D"]
    want = {}
    for i, t in enumerate(TEXTS):
        found = [(s[:-1], [jd.norm_key_of(n) for n in names].index(jd.norm_key_of(k)), s, v) for _, s, k, v in walk(parsed(t)) if jd.norm_key_of(k) in ("name", "id")]
        want[i] = min(found)[3] if found else ""
    assert {r.id: r.value for r in jd.first_value(df, ["id"], "j", names).collect()} == want
    assert want[9] == "own" and want[1] == "n" and want[10] == "too deep"
