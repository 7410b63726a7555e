"""Queries over all rows of their tables, against SQL without filters or plain Python."""

import hashlib
import random

import duckdb
import pytest

from sievework import registry
from sievework.operators import claims, identity
from sievework.sources import tables
from tests.test_queries import plain

PAIRS = """WITH m AS (SELECT DISTINCT l_suppkey AS o, l_partkey AS i FROM lineitem), n AS (SELECT o, count(*) AS n FROM m GROUP BY o),
    p AS (SELECT x.o AS a, y.o AS b, count(*) AS shared FROM m x JOIN m y ON x.i = y.i AND x.o < y.o GROUP BY ALL),
    q AS (SELECT a, b, shared, na.n AS n_a, nb.n AS n_b FROM p JOIN n na ON na.o = a JOIN n nb ON nb.o = b)"""
WHOLE = {
    "pair_overlap_relations": f"{PAIRS} SELECT a, b, shared, round(shared / (n_a + n_b - shared), 6) AS jaccard, CASE WHEN shared / (n_a + n_b - shared) >= 0.2 THEN 'duplicate' WHEN shared / least(n_a, n_b) >= 0.3 THEN 'same_study' ELSE 'related' END AS relation FROM q",
    "containment_relations": f"{PAIRS} SELECT a, b, shared, round(shared / least(n_a, n_b), 6) AS containment, CASE WHEN n_a <= n_b THEN a ELSE b END AS contained FROM q WHERE shared >= 2 AND shared / least(n_a, n_b) >= 0.25",
    "nearby_values": "SELECT s_nationkey AS nation, s_suppkey, c_custkey FROM supplier JOIN customer ON s_nationkey = c_nationkey WHERE abs(s_acctbal - c_acctbal) <= 50",
}


@pytest.mark.parametrize("name", sorted(WHOLE))
def test_whole_table(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("lineitem", "supplier", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    assert plain(registry.queries()[name](spark, sf_dir).toPandas()) == plain(con.execute(WHOLE[name]).df())


def test_nearby_values_over_a_bucket_edge(spark, tmp_path):
    spark.createDataFrame([(1, 1, 499.0), (1, 2, -1.0), (2, 3, 499.0)], "s_nationkey long, s_suppkey long, s_acctbal double").write.parquet(str(tmp_path / "supplier.parquet"))
    spark.createDataFrame([(1, 1, 501.0), (1, 2, 1.0), (1, 3, 560.0), (1, 4, 450.0)], "c_nationkey long, c_custkey long, c_acctbal double").write.parquet(str(tmp_path / "customer.parquet"))
    got = registry.queries()["nearby_values"](spark, str(tmp_path)).collect()
    assert sorted((r.s_suppkey, r.c_custkey) for r in got) == [(1, 1), (1, 4), (2, 2)]


@pytest.mark.parametrize("least, percent", [(1, 0), (2, 0), (2, 25), (1, 60), (3, 100)])
def test_set_relations(spark, least, percent):
    """Sets of many sizes with items that nearly all have, against all pairs."""
    rng = random.Random(1)
    sets = {o: {i for i in range(30) if rng.random() < (0.95 if i < 3 else 0.02 * (o % 20))} for o in range(60)}
    rows = [(o, i) for o, s in sets.items() for i in s for _ in range(1 + i % 2)] + [(None, 1), (1, None)]
    got = claims.set_relations(spark.createDataFrame(rows, "o long, i long"), "o", "i", least, percent).collect()
    size = {o: len(s) + (o == 1) for o, s in sets.items()}  # a null counts in the size, and is never shared
    want = [(a, b, n, size[a], size[b]) for a, s in sets.items() for b, t in sets.items() if a < b and (n := len(s & t)) >= least and 100 * n >= percent * min(size[a], size[b])]
    assert sorted((r.a, r.b, r.shared, r.n_a, r.n_b) for r in got) == sorted(want)


def test_component_keys_are_hashed_in_buckets(spark):
    labels = spark.createDataFrame([(i, 0) for i in range(3000)] + [(5000, 5000), (5001, 5000)], "node long, component long")
    keys = lambda df, **k: {r.component: (r.n, r.key) for r in identity.component_key(df, **k).collect()}
    got = keys(labels)
    assert {c: n for c, (n, _) in got.items()} == {0: 3000, 5000: 2} and keys(labels.repartition(7, "node")) == got
    assert keys(labels.where("node != 17"))[0][1] != got[0][1]
    assert keys(labels, buckets=2)[0][1] != got[0][1]


def test_a_fingerprint_gathers_no_set(spark):
    rows = [(g, f"{i % 700}x") for g in ("a", "b", None) for i in range(1000)] + [("c", "")]
    df = identity.ordered_digest(spark.createDataFrame(rows, "g string, i string").repartition(5), "g", "i")
    of = lambda items: hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    all_of = of({f"{i}x" for i in range(700)})
    assert {r.g: r.fingerprint for r in df.collect()} == {"a": all_of, "b": all_of, None: all_of, "c": of([""])}
    assert "collect_set" not in registry.queries()["set_fingerprint"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()


def test_components_of_all_lines(spark, sf_dir):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for o, p in tables.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").collect():
        x, y = sorted((root(o * 2), root(p * 2 + 1)))
        up[y] = x
    got = {r.node: r.component for r in registry.queries()["connected_components"](spark, sf_dir).collect()}
    assert got == {x: root(x) for x in list(up)}


@pytest.mark.parametrize("block", [2, 1024])
def test_alike_sets_are_counted_where_they_meet(spark, monkeypatch, block):
    """Alike sets meet list by list; sets that mostly share common items still go through the prefix filter."""
    monkeypatch.setattr(claims, "BLOCK", block)
    rng = random.Random(2)
    alike = {o: set(rng.sample(range(40), 20)) for o in range(30)}
    common = {o: {0, 1, 100 + o // 2, 500 + o // 2, 900 + o} for o in range(120)}
    for sets, least, lists in ((alike, 2, True), (common, 3, False)):
        df = claims.set_relations(spark.createDataFrame([(o, i) for o, s in sets.items() for i in s], "o long, i long"), "o", "i", least, 25)
        assert ("owners" in df._jdf.queryExecution().optimizedPlan().toString()) is lists
        want = [(a, b, n, len(s), len(t)) for a, s in sets.items() for b, t in sets.items() if a < b and (n := len(s & t)) >= least and 100 * n >= 25 * min(len(s), len(t))]
        assert sorted(tuple(r) for r in df.select("a", "b", "shared", "n_a", "n_b").collect()) == sorted(want)


def test_links_shrink_by_rounds(spark, monkeypatch):
    """Chains in either order, a hub with the greatest number, a loop and nulls; rounds write far less than the links each."""
    seen = []
    settled = identity._settled
    monkeypatch.setattr(identity, "_settled", lambda df: seen.append(settled(df)) or seen[-1])
    rng = random.Random(3)
    dense = [(2 * o, 2 * rng.randrange(50) + 1) for o in range(400) for _ in range(8)]
    links = [(i, i + 1) for i in range(10_000, 10_100)] + [(20_999, i) for i in range(20_000, 20_100)] + [(5_000, 5_000), (None, 1), (1, None)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for x, y in dense + links[:-2]:
        x, y = sorted((root(x), root(y)))
        up[y] = x
    got = identity.connected(spark.createDataFrame(dense + links, "a long, b long"), "a", "b").collect()
    assert len(got) == len(up) and {r.node: r.component for r in got} == {x: root(x) for x in list(up)}
    of_links = [df.count() for df in seen if "x" in df.columns]
    assert of_links[0] > 3000 and sum(of_links[1:]) < of_links[0] / 4
