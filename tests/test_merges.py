"""Folds against plain loops, and the cases that the tables do not hold."""

from sievework import registry
from sievework.operators import merges, verdicts
from sievework.sources import tables
from pyspark.sql import functions as F


def blocks(spark, sf_dir):
    out = {}
    for r in tables.table(spark, sf_dir, "conversations").collect():
        out.setdefault(r.conv_id, {}).setdefault(r.role, []).append((r.turn, r.text))
    return {c: {k: sorted(v) for k, v in roles.items()} for c, roles in out.items()}


def result(picked):
    return len(picked), sum(len(t) for _, t in picked), ",".join(str(n) for n, _ in picked)


def test_balanced_merge(spark, sf_dir):
    got = {r.conv_id: (r.n, r.chars, r.turns) for r in registry.queries()["balanced_merge"](spark, sf_dir).collect()}
    for c, roles in blocks(spark, sf_dir).items():
        queues = [list(roles.get(k, [])) for k in ("assistant", "user", "system")]
        out, used, gave = [], 0, True
        while gave:
            gave = False
            for q in queues:
                while q:
                    x = q.pop(0)
                    if x not in out and used + len(x[1]) + 100 <= 1500:
                        out.append(x)
                        used += len(x[1]) + 100
                        gave = True
                        break
        assert got[c] == result(out), c


def test_quota_merge(spark, sf_dir):
    got = {r.conv_id: (r.n, r.chars, r.turns) for r in registry.queries()["quota_merge"](spark, sf_dir).collect()}
    for c, roles in blocks(spark, sf_dir).items():
        first, second = roles.get("assistant", []), roles.get("user", [])
        out, used, n = [], 0, [0, 0]
        for lane, x in [*((0, x) for x in first), *((1, x) for x in second), *((2, x) for x in first + second)]:
            if (lane == 2 or n[lane] < (3, 1)[lane]) and x not in out and used + len(x[1]) + 100 <= 1500:
                out.append(x)
                used += len(x[1]) + 100
                if lane < 2:
                    n[lane] += 1
        assert got[c] == result(out), c


def test_packetize(spark, sf_dir):
    got = {r.doc_id: r.numbers for r in registry.queries()["packetize"](spark, sf_dir).collect()}
    for d, text in tables.table(spark, sf_dir, "documents").select("doc_id", "text").collect():
        no, used, n, out = 0, 0, 0, []
        for line in text.split("\n"):
            if n and (used + len(line) > 400 or n >= 5):
                no, used, n = no + 1, 0, 0
            used, n = used + len(line), n + 1
            out.append(str(no))
        assert got[d] == ",".join(out)


def test_spread_centers(spark, sf_dir):
    got = {r.doc_id: r.kept for r in registry.queries()["spread_centers"](spark, sf_dir).collect()}
    for d, text in tables.table(spark, sf_dir, "documents").select("doc_id", "text").collect():
        low, kept = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text), []
        for term in ("the", "license", "tion"):
            at = -len(term)
            for _ in range(2):
                at = low.find(term, at + len(term))
                if at < 0:
                    break
                if all(abs(at - k) >= 60 for k in kept):
                    kept.append(at)
        assert got[d] == ",".join(map(str, kept))


def test_under_root(spark):
    rows = [("https://a.b/x/", "https://a.b/x/y"), ("https://a.b/x/", "https://a.b:443/x/"), ("https://a.b/x/", "http://a.b/x/y"), ("https://a.b/x/", "https://a.b:8443/x/y"), ("https://a.b/x/", "https://c.b/x/y"), ("https://a.b/x/", "https://a.b/y")]
    got = spark.createDataFrame(rows, "r string, c string").select(verdicts.under_root("r", "c").alias("x")).collect()
    assert [r.x for r in got] == [True, True, False, False, False, False]


def test_quota_counts_only_what_is_taken(spark):
    df = spark.sql("select array(named_struct('id', 1, 'text', repeat('x', 50)), named_struct('id', 2, 'text', 'a'), named_struct('id', 3, 'text', 'b')) as p, array(named_struct('id', 9, 'text', 'c')) as s")
    got = df.select(merges.quota(F.col("p"), F.col("s"), (1, 1), 20, 1).alias("o")).first().o
    assert [x["id"] for x in got] == [2, 9, 3]


def test_branches_are_scored_by_profile(spark, tmp_path, monkeypatch):
    """Alike branches are linked by one link each, over the edges of chunks too; those without a brand are not alike."""
    from sievework import registry
    from sievework.operators import identity
    from sievework.plans import merges as plans

    monkeypatch.setattr(plans, "_CHUNK", 2)
    linked = []
    connected = identity.connected
    monkeypatch.setattr(identity, "connected", lambda links, a, b: linked.append(links.count()) or connected(links, a, b))
    brands = {s: {"A", "B"} if s < 100 else {"C"} if s < 110 else {None} for s in range(1, 131)}
    nation = {s: s % 2 if s < 120 else None for s in brands}
    part = {"A": 1, "B": 2, "C": 3, None: 4}
    at = str(tmp_path)
    spark.createDataFrame([(s, n) for s, n in nation.items()], "s_suppkey long, s_nationkey int").write.parquet(f"{at}/supplier.parquet")
    spark.createDataFrame([(s, part[b]) for s, bs in brands.items() for b in bs], "l_suppkey long, l_partkey long").write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(p, b, None if b is None else f"{b}KIND") for b, p in part.items()], "p_partkey long, p_brand string, p_type string").write.parquet(f"{at}/part.parquet")

    def score(x, y):
        share = len((brands[x] - {None}) & (brands[y] - {None})) / max(1, len((brands[x] | brands[y]) - {None}))
        return round((0.35 if x % 3 == y % 3 else 0.15) + (0.30 if x % 5 == y % 5 else 0.10) + 0.15 * share + 0.20 * share, 6)

    want = {(x, y): score(x, y) for x in brands for y in brands if x < y and nation[x] is not None and nation[x] == nation[y]}
    got = registry.queries()["branch_scores"](spark, at).collect()
    assert len(got) == len(want) and all(abs(want[r.a, r.b] - r.score) < 2e-6 and r.linked == (r.score >= 0.72) for r in got)
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    near = [(r.a, r.b) for r in got if r.linked]
    for x, y in near:
        x, y = sorted((root(x), root(y)))
        up[y] = x
    monkeypatch.setattr(plans, "_CHUNK", 256)
    clusters = registry.queries()["branch_clusters"](spark, at).collect()
    assert {r.node: r.component for r in clusters} == {x: root(x) for x in list(up)}
    assert linked[-1] < len(near) / 2
