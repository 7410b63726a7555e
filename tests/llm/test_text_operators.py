"""Mixing, near-duplicates, quality rules and decontamination against plain Python versions."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievework.llm import components, decontaminate, minhash, mixing, quality, shared


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def shingles(t, k):
    w = words(lower(t))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_duplicates(rows, k=4):
    sets = [(d, shingles(t, k)) for d, t in rows]
    up = {d: d for d, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(d), root(e)))
                up[y] = x
    return sorted((d, len(s), root(d), d == root(d)) for d, s in sets)


@pytest.mark.parametrize("which", ["odd", "sf"])
def test_near_duplicates(spark, odd, sf_dir, which):
    docs = odd if which == "odd" else shared.table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in minhash.near_duplicates(docs).collect())
    assert got == brute_duplicates(rows)


def test_near_duplicates_in_a_crowd(spark):
    """A bucket's smallest member that is similar to few of the others does not hide their links."""
    base = [f"w{i}" for i in range(100)]
    rows = [(n, " ".join(base[:n] + [f"v{n}"] + base[n + 1 :] if n % 3 else base[n:] + base[:n])) for n in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in minhash.near_duplicates(docs).collect()) == brute_duplicates(rows)


def test_near_duplicates_of_unlike_members(spark):
    """Documents that share most of a template are no links; the near copies among them are, whatever their bucket's pivot."""
    template = [f"t{i}" for i in range(150)]
    rows = [(n, " ".join(template + [f"own{n % 45}-{i}" for i in range(40)] + [f"end{n}"])) for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in minhash.near_duplicates(docs).collect())
    assert got == brute_duplicates(rows) and len({r[2] for r in got}) == 45


def test_near_duplicates_of_nothing(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0


def test_drop_near_duplicates_keeps_one(odd):
    kept = minhash.drop_near_duplicates(odd, size=4)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {0, 9, 4, 5, 6, 15} <= set(ids) and not {1, 2, 3, 8, 16} & set(ids)


def stage_rows(spark):
    from tests.llm.conftest import prose

    a, b, c, d = (prose(i, 60) for i in (900, 901, 902, 903))
    rows = [(None, a), (None, b), (None, b), (7, c), (7, d), (3, c), (None, d), (None, None), (8, None)]
    return a, b, c, d, spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, row int")


def test_drop_near_duplicates_decides_on_rows(spark):
    a, b, c, d, docs = stage_rows(spark)
    got = sorted(((r.doc_id, r.text) for r in minhash.drop_near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, a), (None, b), (3, c), (7, d), (None, None), (8, None)], key=str)


def test_drop_near_duplicates_with_clashing_names_and_large_ids(spark):
    """Columns named like the operator's own, ids from 2^62 on, rows that repeat all."""
    from tests.llm.conftest import prose

    names = "id several row doc d a b name copies first odd_id component_id u v n".split()
    near = prose(910, 80).split()
    texts = {(1 << 62) + 1: " ".join(near), (1 << 62) + 3: " ".join(near[:-1] + ["other"]), (1 << 63) - 1: prose(911, 60), 5: prose(912, 70), None: prose(913, 70)}
    rows = [(k, t, *range(len(names))) for k, t in texts.items()] + [(5, texts[5], *range(len(names)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    got = minhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted((r for r in rows[:-1] if r[0] != (1 << 62) + 3), key=str)


def test_drop_contaminated_decides_on_texts(spark):
    a, b, c, d, docs = stage_rows(spark)
    items = spark.createDataFrame([(1, b), (2, c)], "item_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in decontaminate.drop_contaminated(docs, items).collect()), key=str)
    assert got == sorted([(None, a), (7, d), (None, d), (None, None), (8, None)], key=str)


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 140), 100), 200: 200, 201: 200}


def test_sketch_bound_grows_with_distance():
    assert minhash.sketch_bound(0.95) < minhash.sketch_bound(0.8) < minhash.SKETCH_BITS / 2


def brute_quality(t):
    w = words(t)
    n = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (t or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit)


@pytest.mark.parametrize("which", ["odd", "sf"])
def test_quality_measures(spark, odd, sf_dir, which):
    docs = odd if which == "odd" else shared.table(spark, sf_dir, "documents")
    for r in quality.quality_verdicts(docs).collect():
        want = brute_quality(r.doc.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc.doc_id
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed and not r.failed_rules)


def test_quality_runs_no_python(odd):
    plan = quality.quality_verdicts(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_quality_filter_measures_each_text_once(odd):
    """The optimizer must not copy the measures into a filter below them."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    verdicts, kept = plan(quality.quality_verdicts(odd)), plan(quality.keep_good(odd))
    assert all(kept.count(f) == verdicts.count(f) for f in ("split(", "xxhash64(", "regexp_replace("))


def test_quality_keeps_columns_and_agrees_with_labels(spark, sf_dir, no_docs):
    docs = shared.table(spark, sf_dir.replace("0.001", "0.01"), "documents")
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and quality.keep_good(no_docs).count() == 0
    verdicts = quality.quality_verdicts(docs).where("not base_failed").select("doc.doc_id", F.col("kept").cast("int").alias("k"))
    labels = shared.table(spark, sf_dir.replace("0.001", "0.01"), "labels")
    same, n = verdicts.join(labels, "doc_id").agg(F.sum((F.col("k") == F.col("quality")).cast("int")), F.count("*")).first()
    assert same >= 0.97 * n


def brute_contamination(docs, items, size=13):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = {}
    for i, t in items:
        w = split(t)
        for x in [tuple(w[j : j + size]) for j in range(len(w) - size + 1)] or ([tuple(w)] if w else []):
            windows.setdefault(x, set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if got := windows.get(tuple(w[j : j + n])):
                    found |= got
                    hit |= set(range(j, j + n))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out)


def bench_of(spark, odd_rows):
    w = [r for r in odd_rows if r[0] == 9][0][1].split()
    rows = [(1, " ".join(w[100:130])), (2, " ".join(w[110:135]).upper()), (3, "ONE, two!"), (4, None), (5, "..."), (6, "nowhere to be found in here"), (7, " ".join(w[100:130])), (10, "x"), (7, " ".join(w[2000:2013]))]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block", [500_000, 7])
def test_contamination(spark, odd, block):
    from tests.llm.conftest import odd_texts

    items = bench_of(spark, odd_texts())
    got = sorted(tuple(r) for r in decontaminate.contamination_report(odd, items, block_windows=block).collect())
    assert got == brute_contamination([r[:2] for r in odd_texts()], [tuple(r) for r in items.collect()])


def test_contamination_of_the_tables(spark, sf_dir):
    docs, items = (shared.table(spark, sf_dir.replace("0.001", "0.01"), t) for t in ("documents", "benchmark"))
    got = sorted(tuple(r) for r in decontaminate.contamination_report(docs, items).collect())
    want = brute_contamination([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == want and any(r[5] for r in got)


def test_decontamination_of_nothing(spark, odd, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.contamination_report(odd, none).collect())
    assert decontaminate.contamination_report(no_docs, none).count() == 0
    assert decontaminate.drop_contaminated(odd, none).count() == odd.count()


def brute_mix(rows, weights, seed=17):
    n = Counter(s for _, s in rows)
    rest = sum(c for s, c in n.items() if s not in weights)
    given = sum(weights.values())
    out = []
    for d, s in rows:
        share = weights[s] / max(1, given) if s in weights else max(0, 1 - given) * n[s] / rest
        rate = share * len(rows) / n[s]
        u = int(hashlib.md5(f"{seed}:{d}".encode()).hexdigest()[:13], 16) / 16**13
        k, at = 0, math.exp(-rate)
        while at <= u:
            k += 1
            at += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        out += [(d, i) for i in range(k)]
    return sorted(out)


def test_mixing(odd, no_docs):
    weights = {"a": 0.2, "b": 0.7}
    mixed = mixing.mix(odd, weights)
    assert mixed.columns == [*odd.columns, "copy_no", "sort_key"]
    rows = mixed.collect()
    assert sorted((r.doc_id, r.copy_no) for r in rows) == brute_mix([(r.doc_id, r.source) for r in odd.collect()], weights)
    assert [r.sort_key for r in rows] == sorted(r.sort_key for r in rows)
    assert mixing.mix(no_docs, weights).count() == 0 and mixing.mix(odd, {}).count() > 0


def test_mixing_of_clashing_names(spark):
    docs = spark.createDataFrame([(1, "x", 5, "k", "s"), (2, "y", 6, "k", "s")], "doc_id long, text string, copy_no int, sort_key string, salt string").selectExpr("*", "'a' as source")
    out = mixing.mix(docs, {"a": 1.0}, total=60.0)
    assert out.columns == ["doc_id", "text", "salt", "source", "copy_no", "sort_key"] and out.where("salt = 's' and sort_key != 'k'").count() == out.count() > 20
    kept = mixing.mixed_documents(docs)
    assert kept.columns == docs.columns and all(r.sort_key == "k" and r.copy_no == 4 + r.doc_id for r in kept.collect())


def test_mixing_of_large_rates(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit("t").alias("text"))
    n = [r["count"] for r in mixing.mix(docs, {"a": 1.0}, total=40 * 500.0).groupBy("doc_id").count().collect()]
    mean = sum(n) / len(n)
    assert len(n) == 40 and abs(mean - 500) < 18 and 200 < sum((x - mean) ** 2 for x in n) / 39 < 1000


def test_mixing_meets_the_weights(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    got = dict(mixing.mix(docs, {"hot": 0.6, "s1": 0.1}).groupBy("source").count().collect())
    assert abs(got["hot"] - 12000) < 450 and abs(got["s1"] - 2000) < 200 and abs(sum(got.values()) - 20000) < 600


def test_small_tables_have_few_files(spark, monkeypatch):
    """Tables on the way of near-duplicates have files by what they hold, however many partitions a shuffle has."""
    many = 4 * spark.sparkContext.defaultParallelism + 40
    rows = [(n, " ".join([f"w{n // 3}-{i}" for i in range(40)] + [f"end{n}"])) for n in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    held, saved = {}, shared.saved

    def counted(df, label, **how):
        back = saved(df, label, **how)
        held[label] = max(held.get(label, 0), len(back.inputFiles()))
        return back

    monkeypatch.setattr(shared, "saved", counted)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", many)
        got = sorted(tuple(r) for r in minhash.near_duplicates(docs).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r[2] for r in got} == set(range(0, 900, 3)) and len(got) == 900
    assert held["minhash-links"] > 1 and max(held.values()) <= many - 40, held
