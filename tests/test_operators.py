"""Operators that SQL does not express, scans, sinks and streams, against plain Python or round trips."""

import json

from pyspark.sql import functions as F

from sievework import registry
from sievework.functions import columns as c
from sievework.operators import claims, evidence, identity, sheets
from sievework.sources import sinks, tables
from sievework.streaming import incremental


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first().x


def test_scalar_functions(spark):
    assert one(spark, c.norm("t"), t="  a \n\t b ") == "a b"
    assert one(spark, c.norm_key("t"), t="Ab-C 1") == "abc1"
    assert one(spark, c.is_concrete("t"), t=" Not  Available") is False
    assert one(spark, c.truthy("t"), t=" Yes ") is True
    assert one(spark, c.first_nonblank("a", "b"), a=" ", b=" x ") == "x"
    assert one(spark, c.tokens("t"), t="a-b A c") == ["A", "B", "C"]
    assert one(spark, c.format_bytes("n"), n=1536) == "1.50 KiB"
    assert one(spark, c.jaccard("a", "b"), a=[1, 2], b=[2, 3]) == 1 / 3
    assert one(spark, c.overlap_coefficient("a", "b"), a=[1, 2], b=[2, 3, 4]) == 0.5
    assert one(spark, c.excerpt("t", "needle"), t="x" * 300 + "needle\n" + "y" * 300) == "x" * 100 + "needle " + "y" * 139


def test_budget_fold(spark, sf_dir):
    got = {r.doc_id: r for r in registry.queries()["evidence_budget_pack"](spark, sf_dir).collect()}
    from sievework.plans.curation import ANCHORS

    for doc_id, text in tables.table(spark, sf_dir, "documents").select("doc_id", "text").collect():
        rows = []
        for pos, line in enumerate(text.split("\n")):
            t = " ".join(line.split())
            low = t.lower()
            if t:
                n = [sum(w in low for w in terms) for terms in ANCHORS.values()]
                rows.append((-sum(min(k, 5) + 2 * (k > 0) for k in n), pos, t))
        used, out, seen = 0, [], set()
        for _, pos, t in sorted(rows):
            if t.lower() in seen:
                continue
            seen.add(t.lower())
            if len(out) < 6 and used + len(t) <= 900:
                used += len(t)
                out.append(str(pos))
        assert (got[doc_id].n_passages, got[doc_id].chars, got[doc_id].positions) == (len(out), used, ",".join(out))


def test_chunks_overlap_and_hold_everything(spark):
    lines = [f"{i} " + "w" * (i * 7 % 40) for i in range(30)]
    df = spark.createDataFrame([("\n".join(lines),)], "t string")
    got = df.select(evidence.chunks(evidence.paragraphs("t"), 80).alias("c")).first().c
    assert all(len(x) <= 80 for x in got) and {y for x in got for y in x.split("\n")} == {x.strip() for x in lines}
    assert sum(a.split("\n")[-1] == b.split("\n")[0] for a, b in zip(got, got[1:])) > len(got) / 2


def test_shards_are_balanced(spark):
    rows = [("g", i, float(1 + i * 37 % 101)) for i in range(50)] + [("h", 1, None), ("h", 2, 5.0)]
    got = sheets.balance(spark.createDataFrame(rows, "g string, i long, w double"), "g", "i", "w", 4).collect()
    load = [0.0] * 4
    for g, i, s in got:
        if g == "g":
            load[s] += rows[i][2]
    assert len(got) == 52 and max(load) - min(load) <= 20


def test_lineage_of_chains_and_cycles(spark):
    links = [(i, i - 1) for i in range(1, 40)] + [(100, 101), (101, 100)]
    links += [(200, 201), (201, 202), (202, 200), (203, 202), (300, 300)]
    got = {r.node: r for r in claims.lineage_roots(spark.createDataFrame(links, "child long, parent long")).collect()}
    assert all(got[i].root == 0 and got[i].depth == i and not got[i].cyclic for i in range(1, 40))
    assert all(got[i].cyclic and got[i].root is None and got[i].depth is None for i in (100, 101, 200, 201, 202, 203, 300))


def test_segments_take_the_mention_literally(spark):
    df = spark.createDataFrame([(1, "a.b.c")], "k long, t string")
    assert sorted(r.segment for r in evidence.segments(df, "k", "t", ".").collect()) == ["a.b", "b.c"]


def test_long_tables_round_trip(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("﻿Source Name\tnote\tnote\r\na\tx\ty\r\n\t\t\r\nb\tz\r\nc\t1\t2\t3\r\n")
    cells = tables.long_table(spark, str(tmp_path / "s.tsv"))
    rows = {r.row_idx: r.line for r in sinks.sheet_lines(cells).collect()}
    assert rows == {-1: "source name\tnote\tnote", 0: "a\tx\ty", 2: "b\tz\t", 3: "c\t1\t2"}


def test_scans(spark, tmp_path):
    (tmp_path / "list.txt").write_text("# no\n a \n\nb\n")
    assert [r.value for r in tables.list_file(spark, str(tmp_path / "list.txt")).collect()] == ["a", "b"]
    (tmp_path / "c.tsv").write_text("accession\tscore\ttier\tlanes\nP1\t12\tweak\ta; b;\nP2\tbad\t\t\n")
    got = tables.candidates(spark, str(tmp_path / "c.tsv")).collect()
    assert [(r.accession, r.score, r.lanes, r.labels) for r in got] == [("P1", 12, ["a", "b"], []), ("P2", 0, [], [])]
    (tmp_path / "d.csv").write_text('x,y\n"a, b",1\n')
    assert tables.delimited(spark, str(tmp_path / "d.csv")).first().x == "a, b"
    lines = ["type=file;size=12;modify=1; a b.raw", "Type=dir; sub", "-rw-r--r-- 1 u g 345 Jan 01 12:00 c d.raw", "lrwxrwxrwx 1 u g 3 Jan 01 12:00 l -> m", "01-02-24  03:04PM  <DIR>  e", "what is this"]
    got = tables.listing(spark.createDataFrame([(x,) for x in lines], "line string")).collect()
    assert [(r.name, r.is_dir, r["size"], r.problem) for r in got] == [("a b.raw", False, 12, None), ("sub", True, None, None), ("c d.raw", False, 345, None), ("l -> m", False, 3, "link"), ("e", True, None, None), (None, False, None, "unknown")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("k", ["a", "b"], {"x": 1})], "key string, tags array<string>, m map<string,int>")
    sinks.write_delimited(df, str(tmp_path / "o"))
    assert tables.delimited(spark, str(tmp_path / "o"), "\t").first().asDict() == {"key": "k", "tags": "a; b", "m": json.dumps({"x": 1}).replace(" ", "")}
    assert sinks.manifest(df, "key").first().sha256 == sinks.manifest(df.select("m", "tags", "key"), "key").first().sha256


def test_record_walk(spark):
    docs = spark.createDataFrame([(1, '{"a": 1, "b": [{"c": "x"}, {"c": "y", "a": 2}]}'), (2, "bad"), (3, None)], "k long, j string")
    got = sorted((r.k, r.path, r.record) for r in sheets.records(docs, "k", "j").collect())
    assert got == [(1, "$", '{"a": 1}'), (1, "$.b[0]", '{"a": 1, "c": "x"}'), (1, "$.b[1]", '{"a": 2, "c": "y"}')]


def test_streams(spark, sf_dir, tmp_path):
    schema = tables.table(spark, sf_dir, "events").schema
    (tmp_path / "in").mkdir()
    tables.table(spark, sf_dir, "events").union(tables.table(spark, sf_dir, "events")).coalesce(2).write.parquet(str(tmp_path / "in" / "a"))
    stream = incremental.first_of_each(incremental.new_files(spark, str(tmp_path / "in" / "a"), schema), "event_id", "ts", "60 days")
    incremental.run_available(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    events = tables.table(spark, sf_dir, "events")
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.select("event_id").distinct().count()
    counts = incremental.windowed_counts(incremental.new_files(spark, str(tmp_path / "in" / "a"), schema), "ts", "event_type")
    counts.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("windows").agg(F.sum("n")).first()[0] == 2 * events.count()


def test_components_and_covers(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)]
    got = {r.node: r.component for r in identity.connected(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 120), 100)}
    rows = [("g", 1, ["a", "b"], 1.0), ("g", 2, ["a", "b", "c"], 0.5), ("g", 3, ["d"], 0.1), ("g", 4, ["a"], 9.0)]
    cover = identity.set_cover(spark.createDataFrame(rows, "g string, i long, f array<string>, s double"), "g", "i", "f", "s", 3).collect()
    assert [(r.i, r["rank"]) for r in sorted(cover, key=lambda r: r["rank"])] == [(2, 1), (3, 2), (4, 3)]
    fit = identity.first_fit(spark.createDataFrame([r[:3] for r in rows], "g string, i long, f array<string>"), "g", "i", "f").collect()
    assert {r.i: r.cluster for r in fit} == {1: 0, 2: 0, 3: 1, 4: 0}


def test_signals_of_their_field(spark):
    """A label counts once a lane, by the first of its patterns; proximity ends at a line break unless the pattern says not."""
    from sievework.operators import lexicon as lx

    rows = [
        (1, "Individual neurons by LC-MS", "proteomics of single cells; one-cell samples"), (2, "", "MS/MS of individual skeletal muscle fibres"), (3, None, "MALDI imaging\nat single-cell resolution"),
        (4, "", "individual oocytes\nproteome"), (5, "single myofibers, proteome; proteome of single fibers", None),
    ]
    docs = spark.createDataFrame(rows, "id int, title string, body string")
    lanes = [lx.Lane("title", "title", 2), lx.Lane("body", "body", 1)]
    got = {r.id: (r.score, [(h.lane, h.label, h.term, h.weight) for h in r.hits]) for r in lx.signal_score(docs, "id", lanes, lx.SINGLE_CELL_SIGNALS).collect()}
    assert got == {
        1: (24 + 12 + 9, [("title", "individual_biological_cell_proteomics", "Individual neurons by LC-MS", 24), ("body", "proteomics_individual_biological_cell", "proteomics of single cells", 12), ("body", "one_cell_sample", "one-cell samples", 9)]),
        2: (12, [("body", "single_muscle_fibre_proteomics", "MS/MS of individual skeletal muscle fibres", 12)]),
        3: (10, [("body", "single_cell_maldi_msi", "MALDI imaging\nat single-cell resolution", 10)]),
        4: (0, []),
        5: (24, [("title", "single_muscle_fibre_proteomics", "single myofibers, proteome; proteome", 24)]),
    }
