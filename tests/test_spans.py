"""Places, masks, sections, screens and segments against plain loops over the text."""

import re

import pytest
from pyspark.sql import functions as F

from sievework.operators import spans
from sievework.plans.screening import PROSE

S = spans.SINGLE_CELL
TEXTS = [
    None, "", "single-cell", "Single-cell proteomics by mass spectrometry. We quantified 1,200 proteins per single cell.",
    "Near-single-cell work: single-cell RNA-seq and single-shot runs; a single-cell-derived clone. No evidence.",
    "One cell per well was sorted. " + "filler words here " * 40 + "single-cell proteomics again and again: single-cell proteome.",
    "individual cells were imaged. " + "x " * 300 + "LC-MS/MS", "individual cells were measured by LC-MS/MS on an Orbitrap",
    "single nuclei were sorted for RNA sequencing, single cell resolution of the proteome", "é" * 50 + " single cells " + "ü" * 200 + " proteomics", "single cells\x01and\x02proteomics",
    "single cell proteomics " * 30, "PXD000001 single cells PXD000002", "A title. We read of single-cell proteomics here, and of single-cell mass spectrometry there.",
]


def compact(t):
    return re.sub(r"[ \t\n\r\f\x0b]+", " ", t).strip(" ")


def blanked(text, masks):
    text, log = (text or "").translate({1: " ", 2: " "}), []
    for kind, p in masks:
        for m in list(re.finditer(p, text)):
            log.append((kind, compact(m[0])))
        text = re.sub(p, lambda m: " " * len(m[0]), text)
    return text, log


def plain_screen(text, title, s):
    text, log = blanked(text, s.masks)
    title, more = blanked(title, s.masks)
    contexts = [m.span() for m in re.finditer(s.context, text)]
    seen = {}
    for r in (*s.strong, *s.weak):
        for m in re.finditer(r.pattern, text):
            a, b = m.span()
            if r.near and not any(x >= a - r.near and y <= b + r.near for x, y in contexts):
                continue
            around = r.near or s.around
            seen[r.kind, compact(m[0]).lower(), compact(text[max(0, a - around) : b + around])[: s.told_by].lower()] = r
    strong = [r for r in seen.values() if r in s.strong]
    direct, procedural = ([r for r in strong if r.kind in kinds] for kinds in (s.direct, s.procedural))
    contextual = len(strong) - len(direct) - len(procedural)
    hit = bool(re.search(s.title, title))
    tier = "high" if hit or procedural else "moderate" if len(direct) > 1 or (direct and contextual) else "weak" if seen else "none"
    score = max([r.score for r in strong], default=0)
    return (len(log) + len(more), hit, len(strong), len(direct), len(procedural), contextual, len(seen) - len(strong), tier, max(score, s.title_score) if hit else score, {"high": "yes", "moderate": "uncertain", "weak": "weak", "none": "no"}[tier])


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string").repartition(3)


def test_places(texts):
    got = {r.id: [(x.at, x.to, x.match) for x in r.m] for r in spans.with_spans(texts, spans.plain("t"), m="[ce]+").collect()}
    assert got == {i: [(*m.span(), m[0]) for m in re.finditer("[ce]+", (t or "").translate({1: " ", 2: " "}))] for i, t in enumerate(TEXTS)}


def test_lengths_of_pieces_are_taken_once(texts):
    """Not again for every block of totals; and pieces do not carry the text on with every pattern."""
    texts.sparkSession.conf.set("spark.sql.debug.maxToStringFields", 1000)
    plan = spans.with_spans(texts, "t", m="[ce]+")._jdf.queryExecution().optimizedPlan().toString()
    texts.sparkSession.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("length(") == 2  # of a piece, and of a match
    many = texts.sparkSession.createDataFrame([(1, "é c" * 5000)], "id int, t string")
    assert [(x.at, x.to) for x in spans.with_spans(many, "t", m="[ce]+").first().m] == [(3 * i + 2, 3 * i + 3) for i in range(5000)]


def test_running_totals(spark):
    sizes = [0, 1, 127, 128, 129, 1000]
    df = spark.createDataFrame([(n, [(7 * i) % 13 for i in range(n)]) for n in sizes], "n int, x array<int>").select("x", spans.running_totals(F.col("x")).alias("y"))
    for r in df.collect():
        assert r.y == [sum(r.x[:i]) for i in range(len(r.x))]


def test_masks_keep_places(texts):
    got = {r.id: (r.t, [tuple(h) for h in r.masked_hits]) for r in spans.masked(texts, "t", S.masks).collect()}
    assert got == {i: blanked(t, S.masks) for i, t in enumerate(TEXTS)}
    assert all(len(got[i][0]) == len(t or "") for i, t in enumerate(TEXTS))


def screen_of(df, s):
    names = "n_masked title_hit n_strong n_direct n_procedural n_contextual n_weak tier max_score verdict".split()
    title = F.substring_index(F.coalesce("t", F.lit("")), ".", 1)
    return {r.id: tuple(r[n] for n in names) for r in spans.screened(df, ["id"], "t", title, s).collect()}


def test_screen_of_its_field(texts):
    got = screen_of(texts, S)
    assert got == {i: plain_screen(t, (t or "").split(".")[0], S) for i, t in enumerate(TEXTS)}
    assert {r[7] for r in got.values()} == {"high", "moderate", "weak", "none"}


def test_screen_of_the_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id as id", "text as t")
    got = screen_of(docs, PROSE)
    assert got == {r.id: plain_screen(r.t, r.t.split(".")[0], PROSE) for r in docs.collect()}


def plain_sections(text):
    """Line by line: off at a heading behind the first fifth, on at the next major one."""
    out, part, on, at, removed = [], [], True, 0, False
    for line in text.split("\n"):
        name = line.strip(" \t").lower()
        if on and re.fullmatch(spans.REFERENCE_HEADINGS, name) and at >= int(len(text) * 0.2):
            out.append("\n".join(part) + ("\n" if part else ""))
            part, on, removed = [], False, True
        elif not on and re.fullmatch(spans.MAJOR_HEADINGS, name):
            on = True
        if on:
            part.append(line)
        at += len(line) + 1
    if on:
        out.append("\n".join(part))
    return ("\n".join(p.rstrip() for p in out if p).strip(), True) if removed else (text, False)


def test_sections(spark):
    lines = ["References", "intro text", " BIBLIOGRAPHY\t", "Methods", "[1] one", "[2] two", "Data availability", "", "Literature cited", "references", "Acknowledgement", "last words here"]
    texts = ["\n".join(lines[k:] + lines[:k]) for k in range(len(lines))] + ["\n".join(lines[:k]) for k in range(len(lines))] + ["x\r\nReferences\r\ny", "a\n\n\nreferences", "é\n" * 9 + "References\nb\nMethods"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r.id: (r.t, r.removed) for r in spans.without_sections(df, "t").collect()}
    assert got == {i: plain_sections(t) for i, t in enumerate(texts)}


def test_segments_do_not_leak(spark):
    text = "single-cell data: PXD000001; window optimization: pxd000002, PXD0000033 bulk. " + "z " * 600 + "PXD000001: single-cell samples (PXD000004)"
    df = spark.createDataFrame([(1, text), (2, None), (3, "PXD000009")], "id int, t string")
    found = spans.key_segments(df, "t", r"(?i)\bPXD\d{6,}\b").collect()
    plain, ms = [], list(re.finditer(r"(?i)\bPXD\d{6,}\b", text))
    for k, m in enumerate(ms):
        left = max(ms[k - 1].end() if k else 0, m.start() - 500)
        right = min(ms[k + 1].start() if k + 1 < len(ms) else len(text), m.end() + 500)
        plain.append((1, k + 1, m[0].upper(), compact(text[left:right])))
    assert sorted((r.id, r.no, r.mention, r.segment) for r in found) == sorted([*plain, (3, 1, "PXD000009", "PXD000009")])
    label = r"(?i)(?:single[- ]cell(?:\s+(?:data|samples?))?[^;\n]{0,160}\b{key}\b|\b{key}\b\s*(?::|-)\s*single[- ]cell)"
    rows = spark.createDataFrame([(r.mention, r.segment) for r in found], "k string, s string")
    hit = {(r.k, r.n) for r in rows.select("k", spans.mapped("s", "k", label).alias("n")).collect()}
    assert hit == {("PXD000001", 1), ("PXD000002", 0), ("PXD0000033", 0), ("PXD000004", 1), ("PXD000009", 0)}
    # the mention before a label ends the segment, so the label counts for what follows it alone
    odd = spark.createDataFrame([("a.b", "x a.b axb"), ("(", "( ()")], "k string, s string")
    assert [r.n for r in odd.select(spans.mapped("s", "k", "{key}").alias("n")).collect()] == [1, 2]


def plain_roles(text, members, roles, radius):
    """A following role within the radius that does not cross the next member, else a preceding one behind the member before."""
    text = (text or "").translate({1: " ", 2: " "})
    ms, out = [m.span() for m in re.finditer(members, text)], []
    for k, (a, b) in enumerate(ms):
        last, following = (ms[k - 1][1] if k else 0), (ms[k + 1][0] if k + 1 < len(ms) else len(text))
        spans_of = [(p, name, m.start(), m.end()) for p, (name, pattern) in enumerate(roles) for m in re.finditer(pattern, text)]
        after = sorted((x - b, p, name) for p, name, x, y in spans_of if x >= b and y <= min(b + radius, following))
        before = sorted((a - y, p, name) for p, name, x, y in spans_of if y <= a and x >= max(0, a - radius, last))
        found = after or before
        out.append((k + 1, text[a:b], found[0][2] if found else None, found[0][0] if found else None, "after" if after else "before" if before else None))
    return out


def test_nearest_roles(texts, spark):
    members, roles = r"(?i)\b12[6-9][NC]?\b", [("carrier", r"(?i)\bcarriers?\b"), ("reference", r"(?i)\breference\b"), ("blank", r"(?i)\bblanks?\b"), ("single", r"(?i)\bsingle[- ]cells?\b")]
    more = ["126 as carrier, 127N and 127C blank; reference 128N single cells, 128C", "carrier 126 127N", "single cell carrier 126", "126" + " x" * 100 + " carrier", "126 carriers single", "126blank 127 blankreference 128 reference", "blank 126 127 128C reference", "129 single-cell 126N carrier blank"]
    rows = list(enumerate([*TEXTS, *more]))
    df = spark.createDataFrame(rows, "id int, t string").repartition(3)
    for radius in (150, 12):
        got = spans.nearest_roles(df, ["id"], "t", members, roles, radius).collect()
        want = [(i, *r) for i, t in rows for r in plain_roles(t, members, roles, radius)]
        assert sorted((r.id, r.no, r.member, r.role, r.distance, r.side) for r in got) == sorted(want)


def test_what_a_task_sorts_does_not_grow(spark, sf_dir, monkeypatch):
    """Twice the table goes to twice the tasks; a role's place is a number."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id as id", "text as t")
    monkeypatch.setattr(spans, "BLOCK_BYTES", 1 << 14)
    n = spans.parts_of(docs)
    assert n > 4 and 2 * n - 2 <= spans.parts_of(docs.union(docs)) <= 2 * n
    plan = spans.nearest_roles(docs, ["id"], "t", "that", [("a", "[0-9]+")])._jdf.queryExecution().sparkPlan().toString()
    assert f", {n}), REPARTITION_BY_NUM" in plan and "struct(at" not in "".join(line for line in plan.split("\n") if "Window" in line)
