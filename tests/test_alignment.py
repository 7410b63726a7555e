"""Alignment of contexts and branches on hand-made facts, and the tree of technologies."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from sievework import registry
from sievework.operators import alignment as al
from sievework.operators import pairing
from sievework.operators import technology as tech

FACTS = "scope string, node string, predicate string, value string, status string, method string, conflict string"
A, C = "HAS_ANALYTICAL_CHANNEL", "HAS_CARRIER_CHANNEL"


def facts(spark, *rows):
    """scope, node, predicate, value and, where they differ, status, method and conflict."""
    return spark.createDataFrame([(*r, *("accepted_resolved", "", "")[len(r) - 4 :]) for r in rows], FACTS)


def branches(spark, rows, states):
    made = spark.createDataFrame(states, "node string, state string, cluster string")
    return al.described(facts(spark, *rows)).join(made, "node", "left").withColumn("cluster", F.coalesce("cluster", "node"))


def chosen(spark, ctx, br, states):
    c, b = al.described(facts(spark, *ctx)), branches(spark, br, states)
    pairs = al.profile_alignments(c, b)
    return pairs, {r.node: r for r in al.choices(c, pairs).collect()}


CLEAN = "canonical_branch_candidate"
LFQ = [("P", "b1", "HAS_MODALITY", "label-free"), ("P", "b1", "HAS_ACQUISITION", "DIA")]
TMT = [("P", "b2", "HAS_MODALITY", "targeted reporter"), ("P", "b2", "USES_CHEMISTRY", "TMTpro 18plex"), ("P", "b2", C, "TMT 126"), ("P", "b2", A, "127n")]


def test_one_branch_fits_and_the_other_contradicts(spark):
    ctx = [("P", "c", "HAS_MODALITY", "Reporter multiplexed single cell"), ("P", "c", "USES_CHEMISTRY", "tmtpro"), ("P", "c", C, "126"), ("Q", "other", "HAS_MODALITY", "label free")]
    pairs, of = chosen(spark, ctx, LFQ + TMT, [("b1", CLEAN, "k1"), ("b2", CLEAN, "k2")])
    rows = {r.b_profile.split("|")[0]: r for r in pairs.collect()}
    assert (rows["label_free"].status, rows["label_free"].conflicts, rows["label_free"].conflict_score) == ("contradictory", "label_free_vs_reporter_modality", 1.0)
    fit = rows["reporter"]
    assert (fit.status, fit.score, fit.cluster) == ("unique_compatible_candidate", 0.75, "k2")
    assert fit.matched == "modality:reporter;chemistry:tmtpro,tmtpro18;HAS_CARRIER_CHANNEL:126"
    assert (of["c"].status, of["c"].cluster, of["c"].n_compatible, of["c"].n_contradictory) == ("unique_compatible_candidate", "k2", 1, 1)
    # a context whose scope has no branch keeps its row
    assert (of["other"].status, of["other"].score, of["other"].n_compatible) == ("no_branch", None, 0)


def test_ties_are_ambiguous_unless_of_one_cluster(spark):
    ctx = [("P", "c", "HAS_MODALITY", "label free"), ("P", "c", "HAS_ACQUISITION", "dia"), ("P", "c", A, "126"), ("P", "c", A, "127")]
    br = [("P", b, p, v) for b in ("b1", "b2") for _, _, p, v in ctx]
    _, of = chosen(spark, ctx, br, [("b1", CLEAN, "k1"), ("b2", CLEAN, "k2")])
    assert (of["c"].status, of["c"].cluster, of["c"].n_compatible, of["c"].score) == ("ambiguous_compatible_candidate", None, 2, 0.6)
    _, of = chosen(spark, ctx, br, [("b1", CLEAN, "k"), ("b2", CLEAN, "k")])
    assert (of["c"].status, of["c"].cluster, of["c"].n_compatible) == ("unique_compatible_candidate", "k", 2)
    # without a resolved branch nothing is eligible
    _, of = chosen(spark, ctx, br, [("b1", "unresolved_hypothesis", "k"), ("b2", None, None)])
    assert (of["c"].status, of["c"].n_compatible, of["c"].n_weak) == ("weak_candidate", 0, 2)


def test_roles_that_exclude_each_other(spark):
    ctx = [("P", "c", "HAS_MODALITY", "targeted_reporter"), ("P", "c", "USES_CHEMISTRY", "TMT"), ("P", "c", A, "126"), ("P", "c", A, "127N")]
    br = [("P", "b", "HAS_MODALITY", "targeted_reporter"), ("P", "b", "USES_CHEMISTRY", "TMT11"), ("P", "b", C, "126"), ("P", "b", C, "TMT127 n")]
    pairs, of = chosen(spark, ctx, br, [("b", CLEAN, "k")])
    row = pairs.first()
    assert (row.score, row.conflict_score, row.conflicts, row.status) == (0.7, 0.6, "reporter_role:126;reporter_role:127N", "contradictory")
    # one contradicted channel alone leaves the pair eligible
    pairs, of = chosen(spark, ctx, br[:3], [("b", CLEAN, "k")])
    assert (pairs.first().conflict_score, of["c"].status) == (0.3, "unique_compatible_candidate")


def test_dirty_nodes_are_never_clean_candidates(spark):
    good = [("P", "{}", "HAS_MODALITY", "label free"), ("P", "{}", "HAS_ACQUISITION", "DIA"), ("P", "{}", A, "126"), ("P", "{}", A, "127")]
    as_ = lambda n, *more: [(s, n, *r) for s, _, *r in [*good, *more]]
    refused = ("P", "{}", "USES_CHEMISTRY", "TMT", "rejected_semantic_hygiene", "hygiene", "")
    _, of = chosen(spark, as_("c", refused), as_("b"), [("b", CLEAN, "k")])
    assert (of["c"].status, of["c"].n_weak) == ("context_conflicted_candidate", 1)
    pairs, of = chosen(spark, as_("c"), as_("b", ("P", "{}", "HAS_TITLE", "x", "conflicted", "", "key")), [("b", CLEAN, "k")])
    assert (of["c"].status, pairs.first().matched) == ("branch_contradictory", "modality:label_free;acquisition:dia;HAS_ANALYTICAL_CHANNEL:126;HAS_ANALYTICAL_CHANNEL:127")
    # a status that is neither usable nor a conflict counts for nothing, and with a method makes the node dirty
    _, of = chosen(spark, as_("c", ("P", "{}", "USES_CHEMISTRY", "TMT", "unresolved", "", "key")), as_("b"), [("b", CLEAN, "k")])
    assert of["c"].status == "unique_compatible_candidate"
    _, of = chosen(spark, as_("c", ("P", "{}", "USES_CHEMISTRY", "TMT", None, "m", "")), as_("b"), [("b", CLEAN, "k")])
    assert of["c"].status == "context_conflicted_candidate"


def test_alike_nodes_are_one_profile_and_separators_do_not_mix(spark):
    ctx = [("P", f"c{i}", "HAS_MODALITY", "label free") for i in range(50)] + [("P", "x", "USES_CHEMISTRY", "a,b"), ("P", "y", "USES_CHEMISTRY", "a"), ("P", "y", "USES_CHEMISTRY", "b"), ("P", "z", "HAS_MODALITY", " "), (None, "n", "HAS_MODALITY", "label free")]
    pairs, of = chosen(spark, ctx, LFQ, [("b1", CLEAN, "k1")])
    assert sorted((r.c_n, r.c_profile) for r in pairs.collect()) == [(1, "|a,b||"), (1, "|a\\,b||"), (50, "label_free|||")]
    assert len(of) == 52 and of["c7"].status == "weak_candidate" and of["x"].status == "insufficient_evidence"
    empty = al.described(facts(spark).limit(0))
    assert al.profile_alignments(empty, branches(spark, LFQ, [("b1", CLEAN, "k")])).count() == 0


def test_tree_relations(spark):
    known = ["tmt", "tmtpro", "tmtpro18", "tmtpro16", "tmt11", "tmt10", "tmt8", "tmt6", "scope2", "odd"]
    rows = spark.createDataFrame(list(itertools.product(known, known)), "a string, b string")
    above = lambda x: [x, *(above(tech.BELONGS_TO[x]) if x in tech.BELONGS_TO else [])]
    for r in rows.select("a", "b", tech.relation("a", "b").alias("r")).collect():
        ends = set(known[2:8])
        want = "equal" if r.a == r.b else "child" if r.b in above(r.a) else "parent" if r.a in above(r.b) else "incompatible" if {r.a, r.b} <= ends else "unknown"
        assert r.r == want, (r.a, r.b)
    with pytest.raises(ValueError):
        tech.intervals({"a": "b", "b": "a"})
    spans = tech.intervals({"b": "a", "c": "b", "d": "a"})
    assert spans == {"a": (0, 3), "b": (1, 2), "c": (2, 2), "d": (3, 3)}


def test_keys(spark):
    names = {"TMTpro 18-plex": "tmtpro18", "tmt 10": "tmt10", "SCoPE-MS": "scope-ms", "SCoPE2": "scope2", "iTRAQ  8": "itraq 8", "TMTproplex": "tmtproplex", None: ""}
    rows = spark.createDataFrame([(n,) for n in names], "v string")
    assert {r.v: r.k for r in rows.select("v", tech.technology_key("v").alias("k")).collect()} == names
    one = spark.range(1).select(tech.channel_key(F.lit(" tmt 127 n")).alias("c"), tech.acquisition_key(F.lit("D I A")).alias("a"), tech.acquisition_key(F.lit("Wide  Window")).alias("w"), tech.modality_family(F.lit("LabelFree")).alias("m")).first()
    assert tuple(one) == ("127N", "dia", "wide window", "label_free")


def test_pairs_are_neither_sorted_nor_held_back_by_lambdas(spark):
    """Pairs outnumber profiles by far: no window orders them, and their scoring is generated code."""
    ctx = [("P", "c", "HAS_MODALITY", "Reporter multiplexed single cell"), ("P", "c", "USES_CHEMISTRY", "tmtpro"), ("P", "c", C, "126")]
    c, b = al.described(facts(spark, *ctx)), branches(spark, LFQ + TMT, [("b1", CLEAN, "k1"), ("b2", CLEAN, "k2")])
    pairs = al.profile_alignments(c, b)
    assert "Window" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    scored = [x for x in pairs.drop("matched", "conflicts")._jdf.queryExecution().optimizedPlan().toString().split("\n") if "c_known" in x and "b_known" in x]
    assert scored and not any("lambda" in x for x in scored)
    rows = {r.b_profile.split("|")[0]: r for r in pairs.collect()}
    assert rows["reporter"].matched == "modality:reporter;chemistry:tmtpro,tmtpro18;HAS_CARRIER_CHANNEL:126"


# --- facts that name both sides ---


def both(spark, rows, states):
    """rows: scope, context, branch, predicate, value, status, method, conflict. What pairing says, and what alignment does."""
    lines = spark.createDataFrame(rows, "scope string, context string, branch string, predicate string, value string, status string, method string, conflict string")
    sides = spark.createDataFrame(states, "node string, state string, cluster string")
    large = pairing.large_of(lines.where("context is not null").select("scope", "context").distinct(), 20)
    assert {r.scope: r.lots for r in large.collect()} == {"Q": 3, "R": 3}
    packed = lines.join(pairing.sides_of(sides).withColumnRenamed("node", "branch"), "branch", "left"), {"value": "predicate"}, large, 5
    node = lambda c: al.described(lines.withColumnRenamed(c, "node"))
    contexts = node("context")
    pairs = al.profile_alignments(contexts, node("branch").join(sides, "node"))
    return packed, pairs, al.choices(contexts, pairs)


def test_packed_pairs_are_those_of_the_tables_of_nodes(spark, monkeypatch):
    """Odd values, more tags than a number has bits, tags with several colons, branches with no row or several, and blocks of few pairs."""
    rng = random.Random(3)
    values = {
        al.MODALITY: ["Label-Free", "label free", "Targeted REPORTER", "modality unresolved", " odd;one", "é|x,y", None, ""],
        al.CHEMISTRY: ["TMT", "TMTpro 18-plex", "tmtpro16", "TMT\\u00a010", "iTRAQ  8", "a,b", "a\\\\b", "SCoPE-MS", " "],
        al.ACQUISITION: ["DIA", "d d a", "Wide  Window", None], "HAS_TITLE": ["x"], None: ["y"],
    }
    channels = [f"TMT {n}{end}" for n in range(40) for end in ("", "n", ":126", " N:126")] + [" ", None]
    rows = []
    for _ in range(3000):
        scope = rng.choice(["P", "P", "Q", "R", None])
        predicate = rng.choice([*values, *al.ROLES, *al.ROLES])
        value = rng.choice(values.get(predicate, channels))
        node = lambda n: rng.choice([None, *range(n)])
        c, b = node(9 if scope == "P" else 60), node(9 if scope == "P" else 40)
        status = rng.choice([*al.USABLE * 8, "conflicted", "unresolved", None])
        rows.append((scope, c and f"c{c}", b and f"b{b}", predicate, value, status, rng.choice(["", None, "m"]), rng.choice(["", "k"])))
    # few facts a node, so that pairs may be compatible
    for i in range(60):
        rows += [("S" + str(i % 9), f"c{i}", f"b{i % 7}", p, v, "accepted_resolved", "", "") for p, v in ((al.MODALITY, "label free"), (al.ACQUISITION, "dia"), (A, f"{120 + i % 4}"), (rng.choice((A, C)), f"{121 + i % 4}"))]
    clean, states = "canonical_branch_candidate", []
    for b in range(38):
        states += [(f"b{b}", rng.choice([clean, clean, clean, "unresolved_hypothesis", "contradictory_hypothesis", None]), rng.choice(["k1", "k2", None]))] * (1 + (b % 9 == 0))
    packed, pairs, chosen = both(spark, rows, states)
    monkeypatch.setattr(pairing, "PAIRS", 50)
    plain = lambda df, like: sorted((tuple(r) for r in df.select(*like.columns).collect()), key=str)
    got, want = plain(pairing.alignments(*packed), pairs), plain(pairs, pairs)
    assert len(want) > 1500 and {r[-2] for r in want} > {"unique_compatible_candidate", "ambiguous_compatible_candidate", "weak_candidate", "contradictory"}
    assert got == want
    assert plain(pairing.choices(*packed), chosen) == plain(chosen, chosen)
    nothing = packed[0].limit(0), *packed[1:]
    assert pairing.alignments(*nothing).count() == pairing.choices(*nothing).count() == 0


@pytest.mark.parametrize("name", ["context_branch_alignment", "context_branch_choice"])
def test_lines_are_sent_once_and_pairs_never(spark, sf_dir, name):
    """Every exchange but those of the joins deals lines to groups of scopes: no node, profile or pair is sent on."""
    plan = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1
    above, below = plan.split("FlatMapGroupsInArrow")
    assert not any(x in above for x in ("Join", "Aggregate", "Repartition", "Sort"))
    assert below.count("Relation [") == 4 and below.count("Aggregate") == 2  # lines, orders, branches by key, and the scopes of orders
