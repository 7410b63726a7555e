"""Which branches of a study an experimental context may belong to.

Contexts and branches are described by resolved facts: modality, chemistry, acquisition and channels with a role. Nodes of one
scope that are described alike form one profile, so pairs are formed between the profiles of a scope and never between its
nodes: a study with a million files still has as many profiles as its vocabulary has uses. An alignment is a diagnosis; it
promotes nothing. Scores are whole hundredths until the end, so that thresholds are exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import keep_rows, ladder, text_of
from .spans import once
from .technology import acquisition_key, channel_key, family, inside, modality_key, more_general, span, technology_key

# Statuses whose facts count, statuses of facts in conflict, and predicates of channels.
USABLE = ("accepted_existing", "accepted_resolved", "source_asserted", "hypothesis_only")
IN_CONFLICT = ("conflicted", "rejected_semantic_hygiene", "rejected_by_stronger_evidence")
ROLES = ("HAS_ANALYTICAL_CHANNEL", "HAS_CARRIER_CHANNEL", "HAS_BLANK_CHANNEL", "HAS_REFERENCE_CHANNEL")
MODALITY, CHEMISTRY, ACQUISITION = "HAS_MODALITY", "USES_CHEMISTRY", "HAS_ACQUISITION"
# Hundredths that a shared or contradicting feature adds, and the thresholds on their sums.
SHARED = {"modality": 35, "chemistry": 35, "acquisition": 15}
SHARED_ROLE, SHARED_ROLES = 5, 15
AGAINST = {"modality": 100, "chemistry": 60, "acquisition": 15}
ROLE_AGAINST, ROLES_AGAINST = 30, 60
CLEAN, WEAK, CONTRADICTORY = 55, 30, 50
STATUSES = (
    "unique_compatible_candidate", "ambiguous_compatible_candidate", "weak_candidate", "context_conflicted_candidate", "branch_unresolved_candidate", "contradictory", "branch_contradictory",
    "insufficient_evidence",
)
_SETS = ("modalities", "chemistries", "acquisitions", "channels")


def described(facts: DataFrame) -> DataFrame:
    """facts: scope, node, predicate, value, status, method, conflict -> scope, node, four sorted sets, dirty, profile.

    Facts of a usable status describe the node. Of the others nothing counts, but a method that refused one, or the key of
    a conflict, makes the node dirty. Blank values and facts without a scope or node do not count. A node's sets hold words
    of the vocabulary and channels, not rows. A profile is its sets as one text, with separators inside words marked."""
    usable, p, value = F.col("status").isin(*USABLE), F.col("predicate"), F.col("value")
    refused = ~F.coalesce(usable, F.lit(False)) & (text_of("method") != "")
    clash = F.coalesce(F.col("status").isin(*IN_CONFLICT), F.lit(False)) & (text_of("conflict") != "")
    key = {"modalities": (p == MODALITY, modality_key(value)), "chemistries": (p == CHEMISTRY, technology_key(value)), "acquisitions": (p == ACQUISITION, acquisition_key(value)), "channels": (p.isin(*ROLES), F.concat(p, F.lit(":"), F.nullif(channel_key(value), F.lit(""))))}
    # keys are made once a fact, one kind a step: all in one expression are a method too long to be compiled. One set of
    # marked keys is gathered a node; its mark is the number of its kind
    rows = once(facts.where("scope is not null and node is not null"), usable=usable, dirty=refused | clash).select("scope", "node", "predicate", "value", "usable", "dirty")
    for name, (is_kind, made) in key.items():
        rows = once(rows, **{name: F.when(F.col("usable") & is_kind, made)})
    rows = once(rows, key=F.coalesce(*key))
    kind = ladder(*[(is_kind, str(i)) for i, (is_kind, _) in enumerate(key.values())], otherwise=F.lit(None).cast("string"))
    word = F.nullif(F.when(p == MODALITY, family(F.col("key"))).otherwise(F.col("key")), F.lit(""))
    sets = rows.groupBy("scope", "node").agg(F.collect_set(F.concat(kind, word)).alias("told"), F.max("dirty").alias("dirty"))
    of = lambda i: F.transform(F.filter("told", lambda x: F.startswith(x, F.lit(str(i)))), lambda x: F.substr(x, F.lit(2)))
    nodes = once(sets, **{s: F.sort_array(of(i)) for i, s in enumerate(key)}).select("scope", "node", *_SETS, "dirty")
    marked = lambda s: F.transform(s, lambda x: F.regexp_replace(x, r"([,|\\])", r"\\$1"))
    return nodes.withColumn("profile", F.concat_ws("|", *[F.array_join(marked(s), ",") for s in _SETS]))


def _compatible(cc, bc) -> Column:
    """Chemistries of either side (structs of key and interval) that are equal to, above or below one of the other's, sorted."""
    met = lambda x, y: F.exists(y, lambda o: (x["key"] == o["key"]) | inside(x, o) | inside(o, x))
    return F.array_sort(F.array_union(F.filter(cc, lambda x: met(x, bc))["key"], F.filter(bc, lambda x: met(x, cc))["key"]))


def _clash(kind: str) -> Column:
    two = {"modality": _both("known"), "chemistry": F.col("c_reporter") & F.col("b_reporter"), "acquisition": _both("acquisitions")}[kind]
    opposed = (F.col("c_free") | F.col("b_free")) & (F.col("c_labelled") | F.col("b_labelled"))
    return ~F.col(kind) & two & (opposed if kind == "modality" else F.lit(True))


def _both(s: str) -> Column:
    return (F.size(f"c_{s}") > 0) & (F.size(f"b_{s}") > 0)


def _scored(pairs: DataFrame) -> DataFrame:
    """Pairs of profiles with what both share (modality, chemistry, acquisition: booleans; roles, taken: arrays), score and
    conflict_score. There are far more pairs than profiles: whatever one side alone tells is a column of its profile, and
    channels are only gone through where both sides name one. No lambda is among the steps, so they are generated code."""
    met = lambda x, y: F.arrays_overlap(f"c_{x}", f"b_{y}")
    near = met("tags", "tags")
    chemistry = met("chemistries", "above") | met("above", "chemistries")
    seen = pairs.withColumns({"modality": met("known", "known"), "chemistry": chemistry, "acquisition": met("acquisitions", "acquisitions"), "near": near})
    of = lambda side: F.when(F.col("near"), F.array_intersect(f"c_{side}", f"b_{side}")).otherwise(F.slice(f"c_{side}", 1, 0))
    seen = seen.withColumns({"held": of("held"), "both": of("tags")})
    seen = seen.withColumns({"roles": F.col("held")["role"], "taken": F.when(F.col("near"), F.array_except(F.col("both"), F.col("held")["tag"])).otherwise(F.col("both"))}).drop("near", "held", "both")
    score = sum((F.when(F.col(k), v).otherwise(0) for k, v in SHARED.items()), F.least(F.lit(SHARED_ROLES), SHARED_ROLE * F.size("roles")))
    conflict = sum((F.when(_clash(k), v).otherwise(0) for k, v in AGAINST.items()), F.least(F.lit(ROLES_AGAINST), ROLE_AGAINST * F.size("taken")))
    return once(seen, score=score, conflict_score=conflict)


def _said() -> tuple[Column, Column]:
    """What the sides of a scored pair share, and what of them contradicts, as texts."""
    joined = lambda c: F.array_join(c, ",")
    shared = {
        "modality": F.sort_array(F.array_intersect("c_known", "b_known")),
        "chemistry": _compatible(F.col("c_spans"), F.col("b_spans")),
        "acquisition": F.sort_array(F.array_intersect("c_acquisitions", "b_acquisitions")),
    }
    said = lambda c: F.when(F.size(c) > 0, F.array_join(F.sort_array(c), ";"))
    matched = F.concat_ws(";", *[F.when(F.col(k), F.concat(F.lit(f"{k}:"), joined(x))) for k, x in shared.items()], said("roles"))
    against = {"modality": "label_free_vs_reporter_modality", "chemistry": "incompatible_reporter_chemistry", "acquisition": "different_acquisition"}
    taken = F.concat(F.lit("reporter_role:"), F.array_join(F.sort_array("taken"), ";reporter_role:"))
    conflicts = F.concat_ws(";", *[F.when(_clash(k), F.lit(x)) for k, x in against.items()], F.when(F.size("taken") > 0, taken))
    return matched, conflicts


def _above(chemistries) -> Column:
    """Chemistries and all that they belong to."""
    return F.array_distinct(F.flatten(F.transform(chemistries, lambda k: F.concat(F.array(k), more_general(k)))))


def _profiles(nodes: DataFrame, prefix: str, *more: Column) -> DataFrame:
    """One row for each way in which nodes of a scope are described; further expressions are summed up for it."""
    keys = ["profile", "dirty", *(["state"] if prefix == "b" else [])]
    groups = nodes.groupBy("scope", *keys, *_SETS).agg(F.count("*").alias("n"), *more)
    told = {
        "spans": F.transform("chemistries", lambda k: F.struct(k.alias("key"), span(k)["lo"].alias("lo"), span(k)["hi"].alias("hi"))),
        "reporter": F.exists("chemistries", lambda k: F.startswith(k, F.lit("tmt"))),
        "above": _above("chemistries"),
        "known": F.filter("modalities", lambda x: x != "unresolved"),
        "free": F.array_contains("modalities", "label_free"),
        "labelled": F.array_contains("modalities", "reporter"),
        "held": F.transform("channels", lambda r: F.struct(r.alias("role"), F.substring_index(r, ":", -1).alias("tag"))),
        "tags": F.array_distinct(F.transform("channels", lambda r: F.substring_index(r, ":", -1))),
    }
    groups = once(groups, **told)
    return groups.select("scope", *[F.col(x).alias(f"{prefix}_{x}") for x in groups.columns if x != "scope"])


def profile_alignments(contexts: DataFrame, branches: DataFrame) -> DataFrame:
    """contexts and branches as described() gives them, branches with state and cluster (the canonical branch's id, or the
    node as text where it has none) -> a row for each pair of profiles of a scope: scope, c_profile, c_dirty, c_n, b_profile,
    b_dirty, b_state, b_n, score, conflict_score, matched, conflicts, status, cluster (of a unique candidate).

    Contexts without any feature have no rows. A candidate is unique when all eligible branches of its context are of one
    cluster; since least and greatest cluster tell that, no list of clusters is kept."""
    some = F.size(F.concat(*_SETS)) > 0
    c = _profiles(contexts.where(some), "c")
    b = _profiles(branches.withColumn("state", text_of("state")), "b", F.min("cluster").alias("least"), F.max("cluster").alias("greatest"))
    # the sides are small and their pairs are not: their number of partitions must not follow the sides' bytes
    tasks = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    c = c.repartition(tasks, "scope", "c_profile", "c_dirty")
    context = ["scope", "c_profile", "c_dirty"]
    # pairs are scored twice, since numbers alone tell which are eligible: a window over whole pairs would shuffle and sort them
    may = c.where("not c_dirty").join(b.where("not b_dirty and b_state = 'canonical_branch_candidate'"), "scope")
    fit = keep_rows(_scored(may).select(*context, "b_least", "b_greatest", "score", "conflict_score"), (F.col("score") >= CLEAN) & (F.col("conflict_score") < CONTRADICTORY))
    found = fit.groupBy(*context).agg(F.min("b_least").alias("least"), F.max("b_greatest").alias("greatest"))
    told = _scored(c.join(found, context, "left").join(b, "scope"))
    told = once(told, eligible=(F.col("score") >= CLEAN) & (F.col("conflict_score") < CONTRADICTORY) & ~F.col("c_dirty") & ~F.col("b_dirty") & (F.col("b_state") == "canonical_branch_candidate"))
    one = F.col("least") == F.col("greatest")
    status = ladder(
        (F.col("b_dirty") | (F.col("b_state") == "contradictory_hypothesis"), "branch_contradictory"),
        (F.col("conflict_score") >= CONTRADICTORY, "contradictory"),
        (F.col("c_dirty") & (F.col("score") >= WEAK), "context_conflicted_candidate"),
        ((F.col("b_state") == "unresolved_hypothesis") & (F.col("score") >= WEAK), "branch_unresolved_candidate"),
        (F.col("eligible") & one, "unique_compatible_candidate"),
        (F.col("eligible"), "ambiguous_compatible_candidate"),
        (F.col("score") >= WEAK, "weak_candidate"),
        otherwise="insufficient_evidence",
    )
    hundredths = [(F.col(x) / 100).alias(x) for x in ("score", "conflict_score")]
    kept = ("scope", "c_profile", "c_dirty", "c_n", "b_profile", "b_dirty", "b_state", "b_n")
    told = once(told, status=status)
    matched, conflicts = _said()
    return told.select(*kept, *hundredths, matched.alias("matched"), conflicts.alias("conflicts"), "status", F.when(F.col("eligible") & one, F.col("least")).alias("cluster"))


def choices(contexts: DataFrame, alignments: DataFrame) -> DataFrame:
    """A row for each context with a feature: scope, node, status (the first of STATUSES that a branch of its scope reaches;
    no_branch where the scope has none), score (the best at this status), cluster (where there is one), and the numbers of
    branches that are compatible, weak and contradictory."""
    rank = F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col("status"))
    counted = lambda *s: F.coalesce(F.sum(F.when(F.col("status").isin(*s), F.col("b_n"))), F.lit(0))
    # rank and score in one number, and clusters as keys: with texts among what is summed up, pairs would be sorted
    alignments = once(alignments.select("scope", "c_profile", "c_dirty", "b_n", "score", "cluster", "status"), top=rank * 1000 - F.round(F.col("score") * 100).cast("long"))
    top = F.min("top")
    sums = alignments.groupBy("scope", F.col("c_profile").alias("profile"), F.col("c_dirty").alias("dirty"), "cluster").agg(
        top.alias("top"), counted(*STATUSES[:2]).alias("n_compatible"), counted(*STATUSES[2:5]).alias("n_weak"), counted(*STATUSES[5:7]).alias("n_contradictory")
    )
    n = [F.sum(x).alias(x) for x in ("n_compatible", "n_weak", "n_contradictory")]
    of = sums.groupBy("scope", "profile", "dirty").agg(F.min("top").alias("top"), F.max("cluster").alias("cluster"), *n)
    best = F.ceil(F.col("top") / 1000).cast("int")
    of = of.withColumns({"status": F.element_at(F.array(*[F.lit(s) for s in STATUSES]), best), "score": (best * 1000 - F.col("top")) / 100})
    got = contexts.where(F.size(F.concat(*_SETS)) > 0).select("scope", "node", "profile", "dirty").join(of, ["scope", "profile", "dirty"], "left")
    n = [F.coalesce(x, F.lit(0)).alias(x) for x in ("n_compatible", "n_weak", "n_contradictory")]
    return got.select("scope", "node", F.coalesce("status", F.lit("no_branch")).alias("status"), "score", "cluster", *n)
