"""The containment join against a plain loop over all names."""

import random
import re

from pyspark.sql import functions as F

from sievework.operators import containment


def plain_settled(values, names):
    out = []
    for v in values:
        if v in names:
            out.append((v, "exact", v, 1))
            continue
        key = lambda t: re.sub("[^a-z0-9]", "", t.lower())
        same = [n for n in names if key(n) and key(n) == key(v)]
        if len(same) == 1:
            out.append((v, "normalized", same[0], 1))
            continue
        tokens = [t for t in re.findall("[a-z0-9]{4,}", v.lower()) if not t.isdigit()]
        held = sorted(n for n in names if tokens and all(t in n.lower() for t in tokens))
        out.append((v, "composite" if len(held) == 1 else "ambiguous" if held else "none", held[0] if len(held) == 1 else None, len(held)))
    return sorted(out, key=str)


def test_settled_by_the_first_step(spark):
    rng = random.Random(1)
    names = sorted({"_".join(rng.choice(["Plate", "well", "cell", "CTRL", "run01", "hela", "k562", "20210101"]) + rng.choice(["", "A", "B"]) for _ in range(rng.randrange(1, 5))) + rng.choice([".raw", ".RAW", ""]) for _ in range(150)})
    values = sorted({*names[::9], *[n.lower().replace("_", " ") for n in names[::5]], *[" ".join(rng.sample(re.split("[_.]", n), rng.randrange(1, 1 + len(re.split("[_.]", n))))) for n in names for _ in range(2)], "", "abc", "1234", "nothing like it", "late_ cell"})
    v = spark.createDataFrame([(x,) for x in [*values, *values, None]], "v string")
    n = spark.createDataFrame([(x,) for x in [*names, names[0], None]], "n string")
    got = containment.settled(v, n, "v", "n").collect()
    assert sorted(((r.value, r.method, r.name, r.n_candidates) for r in got), key=str) == plain_settled(values, names)
    assert {r.method for r in got} == {"exact", "normalized", "composite", "ambiguous", "none"}
    both = containment.settled(v.withColumn("acc", F.lit(1)), n.withColumn("acc", F.expr("if(n < 'R', 1, 2)")), "v", "n", ["acc"]).collect()
    assert sorted(((r.value, r.method, r.name, r.n_candidates) for r in both), key=str) == plain_settled(values, [x for x in names if x < "R"])
    assert containment.settled(v.limit(0), n, "v", "n").count() == 0 and {r.method for r in containment.settled(v, n.limit(0), "v", "n").collect()} == {"none"}


def test_rarest_grams_are_found_in_fixed_width(spark):
    """The rows of a value's grams carry two hashes and a number, never the value, and are summed up without sorting them."""
    v, n = (spark.createDataFrame([(x,) for x in xs], "v string") for xs in (["cell hela", "x" * 5000], ["hela_cell.raw"]))
    plan = containment.settled(v, n, "v", "v")._jdf.queryExecution().sparkPlan().toString()
    partial = [line for line in plan.split("\n") if "partial_min" in line and "held" in line and "gram" in line]
    assert partial and all("HashAggregate(keys=[_a" in line for line in partial)
