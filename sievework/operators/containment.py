"""Joining loosely written values to an inventory of names, each value settled by the first step that answers.

Exact name, then the one name of the same normal form, then the one name that holds every long token of the value. The last
step is an inverted index: a name that holds a token holds all its character grams, so a value has to be compared with the
names that hold its rarest gram only. A gram that no name holds settles the value at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ascii_lower, col, norm_key, text_of
from .spans import once

GRAM = 4


def long_tokens(value) -> Column:
    """Distinct alphanumeric runs of four characters or more in lower case, without plain numbers."""
    runs = F.regexp_extract_all(ascii_lower(text_of(value)), F.lit(f"[a-z0-9]{{{GRAM},}}"), 0)
    return F.array_distinct(F.filter(runs, lambda t: ~t.rlike("^[0-9]+$")))


def grams(texts: Column) -> Column:
    """Distinct runs of GRAM characters of all texts."""
    of = lambda t: F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - (GRAM - 1), F.lit(1))), lambda i: F.substring(t, i, GRAM))
    return F.array_distinct(F.flatten(F.transform(texts, of)))


GRAMS = 36**GRAM


def gram_numbers(texts: Column) -> Column:
    """Numbers of the distinct runs of GRAM characters a-z and 0-9 of all texts; other runs stand in no long token."""
    real = F.filter(grams(texts), lambda g: g.rlike(f"^[a-z0-9]{{{GRAM}}}$"))
    return F.transform(real, lambda g: F.conv(g, 36, 10).cast("int"))


def settled(values: DataFrame, names: DataFrame, value: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """For each distinct value (within `by`): method (exact, normalized, composite, ambiguous, none), name, n_candidates of the
    step that settled it. by: columns of both tables whose values have to be equal, such as an accession.

    Names are distinct within `by`. A value of a hot gram is compared with all names that hold it; equal values once."""
    by = list(by)
    names = names.select(*by, F.col(name).alias("name")).where("name is not null").distinct()
    values = values.select(*by, F.col(value).alias("value")).where("value is not null").distinct()

    exact = values.join(names.select(*by, "name", F.col("name").alias("value")), [*by, "value"], "left")
    normal = names.groupBy(*by, norm_key("name").alias("normal")).agg(F.count("*").alias("n_normal"), F.min("name").alias("one"))
    first = exact.withColumn("normal", norm_key("value")).join(normal.where("normal <> ''"), [*by, "normal"], "left")
    first = first.select(*by, "value", "name", F.when(F.col("n_normal") == 1, F.col("one")).alias("one"))

    # in an inventory's index every gram has a row for each name that holds it; grams of values are four characters of 36, so
    # there are no more than 36^4 of them within `by`, and a number stands for each
    names = names.withColumn("low", ascii_lower("name"))
    index = names.select(*by, "name", "low", F.explode(gram_numbers(F.array("low"))).alias("gram"))
    held = index.groupBy(*by, "gram").agg(F.count("*").alias("held"))
    open_ = first.where("name is null and one is null").select(*by, "value", long_tokens("value").alias("tokens")).where(F.size("tokens") > 0)
    # a value's rarest gram is found without the value: its rows are two hashes and a number each, and meet in fixed-width sums
    seen = once(open_, **{"_a": F.xxhash64("value"), "_b": F.xxhash64(F.lit("held"), F.reverse("value"))})
    asked = seen.select(*by, "_a", "_b", F.explode(gram_numbers(F.col("tokens"))).alias("gram"))
    counts = F.broadcast(held) if not by else held
    asked = asked.join(counts, [*by, "gram"], "left")
    rarest = asked.groupBy(*by, "_a", "_b").agg(F.min(F.coalesce("held", F.lit(0)) * GRAMS + F.col("gram")).alias("r")).where(F.col("r") >= GRAMS)
    probes = seen.join(rarest, [*by, "_a", "_b"]).select(*by, "value", "tokens", F.pmod("r", F.lit(GRAMS)).cast("int").alias("gram"))
    met = probes.join(index, [*by, "gram"]).where(F.forall("tokens", lambda t: F.contains(F.col("low"), t)))
    composite = met.groupBy(*by, "value").agg(F.count("*").alias("n_held"), F.min("name").alias("held_by"))

    out = first.join(composite, [*by, "value"], "left")
    plain = col("name").isNotNull()
    one, held_once = col("one").isNotNull(), F.col("n_held") == 1
    method = F.when(plain, "exact").when(one, "normalized").when(held_once, "composite").when(F.col("n_held") > 1, "ambiguous").otherwise("none")
    found = F.coalesce("name", "one", F.when(held_once, F.col("held_by")))
    return out.select(*by, "value", method.alias("method"), found.alias("name"), F.when(plain | one, 1).otherwise(F.coalesce("n_held", F.lit(0))).cast("long").alias("n_candidates"))
