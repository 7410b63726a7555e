"""Walks over JSON texts as variants: every leaf with its path, and the first value of some keys at any depth.

A level of nesting is one generator: an object becomes its fields, an array its elements, a scalar stays as it is. So a walk
of bounded depth is one chain of projections; rows are neither shuffled nor sent to Python."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, norm, norm_key

DEPTH = 10


def nodes(df: DataFrame, column: str, depth: int = DEPTH) -> DataFrame:
    """The other columns, and for each leaf path (`a.b[0].c`), steps (the way there, whose order is that of the text's
    parsed form: fields by name, elements by place), key (the last field's name) and v, a variant. Empty objects and arrays have
    no leaves; what lies deeper than `depth` stays a container. Bad JSON and nulls give no rows."""
    kept = [c for c in df.columns if c != column]
    start = F.array(F.struct(F.lit("").alias("path"), F.array().cast("array<string>").alias("steps"), F.lit("").alias("key"), F.try_parse_json(col(column)).alias("v")))
    rows = df.select(*kept, F.inline(start)).where("v is not null")
    for _ in range(depth):
        fields, elements = F.expr("map_entries(try_cast(v AS map<string, variant>))"), F.expr("try_cast(v AS array<variant>)")
        dot = F.when(F.col("path") == "", "").otherwise(".")
        node = lambda path, step, key, v: F.struct(path.alias("path"), F.concat("steps", F.array(step)).alias("steps"), key.alias("key"), v.alias("v"))
        inner = F.transform(fields, lambda e: node(F.concat("path", dot, e["key"]), e["key"], e["key"], e["value"]))  # noqa: B023
        items = F.transform(elements, lambda x, i: node(F.concat(F.col("path"), F.lit("["), i.cast("string"), F.lit("]")), F.lpad(i.cast("string"), 10, "0"), F.col("key"), x))  # noqa: B023
        same = F.array(F.struct("path", "steps", "key", "v"))
        rows = rows.select(*kept, F.inline(F.when(fields.isNotNull(), inner).when(elements.isNotNull(), items).otherwise(same)))
    return rows


def _scalar() -> Column:
    deep = F.expr("schema_of_variant(v) LIKE 'OBJECT%' OR schema_of_variant(v) LIKE 'ARRAY%'")
    return F.when(~deep, norm(F.expr("try_cast(v AS string)")))


def leaves(df: DataFrame, column: str, depth: int = DEPTH) -> DataFrame:
    """The other columns, path and value of every scalar that is not blank, white space collapsed."""
    kept = [c for c in df.columns if c != column]
    return nodes(df, column, depth).select(*kept, "path", _scalar().alias("value")).where("value <> ''")


def first_value(df: DataFrame, key: Sequence[str], column: str, names: Sequence[str], depth: int = DEPTH) -> DataFrame:
    """key, value: of each text the first scalar that is not blank under one of the names, compared without case and signs. An
    object's own fields come before what lies within them, in the order of the names; then its parts one after the other.
    Texts without any have an empty value. key names a row."""
    found = nodes(df.select(*key, column), column, depth).select(*key, "steps", norm_key("key").alias("name"), _scalar().alias("value"))
    rank = {norm_key_of(n): i for i, n in reversed(list(enumerate(names)))}
    order = F.coalesce(*[F.when(F.col("name") == n, F.lit(i)) for n, i in rank.items()])
    # a list of steps comes after each of its fronts, so an object's own fields come first
    place = F.struct(F.slice("steps", F.lit(1), F.size("steps") - 1).alias("within"), order.alias("rank"), "steps")
    best = found.where(order.isNotNull() & (F.col("value") != "")).groupBy(*key).agg(F.min_by("value", place).alias("value"))
    return df.select(*key).join(best, list(key), "left").select(*key, F.coalesce("value", F.lit("")).alias("value"))


def norm_key_of(name: str) -> str:
    return "".join(c for c in name.lower() if c.isascii() and c.isalnum())
