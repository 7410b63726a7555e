"""Identity queries: components of a link graph, cover and clusters of a conversation's turns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import tokens
from ..operators import identity as idn
from ..registry import query
from ..sources.tables import table


def _links(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select((F.col("l_orderkey") * 2).alias("a"), (F.col("l_partkey") * 2 + 1).alias("b"))


@query()
def connected_components(spark, sf_dir):
    """Recursive SQL is too slow on whole tables; the tests compare with a plain union-find."""
    return idn.connected(_links(spark, sf_dir), "a", "b")


@query()
def component_keys(spark, sf_dir):
    return idn.component_key(connected_components(spark, sf_dir))


@query()
def greedy_set_cover(spark, sf_dir):
    """Four turns a conversation that cover the most distinct tokens."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", tokens("text").alias("features"), F.length("text").cast("double").alias("score"))
    return idn.set_cover(turns, "conv_id", "turn", "features", "score", 4)


@query()
def first_fit_merge(spark, sf_dir):
    """Turns in clusters whose members all share a token."""
    return idn.first_fit(table(spark, sf_dir, "conversations").select("conv_id", "turn", tokens("text").alias("traits")), "conv_id", "turn", "traits")
