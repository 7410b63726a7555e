"""Connected components of a graph of links, by alternating large-star and small-star rounds.

Each round is two group-bys and joins on one table of links, which is written to the shared folder, so plans stay short
and a lost executor costs one round at most. Hubs never meet in one task: a node's least neighbour comes from a partial
aggregate, and the join that hands it back is one that Spark may split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


def _large_star(links: DataFrame, files: int | None) -> DataFrame:
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = shared.saved(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "components-least", files=files)
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")


def _small_star(links: DataFrame, files: int | None) -> DataFrame:
    least = shared.saved(links.groupBy("u").agg(F.min("v").alias("m")), "components-least", files=files)
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every node has one link down at most, and none that others lead to has any."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(links.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 or (down > 0 and up > 0)").isEmpty()


def components(links: DataFrame, files: int | None = None) -> DataFrame:
    """links: u long, v long. Returns node, component (the least node reachable) for every node with a link. files: of each table
    on the way, at most.
    Links of a node with itself and null ends are ignored; repeated links count once."""
    links = links.select("u", "v").where("u is not null and v is not null and u != v")
    links = shared.saved(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components-links", files=files)
    while not _settled(links):
        # every link leads from the greater node to the smaller one, before and after
        links = shared.saved(_small_star(shared.saved(_large_star(links, files), "components-large", files=files), files), "components-links", files=files)
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
