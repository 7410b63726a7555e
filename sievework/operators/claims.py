"""Claims and their resolution: support by lineage, conflicts, acceptance, and record matching.

A claim is (subject, predicate, object, confidence, source, lineage). Support is two-level: within a lineage only the
strongest claim counts, so copies of one source add nothing; a family of lineages adds at most its three best, up to a
cap. All steps are group-bys with partial aggregates; ranks within a group are taken over what is left after the first
aggregate, which holds one row for each lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ladder


def support(claims: DataFrame, keys: list[str], lineage: str, family: str, value: str, top: int = 3, cap: float = 1.5) -> DataFrame:
    """keys, support, families, best (the strongest contribution), claims."""
    best = claims.groupBy(*keys, family, lineage).agg(F.max(value).alias("v"), F.count("*").alias("n"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys, family).orderBy(F.desc("v"), lineage)))
    per_family = ranked.groupBy(*keys, family).agg(F.least(F.sum(F.when(F.col("rank") <= top, F.col("v")).otherwise(0.0)), F.lit(cap)).alias("s"), F.max("v").alias("best"), F.sum("n").alias("n"))
    return per_family.groupBy(*keys).agg(F.round(F.sum("s"), 6).alias("support"), F.count("*").alias("families"), F.max("best").alias("best"), F.sum("n").alias("claims"))


def acceptance(risk: Column, best: Column, total: Column, families: Column) -> Column:
    """Gates by risk class: high asks for two families, medium for one strong one, low for any."""
    return ladder(
        ((risk == "high") & (families >= 2) & (total >= 1.2) & (best >= 0.7), "accepted"),
        ((risk == "medium") & (total >= 0.9) & (best >= 0.5), "accepted"),
        ((risk == "low") & (total >= 0.5), "accepted"),
        (total >= 0.4, "review"),
        otherwise="rejected",
    )


def functional_conflicts(groups: DataFrame, subject: list[str], accepted: str = "accepted") -> DataFrame:
    """groups: one row for each (subject, object) with status. With several objects and exactly one accepted, the others
    are rejected; with none or several accepted, all are in conflict."""
    sums = groups.groupBy(*subject).agg(F.count("*").alias("n_objects"), F.count_if(F.col("status") == accepted).alias("n_accepted"))
    status = ladder(
        (F.col("n_objects") == 1, F.col("status")), ((F.col("n_accepted") == 1) & (F.col("status") == accepted), F.lit(accepted)), (F.col("n_accepted") == 1, "rejected"), otherwise="conflicted"
    )
    return groups.join(sums, subject).withColumn("status", status)


def best_matches(left: DataFrame, right: DataFrame, on: list[str], row: str, score: Column, disqualified: Column | None = None) -> DataFrame:
    """All right rows at the best score for each left row; disqualified pairs never count."""
    pairs = left.join(right, on).withColumn("score", score)
    pairs = pairs if disqualified is None else pairs.where(~disqualified)
    top = pairs.groupBy(row).agg(F.max("score").alias("top"))
    return pairs.join(top, row).where(F.col("score") == F.col("top")).drop("top")


BLOCK = 1024  # owners of an item that one row holds


def _pairs(sized: DataFrame) -> DataFrame:
    """sized: o, i, n -> u < v, n_u, n_v, shared of all owners that share an item. Owners meet the sorted lists of their items' owners,
    and these lists move to the tasks of the owners: what is shuffled is lists, and pairs arise and are counted where they
    are. An item of many owners has several lists."""
    sized = sized.where("o is not null and i is not null")
    place = F.row_number().over(Window.partitionBy("i").orderBy("o"))
    rows = sized.withColumn("block", F.floor((place - 1) / BLOCK))
    lists = rows.groupBy("i", "block").agg(F.sort_array(F.collect_list(F.struct(F.col("o").alias("v"), F.col("n").alias("n_v")))).alias("owners"))
    met = sized.select(F.col("o").alias("u"), F.col("n").alias("n_u"), "i").join(lists, "i").where(F.element_at("owners", -1)["v"] > F.col("u"))
    behind = F.slice("owners", (F.array_position(F.col("owners")["v"], F.col("u")) + 1).cast("int"), F.size("owners"))
    tasks = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return met.select("u", "n_u", behind.alias("owners")).repartition(tasks, "u").select("u", "n_u", F.inline("owners")).groupBy("u", "v", "n_u", "n_v").agg(F.count("*").alias("shared"))


def set_relations(members: DataFrame, owner: str, item: str, least_shared: int, least_percent: int = 0) -> DataFrame:
    """a < b, shared, n_a, n_b for owners that share at least so many items, and that percentage of the smaller set.

    All pairs that meet are counted, or with a prefix filter those that may be in the result: with t the least overlap that the
    smaller set asks for, its n - t + 1 rarest items hold a shared one, so only these meet the items of sets that are not smaller,
    and the candidates are counted exactly. The filter pays where common items make most of the meetings; where sets are
    alike and their items are not, each candidate costs a set and counting costs one row a meeting. What either
    would move is counted first."""
    own = members.select(F.col(owner).alias("o"), F.col(item).alias("i")).distinct()
    size = own.groupBy("o").agg(F.count("*").alias("n"))
    sized = own.join(size, "o")
    least = lambda n: F.greatest(F.lit(least_shared).cast("long"), F.ceil(n * F.lit(least_percent) / 100))
    rarity = own.groupBy("i").agg(F.count("*").alias("held"))
    rank = F.row_number().over(Window.partitionBy("o").orderBy("held", "i"))
    prefix = sized.join(rarity, "i").withColumn("rank", rank).where(F.col("rank") <= F.col("n") - least(F.col("n")) + 1)
    if least_shared <= 1 and not least_percent or not _filter_pays(rarity, prefix):
        found = _pairs(sized).where(F.col("shared") >= least(F.least("n_u", "n_v")))
        return found.select(F.col("u").alias("a"), F.col("v").alias("b"), "shared", F.col("n_u").alias("n_a"), F.col("n_v").alias("n_b"))
    small, large = prefix.select(F.col("o").alias("u"), F.col("n").alias("n_u"), "i"), sized.select(F.col("o").alias("v"), F.col("n").alias("n_v"), "i")
    met = small.join(large, "i").where("n_u < n_v or (n_u = n_v and u < v)").select("u", "v", "n_u", "n_v").distinct()
    common = met.join(own.select(F.col("o").alias("u"), "i"), "u").join(own.select(F.col("o").alias("v"), "i"), ["v", "i"])
    found = common.groupBy("u", "v", "n_u", "n_v").agg(F.count("*").alias("shared")).where(F.col("shared") >= least(F.col("n_u")))
    first = F.col("u") < F.col("v")
    side = lambda x, y, name: F.when(first, F.col(x)).otherwise(F.col(y)).alias(name)
    return found.select(side("u", "v", "a"), side("v", "u", "b"), "shared", side("n_u", "n_v", "n_a"), side("n_v", "n_u", "n_b"))


def _filter_pays(rarity: DataFrame, prefix: DataFrame) -> bool:
    """Whether candidates of the prefix filter, each with the items of its smaller set, are fewer rows than all meetings."""
    meetings = rarity.agg(F.sum(F.col("held").cast("double") * (F.col("held") - 1) / 2)).first()[0] or 0.0
    return (prefix.agg(F.sum(F.col("held").cast("double") * F.col("n"))).first()[0] or 0.0) < meetings


def lineage_roots(parents: DataFrame) -> DataFrame:
    """child, parent -> node, root, depth, cyclic: ancestry by pointer jumping, so a chain of n takes log n rounds.
    Each round's table is written to the checkpoint folder where one is set. Rounds go on until no pointer moves, or until
    they have gone further than there are nodes: what still moves then leads into a cycle, and has neither root nor depth."""
    up = parents.select(F.col("child").alias("node"), F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth"))
    spark = parents.sparkSession
    nodes, reach = up.count(), 1
    while True:
        above = up.select(F.col("node").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        joined = up.join(above, "root", "left")
        moved = joined.select("node", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0).cast("long"))).alias("depth"), F.col("next").isNotNull().alias("moved"))
        up = moved.checkpoint() if spark.sparkContext.getCheckpointDir() else moved.persist()
        reach *= 2
        if reach > 2 * nodes or up.where("moved").isEmpty():
            break
        up = up.drop("moved")
    end = lambda c: F.when(~F.col("moved"), F.col(c)).alias(c)
    return up.select("node", end("root"), end("depth"), F.col("moved").alias("cyclic"))
