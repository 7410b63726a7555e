"""Identity groups and order-dependent selections within a group."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _settled(df: DataFrame) -> DataFrame:
    """checkpoint() where the session has a folder for it, else kept in memory."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.persist()


def _jumped(up: DataFrame) -> DataFrame:
    """node, component of pointers to smaller nodes -> of each node where its pointers end; each round halves the ways that are left."""
    while True:
        above = up.select(F.col("node").alias("via"), F.col("component").alias("further"))
        moved = _settled(up.join(above, up.component == above.via, "left").select("node", F.col("component").alias("old"), F.coalesce("further", "component").alias("component")))
        up = moved.select("node", "component")
        if moved.where("old != component").isEmpty():
            return up


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (its least node). In each round every node points to its least neighbour if that is smaller, and goes where
    these pointers end; the links of the next round are those between ends, which are far fewer. Chains are jumped along by
    doubling, and a component's least node is always an end. From the last round back, a node takes the component of its end."""
    pairs = _settled(links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null").distinct())
    steps = []
    while not steps or not pairs.isEmpty():
        both = pairs.select(F.inline(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))))
        steps.append(_jumped(_settled(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("x")).alias("component")))))
        to = lambda x: steps[-1].select(F.col("node").alias(x), F.col("component").alias(f"to_{x}"))  # noqa: B023, E731
        moved = pairs.join(to("x"), "x").join(to("y"), "y").where("to_x != to_y")
        pairs = _settled(moved.select(F.least("to_x", "to_y").alias("x"), F.greatest("to_x", "to_y").alias("y")).distinct())
    labels = steps.pop()
    while steps:
        further = labels.select(F.col("node").alias("via"), F.col("component").alias("further"))
        step = steps.pop()
        labels = step.join(further, step.component == further.via, "left").select("node", F.coalesce("further", "component").alias("component"))
    return labels


def component_key(labels: DataFrame, prefix: str = "component", buckets: int = 4096) -> DataFrame:
    """component, n, key: a hash of its members. Members are hashed in buckets by their own hash, each sorted, and then the
    buckets' digests in order: no row holds more than a bucket of a component, or a digest for each bucket."""
    node = F.col("node").cast("string")
    rows = labels.groupBy("component", F.pmod(F.xxhash64(node), F.lit(buckets)).cast("int").alias("bucket")).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set(node)), ",").alias("m"))
    digests = rows.select("component", "n", F.struct("bucket", F.sha2("m", 256).alias("digest")).alias("d"))
    groups = digests.groupBy("component").agg(F.sum("n").alias("n"), F.array_join(F.array_sort(F.collect_list("d"))["digest"], ",").alias("m"))
    return groups.select("component", "n", F.concat(F.lit(f"{prefix}:"), F.substring(F.sha2("m", 256), 1, 24)).alias("key"))


def ordered_digest(rows: DataFrame, group: str, item: str) -> DataFrame:
    """group, fingerprint: SHA-256 of the sorted distinct items, joined by commas. The order is Spark's sort, which spills,
    and the hash takes one Arrow batch after the other, so a large group costs time in one task but no memory."""
    kind = dict(rows.dtypes)[group]

    def run(batches: Iterator[pa.RecordBatch]):
        of, digest, out = None, None, []
        for batch in batches:
            for g, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if digest is None or g != of:
                    if digest is not None:
                        out.append((of, digest.hexdigest()))
                    of, digest = g, hashlib.sha256(i.encode())
                else:
                    digest.update(b"," + i.encode())
            if len(out) > 10_000:
                yield made(out)
                out = []
        yield made(out + ([(of, digest.hexdigest())] if digest is not None else []))

    keys = rows.sparkSession.createDataFrame([], f"k {kind}").toArrow().schema.field(0).type
    made = lambda out: pa.RecordBatch.from_arrays([pa.array([g for g, _ in out], keys), pa.array([d for _, d in out], pa.string())], names=[group, "fingerprint"])
    items = rows.select(group, item).distinct().repartition(group).sortWithinPartitions(group, item)
    return items.mapInArrow(run, f"{group} {kind}, fingerprint string")


def set_cover(rows: DataFrame, group: str, item: str, features: str, score: str, most: int) -> DataFrame:
    """For each group, items that add the most new features first (then score, then the smaller item), until nothing is
    new; the rest is filled by score. A group is the passages of one text."""
    kinds = dict(rows.dtypes)

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        left = [(set(f), s, i) for f, s, i in zip(pdf[features], pdf[score], pdf[item])]
        seen: set = set()
        out = []
        while left and len(out) < most:
            best = min(left, key=lambda x: (-len(x[0] - seen), -x[1], x[2]))
            if not best[0] - seen:
                break
            out.append(best[2])
            seen |= best[0]
            left.remove(best)
        out += [i for _, _, i in sorted(left, key=lambda x: (-x[1], x[2]))][: most - len(out)]
        return pd.DataFrame({group: pdf[group].iloc[0], item: out, "rank": range(1, len(out) + 1)})

    return rows.select(group, item, features, score).groupBy(group).applyInPandas(pick, f"{group} {kinds[group]}, {item} {kinds[item]}, rank long")


def first_fit(rows: DataFrame, group: str, item: str, traits: str) -> DataFrame:
    """Items in order join the first cluster all of whose members share a trait with them, else they begin one."""
    kinds = dict(rows.dtypes)

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        clusters: list[list[set]] = []
        out = []
        for i, t in sorted(zip(pdf[item], pdf[traits]), key=lambda x: x[0]):
            t = set(t)
            for n, members in enumerate(clusters):
                if all(t & m for m in members):
                    members.append(t)
                    out.append((i, n))
                    break
            else:
                clusters.append([t])
                out.append((i, len(clusters) - 1))
        return pd.DataFrame(out, columns=[item, "cluster"]).assign(**{group: pdf[group].iloc[0]})[[group, item, "cluster"]]

    return rows.select(group, item, traits).groupBy(group).applyInPandas(place, f"{group} {kinds[group]}, {item} {kinds[item]}, cluster long")
