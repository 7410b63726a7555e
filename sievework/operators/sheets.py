"""Sample sheets: filling, expanding, required values, linkage, ledgers and shards."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_concrete, ladder, norm_key


def fill(current: Column, new: Column) -> Column:
    """struct<value, action>: a placeholder is filled, an equal value stays, a different one is a conflict."""
    return F.struct(
        F.when(~is_concrete(current) & is_concrete(new), new).otherwise(current).alias("value"),
        ladder((~is_concrete(new), "nothing"), (~is_concrete(current), "filled"), (norm_key(current) == norm_key(new), "equal"), otherwise="conflict").alias("action"),
    )


def narrow(current: Column, new: Column) -> Column:
    """A composite cell becomes the one member that equals the new value; otherwise it stays."""
    members = F.split(current, "[;|]")
    hits = F.filter(members, lambda x: norm_key(x) == norm_key(new))
    return F.when((F.size(members) > 1) & (F.size(hits) == 1), F.trim(F.get(hits, F.lit(0)))).otherwise(current)


def blockers(cells: DataFrame, required: list[str], key: str = "file") -> DataFrame:
    """Long form in, one row for each file and required header: missing, or the number of rows without a value."""
    wanted = cells.sparkSession.createDataFrame([(r,) for r in required], "header string")
    files = cells.select(key).distinct()
    counts = cells.groupBy(key, "header").agg(F.count_if(~is_concrete("value")).alias("n_bad"), F.count("*").alias("n_rows"))
    asked = files.crossJoin(F.broadcast(wanted))  # a fixed list of headers
    state = ladder((F.col("n_rows").isNull(), "missing_column"), (F.col("n_bad") > 0, "missing_values"), otherwise="ok")
    return asked.join(counts, [key, "header"], "left").select(key, "header", state.alias("state"), F.coalesce("n_bad", F.lit(0).cast("long")).alias("n_bad"))


def coverage(sheet: DataFrame, inventory: DataFrame, key: str, file: str) -> DataFrame:
    """Share of each sheet's files that the inventory has: complete, partial, none or unavailable."""
    have = inventory.select(file).distinct().withColumn("have", F.lit(1))
    sums = sheet.select(key, file).distinct().join(have, file, "left").groupBy(key).agg(F.count(file).alias("n_files"), F.sum(F.coalesce("have", F.lit(0))).alias("n_linked"))
    state = ladder((F.col("n_files") == 0, "unavailable"), (F.col("n_linked") == F.col("n_files"), "complete"), (F.col("n_linked") > 0, "partial"), otherwise="none")
    return sums.select(key, "n_files", "n_linked", state.alias("state"))


def upsert(rows: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """For each key and column the latest non-empty value."""
    last = [F.max_by(F.col(c), F.when(F.trim(F.col(c).cast("string")) != "", F.col(order))).alias(c) for c in columns]
    return rows.groupBy(key).agg(*last)


def without_failed_attempts(work: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    return work.join(ledger.where("outcome = 'no_progress'").select(*keys).distinct(), keys, "left_anti")


def balance(items: DataFrame, group: str, item: str, size: str, shards: int) -> DataFrame:
    """Items of each group over shards, the largest first, each to the lightest shard; an unknown size counts as the
    group's mean. The result depends on the order of all items of a group, so the greedy
    order is sequential: a group is one task, and has to fit it, whatever its size."""
    mean = items.groupBy(group).agg(F.avg(size).alias("mean"))
    sized = items.join(mean, group).select(group, item, F.coalesce(F.col(size).cast("double"), "mean", F.lit(0.0)).alias("w"))
    kinds = dict(sized.dtypes)

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        load = [0.0] * shards
        out = []
        for w in pdf.sort_values(["w", item], ascending=[False, True])["w"]:
            lightest = min(range(shards), key=lambda s: (load[s], s))
            load[lightest] += w
            out.append(lightest)
        return pdf.sort_values(["w", item], ascending=[False, True]).assign(shard=out)[[group, item, "shard"]]

    return sized.groupBy(group).applyInPandas(assign, f"{group} {kinds[group]}, {item} {kinds[item]}, shard long")


def records(documents: DataFrame, key: str, column: str) -> DataFrame:
    """Every object in a JSON text, at any depth, as key, path, record (JSON text), with the scalars of the objects around
    it. Bad JSON gives no rows."""
    import json

    def walk(node, path, inherited, out):
        if isinstance(node, dict):
            own = inherited | {k: v for k, v in node.items() if not isinstance(v, (dict, list))}
            out.append((path, json.dumps(own, sort_keys=True, ensure_ascii=False)))
            for k, v in node.items():
                walk(v, f"{path}.{k}", own, out)
        elif isinstance(node, list):
            for i, v in enumerate(node):
                walk(v, f"{path}[{i}]", inherited, out)

    def run(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            rows = []
            for k, text in zip(batch[key], batch[column]):
                found: list[tuple[str, str]] = []
                try:
                    walk(json.loads(text), "$", {}, found)
                except (TypeError, ValueError):
                    continue
                rows += [(k, *f) for f in found]
            yield pd.DataFrame(rows, columns=[key, "path", "record"])

    return documents.select(key, column).mapInPandas(run, f"{key} {dict(documents.dtypes)[key]}, path string, record string")
