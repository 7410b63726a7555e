"""Merges, guards and packings: budgets over several groups, packets, promotion of equal claims, reconciliation, bundles.

Orders that decide a result are written out as sort keys. Folds run within the array of one owner (a conversation, a
document); everything that may be hot is a partial aggregate or an anti join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, norm


def interleaved(groups: Column, most: int, budget: int, overhead: int) -> Column:
    """groups: array of arrays of struct<id, text>. Round after round every group gives its next item that is new and fits
    the budget; a text costs its length and an overhead. Stops when a whole round gives nothing.

    What a group passes over is passed over for good, so a group's turn is the first of its remaining items that fits: the
    fold walks the rounds, and each step carries how far every group has come."""
    key = lambda x: F.concat(x["id"].cast("string"), F.lit("\u001f"), x["text"])
    cost = lambda x: F.length(x["text"]) + overhead
    empty = F.slice(F.flatten(groups), 1, 0)
    start = F.struct(F.lit(0).alias("used"), empty.alias("out"), F.transform(groups, lambda g: F.lit(0)).alias("at"))

    def turn(s, g):
        rest = F.slice(F.get(groups, g), F.get(s["at"], g) + 1, F.greatest(F.size(F.get(groups, g)) - F.get(s["at"], g), F.lit(0)))
        taken = F.transform(s["out"], key)
        place = F.array_position(F.transform(rest, lambda x: ~F.array_contains(taken, key(x)) & (s["used"] + cost(x) <= budget)), F.lit(True))
        item = F.get(rest, (place - 1).cast("int"))
        moved = F.transform(s["at"], lambda n, i: F.when(i == g, F.when(place > 0, n + place.cast("int")).otherwise(F.size(F.get(groups, g)))).otherwise(n))
        return F.when(
            place > 0, F.struct((s["used"] + cost(item)).alias("used"), F.concat(s["out"], F.array(item)).alias("out"), moved.alias("at"))
        ).otherwise(F.struct(s["used"].alias("used"), s["out"].alias("out"), moved.alias("at")))

    turns = F.flatten(F.array_repeat(F.sequence(F.lit(0), F.size(groups) - 1), most))
    return F.when(F.size(groups) > 0, F.aggregate(turns, start, turn, lambda s: s["out"])).otherwise(empty)


def quota(primary: Column, secondary: Column, counts: tuple[int, int], budget: int, overhead: int) -> Column:
    """Up to so many primary items, then so many secondary ones, then the rest of both in turn of the lists; new items that fit
    the budget only."""
    tag = lambda items, lane: F.transform(items, lambda x: F.struct(F.lit(lane).alias("lane"), x.alias("x")))
    order = F.concat(tag(primary, 0), tag(secondary, 1), tag(primary, 2), tag(secondary, 2))
    start = F.struct(F.lit(0).alias("used"), F.slice(primary, 1, 0).alias("out"), F.array(F.lit(0), F.lit(0), F.lit(0)).alias("n"))

    def step(s, item):
        x, lane = item["x"], item["lane"]
        cost = F.length(x["text"]) + overhead
        room = ladder_of(lane, F.get(s["n"], F.lit(0)) < counts[0], F.get(s["n"], F.lit(1)) < counts[1])
        new = ~F.exists(s["out"], lambda o: (o["id"] == x["id"]) & (o["text"] == x["text"]))
        n = F.transform(s["n"], lambda k, i: F.when(i == lane, k + 1).otherwise(k))
        return F.when(room & new & (s["used"] + cost <= budget), F.struct((s["used"] + cost).alias("used"), F.concat(s["out"], F.array(x)).alias("out"), n.alias("n"))).otherwise(s)

    def ladder_of(lane, first, second):
        return F.when(lane == 0, first).when(lane == 1, second).otherwise(F.lit(True))

    return F.aggregate(order, start, step, lambda s: s["out"])


def packets(items: Column, chars: int, most: int) -> Column:
    """Packet number of each item of an ordered array of texts: a packet holds at most so many characters and items; a longer
    text is a packet of its own."""
    start = F.struct(F.array().cast("array<long>").alias("no"), F.lit(0).cast("long").alias("at"), F.lit(0).alias("used"), F.lit(0).alias("n"))

    def step(s, x):
        opens = (s["n"] > 0) & ((s["used"] + F.length(x) > chars) | (s["n"] >= most))
        at = s["at"] + opens.cast("long")
        used = F.when(opens, F.length(x)).otherwise(s["used"] + F.length(x))
        return F.struct(F.concat(s["no"], F.array(at)).alias("no"), at.alias("at"), used.alias("used"), F.when(opens, 1).otherwise(s["n"] + 1).alias("n"))

    return F.aggregate(items, start, step, lambda s: s["no"])


def spread(centers: Column, least: int) -> Column:
    """The centers of an ordered array that lie at least so far from every one kept before."""
    keep = lambda kept, x: F.when(F.exists(kept, lambda k: F.abs(x - k) < least), kept).otherwise(F.concat(kept, F.array(x)))
    return F.aggregate(centers, F.array().cast("array<int>"), keep)


def occurrences(text: Column, term: str, most: int) -> Column:
    """Places (from 0) of the first `most` occurrences of a term that do not overlap, in lower-case text."""
    quoted = "\\Q" + term + "\\E"
    pieces = F.split(text, quoted, most + 1)
    front = lambda i: F.aggregate(F.slice(pieces, 1, i), F.lit(0), lambda a, p: a + F.length(p)) + (i - 1) * len(term)
    return F.transform(F.slice(F.sequence(F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(1))), 1, F.size(pieces) - 1), front)


def window_around(text, start: Column, end: Column, radius: int) -> Column:
    """The characters [start, end) of a text and so many on each side, white space collapsed."""
    first = F.greatest(start - radius, F.lit(0))
    return norm(F.substring(col(text), first + 1, end + radius - first))


def clipped(text, center: Column, chars: int, front: int = 120, tail: int = 140) -> Column:
    """About so many characters around a place, cut back to the ends of sentences or clauses that lie near its edges."""
    t = col(text)
    n = F.length(t)
    begin = F.greatest(F.least(F.greatest(center - chars // 2, F.lit(0)), n - chars), F.lit(0))
    end = F.least(n, begin + chars)
    cut = F.substring(t, begin + 1, end - begin)
    near = lambda mark: F.when(F.instr(cut, mark).between(1, front + 1), F.instr(cut, mark))
    head = F.least(near(". "), near("; "))
    cut = F.when((begin > 0) & head.isNotNull(), F.substring(cut, head + 2, chars)).otherwise(cut)
    last = lambda mark: F.when(F.locate(mark[::-1], F.reverse(cut)) > 0, F.length(cut) - F.locate(mark[::-1], F.reverse(cut)) - 1)
    foot = lambda mark: F.when(last(mark) >= F.length(cut) - tail, last(mark))
    at = F.greatest(foot(". "), foot("; "))
    return norm(F.when((end < n) & at.isNotNull(), F.substring(cut, 1, at + 1)).otherwise(cut))


def promoted(claims: DataFrame, edge: str, signature: list[str], confidence: str) -> DataFrame:
    """One row for each edge: promoted if all its claims assert the same, with the greatest confidence; else refused."""
    row = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in signature])
    sums = claims.groupBy(edge).agg(F.min(row).alias("low"), F.max(row).alias("high"), F.max(confidence).alias("confidence"), F.count("*").alias("claims"))
    same = F.col("low") == F.col("high")
    return sums.select(edge, "claims", F.when(same, "promoted").otherwise("refused").alias("outcome"), F.when(same, F.col("confidence")).alias("confidence"))


def insert_or_ignore(present: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """The present rows and, of the new ones, the first of each key that is not there yet. Which is first, `order` says."""
    rest = [c for c in new.columns if c != key]
    first = new.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("row")).select(key, "row.*")
    return present.select(key, *rest).unionByName(first.join(present.select(key), key, "left_anti"))


def agreed(values: DataFrame, keys: list[str], root: str, value: str) -> DataFrame:
    """keys, value, roots, state: a value on which all roots that have one agree; null where they do not."""
    v = F.nullif(norm(value), F.lit(""))
    sums = values.where(v.isNotNull()).groupBy(*keys).agg(F.min(v).alias("low"), F.max(v).alias("high"), F.countDistinct(root).alias("roots"))
    same = F.col("low") == F.col("high")
    state = F.when(~same, "conflict").when(F.col("roots") > 1, "agreed").otherwise("single_root")
    return sums.select(*keys, F.when(same, F.col("low")).alias("value"), "roots", state.alias("state"))


def preferred_or_mode(rows: DataFrame, group: str, value: str, preferred: list[str]) -> DataFrame:
    """group, value: the first of the preferred values that the group has, else its most frequent one (of equals the
    smallest)."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"))
    rank = F.array_position(F.array(*[F.lit(p) for p in preferred]), F.col(value))
    best = F.struct(F.when(rank > 0, rank).otherwise(F.lit(len(preferred) + 1)).alias("rank"), (-F.when(rank > 0, F.lit(0)).otherwise(F.col("n"))).alias("n"), F.col(value).alias("v"))
    return counts.groupBy(group).agg(F.min(best).alias("m")).select(group, F.col("m.v").alias(value))


def expanded(rows: DataFrame, channels: str, gate: Column, column: str) -> DataFrame:
    """Rows that pass the gate become one row for each of their channels; the others stay as they are, without one."""
    keep = F.array(F.lit(None).cast("string"))
    return rows.withColumn(column, F.explode(F.when(gate & (F.size(channels) > 0), F.col(channels)).otherwise(keep))).drop(channels)


def canonical_records(cells: DataFrame, key: str, header: str, value: str, aliases: dict[str, str]) -> DataFrame:
    """key, field, value: cells whose normalized header is an alias of a field. A record with two different values of a
    field is left out as a whole."""
    from ..functions.columns import norm_key

    names = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    field = F.element_at(names, norm_key(header))
    found = cells.select(key, field.alias("field"), norm(value).alias("value")).where("field is not null and value <> ''")
    folded = F.lower("value")
    fields = found.groupBy(key, "field").agg(F.max("value").alias("value"), (F.min(folded) != F.max(folded)).alias("clash"))
    clashing = fields.where("clash").select(key).distinct()
    return fields.drop("clash").join(clashing, key, "left_anti")
