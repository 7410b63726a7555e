"""Evidence selection and decisions: passages, budgets, segments, votes and ordered rules.

Selections work on one array for each owner, built by a group-by of bounded passages and folded in order, or directly on
the array of a text's paragraphs, without any shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ascii_lower, ladder, norm, pack


def paragraphs(text) -> Column:
    """array<struct<pos, text, low>> of the lines with text; low is the text in lower case, made once for all uses."""
    lines = F.transform(F.split(text, "\n"), lambda t, i: F.struct(i.alias("pos"), norm(t).alias("text")))
    full = F.filter(lines, lambda p: p["text"] != "")
    return F.transform(full, lambda p: F.struct(p["pos"].alias("pos"), p["text"].alias("text"), ascii_lower(p["text"]).alias("low")))


def passage_scores(items: Column, anchors: dict[str, list[str]], cap: int = 5, bonus: int = 2) -> Column:
    """array<struct<score, pos, text, low>>: for each group of anchor terms its hits up to the cap, plus a bonus if any."""

    def hits(low: Column) -> Column:
        return F.array(*[sum((low.contains(w).cast("int") for w in terms), F.lit(0)) for terms in anchors.values()])

    def total(counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0), lambda a, n: a + F.least(n, F.lit(cap)) + F.when(n > 0, bonus).otherwise(0))

    counted = F.transform(items, lambda p: F.struct(hits(p["low"]).alias("counts"), p.alias("p")))
    return F.transform(counted, lambda x: F.struct(total(x["counts"]).alias("score"), x["p"]["pos"].alias("pos"), x["p"]["text"].alias("text"), x["p"]["low"].alias("low")))


def ranked(items: Column) -> Column:
    """Best score first, then position."""
    order = F.transform(items, lambda p: F.struct((-p["score"]).alias("rank"), p["pos"].alias("pos"), p["score"].alias("score"), p["text"].alias("text"), p["low"].alias("low")))
    return F.sort_array(order)


def distinct_by_text(rows: DataFrame, items: str) -> DataFrame:
    """The rows with only the first item of each lower-case text, in order. Sorted by text, the first of each is the one
    that differs from its neighbour: n log n steps for n items."""
    by_text = F.sort_array(F.transform(items, lambda p, i: F.struct(p["low"].alias("low"), i.alias("i"), p.alias("p"))))
    before = F.concat(F.array(F.lit(None).cast("string")), F.transform("by text", lambda x: x["low"]))
    marked = F.filter(F.zip_with("by text", F.slice(before, 1, F.size("by text")), lambda x, low: F.when(~x["low"].eqNullSafe(low), x)), lambda x: x.isNotNull())
    ordered = F.sort_array(F.transform(marked, lambda x: F.struct(x["i"].alias("i"), x["p"].alias("p"))))
    return rows.withColumn("by text", by_text).withColumn(items, F.transform(ordered, lambda x: x["p"])).drop("by text")


def budget_pack(items: Column, most: int, chars: int) -> Column:
    return pack(items, lambda p: F.length(p["text"]), most, chars)


def segments(docs: DataFrame, key: str, text: str, mention: str, reach: int = 500) -> DataFrame:
    """Text around each mention of a term, from the end of the mention before to the start of the one after, at most
    `reach` each way. Positions come from the lengths of the pieces between mentions."""
    pieces = F.split(F.col(text), "\\Q" + mention.replace("\\E", "\\E\\\\E\\Q") + "\\E")
    cut = docs.select(key, F.col(text).alias("t"), pieces.alias("p")).where(F.size("p") > 1)
    rows = cut.select(key, F.explode(F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.struct(i.alias("no"), F.get("p", i - 1).alias("before"), F.get("p", i).alias("after")))).alias("s"))
    shown = F.concat(F.substring(F.col("s.before"), -reach, reach), F.lit(mention), F.substring(F.col("s.after"), 1, reach))
    left = F.when(F.length("s.before") > reach, shown).otherwise(F.concat(F.col("s.before"), F.lit(mention), F.substring(F.col("s.after"), 1, reach)))
    return rows.select(key, F.col("s.no").cast("long").alias("mention_no"), left.alias("segment"))


def consensus(votes: Column, high_risk: Column | None = None) -> Column:
    """votes: array of support, contradict or uncertain. Two contradictions fail; two supports without any pass."""
    against = F.size(F.filter(votes, lambda v: v == "contradict"))
    support = F.size(F.filter(votes, lambda v: v == "support"))
    risk = high_risk if high_risk is not None else F.lit(False)
    return ladder(((against >= 2) | (risk & (against >= 1)), "fail"), ((support >= 2) & (against == 0), "pass"), (against >= 1, "warn"), otherwise="uncertain")


def overall(decisions: Column) -> Column:
    """An aggregate: the worst of fail, warn, pass, not_reviewed."""
    rank = ladder((decisions == "fail", 0), (decisions == "warn", 1), (decisions == "pass", 2), otherwise=3)
    least = F.min(rank)
    return ladder((least == 0, "fail"), (least == 1, "warn"), (least == 2, "pass"), otherwise="not_reviewed")


def unique_or_null(values) -> Column:
    """An aggregate: the value if there is exactly one distinct non-empty one."""
    v = F.nullif(F.trim(values), F.lit(""))
    return F.when(F.min(v) == F.max(v), F.max(v))


def chunks(items: Column, target: int, overlap: int = 1) -> Column:
    """Greedy packing of paragraphs into chunks of at most `target` characters (a longer paragraph is a chunk of its
    own); the next chunk starts with the last `overlap` paragraphs of the one before."""
    text = lambda a: F.array_join(a, "\n")
    start = F.struct(F.array().cast("array<string>").alias("open"), F.array().cast("array<string>").alias("done"), F.lit(False).alias("fresh"))

    def step(s, p):
        fits = F.length(text(F.concat(s["open"], F.array(p["text"])))) <= target
        tail = F.slice(s["open"], F.greatest(F.size(s["open"]) - overlap + 1, F.lit(1)), overlap)
        carried = F.when(F.length(text(F.concat(tail, F.array(p["text"])))) <= target, F.concat(tail, F.array(p["text"]))).otherwise(F.array(p["text"]))
        return F.when(
            fits | (F.size(s["open"]) == 0), F.struct(F.concat(s["open"], F.array(p["text"])).alias("open"), s["done"].alias("done"), F.lit(True).alias("fresh"))
        ).otherwise(F.struct(carried.alias("open"), F.concat(s["done"], F.array(text(s["open"]))).alias("done"), F.lit(True).alias("fresh")))

    return F.aggregate(items, start, step, lambda s: F.when(F.size(s["open"]) > 0, F.concat(s["done"], F.array(text(s["open"])))).otherwise(s["done"]))
