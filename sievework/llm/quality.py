r"""Quality rules: a table of thresholds, compiled into one projection of built-in expressions.

Every measure is a Spark SQL expression over one row: no user function, no shuffle, no state, so the rules run where the
scan runs. Word runs that a text repeats are found by sorting the hashes of its 3-word windows within the row, which
takes n log n steps for n words; texts of any length are read whole.

Defined results: null counts as the empty text, which has no words and fails the base rule. Repeated rows give one row
each. An empty table gives no rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

# Function words by language, the most frequent ones of each.
STOP_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he his are this from at or have an they which you",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son ou",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha",
}


@dataclass(frozen=True)
class Rule:
    """The text fails where 1000 * part is under `least` or over `most` times whole. Both name columns of measures."""

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None


#: Thresholds in thousandths of the second column.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", least=2500, most=12000),
    Rule("symbol_ratio", "n_symbols", "n_words", most=100),
    Rule("stop_word_ratio", "n_stop_words", "n_words", least=60),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_full_lines", most=400),
    Rule("repeated_word_ratio", "n_repeat_words", "n_words", most=300),
)


def _window_hashes(words: Column) -> Column:
    """One 64-bit hash for each run of 3 words, in order."""
    n = F.greatest(F.size(words) - 2, F.lit(0))
    pairs = F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.zip_with(pairs, F.slice(words, 3, n), lambda ab, c: F.xxhash64(ab["a"], ab["b"], c))


def _neighbours(values: Column, make) -> Column:
    n = F.greatest(F.size(values) - 1, F.lit(0))
    return F.zip_with(F.slice(values, 1, n), F.slice(values, 2, n), make)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc (the document's columns as a struct) and the measures that the rules name.

    Whether a text repeats a window shows in its sorted hashes. Only for those that do, the hashes are sorted along with
    their places; sorted by place, each repeated window covers the words up to the next one's start, at most 3. Columns
    that later steps use twice stay in projections of their own, so nothing is computed twice."""
    m = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    bare = F.btrim("t", F.lit(" \t\n\u000b\f\r"))
    m = m.select("doc", "t", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE)).alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(" \t\n\u000b\f\r")) != "").alias("lines"))
    m = m.select("doc", "t", "w", "lines", _window_hashes(F.col("w")).alias("h"))
    m = m.withColumn("repeats", F.exists(_neighbours(F.sort_array("h"), lambda a, b: a == b), lambda x: x))
    ordered = F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    m = m.withColumn("o", F.when(F.col("repeats"), ordered))
    twice = F.filter(_neighbours(F.col("o"), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))), lambda x: x.isNotNull())
    m = m.withColumn("places", F.sort_array(F.array_distinct(F.flatten(twice))))
    covered = F.aggregate(
        "places",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    stops = sorted({v for own in STOP_WORDS.values() for w in own.split() for v in (w, w[0].upper() + w[1:])})
    return m.select(
        "doc",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", f"[{SYMBOLS}]+", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_full_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("w", lambda w: w.isin(stops))).cast("long").alias("n_stop_words"),
    )


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that a text breaks, as one expression over the measures."""
    checks = []
    for r in rules:
        bad = F.lit(False)
        if r.least is not None:
            bad = bad | (F.col(r.part) * 1000 < F.col(r.whole) * r.least)
        if r.most is not None:
            bad = bad | (F.col(r.part) * 1000 > F.col(r.whole) * r.most)
        checks.append(F.when(bad, F.lit(r.name)))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def quality_verdicts(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc (the document's columns as a struct), the measures, base_failed, failed_rules, kept."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = measures(docs).withColumn("base_failed", base).withColumn("failed_rules", compiled(rules))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with their own columns.

    A filter on `kept` would be pushed below the measures and compute each of them once for every mention; a generator of
    one row or none stays above them, so every text is measured once."""
    return quality_verdicts(docs, rules).select(F.explode(F.when(F.col("kept"), F.array("doc"))).alias("doc")).select("doc.*")
