"""Mixing sources to target weights by Poisson replication.

A document of source s is to appear with mean rate r_s = weight_s * total / count_s. Its number of copies is a Poisson
variable of that mean, found by inverting the distribution at a point that a hash of seed and doc_id fixes; so a rerun,
or a retried task, gives the same copies. Copies get a hash of their own as sort key, and one range shuffle over it
mixes them globally.

The distribution is tabulated once for each distinct source, far into the tail (the rest is under 1e-15); a document's
copies are the table's entries that its point has passed. Hot sources cost nothing extra: counts are partial sums, the
table of sources goes to the documents by a join whose side Spark measures first, and documents of a source are spread
by their hash. Sources that are hot keep their rows where they are: the join key of a document is (source, salt).

A mean over MOST_RATE is split into equal parts whose counts are added, which has the same distribution, so no table is
longer than some 200 entries.

Defined results: an empty table gives no rows. mix() replaces input columns named copy_no or sort_key by its own;
mixed_documents() returns the input's. A null source is a source of its own, named by null. Sources without a weight share the remaining
weight in proportion to their documents; weights that sum to more than 1 are scaled. Null doc_ids use the hash of null.
Repeated rows are repeated documents. Documents with null text are mixed like others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

#: md5 hex digits that make a point in [0, 1): 13 digits are 52 bits, which a double holds exactly.
DIGITS = 13
#: A greater mean is met by the sum of independent counts of equal means up to this one, each from a point of its own.
MOST_RATE = 64.0
#: Parts into which the documents of each source are dealt for the join with the sources' tables.
SALTS = 64


def point(*parts: Column) -> Column:
    """A number in [0, 1) that the parts fix."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long") / F.lit(float(16**DIGITS))


def rates(docs: DataFrame, weights: dict[str, float], total: float | None = None) -> DataFrame:
    """src, n_docs, rate. total: the wanted number of documents, that of the input where it is None."""
    counts = docs.groupBy(F.col("source").alias("src")).agg(F.count("*").alias("n_docs"))
    if weights:
        keys = F.create_map(*[x for k, v in sorted(weights.items()) for x in (F.lit(k), F.lit(float(v)))])
        weight = F.when(F.col("src").isNotNull(), F.element_at(keys, F.col("src")))
    else:
        weight = F.lit(None).cast("double")
    given = sum(weights.values())
    counts = counts.withColumn("weight", weight)
    sums = counts.agg(
        F.sum("n_docs").cast("double").alias("n_all"), F.sum(F.when(F.col("weight").isNull(), F.col("n_docs"))).cast("double").alias("n_rest")
    )
    share = F.when(F.col("weight").isNotNull(), F.col("weight") / F.lit(max(1.0, given))).otherwise(
        F.lit(max(0.0, 1.0 - given)) * F.col("n_docs") / F.col("n_rest")
    )
    wanted = F.col("n_all") if total is None else F.lit(float(total))
    return counts.crossJoin(F.broadcast(sums)).select("src", "n_docs", (share * wanted / F.col("n_docs")).alias("rate"))  # one row of sums


def _table(rate: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, 2, ... copies. Terms are exp(k ln r - r - ln k!), so no mean is too
    large for the first one."""
    last = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")
    logs = F.aggregate(
        F.sequence(F.lit(0), last),
        F.struct(F.array().cast("array<double>").alias("cdf"), F.lit(0.0).alias("at"), (-rate).alias("log")),
        lambda a, k: F.struct(
            F.concat(a["cdf"], F.array(a["at"] + F.exp(a["log"]))).alias("cdf"),
            (a["at"] + F.exp(a["log"])).alias("at"),
            (a["log"] + F.log(rate) - F.log((k + 1).cast("double"))).alias("log"),
        ),
    )["cdf"]
    return F.when(rate > 0, logs).otherwise(F.array(F.lit(1.0)))


def mix(docs: DataFrame, weights: dict[str, float], total: float | None = None, seed: int = 17) -> DataFrame:
    """The documents' columns, copy_no (from 0) and sort_key, in the order of sort_key."""
    own = [F.col(f"doc.`{c}`") for c in docs.columns if c not in ("copy_no", "sort_key")]
    return _mixed(docs, weights, total, seed).select(*own, "copy_no", "sort_key")


def _mixed(docs: DataFrame, weights: dict[str, float], total: float | None, seed: int) -> DataFrame:
    """doc (the documents' columns as a struct), copy_no, sort_key, in the order of sort_key."""
    rate = F.col("rate")
    parts = F.greatest(F.ceil(rate / MOST_RATE), F.lit(1)).cast("int")
    tables = rates(docs, weights, total).select("src", parts.alias("parts"), _table(rate / parts).alias("cdf"))
    spread = shared.saved(tables, "mixing-rates").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("source").alias("own"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    joined = rows.alias("d").join(spread.alias("t"), F.col("d.own").eqNullSafe(F.col("t.src")) & (F.col("d.salt") == F.col("t.salt"))).select("d.doc", "t.parts", "t.cdf")
    passed = lambda u: F.size(F.filter("cdf", lambda p: p <= u)).cast("long")
    more = F.aggregate(F.sequence(F.lit(1), F.col("parts") - 1), F.lit(0).cast("long"), lambda n, k: n + passed(point(F.lit(seed), F.col("doc.doc_id"), k)))
    copies = passed(point(F.lit(seed), F.col("doc.doc_id"))) + F.when(F.col("parts") > 1, more).otherwise(0)
    counted = joined.select("doc", copies.alias("copies"))
    out = counted.select("doc", F.explode(F.when(F.col("copies") > 0, F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).alias("copy_no"))
    key = F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), F.coalesce(F.col("doc.doc_id").cast("string"), F.lit("null")), F.col("copy_no")))
    return out.withColumn("sort_key", key).orderBy("sort_key", "doc.doc_id", "copy_no")


# The weights of the registered query; the other sources share the rest.
WEIGHTS = {"src0": 0.10, "src1": 0.20, "src2": 0.05}


def mixed_documents(docs: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """The mixed corpus with the documents' own columns only."""
    return _mixed(docs, weights, None, 17).select("doc.*")


def oracle(weights: dict[str, float] = WEIGHTS, seed: int = 17) -> str:
    """DuckDB SQL for mix(): the same hashes, the same inversion."""
    given = sum(weights.values())
    values = ", ".join(f"('{k}', {v!r})" for k, v in sorted(weights.items()))
    return f"""
    WITH w(src, weight) AS (VALUES {values}),
    c AS (SELECT source AS src, count(*) AS n_docs FROM documents GROUP BY source),
    cw AS (SELECT c.src, n_docs, weight FROM c LEFT JOIN w ON c.src = w.src),
    s AS (SELECT sum(n_docs)::DOUBLE AS n_all, sum(CASE WHEN weight IS NULL THEN n_docs END)::DOUBLE AS n_rest FROM cw),
    r AS (SELECT src, CASE WHEN weight IS NOT NULL THEN weight / {max(1.0, given)!r}
                           ELSE {max(0.0, 1.0 - given)!r} * n_docs / n_rest END * n_all / n_docs AS rate FROM cw, s),
    p AS (SELECT src, rate, unnest(range(0, ceil(rate + 10 * sqrt(rate) + 20)::BIGINT + 1)) AS k FROM r),
    q AS (SELECT src, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1.0))) OVER (PARTITION BY src ORDER BY k) AS cdf FROM p WHERE rate > 0),
    t AS (SELECT src, list(cdf ORDER BY k) AS cdfs FROM q GROUP BY src),
    u AS (SELECT doc_id, source, ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')), 1, {DIGITS}))::BIGINT / {float(16**DIGITS)!r} AS u, n_chars, lang, md5(text) AS text_md5 FROM documents),
    n AS (SELECT u.*, len(list_filter(cdfs, lambda x: x <= u.u)) AS copies FROM u JOIN t ON u.source IS NOT DISTINCT FROM t.src)
    SELECT doc_id, source, lang, n_chars, text_md5, unnest(range(0, copies)) AS copy_no FROM n
    """
