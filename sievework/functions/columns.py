"""Column functions that the operators share. All are built-in expressions, so they stay in generated code.

Missing text is the empty string: every function that concatenates or hashes coalesces first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Cells that stand for a missing value.
PLACEHOLDERS = ("", "not available", "not applicable", "na", "n/a", "nan", "none", "null", "unknown", "not provided", "pooled")
# Cells that mean yes.
TRUTHY = ("yes", "true", "1", "y", "positive", "include", "included")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_of(c) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def ascii_lower(c) -> Column:
    return F.translate(col(c), UPPER, LOWER)


def norm(c) -> Column:
    """White space collapsed and trimmed."""
    return F.trim(F.regexp_replace(text_of(c), r"[ \t\n\r\f\x0B]+", " "))


def norm_key(c) -> Column:
    return F.regexp_replace(ascii_lower(text_of(c)), "[^a-z0-9]", "")


def is_concrete(c) -> Column:
    return ~ascii_lower(norm(c)).isin(*PLACEHOLDERS)


def truthy(c) -> Column:
    return ascii_lower(F.trim(text_of(c))).isin(*TRUTHY)


def first_nonblank(*cs) -> Column:
    return F.coalesce(*[F.nullif(F.trim(text_of(c)), F.lit("")) for c in cs], F.lit(""))


def excerpt(text, needle, left: int = 100, right: int = 140, fallback: int = 240) -> Column:
    """The surroundings of the first match, control white space as spaces; the text's front, as it is, where there is none."""
    t = text_of(text)
    at = F.instr(ascii_lower(t), ascii_lower(needle)) if not isinstance(needle, str) else F.instr(ascii_lower(t), needle)
    length = F.length(needle) if not isinstance(needle, str) else F.lit(len(needle))
    start = F.greatest(at - left, F.lit(1))
    shown = F.translate(F.substring(t, start, at + length + right - start), "\n\r\t", "   ")
    return F.when(at > 0, shown).otherwise(F.substring(t, 1, fallback))


def stable_id(prefix: str, *parts) -> Column:
    joined = F.concat_ws("\u001f", *[ascii_lower(norm(p)) for p in parts])
    return F.concat(F.lit(f"{prefix}:"), F.substring(F.sha2(joined, 256), 1, 24))


def tokens(c) -> Column:
    """Distinct upper-case alphanumeric tokens."""
    return F.array_distinct(F.filter(F.split(F.translate(text_of(c), LOWER, UPPER), "[^A-Z0-9]+"), lambda x: x != ""))


def jaccard(a, b) -> Column:
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(F.lit(0.0))


def overlap_coefficient(a, b) -> Column:
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.lit(0.0))


def join_first_seen(values, sep: str = "; ") -> Column:
    """values: array of struct(ord, v). Distinct non-empty values in order of first sight."""
    ordered = F.transform(F.sort_array(values), lambda x: x["v"])
    return F.array_join(F.array_distinct(F.filter(ordered, lambda v: v != "")), sep)


def ladder(*steps, otherwise=None) -> Column:
    """The value of the first (condition, value) that holds."""
    out = None
    for cond, value in steps:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def keep_rows(df, condition: Column):
    """The rows that meet a condition on computed columns. A filter would be pushed below the projections that compute them
    and repeat their expressions for every mention; a generator of one row or none stays above, so each is computed once."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.explode(F.when(condition, F.array(row))).alias("row")).select("row.*")


def flags(**conditions) -> Column:
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()]))


def pack(items, cost, most: int, budget: int) -> Column:
    """Greedy selection over an ordered array: an item that does not fit is skipped, later ones may still fit."""
    first = F.struct(F.lit(0).alias("used"), F.slice(items, 1, 0).alias("out"))
    return F.aggregate(
        items,
        first,
        lambda s, x: F.when(
            (F.size(s["out"]) < most) & (s["used"] + cost(x) <= budget),
            F.struct((s["used"] + cost(x)).alias("used"), F.concat(s["out"], F.array(x)).alias("out")),
        ).otherwise(s),
        lambda s: s["out"],
    )


def format_bytes(c) -> Column:
    """Whole bytes below one KiB, else two decimals of the greatest unit that fits, up to PiB."""
    n = col(c).cast("double")
    out = F.format_string("%d B", col(c).cast("long"))
    for power, unit in enumerate(("KiB", "MiB", "GiB", "TiB", "PiB"), 1):
        out = F.when(n >= 1024.0**power, F.format_string(f"%.2f {unit}", n / F.lit(1024.0**power))).otherwise(out)
    return out
