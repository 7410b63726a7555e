"""Product quantization of vectors: codebooks by Lloyd's rounds that skip most distances, after Yinyang.

A vector becomes whole numbers, floor(1024 * x), and is cut into equal parts. Each part has a codebook of 256 entries. The
entries of a codebook are clustered once into groups; a point keeps its entry and, for every group, one lower bound of its
distance to the group's other entries. When a codebook moves, a group's bound falls by the largest move of its entries. A
group is scanned only if its bound does not exceed the distance to the best entry so far; all others can't hold a nearer
entry, nor one as near. Distances that are scanned are whole numbers and compared as such, so ties go to the lower index;
bounds are floats, rounded to the safe side, and decide only what is scanned.

One Arrow pass a round reads the points with their state (codes and bounds) from a table and writes the next one, with the
sums for the next codebooks beside them: one row an entry and task, which Spark adds up. What travels to the driver and back
are the codebooks, 256 entries whatever the input. A round's table is deleted once the next one is whole.

Defined results. Vectors that are null or hold null, NaN or infinite components are dropped. The dimension is the greatest
length, rounded up to a multiple of the parts; shorter vectors count as filled up with zeros. Rows that repeat a vec_id are
points of their own; the first codebook takes them in the order of vec_id and vector, those without vec_id last. With fewer
than 256 points, a codebook has as many entries. Whole numbers of any size are compared exactly (as Python integers beyond
2^22); an error, or a sum of errors, that a long does not hold is null. An empty table gives no rows. Other columns are
ignored."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Entries of a codebook in a group, on average.
GROUP_OF = 16
#: Rows that a task handles at a time.
BLOCK_ROWS = 4096
#: Below this, squared distances are exact in doubles whatever the dimension up to 256 a part.
EXACT = 1 << 22
#: Bounds are floats of 32 bits: this share is far above their rounding.
SLACK = 1e-6
FAR = 3e38
#: Sums travel as limbs of so many bits, each a long.
LIMB = 40


# --- whole numbers ---------------------------------------------------------------------------------------------------


def whole_numbers(x: np.ndarray) -> np.ndarray:
    """floor(1024 * x) as doubles where they are exact, else as Python integers."""
    scaled = np.floor(x.astype(np.float64) * SCALE)
    if not scaled.size or np.abs(scaled).max() < EXACT:
        return scaled
    return np.array([int(v) * SCALE if abs(v) >= 1 << 52 else math.floor(v * SCALE) for v in x.ravel().tolist()], object).reshape(x.shape)


def _like(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles, or both as Python integers."""
    if a.dtype == b.dtype:
        return a, b
    return tuple(x if x.dtype == object else np.array([int(v) for v in x.ravel()], object).reshape(x.shape) for x in (a, b))


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all entries."""
    p, e = _like(points, entries)
    if p.dtype != object:
        return (p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)
    out = np.empty((len(p), len(e)), object)
    for i in range(len(e)):
        out[:, i] = ((p - e[i]) ** 2).sum(1) if p.shape[1] else 0
    return out


def squared_to_own(points: np.ndarray, entries: np.ndarray, own: np.ndarray) -> np.ndarray:
    p, e = _like(points, entries)
    d = p - e[own]
    return (d * d).sum(1) if d.shape[1] else np.zeros(len(d))


def _root(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64))


# --- groups and rounds of one part ------------------------------------------------------------------------------------


def group_entries(entries: np.ndarray) -> list[np.ndarray]:
    """Clusters of a codebook's entries, as ascending indices; none is empty. A few plain Lloyd rounds on at most 256 rows."""
    x = entries.astype(np.float64)
    centres = x[: max(1, len(x) // GROUP_OF)].copy()
    for _ in range(5):
        nearest = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1) if len(x) else np.zeros(0, int)
        for g in range(len(centres)):
            if (nearest == g).any():
                centres[g] = x[nearest == g].mean(0)
    return [np.flatnonzero(nearest == g) for g in range(len(centres)) if (nearest == g).any()]


def drifts(old: np.ndarray, new: np.ndarray, groups: list[np.ndarray]) -> np.ndarray:
    """The largest move of each group's entries, rounded up."""
    moved = _root(squared_to_own(new, old, np.arange(len(old)))) * (1 + SLACK)
    return np.array([moved[g].max() for g in groups])


def assign(points: np.ndarray, entries: np.ndarray, groups: list[np.ndarray], own: np.ndarray | None, bounds: np.ndarray | None):
    """The nearest entry of each point, its squared distance, the new bounds, and how many distances were computed.
    own, bounds: the entries before, and the groups' bounds less their drifts; None in the first round, which scans all."""
    n, k = len(points), len(groups)
    group_of = np.empty(len(entries), np.int64)
    for g, members in enumerate(groups):
        group_of[members] = g
    first = own is None
    before = np.zeros(n, np.int64) if first else own
    start = squared_to_own(points, entries, before)
    best, code = start.copy(), before.copy()
    low = np.zeros((n, k)) if first else bounds.astype(np.float64)
    scanned = np.zeros((n, k), bool)
    least, second, where = np.full((n, k), FAR), np.full((n, k), FAR), np.zeros((n, k), np.int64)
    computed = n
    for g, members in enumerate(groups):
        rows = np.flatnonzero(low[:, g] <= _root(best) * (1 + SLACK))
        if not len(rows):
            continue
        d = squared(points[rows], entries[members])
        computed += d.size
        at = d.argmin(1)  # the first of equals, so the lowest index
        here = np.arange(len(rows))
        m, index = d[here, at], members[at]
        nearer = (m < best[rows]) | ((m == best[rows]) & (index < code[rows]))
        best[rows[nearer]], code[rows[nearer]] = m[nearer], index[nearer]
        roots = _root(d)
        scanned[rows, g], least[rows, g], where[rows, g] = True, roots[here, at], index
        if len(members) > 1:
            roots[here, at] = np.inf
            second[rows, g] = roots.min(1)
    # of a scanned group: the nearest of all entries but the point's own; of another one: as before, and the entry that was left
    fresh = np.where(where == code[:, None], second, least)
    low = np.where(scanned, np.minimum(fresh, FAR) * (1 - SLACK), low)
    left = np.flatnonzero(code != before)
    if not first and len(left):
        g = group_of[before[left]]
        gone = np.minimum(_root(start[left]), FAR) * (1 - SLACK)
        low[left, g] = np.where(scanned[left, g], low[left, g], np.minimum(low[left, g], gone))
    return code, best, np.minimum(low, FAR).astype(np.float32), computed


# --- tables ----------------------------------------------------------------------------------------------------------


class _Books:
    """The codebooks of all parts in one round, their groups, and how far groups have moved since the round before."""

    def __init__(self, entries: list[np.ndarray], groups: list[list[np.ndarray]], before: _Books | None = None):
        self.entries, self.groups = entries, groups
        self.drift = [drifts(o, e, g) for o, e, g in zip(before.entries, entries, groups)] if before else None

    @property
    def dim(self) -> int:
        return sum(e.shape[1] for e in self.entries)

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for e in self.entries for row in e for v in row).encode()).hexdigest()


def usable(vectors: DataFrame, name: str) -> DataFrame:
    """vec_id, label, embedding of the rows with a vector of finite components."""
    rows = vectors.select(F.col("`vec_id`").cast("long").alias("vec_id"), F.col("`label`").alias("label"), F.col(f"`{name}`").alias("embedding"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("embedding").isNotNull() & ~odd)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a batch as rows of one matrix, filled up with zeros."""
    lengths = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten()).astype(np.float64)
    if (lengths == dim).all():
        return flat.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _limbs(total: int) -> list[int]:
    """Signed limbs: total = sum of limb_i * 2^(40 i)."""
    out, sign, total = [], 1 if total >= 0 else -1, abs(total)
    while total:
        out.append(sign * (total & ((1 << LIMB) - 1)))
        total >>= LIMB
    return out


class _Sums:
    """Counts and sums of the points of each part's entries, in one task."""

    def __init__(self, books: _Books):
        self.books = books
        self.counts = [np.zeros(len(e), np.int64) for e in books.entries]
        self.sums = [np.zeros(e.shape, np.int64) for e in books.entries]
        self.large = [np.zeros(e.shape, object) for e in books.entries]

    def add(self, part: int, points: np.ndarray, code: np.ndarray) -> None:
        self.counts[part] += np.bincount(code, minlength=len(self.counts[part]))
        if points.dtype == object:
            np.add.at(self.large[part], code, points)
            return
        for j in range(points.shape[1]):  # doubles hold these sums exactly
            self.sums[part][:, j] += np.bincount(code, points[:, j], minlength=len(self.counts[part])).astype(np.int64)

    def rows(self):
        """(part, entry, limb, sums); limb -1 is the count."""
        for part, counts in enumerate(self.counts):
            for e in np.flatnonzero(counts).tolist():
                yield part, e, -1, [int(counts[e])]
                totals = [_limbs(int(a) + int(b)) for a, b in zip(self.sums[part][e], self.large[part][e])]
                for limb in range(max(map(len, totals), default=0)):
                    yield part, e, limb, [t[limb] if limb < len(t) else 0 for t in totals]


def _assigned(points: DataFrame, books: _Books, last: bool) -> DataFrame:
    """One round: codes, bounds and error of every point, and rows of sums (part is not null) for the next codebooks."""
    fields = [points.schema["vec_id"], points.schema["label"], points.schema["embedding"]]
    kinds = [("codes", T.BinaryType()), ("bounds", T.ArrayType(T.FloatType())), ("error", T.LongType()), ("part", T.IntegerType()), ("entry", T.IntegerType()), ("limb", T.IntegerType()), ("sums", T.ArrayType(T.LongType()))]
    out = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [T.StructField(n, t) for n, t in kinds])
    widths = [len(g) for g in books.groups]

    def run(batches):
        sums, arrow = _Sums(books), None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                rows = batch.slice(at, BLOCK_ROWS)
                n = rows.num_rows
                x = _matrix(rows.column("embedding"), books.dim)
                has = "codes" in rows.schema.names
                own = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint8).reshape(n, -1).astype(np.int64) if has else None
                low = np.asarray(rows.column("bounds").flatten()).reshape(n, -1).astype(np.float64) if has else None
                codes, bounds, error = np.zeros((n, len(widths)), np.uint8), [], 0
                begin = 0
                for part, (entries, groups) in enumerate(zip(books.entries, books.groups)):
                    own_low = None
                    if has:
                        own_low = low[:, sum(widths[:part]) : sum(widths[: part + 1])]
                        own_low = np.maximum(np.where(own_low >= FAR, FAR, own_low * (1 - SLACK) - books.drift[part]), 0)
                    cut = whole_numbers(x[:, begin : begin + entries.shape[1]])
                    begin += entries.shape[1]
                    code, best, b, _ = assign(cut, entries, groups, own[:, part] if has else None, own_low)
                    codes[:, part] = code
                    bounds.append(b)
                    error = error + (best if best.dtype == object else best.astype(np.int64))
                    if not last:
                        sums.add(part, cut, code)
                arrow = rows.schema
                fits = [int(e) if int(e) < 1 << 63 else None for e in error.tolist()]
                flat = np.concatenate(bounds, axis=1) if not last else np.zeros((n, 0), np.float32)
                offsets = pa.array(np.arange(n + 1, dtype=np.int32) * flat.shape[1])
                vectors = pa.nulls(n, rows.column("embedding").type) if last else rows.column("embedding")
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("vec_id"), rows.column("label"), vectors, pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.ListArray.from_arrays(offsets, pa.array(flat.ravel(), pa.float32())), pa.array(fits, pa.int64()),
                        pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int64())),
                    ],
                    names=out.names,
                )
        got = [] if last else list(sums.rows())
        if got:
            part, entry, limb, total = zip(*got)
            n = len(got)
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(n, arrow.field(c).type) for c in ("vec_id", "label", "embedding")], pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(pa.float32())), pa.nulls(n, pa.int64())]
                + [pa.array(x, pa.int32()) for x in (part, entry, limb)]
                + [pa.array(total, pa.list_(pa.int64()))],
                names=out.names,
            )

    return points.mapInArrow(run, out)


def _moved(state: DataFrame, books: _Books) -> _Books:
    """The next codebooks: floor(sum / count) of each entry's points; entries without points stay."""
    sums = state.where("part is not null").select("part", "entry", "limb", F.posexplode("sums").alias("place", "value"))
    sums = sums.groupBy("part", "entry", "limb", "place").agg(F.sum("value").alias("value"))
    totals: dict = {}
    counts: dict = {}
    for r in sums.collect():  # at most 256 entries of each part, times their components
        if r.limb < 0:
            counts[r.part, r.entry] = r.value
        else:
            key = (r.part, r.entry, r.place)
            totals[key] = totals.get(key, 0) + (r.value << (LIMB * r.limb))
    new = []
    for part, old in enumerate(books.entries):
        rows = [[totals.get((part, e, j), 0) // counts[part, e] if (part, e) in counts else int(old[e, j]) for j in range(old.shape[1])] for e in range(len(old))]
        large = any(abs(v) >= EXACT for row in rows for v in row)
        new.append(np.array(rows, object if large else np.float64).reshape(old.shape))
    return _Books(new, books.groups, books)


def first_books(points: DataFrame) -> _Books | None:
    """Codebooks from the 256 smallest vec_ids; None without points."""
    longest = points.agg(F.max(F.size("embedding")).alias("n")).first().n
    if longest is None:
        return None
    dim = -(-longest // PARTS) * PARTS
    firsts = points.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).select("embedding").collect()
    x = np.zeros((len(firsts), dim))
    for i, r in enumerate(firsts):
        x[i, : len(r.embedding)] = r.embedding
    entries = [whole_numbers(p) for p in np.split(x, PARTS, axis=1)]
    return _Books(entries, [group_entries(e) for e in entries])


def quantized(vectors: DataFrame, column: str = "embedding") -> tuple[DataFrame, _Books | None]:
    """vec_id, label, codes (one byte a part), error of each usable row, and the final codebooks."""
    spark: SparkSession = vectors.sparkSession
    points = usable(vectors, column)
    books = first_books(points)
    if books is None:
        return points.select("vec_id", "label", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error")), None
    path = None
    for r in range(ROUNDS + 1):
        last = r == ROUNDS
        done, path = path, shared.new_folder(spark, f"vectorcodes-{r}")
        state = shared.saved_to(_assigned(points, books, last), path)
        if done:
            shared.delete(spark, done)
        if not last:
            books = _moved(state, books)
            points = state.where("part is null").select("vec_id", "label", "embedding", "codes", "bounds")
    return state.select("vec_id", "label", "codes", "error"), books


def vector_codes(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error (of all rows with that label), codebooks_sha256."""
    codes, books = quantized(vectors, column)
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = codes.groupBy(F.col("label").alias("of")).agg(F.when(F.count("error") == F.count(F.lit(1)), total).alias("total"))
    fits = F.when(F.col("total") <= (1 << 63) - 1, F.col("total").cast("decimal(38,0)")).try_cast("long")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", fits.alias("label_error"), F.lit(books.digest() if books else hashlib.sha256().hexdigest()).alias("codebooks_sha256")
    )
