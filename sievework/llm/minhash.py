r"""Near-duplicate detection: MinHash bands propose pairs, odd sketches sift them, full shingle sets decide.

1. One Arrow pass makes each document's set of word shingles, its MinHash samples, and from those the band keys and an
   odd sketch: a bitmap in which every sample flips one bit, so that the XOR of two bitmaps counts the samples in which
   two documents differ, precisely where similarities are high. A second bitmap does the same for the whole set; in it two
   documents never differ in more bits than their sets do in shingles.
2. Documents with equal sets become one class, led by the smallest doc_id. Only class leaders go on, so thousands of
   exact copies cost one row.
3. Leaders that share a band key are in one bucket. Each is compared with the bucket's smallest leader: one pair for
   each member, never all pairs.
4. After that round, members that did not join their bucket's component, and the other members of their buckets, meet in a
   prefix join: sets of the asked similarity share one of their rarest shingles, so a bucket of many unlike documents is
   never compared pair by pair. Sizes and sketches sift these pairs.
5. A pair counts as a link only if the full sets have the asked similarity.

40 bands of 5 rows miss a pair of similarity 0.8 with a probability of 1.2e-7; the sketch bound lies six standard
deviations beyond the expectation at that similarity.

Defined results: null, empty and wordless texts have the empty set and are linked with nothing. Documents of fewer words
than a shingle have their whole sequence as the one shingle. doc_id names the node: rows that repeat it are one node,
linked by each of their texts. Rows without doc_id join the class of equal texts but never lead one."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared
from .components import components

BANDS, ROWS = 40, 5
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
PARITY_BITS = 1024

_RNG = np.random.default_rng(20240229)
_MULTIPLIERS = _RNG.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADDENDS = _RNG.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)


def _sets(data: np.ndarray, offsets: np.ndarray, hasher: shared.Hasher, size: int):
    """Each text's distinct shingle hashes, sorted, end to end, and their counts."""
    data = shared.LOWER[data]
    starts, ends, woff = shared.word_spans(data, offsets, shared.WORD)
    words = hasher.spans(hasher.prefix(data), starts, ends)
    runs = shared.shingle_hashes(words, size)
    out, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for i, (b, e) in enumerate(zip(woff[:-1].tolist(), woff[1:].tolist())):
        if e - b >= size:
            own = np.unique(runs[b : e - size + 1])
        elif e > b:
            own = shared.shingle_hashes(words[b:e], e - b)
        else:
            continue
        out.append(own)
        counts[i] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), counts


def _fold(samples: np.ndarray) -> np.ndarray:
    """Odd sketches: rows of 8 words of 64 bits. samples: one column for each document."""
    n = samples.shape[1]
    bits = np.zeros((n, SKETCH_BITS), np.uint8)
    rows = np.arange(n)
    for j in range(SAMPLES):
        place = shared.mixed(samples[j].astype(np.uint64) + shared.U64(j << 32)) >> shared.U64(55)
        bits[rows, place.astype(np.int64)] ^= 1
    return np.packbits(bits, axis=1).view(np.int64)


def _parities(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Odd sketches of whole sets: every shingle flips one bit, so two sketches never differ in more bits than the sets
    differ in shingles."""
    place = (shared.mixed(values ^ shared.U64(0xA0761D6478BD642F)) >> shared.U64(54)).astype(np.int64)
    flips = np.bincount(np.repeat(np.arange(len(counts)), counts) * PARITY_BITS + place, minlength=len(counts) * PARITY_BITS)
    return np.packbits((flips & 1).astype(np.uint8).reshape(len(counts), PARITY_BITS), axis=1).view(np.int64)


def signatures(docs: DataFrame, size: int = 4) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (together a 128-bit name of the set), bands, sketch of the samples, parity of the
    whole set (all three empty for empty sets)."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64())), ("parity", pa.list_(pa.int64()))]
    )

    def sign(batches):
        hasher = shared.Hasher()
        for rows, data, offsets in shared.text_blocks(batches, "text", 1 << 20):
            values, counts = _sets(data, offsets, hasher, size)
            full = np.flatnonzero(counts)
            n = rows.num_rows
            names = np.zeros((2, n), np.uint64)
            bands, sketch = np.zeros((len(full), BANDS), np.int64), np.zeros((len(full), SKETCH_BITS // 64), np.int64)
            parity = np.zeros((len(full), PARITY_BITS // 64), np.int64)
            if len(full):
                at = np.cumsum(counts[full]) - counts[full]
                names[0, full] = np.add.reduceat(shared.mixed(values + shared.U64(11)), at)
                names[1, full] = np.add.reduceat(shared.mixed(values ^ shared.U64(0x5851F42D4C957F2D)), at)
                short = (values >> shared.U64(32)).astype(np.uint32)
                samples = np.empty((SAMPLES, len(full)), np.uint32)
                for j in range(SAMPLES):
                    samples[j] = np.minimum.reduceat(short * _MULTIPLIERS[j] + _ADDENDS[j], at)
                for b in range(BANDS):
                    key = np.full(len(full), b + 1, np.uint64)
                    for r in range(ROWS):
                        key = shared.mixed(key * shared.U64(0x9E3779B97F4A7C15) + samples[b * ROWS + r])
                    bands[:, b] = key.view(np.int64)
                sketch = _fold(samples)
                parity = _parities(values, counts[full])
            has = counts > 0
            cuts = np.concatenate(([0], np.cumsum(has)))
            yield shared.columns_to_batch(
                schema, rows.column("doc_id"), counts, names[0].view(np.int64), names[1].view(np.int64),
                shared.lists(bands.ravel(), cuts * BANDS, pa.int64()), shared.lists(sketch.ravel(), cuts * (SKETCH_BITS // 64), pa.int64()),
                shared.lists(parity.ravel(), cuts * (PARITY_BITS // 64), pa.int64()),
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        sign, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>, parity array<long>"
    )


def shingle_sets(docs: DataFrame, size: int = 4) -> DataFrame:
    """doc_id, shingles: the full set as sorted 64-bit hashes."""
    schema = pa.schema([("doc_id", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def make(batches):
        hasher = shared.Hasher()
        for rows, data, offsets in shared.text_blocks(batches, "text"):
            values, counts = _sets(data, offsets, hasher, size)
            yield shared.columns_to_batch(schema, rows.column("doc_id"), shared.lists(values.view(np.int64), np.concatenate(([0], np.cumsum(counts))), pa.int64()))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(make, "doc_id long, shingles array<long>")


def sketch_bound(similarity: float, deviations: float = 6.0) -> int:
    """The most bits in which the sketches of two sets of this similarity differ, but for `deviations` of the samples'
    and the folding's chance together."""
    flips = 2 * SAMPLES * (1 - similarity)
    left = math.exp(-2 * flips / SKETCH_BITS)
    chance = left**2 * 4 * SAMPLES * similarity * (1 - similarity) + SKETCH_BITS / 4 * (1 - left**2)
    return math.ceil(SKETCH_BITS / 2 * (1 - left) + deviations * math.sqrt(chance))


def _differing(a: str, b: str) -> F.Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _sifted(pairs: DataFrame, light: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sizes and sketches are near enough; only sketches travel here."""
    for x in "uv":
        side = light.select(F.col("leader").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"), F.col("parity").alias(f"p{x}"))
        pairs = pairs.join(side, x)
    return pairs.where(_near(percent)).select("u", "v").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets have at least the asked similarity."""
    of = lambda x: sets.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"a{x}"), F.col("n").alias(f"n{x}"))
    both = pairs.join(of("u"), "u").join(of("v"), "v")
    common = F.size(F.array_intersect("au", "av"))
    return both.where(100 * common >= percent * (F.col("nu") + F.col("nv") - common)).select("u", "v").distinct()


def _near(percent: int) -> F.Column:
    """Sizes and sketches that the asked similarity allows. Sets of that similarity differ in a fixed share of their sizes
    at most, and their parities in no more bits: this bound loses nothing."""
    sizes = (F.col("nu") * 100 >= F.col("nv") * percent) & (F.col("nv") * 100 >= F.col("nu") * percent)
    parity = _differing("pu", "pv") * (100 + percent) <= (F.col("nu") + F.col("nv")) * (100 - percent)
    return sizes & parity & (_differing("su", "sv") <= sketch_bound(percent / 100))


def _meeting(near: DataFrame, sets: DataFrame, percent: int, files: int) -> DataFrame:
    """near: leader, c (its component), outer (still to be compared). Pairs (u, v) of different components, u outer, that
    share a shingle of both prefixes. With all shingles in one order, the rarest first, two sets of the asked similarity
    share one of their first n - ceil(n * percent / 100) + 1; a shingle of one holder meets nothing. Sizes, and the places
    of the shared shingle, bound the pairs inside the join: where it is the first one that two sets share, the shorter rest
    behind it must still hold what the similarity asks for."""
    own = near.select(F.col("leader").alias("doc_id"), "c", "outer")
    held = sets.join(own, "doc_id", "left_semi").select(F.explode("shingles").alias("t")).groupBy("t").agg(F.count("*").alias("held"))
    words = sets.join(own, "doc_id").select("doc_id", "c", "outer", "n", "set", F.explode("shingles").alias("t"))
    rank = F.dense_rank().over(Window.partitionBy("doc_id", "set").orderBy("held", "t"))
    first = words.join(held, "t").withColumn("rank", rank).where(F.expr(f"rank <= n - (n * {percent} + 99) div 100 + 1 and held > 1"))
    first = shared.saved(first.select("doc_id", "c", "outer", "n", "t", "rank"), "minhash-prefixes", files=files)
    of = lambda x: first.select(F.col("t").alias(f"t{x}"), F.col("doc_id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("c", "outer", "n", "rank")])
    able = (
        "tu = tv and c_u != c_v and (not outer_v or u < v)"
        f" and n_u * 100 >= n_v * {percent} and n_v * 100 >= n_u * {percent}"
        f" and (1 + least(n_u - rank_u, n_v - rank_v)) * {100 + percent} >= {percent} * (n_u + n_v)"
    )
    return of("u").where("outer_u").join(of("v"), F.expr(able)).select("u", "v").distinct()


def near_duplicates(docs: DataFrame, size: int = 4, percent: int = 80) -> DataFrame:
    """One row for each document row: doc_id, n_shingles, component_id, kept."""
    docs = shared.columns(docs, "doc_id", "text")
    sig = shared.saved(signatures(docs, size), "minhash-signatures")
    files = shared.files_for(sig)
    classes = shared.saved(
        sig.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles")
        .agg(F.min("doc_id").alias("leader"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("parity").alias("parity")),
        "minhash-classes", files=files,
    )
    leaders = classes.where("leader is not null").select("leader", F.col("n_shingles").alias("n"), "sketch", "parity", "bands")
    entries = leaders.select(F.explode("bands").alias("key"), "leader")
    pivots = shared.saved(entries.groupBy("key").agg(F.min("leader").alias("pivot"), F.count("*").alias("n")).where("n > 1").select("key", "pivot"), "minhash-pivots", files=files)
    members = shared.saved(entries.join(pivots, "key"), "minhash-members", files=files)
    light = leaders.select("leader", "n", "sketch", "parity")
    ids = shared.saved(members.select(F.explode(F.array("leader", "pivot")).alias("doc_id")).distinct(), "minhash-ids", files=files)
    sets = shingle_sets(docs.join(ids, "doc_id", "left_semi"), size)
    sets = sets.withColumns({"n": F.size("shingles").cast("long"), "set": F.xxhash64("shingles")})  # once a set, not once a shingle
    sets = shared.saved(sets, "minhash-sets", release=True, files=files)
    stars = shared.saved(members.where("leader != pivot").select(F.col("pivot").alias("u"), F.col("leader").alias("v")).distinct(), "minhash-stars", files=files)
    able = shared.saved(_sifted(stars, light, percent), "minhash-able", files=files)
    links = shared.saved(_verified(able, sets, percent), "minhash-links", files=files)
    found = shared.saved(components(links, files), "minhash-components", files=files)

    # members outside their pivot's component, against the other components of their bucket
    comp = lambda x: F.coalesce(F.col(f"c_{x}"), F.col(x))
    named = found.select(F.col("node").alias("leader"), F.col("component").alias("c_leader"))
    pivot = found.select(F.col("node").alias("pivot"), F.col("component").alias("c_pivot"))
    placed = members.join(named, "leader", "left").join(pivot, "pivot", "left").select("key", "leader", comp("leader").alias("c"), comp("pivot").alias("p"))
    open_keys = placed.where("c != p").select("key").distinct()
    near = placed.join(open_keys, "key").groupBy("leader").agg(F.first("c").alias("c"), F.max(F.col("c") != F.col("p")).alias("outer"))
    rest = _meeting(shared.saved(near, "minhash-near", files=files), sets, percent, files)
    rest = _sifted(rest, light, percent)
    rest = shared.saved(rest.join(stars.select("u", "v").unionAll(stars.select("v", "u")), ["u", "v"], "left_anti"), "minhash-rest", files=files)
    if not rest.isEmpty():
        more = _verified(rest, sets, percent)
        stars = found.select(F.col("node").alias("u"), F.col("component").alias("v"))
        found = shared.saved(components(stars.unionAll(more), files), "minhash-components", files=files)

    named = classes.select("set_a", "set_b", "n_shingles", "leader").join(
        found.select(F.col("node").alias("leader"), "component"), "leader", "left"
    )
    named = shared.saved(named.select("set_a", "set_b", "n_shingles", F.coalesce("component", "leader").alias("component")), "minhash-named", files=files)
    out = sig.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    )


def _row_names(docs: DataFrame, files: int) -> DataFrame:
    """Numbers of their own for the rows that doc_id does not name: those without one, those whose doc_id has several texts,
    and ids from 2^62 on, where these numbers lie. id, a, b (two hashes of the text), name, copies (rows that repeat all)."""
    keys = docs.groupBy("id", "a", "b").agg(F.count("*").alias("copies"))
    several = keys.groupBy("id").agg(F.count("*").alias("texts")).where("texts > 1").select("id", F.lit(True).alias("several"))
    odd = keys.join(several, "id", "left").where(f"id is null or several or copies > 1 or id >= {1 << 62}")
    number = F.monotonically_increasing_id() + F.lit(1 << 62)
    name = F.when(F.col("id").isNull() | F.col("several") | (F.col("id") >= 1 << 62), number).otherwise(F.col("id"))
    return shared.saved(odd.select("id", "a", "b", name.alias("name"), "copies"), "minhash-names", files=files)


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with its own columns, whatever their names.

    Decisions fall on rows. A row goes by its doc_id; one without, and rows that share a doc_id but not the text, go by a number
    that doc_id and two hashes of the text (128 bits) get. So rows that repeat both are one document, of which one stays; rows
    that share a doc_id but are no near-duplicates all stay, and so do unlike rows without doc_id. Of a group, the row with
    the least doc_id stays, one without doc_id last. Other columns decide nothing, except that of rows that repeat doc_id and
    text any one may be the one that stays."""
    files = shared.files_for(docs)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    packed = docs.select(whole)
    text = F.col("doc.text")
    # the second hash reads the text behind a prefix, so it starts from another state
    packed = packed.select(F.col("doc.doc_id").cast("long").alias("id"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit("b"), text).alias("b"), "doc")
    names = _row_names(packed.select("id", "a", "b"), files).select(F.col("id").alias("odd_id"), F.col("a").alias("odd_a"), F.col("b").alias("odd_b"), "name", "copies")
    same = F.col("id").eqNullSafe(F.col("odd_id")) & (F.col("a") == F.col("odd_a")) & (F.col("b") == F.col("odd_b"))
    named = packed.join(names, same, "left").select(F.coalesce("name", "id").alias("row"), "id", F.coalesce("copies", F.lit(1)).alias("copies"), "doc")
    groups = near_duplicates(named.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text")), size, percent)
    groups = groups.select(F.col("doc_id").alias("row"), "component_id").distinct()
    ids = named.select("row", F.coalesce("id", F.lit((1 << 63) - 1)).alias("first")).distinct()
    best = groups.join(ids, "row").groupBy("component_id").agg(F.min(F.struct("first", "row"))["row"].alias("row"))
    kept = named.join(shared.saved(best.select("row"), "minhash-kept", files=files), "row", "left_semi")
    once = kept.where("copies > 1").groupBy("row").agg(F.first("doc").alias("doc"))
    return kept.where("copies = 1").select("doc.*").union(once.select("doc.*")).coalesce(files)
