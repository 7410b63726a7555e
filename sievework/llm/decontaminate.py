r"""Benchmark decontamination as a prefix-filtered set join.

A window is `size` consecutive words of a benchmark item (an item of fewer words is one window). A window occurs in a
document only if all its shingles do, so it is enough to join on the one shingle that is rarest in the corpus: the
necessary prefix of a containment of 1. A join partner fixes where the window would have to start (positional bound)
and whether it fits into the document (length bound); the words themselves then decide.

* Shingle counts for the rarity order come from one pass over all documents.
* The windows travel to the tasks by broadcast. Their number is checked: a benchmark with more than `block_windows` of
  them is worked off in blocks of that many, each against all documents, and the blocks' finds are merged.
* Documents are neither shuffled nor joined; a hot passage costs its own documents only.

Defined results: null or wordless documents have no words, no hits and no items, so they are clean. Null or wordless
items have no window. Repeated documents give one row each. Repeated items count once by item_id. No benchmark at all:
every document is clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared

SHINGLE = 3
_FOUND = "row long, doc_id long, n_words long, spans array<int>, items array<string>"


def item_windows(benchmark: DataFrame, size: int = 13) -> DataFrame:
    """Distinct windows: words array<string>, items array<string> that hold it."""
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(text, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    items = shared.columns(benchmark, "item_id", "text").where("item_id is not null").select(
        F.col("item_id").cast("string").alias("item"), words.alias("w")
    ).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    return (
        items.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, size))).alias("words"))
        .groupBy("words")
        .agg(F.collect_set("item").alias("items"))
    )


def _words(batches: Iterator[pa.RecordBatch]):
    """Blocks of documents as words: rows, bytes, word starts, ends, first words, word hashes."""
    hasher = shared.Hasher()
    for rows, data, offsets in shared.text_blocks(batches, "text"):
        data = shared.LOWER[data]
        starts, ends, woff = shared.word_spans(data, offsets, shared.ALNUM)
        yield rows, data, starts, ends, woff, hasher.spans(hasher.prefix(data), starts, ends)


def _hash_words(windows: list[list[str]]) -> list[np.ndarray]:
    hasher = shared.Hasher()
    data = np.frombuffer(" ".join(" ".join(w) for w in windows).encode(), np.uint8)
    starts, ends, _ = shared.word_spans(data, np.array([0, len(data)]), shared.ALNUM)
    hashes = hasher.spans(hasher.prefix(data), starts, ends)
    return np.split(hashes, np.cumsum([len(w) for w in windows])[:-1])


def _member(sorted_keys: np.ndarray, values: np.ndarray, filter_bits: np.ndarray) -> np.ndarray:
    """Indices of the values that are among the keys; a bit table over 20 bits spares most of the searches."""
    maybe = np.flatnonzero(filter_bits[(values >> shared.U64(44)).astype(np.int64)])
    at = np.searchsorted(sorted_keys, values[maybe])
    at[at == len(sorted_keys)] = 0
    return maybe[sorted_keys[at] == values[maybe]]


def _bits(keys: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << 20, bool)
    bits[(keys >> shared.U64(44)).astype(np.int64)] = True
    return bits


def shingle_counts(docs: DataFrame, windows: list[list[str]]) -> dict[tuple[int, int], int]:
    """How often each shingle of the windows stands in the whole corpus, by (size, hash)."""
    sizes: dict[int, set[int]] = {}
    for h in _hash_words(windows):
        k = min(SHINGLE, len(h))
        sizes.setdefault(k, set()).update(shared.shingle_hashes(h, k).tolist())
    keys = {k: np.array(sorted(v), np.uint64) for k, v in sizes.items()}
    sent = docs.sparkSession.sparkContext.broadcast(keys)
    schema = pa.schema([("size", pa.int32()), ("key", pa.int64()), ("n", pa.int64())])

    def count(batches):
        totals = {k: np.zeros(len(v), np.int64) for k, v in sent.value.items()}
        bits = {k: _bits(v) for k, v in sent.value.items()}
        for _, _, _, _, woff, hashes in _words(batches):
            for k, own in sent.value.items():
                values = shared.shingle_hashes(hashes, k)
                idx, _ = shared.inside(woff, k)
                values = values[idx]
                hit = _member(own, values, bits[k])
                totals[k] += np.bincount(np.searchsorted(own, values[hit]), minlength=len(own))
        for k, own in sent.value.items():
            some = totals[k] > 0
            yield shared.columns_to_batch(
                schema, np.full(some.sum(), k, np.int32), own[some].view(np.int64), totals[k][some]
            )

    counted = docs.select("text").mapInArrow(count, "size int, key long, n long").groupBy("size", "key").agg(F.sum("n"))
    return {(k, h & 0xFFFFFFFFFFFFFFFF): n for k, h, n in counted.collect()}  # at most the shingles of one block


def _plan(windows: list[list[str]], counts: dict) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By shingle size: sorted anchor hashes, and for each the window and the anchor's place in it."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    for i, h in enumerate(_hash_words(windows)):
        k = min(SHINGLE, len(h))
        s = shared.shingle_hashes(h, k).tolist()
        place = min(range(len(s)), key=lambda j: (counts.get((k, s[j]), 0), s[j], j))
        if counts.get((k, s[place]), 0):  # a shingle that no document has rules its window out
            rows.setdefault(k, []).append((s[place], i, place))
    plan = {}
    for k, r in rows.items():
        r.sort()
        plan[k] = tuple(np.array(c, t) for c, t in zip(zip(*r), (np.uint64, np.int64, np.int64)))
    return plan


def _find(docs: DataFrame, windows: list[list[str]], items: list[list[str]], plan: dict) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(([" ".join(w).encode() for w in windows], [len(w) for w in windows], items, plan))
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])

    def find(batches):
        texts, lengths, items, plan = sent.value
        lengths = np.array(lengths)
        bits = {k: _bits(p[0]) for k, p in plan.items()}
        for rows, data, starts, ends, woff, hashes in _words(batches):
            hits: dict[int, list[tuple[int, int]]] = {}
            for k, (anchors, window, place) in plan.items():
                idx, counts = shared.inside(woff, k)
                values = shared.shingle_hashes(hashes, k)[idx]
                at = _member(anchors, values, bits[k])
                lo, hi = np.searchsorted(anchors, values[at]), np.searchsorted(anchors, values[at], side="right")
                pick = np.repeat(lo - np.concatenate(([0], np.cumsum(hi - lo)[:-1])), hi - lo) + np.arange((hi - lo).sum())
                begin = np.repeat(idx[at], hi - lo) - place[pick]
                which = window[pick]
                doc = np.searchsorted(woff, np.repeat(idx[at], hi - lo), side="right") - 1
                fits = (begin >= woff[doc]) & (begin + lengths[which] <= woff[doc + 1])
                for b, w, d in zip(begin[fits].tolist(), which[fits].tolist(), doc[fits].tolist()):
                    e = b + int(lengths[w])
                    if b" ".join(data[x:y].tobytes() for x, y in zip(starts[b:e], ends[b:e])) == texts[w]:
                        hits.setdefault(d, []).append((b - int(woff[d]), w))
            n = rows.num_rows
            spans, found = [[]] * n, [[]] * n
            for d, own in hits.items():
                merged: list[int] = []
                for b, w in sorted(own):
                    e = b + int(lengths[w])
                    if merged and b <= merged[-1]:
                        merged[-1] = max(merged[-1], e)
                    else:
                        merged += [b, e]
                spans[d] = merged
                found[d] = sorted({x for w in {w for _, w in own} for x in items[w]})
            yield shared.columns_to_batch(schema, rows.column("row"), rows.column("doc_id"), np.diff(woff), spans, found)

    return docs.mapInArrow(find, _FOUND)


def _merged(found: DataFrame) -> DataFrame:
    """The finds of several blocks as one row for each document row."""

    def merge(batches):
        for f in batches:
            spans = []
            for own in f["spans"]:
                own = np.asarray(own).reshape(-1, 2)
                merged: list[int] = []
                for b, e in own[np.lexsort((own[:, 1], own[:, 0]))].tolist():
                    if merged and b <= merged[-1]:
                        merged[-1] = max(merged[-1], e)
                    else:
                        merged += [b, e]
                spans.append(merged)
            yield f.assign(spans=spans)

    grouped = found.groupBy("row", "doc_id", "n_words").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
    )
    return grouped.mapInPandas(merge, _FOUND)


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, block_windows: int = 500_000) -> DataFrame:
    """For each document row: row (a number for this run), doc_id, n_words, spans (flat pairs of first and end word of
    the hit stretches), items (ids as strings)."""
    spark = docs.sparkSession
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    windows = item_windows(benchmark, size)
    n = windows.count()
    if n > block_windows:
        windows = shared.saved(
            windows.withColumn("block", F.floor((F.row_number().over(Window.partitionBy(F.pmod(F.xxhash64("words"), F.lit(n // block_windows + 1))).orderBy("words")) - 1) / block_windows) * (n // block_windows + 1) + F.pmod(F.xxhash64("words"), F.lit(n // block_windows + 1))),
            "decontaminate-windows",
        )
        blocks = [r[0] for r in windows.select("block").distinct().orderBy("block").collect()]
        loads = (windows.where(F.col("block") == b) for b in blocks)
    else:
        loads = iter([windows])
    parts = []
    for load in loads:
        got = [(r["words"], sorted(r["items"])) for r in load.select("words", "items").collect()]  # at most block_windows
        words, items = [g[0] for g in got], [g[1] for g in got]
        plan = _plan(words, shingle_counts(docs, words)) if words else {}
        parts.append(_find(docs, words, items, plan))
    if len(parts) == 1:
        return parts[0]
    parts = [shared.saved(p, "decontaminate-block") for p in parts]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionAll(p)
    return _merged(whole)


def contamination_report(docs: DataFrame, benchmark: DataFrame, size: int = 13, per_mille: int = 50, **kw) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated (hit, and n_hit at least per_mille of n_words)."""
    found = find_contamination(docs, benchmark, size, **kw)
    n_hit = F.aggregate(
        F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "items").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 1000 >= F.col("n_words") * per_mille)).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 13, per_mille: int = 50) -> DataFrame:
    """The documents that are not contaminated, with their own columns. The verdict depends on the text alone, so a text
    goes by its hash, whatever its doc_id, or without one."""
    name = F.xxhash64(F.coalesce("text", F.lit("")))
    dirty = contamination_report(docs.select(name.alias("doc_id"), "text"), benchmark, size, per_mille).where("contaminated").select(F.col("doc_id").alias("row")).distinct()
    rows = docs.select(name.alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    return rows.join(shared.saved(dirty, "decontaminate-dirty"), "row", "left_anti").select("doc.*")
