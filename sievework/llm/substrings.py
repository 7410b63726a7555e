"""Removal of byte strings that an earlier document has as well, by two comparisons at content-picked positions.

Ranking every byte position of a corpus moves more than ten times the corpus in every round. So only the positions that a
content rule picks are ranked: of every `LENGTH - GRAM + 1` neighbouring positions, that with the least hash of its next
GRAM bytes. Every window of LENGTH bytes has exactly one such position, and equal windows have it in the same place, so
nothing is lost and about one position in sixteen remains.

This takes the place of prefix doubling: no pairs of ranks are sorted and no offset grows; GRAM and LENGTH are the only
lengths compared. Round 1 ranks these positions by their first GRAM bytes; Spark brings equal ones together, and positions whose rank only
one document has are dropped. Where all positions of a rank have equal windows, the rank is settled: the windows of all
but the least document are marked. Round 2 takes the pair of the other ranks and the bytes around them to the full
LENGTH: for each remaining position its own windows are ranked, and a window is marked if the least doc_id of its rank is
smaller than its own. Two independent 64-bit hashes have to agree before windows count as equal.

Frequent strings: in round 1 a task counts the ranks of half a million positions before it sends them, so a rank is one entry
of each such lot however often it occurs; the answer is a join that Spark may split. In round 2 equal surroundings inside a
task's block are resolved there, and only the first document's are sent on. A rank of up to MOST positions is gathered by
its key. A more frequent one is not: equal surroundings are one row of a partial aggregate, whose windows are compared by
a second one, and the answer goes back to all positions by a join that Spark may split. Settled positions are not moved.

Disk: chance makes more ranks frequent as a corpus grows, so their windows grow faster than it. They are compared in as many
passes over the ranks as keep the windows of one pass in proportion to the input, and a table is removed as soon as the one
that is made from it is whole.

Defined results: an empty table gives no rows. Only doc_id and text are read, so other columns may have any name. Texts
may have up to 2 GB, as Spark's strings do. null counts as the empty text. Texts shorter than LENGTH bytes have no windows. Rows without doc_id keep
all bytes and remove none. Rows that repeat a doc_id do not remove each other's bytes; each is judged against smaller
ones. Repeats within one document stay."""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

LENGTH = 50
GRAM = 20
MOST = 64  # positions of a rank that one task may gather
WHOLE, OPEN, HOT = 1, 2, 3  # kinds of ranks, in the last two bits of a key
STRETCH = 1 << 15  # windows that are looked at together, so that their hashes stay in a core's cache
RANKS = 1 << 19  # positions whose ranks a task counts before it sends them
PART = 2 << 20  # bytes of the input for each part of the keys in round 2
ROOM = 60_000  # windows of frequent ranks that one pass may compare for each part: some two to three PART
_PLACE = np.uint64((1 << 16) - 1)
_HASH = ~_PLACE


def picked(hasher: shared.Hasher, sums: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each picked position: its text, place, key, and the first and last window that it stands for. All places are
    within the block."""
    n, width = int(offsets[-1]), LENGTH - GRAM + 1
    if n < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none, none
    place = np.empty(n - LENGTH + 1, np.int64)  # of each window that starts there, whether it lies in one text or not
    for at in range(0, len(place), STRETCH):
        to = min(at + STRETCH, len(place))
        low = hasher.runs(sums, GRAM, at, to + width - 1)
        low &= _HASH
        low |= np.arange(len(low), dtype=np.uint64)  # ties go to the first
        span = 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        low = np.minimum(low[: to - at], low[width - span :])
        place[at:to] = (low & _PLACE).astype(np.int64) + at
    new = np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1]
    new[offsets[:-1][offsets[:-1] < len(place)]] = True
    first = np.flatnonzero(new)
    text = np.searchsorted(offsets, first, side="right") - 1
    last = np.minimum(np.append(first[1:], len(place)) - 1, offsets[text + 1] - LENGTH)
    inside = last >= first
    text, first, last = text[inside], first[inside], last[inside]
    place = place[first]
    # the least of hashes are no longer spread evenly; once more mixed, they are
    return text, place, shared.mixed(hasher.spans(sums, place, place + GRAM)), first, last


def _positions(docs: DataFrame) -> DataFrame:
    """key, doc_id: one row for each picked position."""
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64())])

    def pick(batches):
        hasher = shared.Hasher(9)
        for rows, data, offsets in shared.text_blocks(batches, "text", 1 << 20):
            text, _, key, _, _ = picked(hasher, hasher.prefix(data), offsets)
            yield shared.columns_to_batch(schema, key.view(np.int64), rows.column("doc_id").to_numpy(zero_copy_only=False)[text])

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(pick, "key long, doc_id long")


def _counted(ranks: np.ndarray) -> np.ndarray:
    """One column for each key, in order of keys, of a table with the rows key, least and most doc_id, a hash of all bytes of
    the windows, and the number of positions, below 0 where that hash is not the same for all of them."""
    if not ranks.shape[1]:
        return ranks
    ranks = ranks[:, np.argsort(ranks[0].view(np.uint64))]
    heads = np.flatnonzero(np.append(True, ranks[0, 1:] != ranks[0, :-1]))
    low, high = np.minimum.reduceat(ranks[3], heads), np.maximum.reduceat(ranks[3], heads)
    n = np.add.reduceat(np.abs(ranks[4]), heads)
    same = (low == high) & (np.minimum.reduceat(ranks[4], heads) > 0)
    return np.stack([ranks[0, heads], np.minimum.reduceat(ranks[1], heads), np.maximum.reduceat(ranks[2], heads), low, np.where(same, n, -n)])


def _sent_ranks(docs: DataFrame, parts: int) -> DataFrame:
    """part, ranks: a task counts the ranks of RANKS positions and sends them packed, one row for each part of the keys. A
    frequent rank is one entry in each of these rows, not one a position."""
    sent_schema = pa.schema([("part", pa.int32()), ("ranks", pa.binary())])

    def packed(held):
        ranks = _counted(np.concatenate(held, axis=1))
        of = ((ranks[0].view(np.uint64) >> shared.U64(32)) * shared.U64(parts)) >> shared.U64(32)
        edges = np.append(np.flatnonzero(np.append(True, of[1:] != of[:-1])), len(of))
        pieces = [ranks[:, a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        return shared.columns_to_batch(sent_schema, of[edges[:-1]].astype(np.int32), pieces)

    def count(batches):
        hasher, held, size = shared.Hasher(9), [], 0
        for rows, data, offsets in shared.text_blocks(batches, "text", 1 << 20):
            sums = hasher.prefix(data)
            text, _, key, lo, hi = picked(hasher, sums, offsets)
            if not len(key):
                continue
            doc = rows.column("doc_id").to_numpy(zero_copy_only=False)[text]
            held.append(np.stack([key.view(np.int64), doc, doc, hasher.spans(sums, lo, hi + LENGTH).view(np.int64), np.ones(len(key), np.int64)]))
            size += len(key)
            if size >= RANKS:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(count, "part int, ranks binary")


def _unpacked(packed: pa.ChunkedArray) -> np.ndarray:
    return _counted(np.concatenate([np.frombuffer(r.as_py(), np.int64).reshape(5, -1) for r in packed], axis=1))


def _ranks(docs: DataFrame, most: int) -> DataFrame:
    """key, least, kind of the ranks that more than one document has."""
    schema = pa.schema([("key", pa.int64()), ("least", pa.int64()), ("kind", pa.int32())])

    def kinds(rows):
        ranks = _unpacked(rows.column("ranks"))
        key, least, _, _, n = ranks[:, ranks[1] < ranks[2]]
        kind = np.where(n > 0, WHOLE, np.where(-n <= most, OPEN, HOT))
        return pa.Table.from_arrays([pa.array(key), pa.array(least), pa.array(kind.astype(np.int32))], schema=schema)

    sent = _sent_ranks(docs, shared.parts_for(docs, 4 << 20))
    return sent.groupBy("part").applyInArrow(kinds, "key long, least long, kind int")


def _repeated(docs: DataFrame, most: int = MOST) -> DataFrame:
    """doc_id, keys: the ranks of round 1 that another document has as well, the kind of each in the last two bits. Where
    all positions of a rank have the same windows, those of later documents are done (whole) and the first one's are of no
    more use; the rest is open, or hot if it has more positions than most."""
    ranks = shared.saved(_ranks(docs, most), "substrings-ranks", release=True)
    met = _positions(docs).join(ranks, "key").where(f"kind <> {WHOLE} or least < doc_id")
    named = F.col("key").bitwiseAND(F.lit(~3)).bitwiseOR(F.col("kind"))
    keys = shared.saved(met.groupBy("doc_id").agg(F.collect_list(named).alias("keys")), "substrings-keys", release=True)
    shared.drop(ranks)
    return keys


_SENT = "part int, doc_id long, row long, start int, windows int, around binary, hot boolean"


def _surroundings(docs: DataFrame, repeated: DataFrame, parts: int) -> DataFrame:
    """For each remaining position: part (by its key), doc_id, row, where its windows start, their number, the bytes of all
    of them, or no bytes if a smaller document is known to have the same, and whether its rank is a frequent one. row is 0
    unless the table has the doc_id more than once, then a hash of the text."""
    schema = pa.schema(
        [("part", pa.int32()), ("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), ("around", pa.binary()), ("hot", pa.bool_())]
    )

    def surround(batches):
        hasher = shared.Hasher(9)
        for rows, data, offsets in shared.text_blocks(batches, "text", 1 << 20):
            sums = hasher.prefix(data)
            text, place, key, lo, hi = picked(hasher, sums, offsets)
            if not len(text):
                continue
            pair = lambda k, t: shared.mixed((k >> shared.U64(2)) + t.astype(np.uint64) * shared.U64(0x9E3779B97F4A7C15))
            lists = rows.column("keys")
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            known, at = np.unique(pair(flat, np.repeat(np.arange(rows.num_rows), np.diff(lists.offsets.to_numpy()))), return_index=True)
            kinds = (flat[at] & shared.U64(3)).astype(np.int64)
            asked = pair(key, text)
            at = np.searchsorted(known, asked)
            at[at == len(known)] = 0
            kind = np.where(known[at] == asked, kinds[at], 0)
            keep = np.flatnonzero(kind)
            text, key, lo, hi, whole, hot = text[keep], key[keep], lo[keep], hi[keep], kind[keep] == WHOLE, kind[keep] == HOT
            ids, names = rows.column("doc_id").to_numpy(zero_copy_only=False), rows.column("row").to_numpy(zero_copy_only=False)
            # equal surroundings in this block: only the least document's go on
            same = hasher.spans(sums, lo, hi + LENGTH)
            order = np.lexsort((ids[text], same))
            head = np.ones(len(order), bool)
            head[1:] = same[order][1:] != same[order][:-1]
            least = np.empty(len(order), np.int64)
            least[order] = ids[text][order][np.flatnonzero(head)][np.cumsum(head) - 1] if len(order) else least
            settled = whole | (least < ids[text])
            # settled stretches of a text that touch make one row
            head = np.ones(len(text), bool)
            head[1:] = ~(settled[1:] & settled[:-1] & (text[1:] == text[:-1]) & (lo[1:] <= hi[:-1] + LENGTH))
            first = np.flatnonzero(head)
            if len(first) < len(text):
                hi = np.maximum.reduceat(hi, first)
                text, key, lo, hot, settled = text[first], key[first], lo[first], hot[first], settled[first]
            raw = data.tobytes()
            around = [None if d else raw[b : e + LENGTH] for d, b, e in zip(settled.tolist(), lo.tolist(), hi.tolist())]
            part = (shared.mixed(key) % shared.U64(parts)).astype(np.int32)
            yield shared.columns_to_batch(schema, part, ids[text], names[text], (lo - offsets[:-1][text]).astype(np.int32), (hi - lo + 1).astype(np.int32), around, hot)

    met = docs.join(repeated, "doc_id")
    again = shared.saved(docs.groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("again")), "substrings-again")
    row = F.when(F.col("again"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    return met.join(again, "doc_id", "left").select("doc_id", "text", "keys", row.alias("row")).mapInArrow(surround, _SENT)


def _around(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The surroundings' bytes end to end, and the offset of each plus the end."""
    around = rows.column("around")
    around = (around.combine_chunks() if isinstance(around, pa.ChunkedArray) else around).cast(pa.large_binary())
    offsets = np.frombuffer(around.buffers()[1], np.int64, len(around) + 1, around.offset * 8)
    return np.frombuffer(around.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _each(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts of things: the owner of each thing, and its number there."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _ranked(rows: pa.Table) -> pa.Table:
    """doc_id, row, start, end of the byte stretches of a part whose windows a smaller document has. Of equal surroundings
    only the least document's windows are ranked; all others are covered."""
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
    there = rows.combine_chunks()
    if not there.num_rows:
        return schema.empty_table()
    doc, start, n = (there.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "start", "windows"))
    data, offsets = _around(there)
    one, two = shared.Hasher(10), shared.Hasher(11)
    sums, more = one.prefix(data), two.prefix(data)
    same, check = one.spans(sums, offsets[:-1], offsets[1:]), two.spans(more, offsets[:-1], offsets[1:])
    order = np.lexsort((doc, same))
    same, check = same[order], check[order]
    head = np.append(True, (same[1:] != same[:-1]) | (check[1:] != check[:-1]))
    alike, heads = np.cumsum(head) - 1, order[head]
    own = doc[order] == doc[heads][alike]
    later, own, alike = order[~own], order[own], alike[own]
    # the windows of heads
    row, step = _each(n[heads])
    at = offsets[:-1][heads][row] + step
    name, check = one.spans(sums, at, at + LENGTH), two.spans(more, at, at + LENGTH)
    order = np.argsort(name, kind="stable")
    name, check = name[order], check[order]
    head = np.append(True, (name[1:] != name[:-1]) | (check[1:] != check[:-1]))
    whose = doc[heads][row]
    least = np.minimum.reduceat(whose[order], np.flatnonzero(head))[np.cumsum(head) - 1]
    marked = np.zeros(len(row) + 2, bool)
    marked[1:-1][order] = least < whose[order]
    first = np.append(step == 0, True)  # of a row; nothing runs on over it
    begin = np.flatnonzero(marked[1:-1] & (~marked[:-2] | first[:-1]))
    finish = np.flatnonzero(marked[1:-1] & (~marked[2:] | first[1:]))
    # runs of a head hold for all positions of its document that have these surroundings
    runs = np.bincount(row[begin], minlength=len(heads))
    to, i = _each(runs[alike])
    i += (np.cumsum(runs) - runs)[alike][to]
    to = own[to]
    at = np.append(later, to)
    begins, ends = np.append(start[later], start[to] + step[begin][i]), np.append(start[later] + n[later] - 1, start[to] + step[finish][i]) + LENGTH
    made = [doc[at], there.column("row").to_numpy()[at], begins.astype(np.int32), ends.astype(np.int32)]
    return pa.Table.from_arrays([pa.array(x) for x in made], schema=schema)


def _windows(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """For every window of rows with bytes: its row, its place there, and two hashes."""
    data, offsets = _around(rows)
    row, step = _each(rows.column("windows").to_numpy().astype(np.int64))
    at = offsets[row] + step
    one, two = shared.Hasher(10), shared.Hasher(11)
    return row, step, one.spans(one.prefix(data), at, at + LENGTH), two.spans(two.prefix(data), at, at + LENGTH)


def _ranked_apart(sent: DataFrame, room: int) -> tuple[DataFrame, DataFrame]:
    """What _ranked gives, without gathering a rank, and the table that it is read from. Positions with equal surroundings
    share a name of 128 bits: all but those of their least document are covered. The windows of each distinct surroundings
    stand for that document; the least document of equal windows is a partial aggregate too. Equal windows are of one rank
    and so of one part: the parts are gone through in passes of about room windows."""
    parts = [("part", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), ("around", pa.binary())]
    named_schema = pa.schema(parts)
    window_schema = pa.schema([("id", pa.int64()), ("least", pa.int64()), ("step", pa.int32()), ("one", pa.int64()), ("two", pa.int64())])

    def name(batches):
        one, two = shared.Hasher(10), shared.Hasher(11)
        for batch in batches:
            data, at = _around(batch)
            names = [h.spans(h.prefix(data), at[:-1], at[1:]).view(np.int64) for h in (one, two)]
            yield shared.columns_to_batch(named_schema, batch.column("part"), *names, *[batch.column(c) for c in ("doc_id", "row", "start", "windows", "around")])

    def explode(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 10_000):
                rows = pa.Table.from_batches([batch.slice(at, 10_000)])
                row, step, one, two = _windows(rows)
                of = lambda c: rows.column(c).to_numpy()[row]  # noqa: E731, B023
                yield shared.columns_to_batch(window_schema, of("id"), of("least"), step.astype(np.int32), one.view(np.int64), two.view(np.int64))

    named = sent.mapInArrow(name, "part int, a long, b long, doc_id long, row long, start int, windows int, around binary")
    blocks = named.groupBy("a", "b").agg(F.min("doc_id").alias("least"), *[F.first(c).alias(c) for c in ("part", "windows", "around")])
    blocks = shared.saved(blocks.withColumn("id", F.monotonically_increasing_id()), "substrings-blocks", release=True)
    passes = -(-(blocks.agg(F.sum("windows")).first()[0] or 1) // room)
    bit, marks = F.call_function("shiftleft", F.lit(1), F.col("step")), []
    for k in range(passes):
        mine = blocks.where(F.col("part") % passes == k).select("id", "least", "windows", "around")
        windows = shared.saved(mine.mapInArrow(explode, "id long, least long, step int, one long, two long"), "substrings-windows")
        first = windows.groupBy("one", "two").agg(F.min("least").alias("first"), F.max("least").alias("last")).where("first < last").drop("last")
        marked = windows.join(first, ["one", "two"]).where("first < least").groupBy("id").agg(F.bit_or(bit).alias("mask"))
        marks.append(shared.saved(marked, "substrings-marks", release=True))
        shared.drop(windows)
    every = functools.reduce(DataFrame.unionAll, marks)
    least = shared.saved(blocks.select("id", "a", "b", "least").join(every, "id", "left").drop("id"), "substrings-least", release=True)
    for table in (blocks, *marks):
        shared.drop(table)
    placed = named.select("a", "b", "doc_id", "row", "start", "windows").join(least, ["a", "b"]).where("least < doc_id or mask <> 0")
    run = lambda at, n: F.struct(at.cast("int").alias("start"), (at + n + F.lit(LENGTH - 1)).cast("int").alias("end"))
    steps = F.filter(F.sequence(F.lit(0), F.col("windows") - 1), lambda i: F.call_function("getbit", F.col("mask").cast("long"), i) == 1)
    runs = F.when(F.col("least") < F.col("doc_id"), F.array(run(F.col("start"), F.col("windows")))).otherwise(F.transform(steps, lambda i: run(F.col("start") + i, F.lit(1))))
    return placed.select("doc_id", "row", F.explode(runs).alias("run")).select("doc_id", "row", "run.start", "run.end"), least


def _runs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each row's maximal removed stretches, and each row's first stretch plus the end."""
    spans = batch.column("spans")
    flat = spans.flatten()
    counts = pa.compute.list_value_length(spans).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(np.arange(batch.num_rows), counts)
    start, end, row = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "end", "row"))
    mine = (row == 0) | (row == batch.column("row").to_numpy(zero_copy_only=False)[of])
    of, start, end = of[mine], start[mine], end[mine]
    if not len(of):
        return start, end, np.zeros(batch.num_rows + 1, np.int64)
    reach = np.maximum.accumulate((of << 32) + end) - (of << 32)  # spans are sorted by start within their row
    head = np.ones(len(of), bool)
    head[1:] = (of[1:] != of[:-1]) | (start[1:] > reach[:-1])
    heads = np.flatnonzero(head)
    lasts = np.append(heads[1:], len(of)) - 1
    return start[heads], reach[lasts], np.searchsorted(of[heads], np.arange(batch.num_rows + 1))


def remove_repeats(docs: DataFrame, keep_text: bool = False, most: int = MOST, room: int = ROOM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; with keep_text also kept, the remaining bytes. Ranks of more than
    most positions are not gathered in one task, and a pass compares room of their windows for each part of the keys; all
    ways give the same rows."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = shared.parts_for(docs, PART)
    repeated = _repeated(docs, most)
    sent = shared.saved(_surroundings(docs, repeated, parts), "substrings-sent", release=True)
    shared.drop(repeated)
    settled = sent.where("around is null").select("doc_id", "row", "start", (F.col("start") + F.col("windows") + F.lit(LENGTH - 1)).alias("end"))
    there = sent.where("around is not null")
    marked = there.where("not hot").groupBy("part").applyInArrow(_ranked, "doc_id long, row long, start int, end int")
    apart, least = _ranked_apart(there.where("hot"), parts * room)
    marked = settled.unionAll(marked).unionAll(apart)
    spans = marked.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end", "row"))).alias("spans"))
    spans = shared.saved(spans, "substrings-spans", release=True)
    shared.drop(sent)
    shared.drop(least)
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    fields += [("kept", pa.binary())] if keep_text else []
    schema = pa.schema(fields)

    def cut(batches):
        for batch in batches:
            begins, finishes, first = _runs(batch)
            texts, rows = batch.column("text").cast(pa.large_binary()), []
            for i, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                raw = texts[i].as_py()
                edges = [0, *(x for be in zip(begins[lo:hi].tolist(), finishes[lo:hi].tolist()) for x in be), len(raw)]
                left = b"".join([raw[b:e] for b, e in zip(edges[::2], edges[1::2])]) if hi > lo else raw
                rows.append((len(raw), len(raw) - len(left), hi - lo, hashlib.sha256(left).hexdigest(), left))
            made = list(zip(*rows)) if rows else [[]] * 5
            yield shared.columns_to_batch(schema, batch.column("doc_id"), *made[: len(fields) - 1])

    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_text else "")
    return docs.join(spans, "doc_id", "left").select("doc_id", "text", "spans", F.xxhash64("text").alias("row")).mapInArrow(cut, out)
