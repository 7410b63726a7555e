"""Language-model scoring: a small causal self-attention model over subword ids, and corpus counts of words.

A text is its words and one end token. A word stands in the model as a subword id: the longest piece of the public
vocabulary that begins it, of any length. The model, one attention layer in numpy, gives the probability of the next subword
id from the ids before it; the ids that are most frequent in all training documents have a class each, the others share
classes by hash. Given its class, a word has the probability that the counts of all training words give it:

    log10 P(text) = sum over tokens of log10 P_model(class | context) + log10 (c + 1) / (N_class + V_class + 1)

so the model needs no cut of the vocabulary, and unseen words have their share in every class.

Training: every window of every training document is learned from once. Documents are cut into chunks of windows, one byte a
token; chunks are dealt to learners by a hash of document and place, EACH windows to a learner on average. Learners set out from
the same values, which a few steps over some documents give, go over all their windows in a random order, and their parameters
are averaged by their numbers of windows; so what the model learns from is the corpus, while a learner holds its chunks and one
set of parameters. The scores follow from the table alone: rows may come in any order, files and partitions (up to the rounding
of floats in batches of other sizes).

Scoring goes over overlapping windows: each window of 2 * STRIDE positions scores its last STRIDE, so every token is
scored once with at least STRIDE positions of context where the text has them. Windows of many texts make one masked
batch.

Counts: every block of documents sends its distinct words with their counts, a partial sum; Spark adds them up over the
corpus. Documents are then dealt into groups by a hash of doc_id and text, every group asks once for each of its distinct words,
and the answers come back to the group: the vocabulary is neither broadcast nor collected, and a frequent word costs one
row a group.

Defined results: null counts as the empty text, which has the end token only. Repeated rows count each, and give one row
each. A null doc_id counts as training. Without training tokens N and V are 0 and every count is 0."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

CLASSES, OWN = 128, 96
WIDTH, STRIDE = 16, 16
WINDOW = 2 * STRIDE
CHUNK = 64  # windows of a text that go to a learner together
BATCH = 96
EACH = 1 << 16  # windows that a learner goes over
END = np.uint64(0x5E5E5E5E00000001)
END_PIECE = -2  # stands for the end token among subword ids; -1 for a word without one
#: Class 0 is the end token; class numbers from OWN up are shared by hash.
START = CLASSES  # an input id only


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


# --- words and subword ids ------------------------------------------------------------------------------------------


class Words:
    """Blocks of texts as word hashes, with the subword id of each distinct word."""

    def __init__(self, tables: list[tuple[int, np.ndarray, np.ndarray]] | None = None):
        """tables: what piece_tables() makes; without them there are no subword ids."""
        self.hasher = shared.Hasher(3)
        self.tables = []
        for n, keys, ids in tables or []:
            # the front bits that keys have, 16 places or more a key: most words that are no key end here
            shift = shared.U64(64 - (16 * len(keys)).bit_length())
            some = np.zeros(1 << (64 - int(shift)), bool)
            some[keys >> shift] = True
            self.tables.append((n, keys, ids, shift, some))

    def read(self, data: np.ndarray, offsets: np.ndarray):
        data = shared.LOWER[data]
        starts, ends, woff = shared.word_spans(data, offsets, shared.WORD)
        sums = self.hasher.prefix(data)
        return sums, starts, ends, woff, self.hasher.spans(sums, starts, ends)

    def subwords(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The longest piece at the front of each word; -1 where there is none."""
        out = np.full(len(starts), -1, np.int64)
        size = ends - starts
        for n, keys, ids, shift, some in self.tables:
            open_ = np.flatnonzero((out < 0) & (size >= n))
            h = self.hasher.spans(sums, starts[open_], starts[open_] + n)
            maybe = some[h >> shift]
            open_, h = open_[maybe], h[maybe]
            at = np.searchsorted(keys, h)
            at[at == len(keys)] = 0
            hit = keys[at] == h
            out[open_[hit]] = ids[at[hit]]
        return out


def piece_tables(pieces: list[bytes]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """By length, the longest first: sorted hashes of the pieces, and their ids."""
    hasher, tables = shared.Hasher(3), []
    by_length: dict[int, dict[bytes, int]] = {}
    for i, p in enumerate(pieces):
        by_length.setdefault(len(p), {})[p] = i
    for n in sorted(by_length.keys() - {0}, reverse=True):
        found = by_length[n]
        data = np.frombuffer(b"".join(found), np.uint8)
        starts = np.arange(0, len(data), n)
        keys, order = np.unique(hasher.spans(hasher.prefix(data), starts, starts + n), return_index=True)
        tables.append((n, keys, np.array(list(found.values()), np.int64)[order]))
    return [t for t in tables if len(t[1])]


def vocabulary_pieces(path: str) -> list[bytes]:
    """The pieces of a byte-level vocabulary as bytes, without a leading space, by id."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    n = tokenizer.get_vocab_size()
    return [(tokenizer.decode([i]) or "").encode().strip() if tokenizer.id_to_token(i) else b"" for i in range(n)]


def class_of(subwords: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """frequent: sorted subword ids with a class of their own."""
    at = np.searchsorted(frequent, subwords)
    at[at == len(frequent)] = 0
    own = frequent[at] == subwords if len(frequent) else np.zeros(len(subwords), bool)
    shared_class = OWN + (shared.mixed(subwords.astype(np.uint64)) % shared.U64(CLASSES - OWN)).astype(np.int64)
    return np.where(own, 1 + at, shared_class)


# --- the model ------------------------------------------------------------------------------------------------------


def _window_index(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text of count tokens that starts at first: its windows' first scored positions and the text's end."""
    n = -(-count // STRIDE)
    text = np.repeat(np.arange(len(first)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return first[text] + k * STRIDE, text


def _keep_freed() -> None:
    """Once a block of this size was freed, the C library keeps freed memory for smaller ones, so that the arrays of each step do
    not get their pages from the system again. The block itself is never touched."""
    np.empty(31 << 20, np.uint8)


def _sums(x: np.ndarray) -> np.ndarray:
    """Of the last axis: a product with ones takes less time than sum() here."""
    return x @ np.ones(x.shape[-1], x.dtype)


def _within(z: np.ndarray) -> np.ndarray:
    """Logits whose exponentials float32 can hold: as they are, or with each row moved by its greatest, in place."""
    if len(z) and (z.max() > 60 or z.min() < -60):
        z -= z.max(1, keepdims=True)
    return z


def _rows(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    return (x.reshape(-1, x.shape[-1]) @ by).reshape(*x.shape[:-1], by.shape[1])


@dataclass
class Model:
    """One layer of causal self-attention. Parameters: token and place embeddings, query, key, value, output."""

    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 0) -> "Model":
        rng = np.random.default_rng(seed)
        small = lambda *s: (rng.normal(size=s) * 0.1).astype(np.float32)
        return Model({"e": small(CLASSES + 1, WIDTH), "pos": small(WINDOW, WIDTH), "q": small(WIDTH, WIDTH), "k": small(WIDTH, WIDTH), "v": small(WIDTH, WIDTH), "w": small(WIDTH, CLASSES), "b": np.zeros(CLASSES, np.float32)})

    def forward(self, inputs: np.ndarray, valid: np.ndarray, last: int):
        """inputs, valid: windows x WINDOW. Logits of the last positions, and what the gradient needs."""
        p = self.p
        x = p["e"][inputs] + p["pos"]
        xq = np.ascontiguousarray(x[:, -last:])
        # one product for all windows, where their rows do not mix
        q, k, v = (_rows(l, p[n]) for l, n in ((xq, "q"), (x, "k"), (x, "v")))
        s = q @ k.transpose(0, 2, 1) / np.float32(np.sqrt(WIDTH))
        rows = np.arange(WINDOW - last, WINDOW)[:, None]
        mask = (np.arange(WINDOW)[None, :] <= rows)[None] & valid[:, None, :]
        a = np.exp(s, out=s)
        a *= mask
        a /= (_sums(a) + np.float32(1e-9))[..., None]
        h = xq + a @ v
        z = h.reshape(-1, WIDTH) @ p["w"]
        z += p["b"]
        return z, (x, xq, q, k, v, a, h)

    def step(self, inputs, valid, targets, scored, last):
        """Loss and gradients for scored positions (a mask like targets)."""
        p = self.p
        z, (x, xq, q, k, v, a, h) = self.forward(inputs, valid, last)
        t, m = targets.ravel(), scored.ravel()
        n, at = max(1, m.sum()), np.arange(len(t))
        own = _within(z)[at, t]
        dz = np.exp(z, out=z)
        total = _sums(dz)
        loss = (np.log(total) - own)[m].sum() / n
        dz *= (m / (n * total)).astype(np.float32)[:, None]
        dz[at, t] -= (m / n).astype(np.float32)
        flat = h.reshape(-1, WIDTH)
        g = {"w": flat.T @ dz, "b": np.ones(len(dz), np.float32) @ dz}
        dh = (dz @ p["w"].T).reshape(h.shape)
        da, dv = dh @ v.transpose(0, 2, 1), a.transpose(0, 2, 1) @ dh
        da -= _sums(a * da)[..., None]
        ds = np.multiply(a, da, out=da)
        ds *= np.float32(1 / np.sqrt(WIDTH))
        dq, dk = ds @ k, ds.transpose(0, 2, 1) @ q
        sum2 = lambda l, r: l.reshape(-1, WIDTH).T @ r.reshape(-1, WIDTH)
        g |= {"q": sum2(xq, dq), "k": sum2(x, dk), "v": sum2(x, dv)}
        dx = _rows(dk, p["k"].T)
        dx += _rows(dv, p["v"].T)
        dx[:, -last:] += dh + _rows(dq, p["q"].T)
        g["pos"] = dx.sum(0)
        ids = inputs.ravel().astype(np.uint8)  # which sort in linear time
        order = np.argsort(ids, kind="stable")
        seen, begin = np.unique(ids[order], return_index=True)
        g["e"] = np.zeros_like(p["e"])
        g["e"][seen] = np.add.reduceat(dx.reshape(-1, WIDTH)[order], begin, axis=0)
        return loss, g

    def log_probabilities(self, tokens: np.ndarray, first: np.ndarray, count: np.ndarray, batch: int = 128) -> np.ndarray:
        """The natural log probability of every token of the texts, each from one window."""
        _keep_freed()
        out = np.zeros(len(tokens), np.float32)
        before = np.empty(len(tokens), np.int64)
        before[1:] = tokens[:-1]
        before[first] = START
        begin, text = _window_index(first, count)
        p = self.p
        scale = np.float32(1 / np.sqrt(WIDTH))
        eq, ek, ev = p["e"] @ p["q"] * scale, p["e"] @ p["k"], p["e"] @ p["v"]
        pq, pk, pv = p["pos"] @ p["q"] * scale, p["pos"] @ p["k"], p["pos"] @ p["v"]
        causal = np.arange(WINDOW)[None, :] <= np.arange(STRIDE, WINDOW)[:, None]
        for at in range(0, len(begin), batch):
            b, t = begin[at : at + batch], text[at : at + batch]
            place = b[:, None] + np.arange(-STRIDE, STRIDE)
            valid = (place >= first[t][:, None]) & (place < (first + count)[t][:, None])
            ids = before[np.clip(place, 0, len(tokens) - 1)]
            s = (eq[ids[:, STRIDE:]] + pq[STRIDE:]) @ (ek[ids] + pk).transpose(0, 2, 1)
            a = np.exp(s, out=s)
            a *= causal[None] & valid[:, None, :]
            a /= (_sums(a) + np.float32(1e-9))[..., None]
            h = p["e"][ids[:, STRIDE:]] + p["pos"][STRIDE:] + a @ (ev[ids] + pv)
            z = h.reshape(-1, WIDTH) @ p["w"]
            z += p["b"]
            where, ok = place[:, STRIDE:].ravel(), valid[:, STRIDE:].ravel()
            rows = np.flatnonzero(ok)
            target = tokens[where[rows]]
            own = _within(z)[rows, target]
            out[where[rows]] = own - np.log(_sums(np.exp(z, out=z)))[rows]
        return out


def windows_of(tokens: np.ndarray, first: np.ndarray, count: np.ndarray, begin: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows as they are learned from: the ids in front of each place, -1 outside the text, and the ids to score, -1 behind
    its end. begin, text: some of what _window_index gives."""
    before = np.empty(len(tokens), np.int64)
    before[1:] = tokens[:-1]
    before[first] = START
    place = begin[:, None] + np.arange(-STRIDE, STRIDE)
    valid = (place >= first[text][:, None]) & (place < (first + count)[text][:, None])
    held = np.clip(place, 0, max(len(tokens) - 1, 0))
    return np.where(valid, before[held], -1), np.where(valid, tokens[held], -1)[:, STRIDE:]


def train(take, picks: list[np.ndarray], seed: int = 0, start: Model | None = None, speed: float = 0.02) -> Model:
    """Adam, one step for each pick of windows, from a fresh model or from `start`. take: of a pick, inputs and targets."""
    _keep_freed()
    model = Model(dict(start.p)) if start else Model.fresh(seed)
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    s = {k: np.zeros_like(v) for k, v in model.p.items()}
    for i, pick in enumerate(picks, 1):
        x, y = take(pick)
        _, g = model.step(np.maximum(x, 0), x >= 0, np.maximum(y, 0), y >= 0, STRIDE)
        rate = speed * min(1.0, i / 20) * (1 - i / (len(picks) + 1)) ** 0.5
        for k, grad in g.items():
            m[k] += 0.1 * (grad - m[k])
            s[k] += 0.01 * (grad * grad - s[k])
            model.p[k] = (model.p[k] - rate * (m[k] / (1 - 0.9**i)) / (np.sqrt(s[k] / (1 - 0.99**i)) + 1e-8)).astype(np.float32)
    return model


# --- the jobs -------------------------------------------------------------------------------------------------------


def _classes(pieces, frequent):
    """A reader of blocks: tokens (classes, 0 for the end of a text), and where each text's begin and how many there are."""
    words = Words(pieces.value)

    def read(data: np.ndarray, offsets: np.ndarray):
        sums, starts, ends, woff, hashes = words.read(data, offsets)
        _, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        kind = class_of(words.subwords(sums, starts[at], ends[at]), frequent)[back]
        return np.insert(kind, woff[1:], 0), woff[:-1] + np.arange(len(offsets) - 1), np.diff(woff) + 1

    return read


def _first_model(docs: DataFrame, read, sample_docs: int, steps: int = 400) -> Model:
    """The learners' start values: some steps over random windows of a few training documents, by a hash of doc_id, in the order
    of their keys. Every learner goes on from them over the whole corpus."""
    n = docs.where("not held_out").count()
    point = F.pmod(F.xxhash64(F.lit("attention"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = docs.where(~F.col("held_out") & (point * F.lit(n) < sample_docs)).select("name", "text")

    def tokens_of(batches):
        own = read()
        for rows, data, offsets in shared.text_blocks(batches, "text"):
            tokens, first, _ = own(data, offsets)
            yield pa.RecordBatch.from_arrays([rows.column("name"), shared.lists(tokens.astype(np.int32), np.append(first, len(tokens)), pa.int32())], names=["name", "ids"])

    found = sorted((r.name, r.ids) for r in sample.mapInArrow(tokens_of, "name long, ids array<int>").collect())  # bounded by sample_docs
    count = np.array([len(ids) for _, ids in found], np.int64)
    tokens, first = np.array([t for _, ids in found for t in ids], np.int64), np.cumsum(count) - count
    begin, text = _window_index(first, count)
    if not len(begin):
        return Model.fresh()
    rng = np.random.default_rng(0)
    return train(lambda pick: windows_of(tokens, first, count, begin[pick], text[pick]), [rng.integers(0, len(begin), BATCH) for _ in range(steps)])


def _learned_chunks(docs: DataFrame, read) -> DataFrame:
    """key, lead, ids: all training documents in chunks of CHUNK windows. ids, a byte each: START or the token in front, then the
    tokens; lead: how many of the places are there to be seen only. The key is a hash of the document's name and the place."""
    schema = pa.schema([("key", pa.int64()), ("lead", pa.int32()), ("ids", pa.binary())])
    step = CHUNK * STRIDE

    def cut(batches):
        own = read()
        for rows, data, offsets in shared.text_blocks(batches, "text"):
            tokens, first, count = own(data, offsets)
            names = np.asarray(rows.column("name")).view(np.uint64)
            n = -(-count // step)
            text = np.repeat(np.arange(len(first)), n)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            key = shared.mixed(names[text] + k.astype(np.uint64) * shared.U64(0x9E3779B97F4A7C15))
            lead = np.where(k > 0, STRIDE, 0)
            # a text with START in front of it begins at first + its number
            held = np.insert(tokens, first, START).astype(np.uint8)
            begin = first[text] + text + k * step
            end = np.minimum(begin + step, first[text] + text + count[text]) + 1
            yield shared.columns_to_batch(schema, key.view(np.int64), lead.astype(np.int32), [held[x:y].tobytes() for x, y in zip(begin - lead, end)])

    return docs.where("not held_out").select("name", "text").mapInArrow(cut, "key long, lead int, ids binary")


class ChunkWindows:
    """Windows of chunks, made when they are picked: the ids in front of each place, -1 outside, and the ids to score."""

    def __init__(self, lead: np.ndarray, ids: list[bytes]):
        self.ids = np.frombuffer(b"".join(ids), np.uint8)
        size = np.array([len(x) for x in ids], np.int64)
        self.offsets = np.concatenate(([0], np.cumsum(size)))
        self.begin, self.chunk = _window_index(self.offsets[:-1] + lead, size - 1 - lead)

    def __len__(self) -> int:
        return len(self.begin)

    def take(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = self.begin[pick][:, None] + np.arange(-STRIDE, STRIDE)
        chunk = self.chunk[pick][:, None]
        valid = (place >= self.offsets[chunk]) & (place < self.offsets[chunk + 1] - 1)
        place = np.where(valid, place, 0)
        return np.where(valid, self.ids[place].astype(np.int64), -1), np.where(valid, self.ids[place + 1].astype(np.int64), -1)[:, STRIDE:]


def _fit(docs: DataFrame, read, sample_docs: int, share: int, each: int, n_tokens: int) -> Model:
    """Start values, then the average of what learners make of them, by their numbers of windows. A chunk's learner follows from
    its key, and so does its turn; the number of learners follows from the number of training tokens. So the model is a function
    of the table, whatever its files and partitions. share: for trials, to go over one window in so many."""
    start = _first_model(docs, read, sample_docs)
    if not n_tokens:
        return start
    learners = -(-n_tokens // (STRIDE * share * each))
    names = list(start.p)
    schema = pa.schema([("windows", pa.int64()), ("p", pa.list_(pa.float32()))])

    def improve(own: pa.Table) -> pa.Table:
        own = own.sort_by([("key", "ascending"), ("ids", "ascending")])
        windows = ChunkWindows(own.column("lead").to_numpy().astype(np.int64), own.column("ids").to_pylist())
        order = np.random.default_rng(len(windows)).permutation(len(windows))[: -(-len(windows) // share)]
        picks = [order[at : at + BATCH] for at in range(0, len(order), BATCH)]
        model = train(windows.take, picks, start=start, speed=0.004)
        flat = np.concatenate([model.p[k].ravel() for k in names]).astype(np.float32)
        return pa.Table.from_batches([shared.columns_to_batch(schema, [len(order)], shared.lists(flat, np.array([0, len(flat)]), pa.float32()))])

    dealt = _learned_chunks(docs, read).withColumn("learner", F.pmod(F.xxhash64("key"), F.lit(learners)))
    made = dealt.groupBy("learner").applyInArrow(improve, "windows long, p array<float>")
    parameters = made.select("windows", F.posexplode("p").alias("at", "v"))
    # whole numbers add up to the same sum in any order
    unit = float(1 << 40)
    mean = parameters.groupBy("at").agg((F.sum((F.round(F.col("v").cast("double") * unit) * F.col("windows")).cast("decimal(38,0)")) / F.sum("windows")).cast("double").alias("v"))
    found = mean.toPandas().sort_values("at")["v"].to_numpy(np.float64) / unit  # one row a parameter
    out, at = {}, 0
    for k in names:
        out[k] = found[at : at + start.p[k].size].reshape(start.p[k].shape).astype(np.float32)
        at += start.p[k].size
    return Model(out)


def _counts(docs: DataFrame, pieces, most: int = 1_000_000) -> DataFrame:
    """word (hash), subword, c: counts over all training documents. Each task sends partial sums; it holds about `most` of
    them, and merges those of its blocks whenever a third as many have come together."""
    schema = pa.schema([("word", pa.int64()), ("subword", pa.int32()), ("c", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]):
        words = Words(pieces.value)
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64))
        (keys, subwords, counts), pending, waiting, ends_seen = none, [], 0, 0

        def merged():
            all_keys, all_subwords, all_counts = (np.concatenate(c) for c in zip((keys, subwords, counts), *pending))
            own, first, back = np.unique(all_keys, return_index=True, return_inverse=True)
            return own, all_subwords[first], np.bincount(back, all_counts).astype(np.int64)

        for rows, data, offsets in shared.text_blocks(batches, "text", 2 << 20):
            sums, starts, ends, _, hashes = words.read(data, offsets)
            ends_seen += rows.num_rows
            own, at, n = np.unique(hashes, return_index=True, return_counts=True)
            pending.append((own, words.subwords(sums, starts[at], ends[at]).astype(np.int32), n))
            waiting += len(own)
            if waiting > most // 3:
                keys, subwords, counts = merged()
                pending, waiting = [], 0
                if len(keys) > most:
                    yield shared.columns_to_batch(schema, keys.view(np.int64), subwords, counts)
                    keys, subwords, counts = none
        keys, subwords, counts = merged()
        keys, subwords, counts = np.append(keys, END), np.append(subwords, np.int32(END_PIECE)), np.append(counts, ends_seen)
        yield shared.columns_to_batch(schema, keys.view(np.int64), subwords, counts)

    made = docs.where("not held_out").select("text").mapInArrow(count, "word long, subword int, c long").where("c > 0")
    return shared.saved(made.groupBy("word").agg(F.first("subword").alias("subword"), F.sum("c").alias("c")), "attention-counts")


@dataclass
class Fitted:
    """What scoring needs: counts of words in Spark, the classes' sizes (training tokens, distinct words), and the model."""

    docs: DataFrame
    pieces: object
    counts: DataFrame
    frequent: np.ndarray
    size: np.ndarray
    kinds: np.ndarray
    model: Model


def fit(docs: DataFrame, tokenizer: str, sample_docs: int = 600, share: int = 1, each: int = EACH) -> Fitted:
    """Count, name the classes and train. Rows go by a hash of doc_id and text, so rows of one doc_id are spread."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("name", F.xxhash64("doc_id", "text"))
    pieces = docs.sparkSession.sparkContext.broadcast(piece_tables(vocabulary_pieces(tokenizer)))
    counts = _counts(docs, pieces)
    kinds_of = counts.groupBy("subword").agg(F.sum("c").alias("n"), F.count("*").alias("v")).toPandas()  # no more rows than the vocabulary has
    subwords, found = kinds_of["subword"].to_numpy(np.int64), kinds_of[["n", "v"]].to_numpy(np.int64)
    inner = subwords != END_PIECE
    order = np.lexsort((subwords[inner], -found[inner, 0]))[: OWN - 1]
    frequent = np.sort(subwords[inner][order])
    classes = np.where(inner, class_of(subwords, frequent), 0)
    size, kinds = (np.bincount(classes, found[:, i], CLASSES).astype(np.int64) for i in (0, 1))
    model = _fit(docs, lambda: _classes(pieces, frequent), sample_docs, share, each, int(size.sum()))
    return Fitted(docs, pieces, counts, frequent, size, kinds, model)


def score(docs: DataFrame, tokenizer: str, sample_docs: int = 600, group_bytes: int = 12 << 20, share: int = 1, each: int = EACH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    fitted = fit(docs, tokenizer, sample_docs, share, each)
    docs, pieces, counts = fitted.docs, fitted.pieces, fitted.counts
    groups = shared.parts_for(docs, group_bytes, least=1)
    dealt = docs.withColumn("part", F.pmod("name", F.lit(groups)).cast("int")).drop("name").repartition(groups, "part")
    sent = docs.sparkSession.sparkContext.broadcast((fitted.frequent, fitted.model, fitted.size, fitted.kinds))
    words_schema = pa.schema([("part", pa.int32()), ("word", pa.int64())])

    def ask(batch: pa.Table) -> pa.Table:
        words, found = Words(), [np.array([END])]
        for _, data, offsets in shared.text_blocks(batch.to_batches(), "text"):
            found.append(np.unique(words.read(data, offsets)[4]))
        own = np.unique(np.concatenate(found))
        part = batch.column("part")[0].as_py()
        return pa.Table.from_arrays([pa.array(np.full(len(own), part, np.int32)), pa.array(own.view(np.int64))], schema=words_schema)

    asked = dealt.groupBy("part").applyInArrow(ask, "part int, word long")
    answers = asked.join(counts.select("word", "c"), "word").select("part", "word", "c")
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def answer(texts: pa.Table, known: pa.Table) -> pa.Table:
        frequent, model, size, kinds = sent.value
        total, distinct = int(size.sum()), int(kinds.sum())
        keys = known.column("word").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        keys, values = keys[order], known.column("c").to_numpy()[order]
        words = Words(pieces.value)
        made = []
        for rows, data, offsets in shared.text_blocks(texts.to_batches(), "text"):
            n = rows.num_rows
            sums, starts, ends, woff, hashes = words.read(data, offsets)
            unique, at, back = np.unique(hashes, return_index=True, return_inverse=True)
            kind = class_of(words.subwords(sums, starts[at], ends[at]), frequent)[back]
            place = np.searchsorted(keys, unique)
            place[place == len(keys)] = 0
            c = (np.where(keys[place] == unique, values[place], 0) if len(keys) else np.zeros(len(unique), np.int64))[back]
            tokens = np.insert(kind, woff[1:], 0)
            end_at = np.searchsorted(keys, END)
            c_end = int(values[end_at]) if end_at < len(keys) and keys[end_at] == END else 0
            c = np.insert(c, woff[1:], c_end)
            first = woff[:-1] + np.arange(n)
            count = np.diff(woff) + 1
            base = np.log10((c + 1) / (total + distinct + 1))
            context = model.log_probabilities(tokens, first, count).astype(np.float64) / np.log(10)
            own = context + np.log10((c + 1) / (size + kinds + 1)[tokens])
            add = lambda x: np.add.reduceat(x, first)  # noqa: E731, B023
            made.append(shared.columns_to_batch(schema, rows.column("doc_id"), rows.column("held_out"), count, add((c > 0).astype(np.int64)), np.full(n, total), add(base), add(own)))
        return pa.Table.from_batches(made, schema)

    return dealt.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(answer, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
