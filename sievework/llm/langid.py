"""Language identification by interpolated Kneser-Ney character models.

For each language, trigram, bigram and unigram counts of a bounded sample of labelled texts make an interpolated
Kneser-Ney model. All languages share sorted arrays of keys; beside each key stands a row with every language's log
probability, so one binary search scores a position for all languages. Positions whose trigram no language knows fall
back along the same chain: context weight, then bigrams, then unigrams.

A text gets the language of the lowest cross-entropy per character. The score is a softmax of the negative
cross-entropies at a temperature; a text whose best cross-entropy lies beyond nearly all those of known texts is marked as
rejected. Temperature and limit are calibrated on a fifth of the sample, by a model of the other four; the model that
predicts then learns from the whole sample.

Training takes at most about `per_language` texts of each language, chosen by a hash of doc_id; the model is as big as
the trigrams of that sample and goes to the tasks by broadcast. Scoring is one Arrow pass over whole texts, without a
shuffle.

Defined results: null texts and texts without a letter are `und` with score 0. Without any labelled text every row is
`und`. An empty table gives no rows. Only doc_id, text and lang are read, so other columns may have any name. Of languages
with equal cross-entropies the first by name wins. Rows with null lang are never learned from, and are predicted like others. Repeated rows give one row each."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

DISCOUNT = 0.75
#: Code points below this are lower-cased, or made a space if they are no letters; others stay as they are.
FOLDED = 0x2000
_FOLD = np.arange(0x110000, dtype=np.uint32)
_FOLD[:FOLDED] = [ord(c.lower()) if len(c.lower()) == 1 and c.isalpha() else (ord(c) if c.isalpha() else 32) for c in map(chr, range(FOLDED))]
SHIFT = np.uint64(21)


def _folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block's texts as folded code points, each with two spaces in front and one behind, runs of spaces as one; and
    the offsets of the texts."""
    chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
    n = len(offsets) - 1
    codes = np.insert(_FOLD[chars], heads[:-1], np.uint32(32))
    bounds = heads + np.arange(n + 1)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    keep[bounds[:-1]] = True
    sums = np.concatenate(([0], np.cumsum(keep)))
    codes, bounds = codes[keep], sums[bounds]
    codes = np.insert(codes, bounds[1:], np.uint32(32))
    return codes, bounds + np.arange(n + 1)


def _grams(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact 63-bit trigram keys that end at each position but a text's first, and each text's first key."""
    c = codes.astype(np.uint64)
    before = np.empty_like(c)
    before[0:1], before[1:] = 32, c[:-1]
    first = np.empty_like(c)
    first[:2], first[2:] = 32, c[:-2]
    starts = bounds[:-1]
    first[np.minimum(starts + 1, len(c) - 1)] = 32
    inside = np.ones(len(c), bool)
    inside[starts] = False
    keys = (first << (SHIFT + SHIFT)) | (before << SHIFT) | c
    return keys[inside], bounds - np.arange(len(bounds))


@dataclass
class Model:
    languages: list[str]
    tri: np.ndarray  # sorted keys
    tri_log: np.ndarray  # a row of log probabilities for each
    context: np.ndarray  # sorted two-character contexts
    context_weight: np.ndarray  # log of what a context leaves to shorter grams
    bi: np.ndarray
    bi_p: np.ndarray
    one: np.ndarray
    one_weight: np.ndarray
    uni: np.ndarray
    uni_p: np.ndarray
    rare: np.ndarray  # probability of a character never seen
    temperature: float = 1.0
    limit: float = 99.0

    def logs(self, keys: np.ndarray) -> np.ndarray:
        at, seen = _look(self.tri, keys)
        out = self.tri_log[at]
        miss = np.flatnonzero(~seen)
        if len(miss):
            out[miss] = self._backed_off(keys[miss])
        return out

    def _backed_off(self, keys: np.ndarray) -> np.ndarray:
        mask = np.uint64((1 << 42) - 1)
        p = _rows(self.uni, self.uni_p, keys & np.uint64((1 << 21) - 1), self.rare)
        p = _rows(self.one, self.one_weight, (keys & mask) >> SHIFT, 1.0) * p + _rows(self.bi, self.bi_p, keys & mask, 0.0)
        return np.log(_rows(self.context, self.context_weight, keys >> SHIFT, 1.0) * p).astype(np.float32)


def _look(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


def _rows(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, otherwise) -> np.ndarray:
    at, seen = _look(keys, wanted)
    out = values[at].copy()
    out[~seen] = otherwise
    return out


def _dense(keys: np.ndarray, which: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and a matrix of the summed values, one column for each language."""
    own, back = np.unique(keys, return_inverse=True)
    out = np.zeros((len(own), n))
    np.add.at(out, (back, which), values)
    return own, out


def fit(languages: list[str], keys: np.ndarray, which: np.ndarray, counts: np.ndarray) -> Model:
    """Interpolated Kneser-Ney from trigram counts; lower orders count the different characters before them."""
    n = len(languages)
    low21, low42 = np.uint64((1 << 21) - 1), np.uint64((1 << 42) - 1)
    tri, c3 = _dense(keys, which, counts.astype(float), n)
    present = c3 > 0
    context, total3 = _dense(np.repeat(tri >> SHIFT, n), np.tile(np.arange(n), len(tri)), c3.ravel(), n)
    _, kinds3 = _dense(np.repeat(tri >> SHIFT, n), np.tile(np.arange(n), len(tri)), present.ravel().astype(float), n)
    bi, c2 = _dense(np.repeat(tri & low42, n), np.tile(np.arange(n), len(tri)), present.ravel().astype(float), n)
    has2 = c2 > 0
    one, total2 = _dense(np.repeat(bi >> SHIFT, n), np.tile(np.arange(n), len(bi)), c2.ravel(), n)
    _, kinds2 = _dense(np.repeat(bi >> SHIFT, n), np.tile(np.arange(n), len(bi)), has2.ravel().astype(float), n)
    uni, c1 = _dense(np.repeat(bi & low21, n), np.tile(np.arange(n), len(bi)), has2.ravel().astype(float), n)
    total1 = c1.sum(0)
    with np.errstate(divide="ignore", invalid="ignore"):
        rare = DISCOUNT * (c1 > 0).sum(0) / np.maximum(total1, 1) / (len(uni) + 1)
        uni_p = np.maximum(c1 - DISCOUNT, 0) / np.maximum(total1, 1) + rare
        one_weight = np.where(total2 > 0, DISCOUNT * kinds2 / total2, 1.0)
        bi_p = np.where(has2, (c2 - DISCOUNT) / total2[np.searchsorted(one, bi >> SHIFT)], 0.0)
        context_weight = np.where(total3 > 0, DISCOUNT * kinds3 / total3, 1.0)
        tri_p = np.where(present, (c3 - DISCOUNT) / total3[np.searchsorted(context, tri >> SHIFT)], 0.0)
    model = Model(languages, tri, np.zeros((len(tri), n), np.float32), context, context_weight, bi, bi_p, one, one_weight, uni, uni_p, np.maximum(rare, 1e-12))
    model.tri_log = np.log(tri_p + np.exp(model._backed_off(tri))).astype(np.float32)
    return model


def cross_entropies(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits per character, one row for each text and one column for each language."""
    codes, bounds = _folded(data, offsets)
    keys, first = _grams(codes, bounds)
    logs = model.logs(keys)
    sums = np.add.reduceat(logs, first[:-1], axis=0) if len(keys) else np.zeros((0, len(model.languages)))
    return -sums / np.diff(first)[:, None] / np.log(2)


def is_training(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(doc_id.cast("string")) % folds != 0


def _sample(docs: DataFrame, per_language: int) -> DataFrame:
    """About per_language texts of each language at most, by a hash of doc_id. The counts are written first, so Spark
    knows their size before it plans the join, and does not move the texts to the few tasks of the languages."""
    own = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & F.coalesce(is_training(F.col("doc_id")), F.lit(True)))
    counts = shared.saved(own.groupBy("lang").count(), "langid-counts")
    point = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    held = F.pmod(F.xxhash64(F.lit("calibration"), "doc_id"), F.lit(5)) == 0
    return own.join(counts, "lang").where(point * F.col("count") < per_language).select("lang", "text", held.alias("held"))


def train(docs: DataFrame, per_language: int = 1500) -> Model | None:
    schema = pa.schema([("lang", pa.string()), ("held", pa.bool_()), ("key", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]):
        for rows, data, offsets in shared.text_blocks(batches, "text"):
            codes, bounds = _folded(data, offsets)
            keys, first = _grams(codes, bounds)
            names, which = np.unique(np.array(rows.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
            held = rows.column("held").to_numpy(zero_copy_only=False)
            of = np.repeat(which * 2 + held, np.diff(first))
            for i in np.unique(of).tolist():
                own, n = np.unique(keys[of == i], return_counts=True)
                yield shared.columns_to_batch(schema, [names[i // 2]] * len(own), np.full(len(own), bool(i % 2)), own.view(np.int64), n)

    sample = shared.saved(_sample(docs, per_language), "langid-sample")
    counted = sample.mapInArrow(count, "lang string, held boolean, key long, n long").groupBy("lang", "held", "key")
    grams = counted.agg(F.sum("n").alias("n")).toPandas()  # bounded by the sample
    if grams.empty:
        return None
    languages = sorted(grams["lang"].unique())
    learn = lambda g: fit(languages, g["key"].to_numpy().view(np.uint64), g["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(), g["n"].to_numpy())
    model, most = learn(grams), grams[~grams["held"]]
    if most["lang"].nunique() == len(languages) and grams["held"].any():
        model.temperature, model.limit = _calibrated(learn(most), sample.where("held"))
    else:  # a sample of a few texts has no part to spare
        model.temperature, model.limit = _calibrated(model, sample)
    return model


def _calibrated(model: Model, sample: DataFrame) -> tuple[float, float]:
    """The temperature with the least loss on the sample's cross-entropies, and the limit that one in a thousand passes."""
    sent = sample.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for rows, data, offsets in shared.text_blocks(batches, "text"):
            ce = cross_entropies(sent.value, data, offsets)
            gold = np.array([sent.value.languages.index(x) for x in rows.column("lang").to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(gold, pa.int32()), shared.lists(ce.ravel().astype(np.float64), np.arange(len(ce) + 1) * ce.shape[1], pa.float64())], names=["gold", "ce"])

    got = sample.mapInArrow(score, "gold int, ce array<double>").toPandas()  # bounded by the sample
    ce, gold = np.vstack(got["ce"]), got["gold"].to_numpy()
    best = None
    for t in (0.5, 1, 2, 4, 8, 16, 32):
        z = -ce * t
        loss = (np.log(np.exp(z - z.max(1, keepdims=True)).sum(1)) + z.max(1) - z[np.arange(len(z)), gold]).mean()
        if best is None or loss < best[0]:
            best = (loss, float(t))
    return best[1], float(np.quantile(ce.min(1), 0.999))


def identify(docs: DataFrame, per_language: int = 1500) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy, rejected."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    held = F.coalesce(~is_training(F.col("doc_id")), F.lit(False))
    model = train(docs, per_language)
    rows = docs.select("doc_id", held.alias("held_out"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("cross_entropy", pa.float64()), ("rejected", pa.bool_())])

    def predict(batches):
        model = sent.value
        names = np.array(model.languages, dtype=object)
        for rows, data, offsets in shared.text_blocks(batches, "text", 1 << 20):
            ce = cross_entropies(model, data, offsets)
            ok = rows.column("has_letter").to_numpy(zero_copy_only=False)
            best = ce.argmin(1)
            low = ce.min(1)
            score = 1 / np.exp(-(ce - low[:, None]) * model.temperature).sum(1)
            yield shared.columns_to_batch(
                schema, rows.column("doc_id"), rows.column("held_out"), np.where(ok, names[best], "und").tolist(), np.where(ok, np.clip(score, 0, 1), 0.0), low, (low > model.limit) | ~ok
            )

    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double, cross_entropy double, rejected boolean")
