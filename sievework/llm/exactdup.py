"""Exact duplicates by composable polynomial fingerprints.

A text is a sequence of bytes b_0, b_1, ...; in each of four lanes its fingerprint is the sum of b_i * B^i modulo the prime
2^31 - 1, with another base B. The fingerprint of a joined text follows from those of its halves, H(xy) = H(x) + B^|x| H(y), so
chunks are hashed apart, in any order, shifted by the length before them and added up.

1. Texts of up to one chunk are hashed where they are read, a block of texts in a few numpy steps. Longer ones are cut into
   chunks that Spark deals over the tasks, and their shifted hashes are summed for each row.
2. Rows with equal length and lanes form a group, from partial aggregates: a hot group is one row a task.
3. Groups of two rows or more undergo a comparison of the bytes, chunk by chunk: for each place in the text the least and the
   greatest chunk of the group stream through a sorted partial aggregate, two chunks in memory a place. Equal at all places,
   the texts are equal. Only texts of such groups are read for this, and copies within a task fold before they travel.
4. Groups in which some chunk differs (unlike texts with equal fingerprints) are grouped by the texts themselves.

Defined results: null counts as the empty text; nothing else is changed. Of equal texts the row with the largest doc_id
stays, rows without doc_id come last. Of rows that repeat doc_id and text one stays; keep_id is null only if no row of the group
has a doc_id. An empty table gives no rows. Other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 715_827_881, 1_812_433_253 % PRIME, 48_271_999)
CHUNK = 1 << 20


class Polynomial:
    """Fingerprints of byte ranges modulo a prime below 2^31, one lane for each base."""

    def __init__(self, prime: int = PRIME, bases: tuple[int, ...] = BASES):
        self.prime, self.bases = prime, [b % prime or 1 for b in bases]
        self.up = np.ones((len(bases), 1), np.int64)
        self.down = self.up.copy()

    def _grow(self, n: int) -> None:
        while self.up.shape[1] < n:
            have = self.up.shape[1]
            steps = [(pow(b, have, self.prime), pow(pow(b, -1, self.prime), have, self.prime)) for b in self.bases]
            self.up = np.concatenate([self.up, self.up * np.array([[u] for u, _ in steps]) % self.prime], axis=1)
            self.down = np.concatenate([self.down, self.down * np.array([[d] for _, d in steps]) % self.prime], axis=1)

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The lanes of each text, one row a lane. A block holds less than 2^23 bytes, so no sum leaves 64 bits."""
        self._grow(len(data) + 1)
        out = np.zeros((len(self.bases), len(offsets) - 1), np.int64)
        sums = np.zeros(len(data) + 1, np.int64)
        for lane in range(len(self.bases)):
            np.cumsum(data * self.up[lane, : len(data)], out=sums[1:])
            out[lane] = np.diff(sums[offsets]) % self.prime * self.down[lane, offsets[:-1]] % self.prime
        return out

    def shifted(self, lanes: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The share of chunks in the fingerprint of their whole, of which `before` bytes stand in front of each."""
        shifts = np.array([[pow(b, int(n), self.prime) for n in before.tolist()] for b in self.bases], np.int64).reshape(lanes.shape)
        return lanes * shifts % self.prime


LANES = [f"h{i}" for i in range(len(BASES))]


def _hashed(chunks: DataFrame, poly: Polynomial, keep: list[str]) -> DataFrame:
    """The shifted lanes of each chunk (columns `at` and `data`), with the columns to keep."""
    names = [*keep, *LANES]
    kinds = ", ".join([*(f"{c} {chunks.schema[c].dataType.simpleString()}" for c in keep), *(f"{h} long" for h in LANES)])

    def run(batches):
        for rows, data, offsets in shared.text_blocks(batches, "data"):
            lanes = poly.shifted(poly.spans(data, offsets), np.asarray(rows.column("at")))
            parts = [rows.column(c) for c in keep] + [pa.array(x, pa.int64()) for x in lanes]
            yield pa.RecordBatch.from_arrays(parts, names=names)

    return chunks.select(*keep, "at", "data").mapInArrow(run, kinds)


def _pieces(chunk: int) -> F.Column:
    """A text's bytes in chunks: (at, data). The empty text has one, which is empty."""
    size = F.greatest(F.length("bytes").cast("long"), F.lit(1))
    starts = F.sequence(F.lit(0).cast("long"), size - 1, F.lit(chunk).cast("long"))
    return F.inline(F.transform(starts, lambda at: F.struct(at.alias("at"), F.expr("bytes").substr((at + 1).cast("int"), F.lit(chunk)).alias("data"))))


def _read(docs: DataFrame) -> DataFrame:
    """doc_id, bytes, size and x: a hash that only selects rows for another look."""
    text = F.coalesce(F.col("`text`").cast("string"), F.lit(""))
    return docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), text.cast("binary").alias("bytes"), F.octet_length(text).cast("long").alias("size"), F.xxhash64(text).alias("x"))


def fingerprints(docs: DataFrame, chunk: int = CHUNK, poly: Polynomial | None = None) -> DataFrame:
    """One row for each document row: row (a number of its own), doc_id, x, sha256, size, h0 to h3."""
    poly = poly or Polynomial()
    rows = _read(docs).select("doc_id", "bytes", "size", "x", F.sha2("bytes", 256).alias("sha256"))
    number = F.monotonically_increasing_id() * 2
    own = ["row", "doc_id", "x", "sha256", "size"]
    short = rows.where(F.col("size") <= chunk).withColumns({"row": number, "at": F.lit(0).cast("long"), "data": F.col("bytes")})
    long = rows.where(F.col("size") > chunk).withColumn("row", number + 1)
    pieces = long.select(*own, _pieces(chunk)).repartition("row", "at")
    whole = _hashed(pieces, poly, own).groupBy(*own).agg(*[(F.sum(h) % poly.prime).alias(h) for h in LANES])
    return _hashed(short, poly, own).unionByName(whole)


def exact_duplicates(docs: DataFrame, chunk: int = CHUNK, poly: Polynomial | None = None) -> DataFrame:
    """One row for each document row: doc_id, keep_id, group_size, kept, text_sha256."""
    poly = poly or Polynomial()
    key = ["size", *LANES]
    prints = shared.saved(fingerprints(docs, chunk, poly), "exact-prints")
    found = [F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("best")]
    groups = shared.saved(prints.groupBy(*key).agg(*found, F.min("x").alias("x"), F.max("x").alias("x2")), "exact-groups")
    several = groups.where("group_size > 1").select(F.struct(*key).alias("of"), "x", "x2")
    pieces = _read(docs).join(several.where("x = x2").select("x", "of"), "x").select("of", "bytes").select("of", _pieces(chunk))
    same = pieces.groupBy("of", "at").agg((F.min("data") == F.max("data")).alias("same"))
    unlike = shared.saved(same.where("not same").select("of").unionAll(several.where("x <> x2").select("of")).distinct(), "exact-unlike")
    if unlike.isEmpty():
        return _verdicts(prints.join(groups.drop("x", "x2"), key))
    apart = shared.saved(prints.join(unlike.select("of.*"), key, "left_semi").select("x").distinct(), "exact-apart")
    plain = _verdicts(prints.join(apart, "x", "left_anti").join(groups.drop("x", "x2"), key))
    texts = _read(docs).join(apart, "x", "left_semi").withColumn("row", F.monotonically_increasing_id())
    texts = shared.saved(texts.select("row", "doc_id", "bytes", F.sha2("bytes", 256).alias("sha256")), "exact-texts")
    return plain.unionByName(_verdicts(texts.join(texts.groupBy("bytes").agg(*found), "bytes")))


def _verdicts(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha256").alias("text_sha256"))
