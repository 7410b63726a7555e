"""Helpers that several corpus operators share: where intermediate tables go, and how blocks of text become numpy arrays.

Texts are handled as UTF-8 bytes in blocks of a few megabytes, so the memory a task needs depends on the block and on
its longest single text, never on the partition.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 2 << 20

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir as the session names it. Only where it is unset, as in
    tests, a folder of our own: under /tmp/checkpoints for a local master, else under the warehouse."""
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if conf.get("spark.master", "").startswith("local"):
        return "file:///tmp/checkpoints"
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def delete(spark: SparkSession, path: str) -> None:
    """Remove a table or a folder of files that nothing reads any more."""
    system, at = _file_system(spark, path)
    system.delete(at, True)


def until_exit(spark: SparkSession, path: str) -> None:
    """Have a written folder removed when the driver ends: results read it until then."""
    system, at = _file_system(spark, path)
    system.deleteOnExit(at)


def saved_to(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    until_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved(df: DataFrame, label: str, release: bool = False, files: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, survives lost executors, and lets the
    shuffle files behind it go. release: see to it that these files are gone before more work begins. files: how many it
    has at most, as files_for() says; partitions are taken together, none is sent on."""
    spark = df.sparkSession
    back = saved_to(df.coalesce(files) if files else df, new_folder(spark, label))
    for _ in range(2 if release else 1):
        # Spark drops shuffle files once the driver has collected the plan that made them; listeners hold it for a moment
        time.sleep(0.7 if release else 0)
        spark.sparkContext._jvm.System.gc()
    return back


def drop(table: DataFrame) -> None:
    """Remove a table that saved() gave, once what was made from it is a saved table itself."""
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        delete(table.sparkSession, folder)


def parts_for(df: DataFrame, bytes_each: int = 16 << 20, least: int = 8) -> int:
    """A number of partitions in proportion to the input, from the optimizer's size estimate; the session's number of
    shuffle partitions where Spark knows no size."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= 1 << 60:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return int(max(least, min(size // bytes_each + 1, 1 << 17)))


def files_for(df: DataFrame, bytes_each: int = 1 << 20) -> int:
    """How many files a table should have that is made from df: some for every core, and more in proportion to df. On a local
    disk Hadoop starts two processes for each file (chmod of it and of its checksum), and a process that an executor
    starts has all the executor's memory until it runs its program; hundreds of almost empty files are hundreds of those."""
    return parts_for(df, bytes_each, least=4 * df.sparkSession.sparkContext.defaultParallelism)


# --- blocks of text -------------------------------------------------------------------------------------------------


def text_blocks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into blocks of rows. Yields the rows, their texts' bytes end to end, and the offset of each
    text plus the end. Null counts as empty. A text longer than the limit makes a block of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        if texts.null_count:
            texts = texts.fill_null("")
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
        at = 0
        while at < len(texts):
            to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), len(texts))
            yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """True for bytes inside any of the ranges, both ends included."""
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


#: Bytes of words that white space separates: [^\x20\x09-\x0D].
WORD = ~byte_table((0x20, 0x20), (0x09, 0x0D))
#: Bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F] words, for lower-cased text.
ALNUM = ~byte_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the index of each text's first word plus the end. No word crosses texts."""
    word = table[data]
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = word[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


# --- hashes ---------------------------------------------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finisher over 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


class Hasher:
    """64-bit hashes of any byte ranges of a block, from one pass of prefix sums. Byte values go through a random table
    first, so plain repetitive text has no algebraic structure left."""

    def __init__(self, seed: int = 1):
        self.values = np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            with np.errstate(over="ignore"):
                steps = np.full(n, _BASE, np.uint64)
                steps[0] = 1
                self.up = np.cumprod(steps)
                steps[1:] = _BASE_INVERSE
                self.down = np.cumprod(steps)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (sums[ends] - sums[starts]) * self.down[starts]
        return mixed(raw + (ends - starts).astype(np.uint64) * U64(0xD6E8FEB86659FD93))

    def runs(self, sums: np.ndarray, size: int, at: int, to: int) -> np.ndarray:
        """What spans() gives for the `size` bytes from each place of at..to, without index arrays."""
        x = sums[at + size : to + size] - sums[at:to]
        with np.errstate(over="ignore"):
            x *= self.down[at:to]
            x += U64(size) * U64(0xD6E8FEB86659FD93)
            x ^= x >> U64(30)
            x *= U64(0xBF58476D1CE4E5B9)
            x ^= x >> U64(27)
            x *= U64(0x94D049BB133111EB)
            x ^= x >> U64(31)
        return x


#: Odd multipliers, one for each place in a shingle.
_PLACES = np.random.default_rng(7).integers(0, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of `size` word hashes; runs are not kept inside texts here."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total += words[j : j + n] * _PLACES[j]
    return mixed(total)


def inside(woff: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the runs of `size` words that lie within one text, and each text's number of them."""
    counts = np.maximum(np.diff(woff) - size + 1, 0)
    first = np.repeat(woff[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return first + np.arange(counts.sum()), counts


def columns_to_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, t) for c, t in zip(columns, schema.types)],
        schema=schema,
    )


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator works on, so extra columns with clashing names do no harm."""
    return df.select(*[F.col(f"`{n}`") for n in names])
