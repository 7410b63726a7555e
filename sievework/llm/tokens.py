"""Token ids as fixed-width bit-packed files.

A file holds ids of `width` bits each, most significant bit first, without gaps; width is the fewest bits that number
the vocabulary. Layout: the packed blocks, the byte offset of every block as 64-bit integers, and a 32-byte trailer
(magic, width, block size, number of ids, number of blocks). A block has a fixed number of ids and starts on a byte, so
any id is found by one seek, and whole blocks unpack with a few numpy steps. Nothing is written twice, so a file may go to
storage that only appends.

Documents are dealt into files by ranges of doc_id and written in that order, one file a task, under a name that the
range fixes: a task that runs again replaces its own file. An index table (file, doc_id, first id, ids) goes beside them.

Encoding: the text is cut in front of single spaces between other characters, where the tokenizer's own splitting always
cuts as well; each distinct piece of a block is encoded once, by the tokenizers library, and its ids are laid out for
every occurrence. Cuts, numbering and layout are numpy.

Defined results: null counts as the empty text; each document ends with the end id, so empty ones have one id. Rows that
repeat a doc_id are written in order of their text. An empty table makes no files and no rows."""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext

from . import files, shared

MAGIC = b"SVTK"
BLOCK_IDS = 4096
TRAILER = struct.Struct("<4sIIxxxxqq")
#: Distinct pieces that a worker remembers, about 20 bytes each; the memory grows with none but this number.
REMEMBERED = 3_000_000
#: Pieces that go to the tokenizer at a time.
AT_A_TIME = 32_768


def width_of(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Bits of the ids, end to end; the last byte is filled with zeros."""
    if width == 16:
        return ids.astype(">u2").tobytes()
    shifts = np.arange(width - 1, -1, -1, dtype=np.uint32)
    return np.packbits(((ids.astype(np.uint32)[:, None] >> shifts) & 1).astype(np.uint8)).tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    if width == 16:
        return np.frombuffer(data, ">u2", n).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width).reshape(n, width)
    return bits.astype(np.uint32) @ (np.uint32(1) << np.arange(width - 1, -1, -1, dtype=np.uint32))


class Writer:
    """Writes ids to a stream in blocks; keeps one unfinished block in memory."""

    def __init__(self, out, width: int, block: int = BLOCK_IDS):
        self.out, self.width, self.block, self.n = out, width, block, 0
        self.rest, self.offsets, self.at = np.zeros(0, np.uint32), [], 0

    def add(self, ids: np.ndarray) -> None:
        self.n += len(ids)
        ids = np.concatenate((self.rest, ids.astype(np.uint32)))
        whole = len(ids) // self.block * self.block
        for b in range(0, whole, self.block):
            self._put(ids[b : b + self.block])
        self.rest = ids[whole:]

    def _put(self, ids: np.ndarray) -> None:
        data = pack(ids, self.width)
        self.offsets.append(self.at)
        self.at += len(data)
        self.out.write(data)

    def finish(self) -> None:
        if len(self.rest):
            self._put(self.rest)
        self.out.write(np.array(self.offsets, "<i8").tobytes())
        self.out.write(TRAILER.pack(MAGIC, self.width, self.block, self.n, len(self.offsets)))


class Reader:
    """Random access to the ids of a file."""

    def __init__(self, stream):
        self.stream = stream
        end = stream.seek(0, os.SEEK_END)
        stream.seek(end - TRAILER.size)
        magic, self.width, self.block, self.n, blocks = TRAILER.unpack(stream.read(TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        stream.seek(end - TRAILER.size - 8 * blocks)
        self.offsets = np.frombuffer(stream.read(8 * blocks), "<i8")

    def ids(self, first: int, n: int) -> np.ndarray:
        if n <= 0:
            return np.zeros(0, np.uint32)
        lo, hi = first // self.block, (first + n - 1) // self.block
        self.stream.seek(int(self.offsets[lo]))
        count = min(self.n - lo * self.block, (hi - lo + 1) * self.block)
        size = (self.block * self.width + 7) // 8 * (hi - lo) + ((count - (hi - lo) * self.block) * self.width + 7) // 8
        data = self.stream.read(size)
        if self.block * self.width % 8 == 0:
            got = unpack(data, count, self.width)
        else:
            step = (self.block * self.width + 7) // 8
            got = np.concatenate([unpack(data[k * step : (k + 1) * step], min(self.block, count - k * self.block), self.width) for k in range(hi - lo + 1)])
        return got[first - lo * self.block :][:n]


class PieceEncoder:
    """Encodes blocks of texts piece by piece. Remembers the ids of pieces by their 64-bit hash and length. Once there are
    more than REMEMBERED, those that came up only once since the last time are forgotten."""

    def __init__(self, path: str):
        self.vocabulary = self._load(path)
        self.hasher = shared.Hasher(5)
        self.keys, self.firsts, self.counts, self.again = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool)
        self.ids = np.zeros(0, np.uint16 if self.vocabulary <= 1 << 16 else np.uint32)

    def _load(self, path: str) -> int:
        """Load the tokenizer; the size of its vocabulary."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        return self.tokenizer.get_vocab_size()

    def _tokenized(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _forget(self) -> None:
        keep = np.flatnonzero(self.again)
        if len(keep) > REMEMBERED // 2:
            keep = keep[:0]
        counts = self.counts[keep].astype(np.int64)
        firsts = np.cumsum(counts) - counts
        self.ids = self.ids[np.repeat(self.firsts[keep] - firsts, counts) + np.arange(counts.sum())]
        self.keys, self.firsts, self.counts, self.again = self.keys[keep], firsts, self.counts[keep], np.zeros(len(keep), bool)

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw, all_counts, all_ids = data.tobytes(), [], [self.ids]
        for at in range(0, len(keys), AT_A_TIME):
            pieces = [raw[b:e].decode() for b, e in zip(starts[at : at + AT_A_TIME].tolist(), ends[at : at + AT_A_TIME].tolist())]
            got = self._tokenized(pieces)
            all_counts.append(np.fromiter(map(len, got), np.int64, len(got)))
            all_ids.append(np.fromiter((i for g in got for i in g), self.ids.dtype, all_counts[-1].sum()))
        counts = np.concatenate(all_counts)
        firsts = np.cumsum(counts) - counts + len(self.ids)
        self.ids = np.concatenate(all_ids)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.firsts = np.insert(self.keys, at, keys), np.insert(self.firsts, at, firsts)
        self.counts, self.again = np.insert(self.counts, at, counts), np.insert(self.again, at, False)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        n = len(data)
        if not n:
            return np.zeros(0, self.ids.dtype), np.zeros(len(offsets) - 1, np.int64)
        plain = (data > 0x20) & (data < 0x7F)
        space = data == 0x20
        cut = np.zeros(n, bool)
        cut[1:-1] = space[1:-1] & (plain[:-2] | plain[2:]) & ~space[:-2] & ~space[2:]
        cut[offsets[:-1][offsets[:-1] < n]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], n)
        keys = self.hasher.spans(self.hasher.prefix(data), starts, ends)
        unique, first, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self._forget()
        at = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        inner = at < len(self.keys)
        known[inner] = self.keys[at[inner]] == unique[inner]
        self.again[at[known]] = True
        new = np.flatnonzero(~known)
        if len(new):
            self._learn(unique[new], data, starts[first[new]], ends[first[new]])
            at = np.searchsorted(self.keys, unique)
        which = at[back]
        counts = self.counts[which].astype(np.int64)
        total = np.cumsum(counts)
        source = np.repeat(self.firsts[which] - (total - counts), counts) + np.arange(total[-1])
        bounds = np.searchsorted(starts, offsets)
        sums = np.concatenate(([0], total))
        return self.ids[source], sums[bounds[1:]] - sums[bounds[:-1]]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


INDEX = T.StructType(
    [T.StructField("file", T.StringType()), T.StructField("file_no", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("first", T.LongType()), T.StructField("n_tokens", T.LongType())]
)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, files_of: int = 16 << 20) -> DataFrame:
    """Write the files and return the index, read back from its table: file, file_no, doc_id, first (id in the file),
    n_tokens (with the end id). files_of: bytes of input for each file, roughly."""
    schema = pa.schema([("file", pa.string()), ("file_no", pa.int32()), ("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])

    def write(batches):
        enc = encoder(tokenizer)
        no = TaskContext.get().partitionId()
        name = f"{folder}/tokens-{no:06d}.bin"
        out = None
        for rows, data, offsets in shared.text_blocks(batches, "text", 2 << 20):
            if out is None:
                out = files.Replacing(name)
                writer = Writer(out.stream, width_of(enc.vocabulary))
            ids, counts = enc.encode(data, offsets)
            full = np.insert(ids, np.cumsum(counts), end_id)
            first = writer.n + np.concatenate(([0], np.cumsum(counts + 1)[:-1]))
            writer.add(full)
            n = rows.num_rows
            yield shared.columns_to_batch(schema, [name] * n, np.full(n, no, np.int32), rows.column("doc_id"), first, counts + 1)
        if out is not None:
            writer.finish()
            out.finish()

    docs = shared.columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    ranged = docs.repartitionByRange(shared.parts_for(docs, files_of), "doc_id").sortWithinPartitions("doc_id", "text")
    return shared.saved(ranged.mapInArrow(write, INDEX), "token-index")


def read_token_files(index: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it, over all files), n_tokens, ids_crc32 of the ids in the files."""
    sums = index.groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    # one row a file, in hundreds of megabytes of tokens each
    before = sums.select("file_no", (F.sum("n").over(Window.orderBy("file_no")) - F.col("n")).alias("before"))
    schema = pa.schema([("file_no", pa.int32()), ("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def check(batches):
        name, reader, out = None, None, None
        for batch in batches:
            sums = np.zeros(batch.num_rows, np.int64)
            for i, (f, first, n) in enumerate(zip(batch.column("file").to_pylist(), batch.column("first").to_pylist(), batch.column("n_tokens").to_pylist())):
                if f != name:
                    if out is not None:
                        out.close()
                    out = files.opened(f)
                    name, reader = f, Reader(out)
                sums[i] = zlib.crc32(reader.ids(first, n).astype("<u4").tobytes())
            yield shared.columns_to_batch(schema, batch.column("file_no"), batch.column("doc_id"), batch.column("first"), batch.column("n_tokens"), sums)

    per_file = index.repartition("file").sortWithinPartitions("file", "first")
    read = per_file.mapInArrow(check, "file_no int, doc_id long, first long, n_tokens long, ids_crc32 long")
    return read.join(before, "file_no").select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
