"""Alignment of two tokenizers' tokens over the same bytes.

Tokenizer A is a byte-level vocabulary and sees the text behind a space, B is a piece vocabulary that adds this space
itself, so both cover the same bytes. In a block of texts the ends of A's tokens are bits of one packed bitset over byte
places, those of B's another one. Their AND has the shared cuts; population counts of words (rank) turn a cut into the
number of tokens before it, and the set bits' places (select) into bytes. Between two cuts lies a group: a run of A's tokens
over the same bytes as a run of B's. Every pair of a token of one run and one of the other is a link.

How many documents hold a pair linked is counted over the whole corpus. A block of documents numbers its distinct pairs and
tells how many of its documents hold each; these numbers travel, not the links. Spark adds them up, finds the highest count of
each A id, and hands the counts back to the block, where one step sums them over the links of each document.

Texts are cut in front of single spaces next to printable characters, where neither tokenizer joins anything: each
distinct piece of a block is encoded once and its ids are laid out for every occurrence. A long text is aligned in segments,
one after the other; memory follows the segment and the distinct pairs of a document.

Defined results: texts that are null or empty, and those that the tokens of A or B do not spell byte for byte (B folds
U+2581 and spaces, for one), have no tokens: zeros and an empty digest; they count for no pair. Rows that repeat a doc_id or a
text are documents of their own. An empty table gives no rows. Other columns are ignored."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from . import shared, tokens

BLOCK_BYTES = 2 << 20
#: Characters of a long text that are tokenized at a time, roughly.
SEGMENT = 1 << 20
#: Links that are held at a time, and from how many on a group is counted by its distinct ids.
LINKS, LARGE = 1 << 22, 1 << 12
#: An id pair is one number: A's id above the bits of B's.
B_BITS = 20
_CUT = re.compile(r"(?<=[!-~]) (?=[!-~])")


# --- vocabularies ----------------------------------------------------------------------------------------------------


def _byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others in order
    for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class PlainEncoder(tokens.PieceEncoder):
    """Tokenizer A; the strings of its special tokens are plain text."""

    def _load(self, path: str) -> int:
        size = super()._load(path)
        self.tokenizer.encode_special_tokens = True
        return size

    def bytes_of_ids(self) -> list[bytes]:
        of, out = _byte_of_character(), [b""] * self.vocabulary
        for token, i in self.tokenizer.get_vocab().items():
            out[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        return out


class ModelEncoder(tokens.PieceEncoder):
    """Tokenizer B, which adds the space that each of its pieces begins with."""

    def _load(self, path: str) -> int:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        if any("▁" in self.model.id_to_piece(i).lstrip("▁") for i in range(self.model.get_piece_size())):
            raise ValueError("a piece joins a space to what stands before it, so texts can't be cut in front of spaces")
        return self.model.get_piece_size()

    def _tokenized(self, pieces: list[str]) -> list[list[int]]:
        return self.model.encode([p[1:] for p in pieces], num_threads=1)

    def bytes_of_ids(self) -> list[bytes]:
        pieces = enumerate(map(self.model.id_to_piece, range(self.vocabulary)))
        return [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]


class Vocabularies:
    """Both tokenizers, and for each of them the bytes of every id."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = PlainEncoder(a_path), ModelEncoder(b_path)
        self.a_bytes, self.b_bytes = self.a.bytes_of_ids(), self.b.bytes_of_ids()
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        if len(self.b_bytes) > 1 << B_BITS:
            raise ValueError("the piece vocabulary has too many ids for a pair's number")


_LOADED: dict[tuple[str, str], Vocabularies] = {}


def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Vocabularies(a_path, b_path)
    return _LOADED[a_path, b_path]


# --- bitsets ---------------------------------------------------------------------------------------------------------


class Bits:
    """A packed bitset with rank and select."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    @staticmethod
    def of(places: np.ndarray, n: int) -> Bits:
        marks = np.zeros(-(-n // 64) * 64, np.uint8)
        marks[places] = 1
        return Bits(np.packbits(marks, bitorder="little").view("<u8"))

    def __and__(self, other: Bits) -> Bits:
        return Bits(self.words & other.words)

    def places(self) -> np.ndarray:
        """Select: the places of all set bits."""
        return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))

    def rank(self, places: np.ndarray) -> np.ndarray:
        """The number of set bits up to each place, itself included."""
        word, bit = places >> 6, (places & 63).astype(np.uint64)
        upto = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(63) - bit)
        return self.before[word] + np.bitwise_count(self.words[word] & upto)


def groups(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The last byte of each group, and the numbers of A's and B's tokens up to it. Both sides cover the same bytes."""
    a_ends, b_ends = np.cumsum(a_sizes) - 1, np.cumsum(b_sizes) - 1
    n = int(a_ends[-1]) + 1 if len(a_ends) else 0
    a, b = Bits.of(a_ends, n), Bits.of(b_ends, n)
    cuts = (a & b).places()
    return cuts, a.rank(cuts), b.rank(cuts)


# --- links and digests of a block ------------------------------------------------------------------------------------


def _expanded(a: np.ndarray, b: np.ndarray, a_upto: np.ndarray, b_upto: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (owner, pair) keys, sorted, and their numbers of links. owner: the document of each group."""
    a_from, b_from = np.concatenate(([0], a_upto[:-1])), np.concatenate(([0], b_upto[:-1]))
    na, nb = a_upto - a_from, b_upto - b_from
    keys, times = [], []
    large = na * nb > LARGE
    for g in np.flatnonzero(large).tolist():
        ua, ta = np.unique(a[a_from[g] : a_upto[g]], return_counts=True)
        ub, tb = np.unique(b[b_from[g] : b_upto[g]], return_counts=True)
        keys.append((owner[g] << (2 * B_BITS) | ua[:, None] << B_BITS | ub).ravel())
        times.append((ta[:, None] * tb).ravel())
    small = np.flatnonzero(~large)
    batch = np.cumsum(na[small] * nb[small]) // LINKS
    for part in np.split(small, np.flatnonzero(np.diff(batch)) + 1) if len(small) else []:
        per = np.repeat(nb[part], na[part])  # links of each of A's tokens
        of = np.repeat(part, na[part])
        tokens = np.repeat(a_from[part] - (np.cumsum(na[part]) - na[part]), na[part]) + np.arange(na[part].sum())
        within = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        found = np.repeat(owner[of] << (2 * B_BITS) | a[tokens] << B_BITS, per) | b[np.repeat(b_from[of], per) + within]
        k, t = np.unique(found, return_counts=True)
        keys.append(k)
        times.append(t)
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(keys) == 1:
        return keys[0], times[0]
    k, back = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(k), np.int64)
    np.add.at(total, back, np.concatenate(times))
    return k, total


_DIGITS = 8


def _decimal(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 to n - 1, left-aligned, and their numbers."""
    text = np.array([str(i).ljust(_DIGITS, "\0") for i in range(n)], f"S{_DIGITS}")
    return np.frombuffer(text.tobytes().ljust(n * _DIGITS, b"\0"), np.uint8).reshape(n, _DIGITS).copy(), np.array([len(str(i)) for i in range(n)], np.int64)


_SHOWN: list[tuple[np.ndarray, np.ndarray]] = []


def _spelled(a: np.ndarray, b: np.ndarray, a_upto: np.ndarray, b_upto: np.ndarray, vocabulary: int) -> tuple[bytes, np.ndarray]:
    """All groups as text, each with its closing `;`, and where in that text each group ends."""
    if not _SHOWN or len(_SHOWN[0][0]) < vocabulary:
        _SHOWN[:] = [_decimal(vocabulary)]
    digits, lengths = _SHOWN[0]
    na, nb = np.diff(a_upto, prepend=0), np.diff(b_upto, prepend=0)
    ids, marks = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[np.arange(len(a)) + np.repeat(b_upto - nb, na)] = a
    ids[np.arange(len(b)) + np.repeat(a_upto, nb)] = b
    ends = a_upto + b_upto
    marks[ends - nb - 1], marks[ends - 1] = ord("|"), ord(";")
    shown = digits[ids]
    size = lengths[ids]
    shown[np.arange(len(ids)), size] = marks
    upto = np.cumsum(size + 1)
    return shown[np.arange(_DIGITS) <= size[:, None]].tobytes(), upto[ends - 1]


def segments(text: str) -> list[bytes]:
    """The text behind its space, in segments of about SEGMENT characters that each begin with a space."""
    text = " " + text
    out, at = [], 0
    while len(text) - at > SEGMENT:
        cut = _CUT.search(text, at + SEGMENT)
        if cut is None:
            break
        out.append(text[at : cut.start()].encode())
        at = cut.start()
    return [*out, text[at:].encode()]


def _batches(texts: list[str | None]):
    """Segments of the texts in batches of limited size: (index of the text, bytes) each."""
    batch, size = [], 0
    for i, text in enumerate(texts):
        for segment in segments(text) if text else ():
            if batch and size + len(segment) > BLOCK_BYTES:
                yield batch
                batch, size = [], 0
            batch.append((i, segment))
            size += len(segment)
    if batch:
        yield batch


def _spells(raw: bytes, offsets: np.ndarray, side: np.ndarray, counts: np.ndarray, of: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """For each segment, whether its tokens spell its bytes."""
    parts = [of[i] for i in side.tolist()]
    upto = np.concatenate(([0], np.cumsum(counts)))
    lengths = np.diff(np.concatenate(([0], np.cumsum(sizes[side])))[upto])
    fits = lengths == np.diff(offsets)
    if fits.all() and b"".join(parts) == raw:
        return fits
    for j in np.flatnonzero(fits).tolist():
        fits[j] = b"".join(parts[upto[j] : upto[j + 1]]) == raw[offsets[j] : offsets[j + 1]]
    return fits


def align_block(texts: list[str | None], voc: Vocabularies) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """For each text (n_a, n_b, n_groups, n_links, groups_sha256); then the distinct (text, pair) keys with their links."""
    totals = np.zeros((len(texts), 4), np.int64)
    spelled_by: dict = {}  # the digest of each text so far, None if its tokens do not spell it
    keys, times = [], []
    for batch in _batches(texts):
        owners, raw = np.array([i for i, _ in batch]), b"".join(x for _, x in batch)
        offsets = np.concatenate(([0], np.cumsum([len(x) for _, x in batch])))
        data = np.frombuffer(raw, np.uint8)
        (a, n_a), (b, n_b) = voc.a.encode(data, offsets), voc.b.encode(data, offsets)
        a, b = a.astype(np.int64), b.astype(np.int64)
        good = _spells(raw, offsets, a, n_a, voc.a_bytes, voc.a_size) & _spells(raw, offsets, b, n_b, voc.b_bytes, voc.b_size)
        if not good.all():
            a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        for i in owners[~good].tolist():
            spelled_by[i] = None
        ends = np.cumsum(np.diff(offsets)[good]) - 1
        cuts, a_upto, b_upto = groups(voc.a_size[a], voc.b_size[b])
        last = np.searchsorted(cuts, ends, side="right")  # groups up to each segment's end
        first = np.concatenate(([0], last[:-1])).astype(np.int64)
        links = np.concatenate(([0], np.cumsum(np.diff(a_upto, prepend=0) * np.diff(b_upto, prepend=0))))
        spelled, at = _spelled(a, b, a_upto, b_upto, max(len(voc.a_bytes), len(voc.b_bytes)))
        at = np.concatenate(([0], at))
        np.add.at(totals, owners[good], np.stack([n_a[good], n_b[good], last - first, links[last] - links[first]], axis=1))
        for i, f, t in zip(owners[good].tolist(), at[first].tolist(), at[last].tolist()):
            digest = spelled_by.get(i, ...)
            if digest is None:
                continue
            if digest is ...:
                digest = spelled_by[i] = hashlib.sha256()
            else:
                digest.update(b";")
            digest.update(spelled[f : t - 1])
        k, n = _expanded(a, b, a_upto, b_upto, np.repeat(owners[good], last - first))
        keys.append(k)
        times.append(n)
    out = [(*row, spelled_by[i].hexdigest()) if spelled_by.get(i) else (0, 0, 0, 0, "") for i, row in enumerate(totals.tolist())]
    if not keys:
        return out, np.zeros(0, np.int64), np.zeros(0, np.int64)
    k, n = keys[0], times[0]
    if len(keys) > 1:
        k, back = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.zeros(len(k), np.int64)
        np.add.at(n, back, np.concatenate(times))
    odd = [i for i, digest in spelled_by.items() if digest is None]
    whole = ~np.isin(k >> (2 * B_BITS), odd)
    return out, k[whole], n[whole]


# --- Spark -----------------------------------------------------------------------------------------------------------

ALIGNED = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, links binary, pairs array<long>, holders array<long>"


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row for each document, with its distinct pairs (places in its block's list) and their links. The first row of a
    block has the block's list: the pairs, and how many documents of the block hold each."""
    names = [x.split()[0] for x in ALIGNED.split(", ")]

    def run(batches):
        voc, block = vocabularies(a_path, b_path), TaskContext.get().partitionId() << 32
        for rows, _, _ in shared.text_blocks(batches, "text", BLOCK_BYTES):
            n = rows.num_rows
            found, keys, times = align_block(rows.column("text").to_pylist(), voc)
            pairs, places = np.unique(keys & ((1 << 2 * B_BITS) - 1), return_inverse=True)
            holders = np.bincount(places, minlength=len(pairs))
            upto = np.searchsorted(keys >> (2 * B_BITS), np.arange(n + 1))
            part = lambda x: [x[f:t].astype("<u4" if x is places else "<i8").tobytes() for f, t in zip(upto[:-1].tolist(), upto[1:].tolist())]
            lists = [pa.array([x.tolist(), *[None] * (n - 1)], pa.list_(pa.int64())) for x in (pairs, holders)]
            columns = list(zip(*found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block)), rows.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.string())]
                + [pa.array(part(places), pa.binary()), pa.array(part(times), pa.binary()), *lists],
                names=names,
            )
            block += 1

    return docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`text`").cast("string").alias("text")).mapInArrow(run, ALIGNED)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, n (documents that hold it linked), top (whether no pair of the same A id has more)."""
    held = blocks.where("pairs is not null").select(F.inline(F.arrays_zip("pairs", "holders")))
    counts = shared.saved(held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("holders").alias("n")), "alignment-counts")
    a = F.shiftrightunsigned("pair", B_BITS).alias("a")
    best = counts.groupBy(a).agg(F.max("n").alias("best"))
    return counts.select("pair", "n", a).join(best, "a").select("pair", "n", (F.col("n") == F.col("best")).alias("top"))


def token_alignment(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document row."""
    blocks = shared.saved(aligned(docs, a_path, b_path), "alignment-blocks")
    counts = pair_counts(blocks)
    listed = blocks.where("pairs is not null").select(F.col("block").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    looked_up = listed.join(counts, "pair").select("of", "place", "n", "top")
    own = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def summed(docs: pa.Table, counts: pa.Table) -> pa.Table:
        n, top = np.zeros(counts.num_rows, np.int64), np.zeros(counts.num_rows, np.int64)
        place = counts.column("place").to_numpy()
        n[place], top[place] = counts.column("n").to_numpy(), counts.column("top").to_numpy(zero_copy_only=False)
        sizes = pc.binary_length(docs.column("places")).to_numpy().astype(np.int64) // 4
        places = np.frombuffer(b"".join(docs.column("places").to_pylist()), "<u4")
        links = np.frombuffer(b"".join(docs.column("links").to_pylist()), "<i8")
        upto = np.concatenate(([0], np.cumsum(sizes)))
        total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[upto])
        found = docs.select(own)
        return found.append_column("n_best", pa.array(total(links * top[places]))).append_column("count_sum", pa.array(total(links * n[places]))).select([f.split()[0] for f in schema.split(", ")])

    rows = blocks.select("block", *own, "places", "links")
    return rows.groupBy("block").cogroup(looked_up.groupBy("of")).applyInArrow(summed, schema)
