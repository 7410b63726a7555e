r"""WARC archives, index first.

Writing: every page becomes one record. The first page (smallest page_id) of equal payloads is written as a response
with the payload; the others as revisit records that name the first one and repeat its digest, with the HTTP header but
no payload. Records are gzip members of their own, so each can be read alone. While a task writes an archive it emits the
index: file, offset, length, URL, digest, page_id, record type.

Reading starts from the index. The selected records are sorted by file and offset; neighbours whose gap is small are
joined into byte ranges of bounded size, dealt over tasks by range, and each range is one read.

Equal payloads may be a third of all pages. The first page of each digest comes from a partial aggregate. Digests that
more than one page in 500 has are at most 500 by counting, so these travel by broadcast; the rest is joined by digest,
where pages of the hot ones are spread under keys that match nothing. Payloads are moved once.

Defined results: null html is the empty payload. Rows that repeat both page_id and payload of a first page are responses
as well: none has a smaller page_id than the others. Null urls are written as the empty target. A page without page_id is
never the first of others; without any page_id among equals, all are responses. An empty table makes no archives and no
rows. Only page_id, url and html are read, so other columns may have any name. A payload is one record, whatever its size."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from . import files, shared

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset long, length long, page_id long, url string, payload_digest string, record_type string, refers_to long"
RANGE_BYTES = 4 << 20
GAP_BYTES = 64 << 10
#: An archive ends with the record that reaches this size, so archives do not grow with the partitions.
ROLL_BYTES = 256 << 20
HOT_SHARE = 500


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def make_record(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One gzip member. refers_to: None for a response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Target-URI: {re.sub(r'[\r\n]+', ' ', url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 4, mtime=0)


def parse_record(member: bytes) -> dict:
    """The WARC and HTTP headers and the payload of a gzip member."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = re.search(rb"Content-Length: (\d+)", http)
    return {"fields": fields, "payload": payload, "payload_bytes": int(sizes[1])}


def _roles(pages: DataFrame) -> DataFrame:
    """The pages with first: the smallest page_id of equal payloads."""
    hashed = pages.withColumn("d", F.sha1(F.encode("html", "UTF-8")))
    first = shared.saved(hashed.groupBy("d").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1"), "warc-first")
    total = pages.count()
    hot = first.where(F.col("n") * HOT_SHARE > total).select("d", F.col("first").alias("hot"))  # at most HOT_SHARE rows
    marked = hashed.join(F.broadcast(hot), "d", "left")
    key = F.when(F.col("hot").isNull(), F.col("d")).otherwise(F.concat(F.lit("hot "), F.xxhash64("page_id", "url").cast("string")))
    cold = first.where(F.col("n") * HOT_SHARE <= total).select(F.col("d").alias("key"), F.col("first").alias("cold"))
    joined = marked.withColumn("key", key).join(cold, "key", "left")
    return joined.select("page_id", "url", "html", F.coalesce("hot", "cold").alias("first"))


def write_archives(pages: DataFrame, folder: str, roll: int = ROLL_BYTES) -> DataFrame:
    """Write archives of `roll` bytes or a record more, and return the index, read back from its table. Ids stay whole numbers of
    64 bits on their way through the tasks."""
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]):
        task, archives = TaskContext.get().partitionId(), 0
        out, name, at = None, None, 0
        for pages in batches:
            rows = []
            for page in pages.to_pylist():
                if out is None:
                    name, at = f"{folder}/pages-{task:06d}-{archives:04d}.warc.gz", 0
                    out = files.Replacing(name)
                    archives += 1
                page_id, first, payload = page["page_id"], page["first"], page["html"].encode()
                refers = None if first is None or first == page_id else first
                digest = digest_of(payload)
                data = make_record(page_id, page["url"], payload, digest, refers)
                out.stream.write(data)
                rows.append((name, at, len(data), page_id, page["url"], digest, "response" if refers is None else "revisit", refers))
                at += len(data)
                if at >= roll:
                    out.finish()
                    out = None
            if rows:
                yield shared.columns_to_batch(schema, *zip(*rows))
        if out is not None:
            out.finish()

    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    # the order in an archive is that of its rows, whatever order they arrive in, so a task that runs again writes the same file
    ordered = _roles(pages).sortWithinPartitions("page_id", "url", F.xxhash64("html"))
    return shared.saved(ordered.mapInArrow(write, INDEX), "warc-index")


def byte_ranges(index: DataFrame) -> DataFrame:
    """Ranges to read: file, start, size, and the places of their records. Neighbours by offset are joined until a gap
    or a full range; the running number of bytes, cut into steps, bounds a range."""
    order = Window.partitionBy("file").orderBy("offset")
    gap = F.col("offset") - F.lag(F.col("offset") + F.col("length"), 1, 0).over(order)
    marked = index.select("file", "offset", "length").withColumn("jump", (gap > GAP_BYTES).cast("long"))
    marked = marked.withColumn("island", F.sum("jump").over(order)).withColumn("step", F.floor(F.col("offset") / RANGE_BYTES))
    return marked.groupBy("file", "island", "step").agg(
        F.min("offset").alias("start"),
        (F.max(F.col("offset") + F.col("length")) - F.min("offset")).alias("size"),
        F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("places"),  # no more than RANGE_BYTES hold
    )


def read_archives(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records that the index names, from the archives: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, and payload if asked for (null for revisits)."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
    out = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if with_payload:
        schema, out = schema.append(pa.field("payload", pa.binary())), out + ", payload binary"

    def number(text: str):
        digits = text.removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    def read(batches: Iterator[pa.RecordBatch]):
        for ranges in batches:
            for wanted in ranges.to_pylist():
                file, start = wanted["file"], wanted["start"]
                with files.opened(file) as stream:
                    stream.seek(start)
                    data = stream.read(wanted["size"])
                rows = []
                for place in wanted["places"]:
                    at = place["offset"] - start
                    r = parse_record(data[at : at + place["length"]])
                    f, revisit = r["fields"], r["fields"]["WARC-Type"] == "revisit"
                    digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and (len(r["payload"]) != r["payload_bytes"] or digest_of(r["payload"]) != digest):
                        raise ValueError(f"damaged record at {place['offset']} of {file}")
                    row = (number(f["WARC-Record-ID"]), f["WARC-Target-URI"], r["payload_bytes"], digest, f["WARC-Type"], number(f["WARC-Refers-To"]) if revisit else None)
                    rows.append((*row, None if revisit else r["payload"]) if with_payload else row)
                yield shared.columns_to_batch(schema, *zip(*rows))

    ranges = byte_ranges(index)
    return ranges.repartition(shared.parts_for(index, 1 << 20), "file", "start").mapInArrow(read, out)
