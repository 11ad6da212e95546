"""WARC archives as tables of record chunks.

A record's payload is cut into chunks of bounded size. Each chunk is a row (record
identifier, chunk number, bytes) and becomes a WARC segment of its own: the first is the
record, the others are ``continuation`` records. Digests are carried from chunk to chunk,
and the last segment states length and digest of the whole. Spark's text writer stores the
segments, gzip-compressed, so executors write to whatever file system the path names.
Reading streams the lines of an archive through a parser with one chunk in memory.

Of records with equal payloads of at least ``min_bytes``, that with the largest id is
written with its payload; the others are ``revisit`` records without one, which name it
and its digest.

* A null payload is empty; empty payloads are ``response`` records without bytes.
* Null ids are kept: a record without id can be a revisit, and is never referred to unless
  its whole group has no id, in which case all of them are responses. Rows that repeat the
  group's largest id are all responses.
* Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

CHUNK_BYTES = 1 << 20
MIN_REVISIT = 1000
NO_ID = "none"

SEGMENTS = T.StructType([T.StructField("value", T.BinaryType())])
CHUNKS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("chunk_no", T.LongType()),
        T.StructField("chunk", T.BinaryType()),
        T.StructField("last", T.BooleanType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
    ]
)


def plan_records(pages: DataFrame, record_id: str = "page_id", uri: str = "url", payload: str = "html", min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Each page with its record type and, for a revisit, the record it refers to.

    Digests of payloads are counted per group with map-side combining; the join back is on
    the digest, where adaptive execution can split a group that holds much of the table. The
    hashed side has one narrow row per payload that several records share, so payloads need
    no sort.
    """
    rows = pages.select(
        F.col(record_id).cast("string").alias("record_id"),
        F.col(record_id).alias("_order"),
        F.regexp_replace(F.col(uri), "[\\r\\n]", "").alias("target_uri"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"").cast("binary")).alias("payload"),
    )
    rows = rows.withColumn("_digest", F.sha1("payload")).withColumn("_bytes", F.length("payload"))
    groups = rows.where(F.col("_bytes") >= min_bytes).groupBy("_digest").agg(F.max("_order").alias("_first"), F.count("*").alias("_n"))
    shared = groups.where("_n > 1 and _first is not null").select(F.col("_digest").alias("_shared"), "_first")
    joined = rows.join(shared.hint("shuffle_hash"), F.col("_digest") == F.col("_shared"), "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_order").eqNullSafe(F.col("_first"))
    return joined.select(
        "record_id",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.when(revisit, F.col("_first").cast("string")).alias("refers_to"),
        F.when(revisit, F.lit(b"").cast("binary")).otherwise(F.col("payload")).alias("payload"),
        F.when(revisit, F.col("_digest")).alias("known_digest"),
        F.when(revisit, F.col("_bytes").cast("long")).alias("known_bytes"),
    )


def chunk_rows(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of planned records: one row per chunk, digest and length so far in each.

    Chunks of a record follow one another in one partition. A batch handed on holds about
    one chunk's bytes; the payload is only sliced, never copied whole.
    """
    schema = to_arrow_schema(CHUNKS)

    def run(batches):
        for batch in batches:
            names = ("record_id", "record_type", "target_uri", "refers_to", "known_digest", "known_bytes")
            columns = [batch.column(n).to_pylist() for n in names]
            payloads = batch.column("payload")
            rows, held = [], 0
            for i, (record, kind, uri, refers, digest, size) in enumerate(zip(*columns, strict=True)):
                view = memoryview(payloads[i].as_buffer() or b"")
                running = hashlib.sha1()
                for no in range(max(1, -(-len(view) // chunk_bytes))):
                    piece = view[no * chunk_bytes : (no + 1) * chunk_bytes]
                    running.update(piece)
                    done = min(len(view), (no + 1) * chunk_bytes)
                    last = done == len(view)
                    told = (size, digest) if kind == "revisit" else (done, running.hexdigest())
                    rows.append((record, kind, uri, refers, no, bytes(piece), last, *told))
                    held += len(piece)
                    if held >= chunk_bytes:
                        yield _batch(rows, schema)
                        rows, held = [], 0
            if rows:
                yield _batch(rows, schema)

    return records.mapInArrow(run, CHUNKS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _segment(record, kind, uri, refers, no, chunk, last, size, digest) -> bytes:
    name = NO_ID if record is None else record
    head = ["WARC/1.1", f"WARC-Type: {'continuation' if no else kind}", f"WARC-Record-ID: <urn:record:{name}{f':{no}' if no else ''}>"]
    if no:
        head.append(f"WARC-Segment-Origin-ID: <urn:record:{name}>")
    if no or not last:
        head.append(f"WARC-Segment-Number: {no + 1}")
    if no and last:
        head.append(f"WARC-Segment-Total-Length: {size}")
    if uri is not None and not no:
        head.append(f"WARC-Target-URI: {uri}")
    if refers is not None:
        head.append(f"WARC-Refers-To: <urn:record:{refers}>")
    if last:
        head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {size}"]
    head += ["Content-Type: application/octet-stream", f"Content-Length: {len(chunk)}"]
    return b"\r\n".join([*(h.encode() for h in head), b"", b""]) + chunk + b"\r\n\r"


def write(chunks: DataFrame, path: str) -> None:
    """Store a chunk table as gzip-compressed archives, one a partition; a line end closes each segment."""

    def run(batches):
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([_segment(*r) for r in rows], pa.binary())], names=["value"])

    segments = chunks.mapInArrow(run, SEGMENTS)
    segments.select(F.col("value").cast("string")).write.option("lineSep", "\n").option("compression", "gzip").text(path)


class Parser:
    """Reads segments from bytes fed in order; hands out pieces of a record's payload."""

    def __init__(self):
        self.buffer = bytearray()
        self.head: dict[str, str] | None = None
        self.left = 0

    def feed(self, data: bytes) -> Iterator[tuple[dict[str, str], bytes, bool]]:
        """(headers, bytes, whether the segment ends) as far as the bytes so far allow."""
        self.buffer += data
        while True:
            if self.head is None:
                between = 0  # the two line ends after the block before
                while self.buffer[between : between + 1] in (b"\r", b"\n"):
                    between += 1
                del self.buffer[:between]
                end = self.buffer.find(b"\r\n\r\n")
                if end < 0:
                    return
                lines = bytes(self.buffer[:end]).decode("utf-8", "replace").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
                self.head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
                self.left = int(self.head["content-length"])
                del self.buffer[: end + 4]
            if self.left and not self.buffer:
                return
            piece = bytes(self.buffer[: self.left])
            del self.buffer[: self.left]
            self.left -= len(piece)
            yield self.head, piece, not self.left
            if self.left:
                return
            self.head = None


RECORDS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("segments", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
    ]
)


def _urn(text: str | None) -> str | None:
    name = text[len("<urn:record:") : -1] if text else None
    return None if name == NO_ID else name


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Archive lines in file order; a compressed file is never split."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("value").cast("binary").alias("line"), F.input_file_name().alias("file"))


def _streamed(batches) -> Iterator[tuple[dict[str, str], bytes, bool]]:
    parser, file = Parser(), None
    for batch in batches:
        for line, name in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            if name != file:
                parser, file = Parser(), name
            yield from parser.feed(line.as_py() + b"\n")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: length and digest of the whole payload, carried over its segments.

    A stored digest or length that the bytes do not have stops the job. A revisit has those
    of the payload it refers to.
    """
    schema = to_arrow_schema(RECORDS)

    def run(batches):
        rows, running, size, count, first = [], hashlib.sha1(), 0, 0, None
        for head, piece, ended in _streamed(batches):
            if head["warc-type"] != "continuation" and head is not first:
                running, size, count, first = hashlib.sha1(), 0, 0, head
            running.update(piece)
            size += len(piece)
            count += ended
            if ended and "warc-payload-digest" in head:
                digest, length = head["warc-payload-digest"].removeprefix("sha1:"), int(head["warc-payload-length"])
                if first["warc-type"] != "revisit" and (digest, length) != (running.hexdigest(), size):
                    raise ValueError(f"record {first['warc-record-id']} does not have its digest")
                rows.append((_urn(first["warc-record-id"]), first["warc-type"], first.get("warc-target-uri"), _urn(first.get("warc-refers-to")), count, length, digest))
            if len(rows) >= 4096:
                yield _batch(rows, schema)
                rows = []
        if rows:
            yield _batch(rows, schema)

    return _lines(spark, path).mapInArrow(run, RECORDS)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of archives: (record_id, chunk_no, chunk), a row per segment."""
    schema = T.StructType([CHUNKS["record_id"], CHUNKS["chunk_no"], CHUNKS["chunk"]])
    arrow = to_arrow_schema(schema)

    def run(batches):
        held: list[bytes] = []
        for head, piece, ended in _streamed(batches):
            held.append(piece)
            if ended:
                origin = head.get("warc-segment-origin-id", head["warc-record-id"])
                yield _batch([(_urn(origin), int(head.get("warc-segment-number", "1")) - 1, b"".join(held))], arrow)
                held = []

    return _lines(spark, path).mapInArrow(run, schema)
