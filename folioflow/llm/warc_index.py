"""WARC archives and their capture index, merged from sorted runs.

Writing: a task writes the captures of its partition to an archive of its own in
the shared folder, one gzip member per record. The archive's name is new for
each attempt and is returned as a row, so what a lost or repeated attempt left
behind is never read. A payload is written once: of captures with equal
payloads the one with the least id is a response, the others revisit it.

Reading: archives are read back record by record. Each gives a capture run,
sorted by URL key, time and id. The runs are dealt to ranges of that order, and
in each range a loser tree merges the k pieces of runs, so the ranges one after
the other are the whole capture history. Equal URL keys may fill many ranges, as
time and id are part of the order; a range holds index rows, never payloads.

Defined results: NULL html is an empty payload, NULL url an empty one and NULL time
the start of 1970; an index carries ids as whole numbers or, of any other type, as
text; of
repeated rows of the least id all are responses; captures without id never stand
for others while one with an id has the payload, and alone are responses.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from folioflow.llm.batches import raw_texts, slices
from folioflow.session import new_run_folder

VERSION = b"WARC/1.1\r\n"
READ_BYTES = 1 << 20
LEVEL = 4
INDEX = (
    "url_key STRING, captured_at STRING, page_id {ids}, payload_bytes BIGINT, payload_digest STRING, "
    "record_type STRING, refers_to {ids}, archive STRING, offset BIGINT"
)
NAMES = [part.split()[0] for part in INDEX.split(", ")]
NO_TIME = "1970-01-01T00:00:00Z"


# ---------------------------------------------------------------- records


def record(page_id, url: bytes, date: str, payload: bytes, digest: str, refers_to) -> bytes:
    """A response, or where ``refers_to`` is given a revisit without payload."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    target = re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], url)
    head = [
        b"WARC-Type: " + (b"revisit" if revisit else b"response"),
        b"WARC-Record-ID: <urn:uuid:" + str(uuid.uuid4()).encode() + b">",
        b"WARC-Target-URI: " + target,
        b"WARC-Date: " + date.encode(),
        b"WARC-Payload-Digest: sha1:" + digest.encode(),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    if page_id is not None:
        head.append(b"X-Page-Id: " + quote(str(page_id)).encode())
    if revisit:
        head.append(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(b"X-Refers-To-Page-Id: " + quote(str(refers_to)).encode())
    return VERSION + b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(stream) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of the gzip members of a file, read piece by piece."""
    offset, taken = 0, 0
    content: list[bytes] = []
    inflate = zlib.decompressobj(31)
    rest = b""
    while data := rest or stream.read(READ_BYTES):
        content.append(inflate.decompress(data))
        rest = inflate.unused_data
        taken += len(data) - len(rest)
        if inflate.eof:
            yield offset, b"".join(content)
            offset, content, inflate = taken, [], zlib.decompressobj(31)
    if content and any(content):
        raise ValueError("an archive ends within a record")


def url_key(url: str) -> str:
    """Host labels from the last to the first, then the rest, for sorting."""
    found = re.match(r"(?s).*?://([^/?#]*)(.*)", url)
    if not found:
        return url
    host, rest = found.groups()
    return ",".join(reversed(host.lower().split("."))) + ")" + (rest or "/")


def index_row(archive: str, offset: int, content: bytes, read_id=int) -> tuple:
    head, _, block = content.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    http, _, payload = block[: int(fields[b"Content-Length"])].partition(b"\r\n\r\n")
    stated = fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:")
    revisit = fields[b"WARC-Type"] == b"revisit"
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if not revisit:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest != stated or size != len(payload):
            raise ValueError(f"the record at {offset} of {archive} does not hold the payload it states")
    page = lambda name: read_id(unquote(fields[name].decode())) if name in fields else None
    return (
        url_key(fields[b"WARC-Target-URI"].decode("utf-8", "replace")), fields[b"WARC-Date"].decode(),
        page(b"X-Page-Id"), size, stated, fields[b"WARC-Type"].decode(), page(b"X-Refers-To-Page-Id"), archive, offset,
    )


# ---------------------------------------------------------------- merging


class LoserTree:
    """Merges k sorted lists: each inner node holds the loser of its match, so
    the next row costs one match for each level."""

    def __init__(self, runs: list[list], key) -> None:
        self.runs, self.key = runs, key
        self.at = [0] * len(runs)
        self.heads = [key(r[0]) if r else None for r in runs]
        self.losers = [-1] * max(1, len(runs))
        self.winner = self._play(1) if runs else -1

    def _beats(self, a: int, b: int) -> bool:
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[b] is None
        return (self.heads[a], a) < (self.heads[b], b)

    def _play(self, node: int) -> int:
        """The winner below an inner node; leaves stand from k on."""
        k = len(self.runs)
        if node >= k:
            return node - k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        if not self._beats(a, b):
            a, b = b, a
        self.losers[node] = b
        return a

    def __iter__(self):
        k = len(self.runs)
        while k and self.heads[self.winner] is not None:
            run = self.winner
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            left = self.at[run] < len(self.runs[run])
            self.heads[run] = self.key(self.runs[run][self.at[run]]) if left else None
            node = (run + k) // 2
            while node:
                if self._beats(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def order_key(row: dict) -> tuple:
    page = row["page_id"]
    return row["url_key"], row["captured_at"], page is not None, page if page is not None else 0, row["archive"], row["offset"]


# ---------------------------------------------------------------- jobs


def write_archives(captures: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(archive) of what was written from (page_id, url, html, captured_at).

    ``captured_at`` is text like 2024-01-01T00:00:00Z. Payloads of fewer than
    ``least_bytes`` bytes are always responses. Whole numbers are compared as such
    where the least id is looked for, ids of any other type as text.
    """
    spark = captures.sparkSession
    folder = new_run_folder(spark, "warc")
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = captures.select(
        F.col("page_id").cast(id_type(captures)).alias("page_id"),
        F.coalesce("url", F.lit("")).cast("binary").alias("url"),
        F.coalesce(F.col("captured_at").cast("string"), F.lit(NO_TIME)).alias("captured_at"),
        payload.alias("payload"),
    ).withColumn("sha", F.unhex(F.sha1("payload")))
    first = rows.groupBy("sha").agg(F.min("page_id").alias("first"))
    again = (F.length("payload") >= least_bytes) & ~F.coalesce(F.col("page_id") == F.col("first"), F.col("first").isNull())
    ready = rows.join(first, "sha").select(
        "page_id", "url", "captured_at", "payload", "sha", F.when(again, F.col("first")).alias("refers_to")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pa.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        name, out = f"{root}/{uuid.uuid4().hex}.warc.gz", None
        for part in slices(batches):
            ids, dates, back = (part.column(i).to_pylist() for i in (0, 2, 5))
            for row in zip(ids, raw_texts(part.column(1)), dates, raw_texts(part.column(3)), raw_texts(part.column(4)), back):
                page_id, url, date, body, sha, refers_to = row
                deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                out = out or files.open_output_stream(name, compression=None)
                digest = base64.b32encode(sha).decode()
                out.write(deflate.compress(record(page_id, url, date, body, digest, refers_to)) + deflate.flush())
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["archive"])

    ready.mapInArrow(write, "archive STRING").write.parquet(f"{folder}/written")
    return spark.read.schema("archive STRING").parquet(f"{folder}/written").withColumn("folder", F.lit(folder))


def id_type(captures: DataFrame) -> str:
    """How ids of captures stand in their index."""
    return "BIGINT" if isinstance(captures.schema["page_id"].dataType, IntegralType) else "STRING"


def capture_history(archives: DataFrame, ids: str = "BIGINT") -> DataFrame:
    """Index rows of all records, in the order of URL key, time and id.

    ``ids`` is the ``id_type`` of what was written.
    """
    schema = INDEX.format(ids=ids)
    read_id = int if ids == "BIGINT" else str
    _batch = batch_maker(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, folder in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                files, _ = pa.fs.FileSystem.from_uri(folder)
                with files.open_input_stream(archive, compression=None) as stream:
                    rows = [dict(zip(NAMES, index_row(archive, at, content, read_id))) for at, content in members(stream)]
                yield _batch(sorted(rows, key=order_key))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                runs.setdefault(row["archive"], []).append(row)
        merged: list[dict] = []
        for row in LoserTree(list(runs.values()), order_key):
            merged.append(row)
            if len(merged) == 10_000:
                yield _batch(merged)
                merged = []
        yield _batch(merged)

    order = [F.col("url_key"), F.col("captured_at"), F.col("page_id").asc_nulls_first(), F.col("archive"), F.col("offset")]
    # A task for each archive or so, whatever the few bytes of their names. The
    # runs are kept, as dealing them to ranges reads them twice.
    path = f"{new_run_folder(archives.sparkSession, 'capture-runs')}/runs"
    written = max(1, archives.count())
    archives.repartition(written).mapInArrow(read, schema).write.parquet(path)
    spark = archives.sparkSession
    runs = spark.read.schema(schema).parquet(path)
    # Each run comes sorted out of its archive; a range gets a piece of each. There
    # are as many ranges as archives, so a range does not grow with the index.
    ranges = max(written, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = runs.repartitionByRange(ranges, *order).sortWithinPartitions("archive", *order[:3], "offset")
    return dealt.mapInArrow(merge, schema)


def batch_maker(schema: str):
    kinds = {"BIGINT": pa.int64(), "STRING": pa.string()}
    arrow = pa.schema([(part.split()[0], kinds[part.split()[1]]) for part in schema.split(", ")])
    return lambda rows: pa.RecordBatch.from_pylist(rows, schema=arrow)
