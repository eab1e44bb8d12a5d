"""WARC archives: a writer with revisit records and a splittable reader.

Each record is a gzip member of its own. A reading task gets byte ranges, scans each for the gzip magic,
takes a place for a member only if its beginning decodes to a WARC version line, and owns the records
that begin inside its range, reading past the end of the range for the last. Members follow one another
without gaps: each reader also looks whether one begins where its last record ends, so a damaged or
lost member is an error wherever it lies. Files are reached through pyarrow's file systems, so the
archives may be wherever the shared folder is.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkgraph.llm.common import cut, remove, saved, scratch, small_batches

MAGIC = b"\x1f\x8b\x08"
#: Payloads of fewer bytes are always stored.
LEAST_REVISIT = 100
SPLIT_BYTES = 4 << 20
#: Splits of about so many bytes go to a task, where there are more splits than cores.
TASK_BYTES = 64 << 20
#: Bytes read at a time past a range's end, and inflated at a time.
STEP = 1 << 18
DATE = "2024-01-01T00:00:00Z"


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else f"file://{uri}")


def clean(value: object) -> str:
    """A header's value; line ends are escaped."""
    return str(value).replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def plain(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A gzip member with one record. A revisit has no payload, but its digest and length."""
    revisit = refers_to is not None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}|{digest}')}>", f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {clean(url)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-Id: {refers_to}"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record's bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = {k.lower(): plain(v.strip()) for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2] if headers.get("content-type", "").startswith("application/http") else block


def with_first(pages: DataFrame, id_col: str, body_col: str) -> DataFrame:
    """id, url, body (null: empty) and digest of each page, and _first: the page that it revisits.

    Only digests are grouped and joined; bodies move once, and not at all where the revisits are few
    enough for Spark to broadcast. A page without id can revisit but isn't revisited.
    """
    rows = pages.select(F.col(id_col).alias("_id"), F.col("url").cast("string").alias("_url") if "url" in pages.columns else F.lit(None).cast("string").alias("_url"), F.encode(F.coalesce(F.col(body_col).cast("string"), F.lit("")), "utf-8").alias("_body")).withColumn("_sha", F.sha2("_body", 256))
    large = rows.filter(F.length("_body") >= LEAST_REVISIT).select("_id", "_sha")
    first = large.groupBy("_sha").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1 and _first is not null").select("_sha", "_first")
    revisits = large.join(first, "_sha").filter(~F.col("_id").eqNullSafe(F.col("_first"))).distinct().select(F.col("_sha").alias("_s"), F.col("_id").alias("_i"), "_first")
    return rows.join(revisits, (F.col("_sha") == F.col("_s")) & F.col("_id").eqNullSafe(F.col("_i")), "left").select("_id", "_url", "_body", "_sha", "_first")


def write(pages: DataFrame, path: str, id_col: str = "page_id", body_col: str = "html") -> DataFrame:
    """Archives of all pages below path, a file for each task; returns their names, bytes and records, kept in the shared folder.

    Each attempt of a task has a file name of its own, so one that is lost or repeated leaves at most
    a file that the manifest doesn't list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get()
        fs, folder = file_system(path)
        fs.create_dir(folder, recursive=True)
        name = f"{folder}/part-{at.partitionId():05d}-{at.taskAttemptId()}.warc.gz"
        n = size = 0
        with fs.open_output_stream(name, compression=None) as f:
            for b in batches:
                for i, url, body, sha, first in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                    member = record(i, url, body, sha, first)
                    f.write(member)
                    n, size = n + 1, size + len(member)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], names=["file", "bytes", "records"])

    small_batches(pages.sparkSession)
    return cut(with_first(pages, id_col, body_col).mapInArrow(run, "file string, bytes long, records long")).filter("records > 0")


class Window:
    """The bytes of a file from start on, read as they are asked for."""

    def __init__(self, f: pa.NativeFile, start: int, size: int) -> None:
        self.f, self.start, self.size, self.data = f, start, size, bytearray()

    def fill(self, upto: int) -> bool:
        """Whether byte upto (of the file) is there."""
        while self.start + len(self.data) <= upto:
            at = self.start + len(self.data)
            got = self.f.read_at(min(STEP, self.size - at), at) if at < self.size else b""
            if not got:
                return False
            self.data += got
        return True

    def drop(self, upto: int) -> None:
        if upto - self.start > STEP:
            del self.data[: upto - self.start]
            self.start = upto


def member_at(w: Window, at: int) -> tuple[bytes, int] | None:
    """The record in the member at that place and the place after it; None if no WARC member begins there. A member that begins and doesn't decode is an error."""
    z, out, pos = zlib.decompressobj(31), bytearray(), at
    try:
        while not z.eof:
            if not w.fill(pos):
                if out.startswith(b"WARC/1"):
                    raise ValueError(f"the record at byte {at} is cut off")
                return None
            chunk = bytes(w.data[pos - w.start : pos - w.start + (1024 if pos == at else STEP)])
            out += z.decompress(chunk)
            pos += len(chunk)
            if len(out) >= 6 and not out.startswith(b"WARC/1"):
                return None
    except zlib.error as e:
        if out.startswith(b"WARC/1"):
            raise ValueError(f"the record at byte {at} is damaged: {e}") from e
        return None
    return (bytes(out), pos - len(z.unused_data)) if out.startswith(b"WARC/1") else None


def begins_at(w: Window, at: int) -> bool:
    """Whether a WARC member begins there, by its first bytes."""
    w.fill(min(at + 1024, w.size) - 1)
    try:
        return zlib.decompressobj(31).decompress(bytes(w.data[at - w.start : at - w.start + 1024]), 6).startswith(b"WARC/1")
    except zlib.error:
        return False


def records_in(f: pa.NativeFile, start: int, end: int, size: int, strict: bool = True) -> Iterator[bytes]:
    """The records that begin in the file from start to before end. If strict, bytes that belong to no record are an error; else they and damaged records are passed over."""
    w, at = Window(f, start, size), start
    due = 0 if start == 0 else None  # where a record must begin, once that is known
    w.fill(min(end, size) - 1)
    while at < end:
        w.fill(min(at + STEP, size) - 1)
        k = w.data.find(MAGIC, at - w.start)
        if k < 0:
            at = max(at, w.start + len(w.data) - 2)
            if not w.fill(w.start + len(w.data)):
                at = end
            if not strict or due is None or at <= due:
                continue
        else:
            at = w.start + k
        if strict and due is not None and at > due:
            raise ValueError(f"no record begins at byte {due}, where the one before it ends")
        if k < 0 or at >= end:
            return
        try:
            got = member_at(w, at)
        except ValueError:
            if strict:
                raise
            got = None
        if got is None:
            at += 1
        else:
            yield got[0]
            due = at = got[1]
        w.drop(at)
    if strict and due is not None and end <= due < size and not begins_at(w, due):
        raise ValueError(f"no record begins at byte {due}, where the one before it ends")


def read(manifest: DataFrame, digests: bool = False, split_bytes: int = SPLIT_BYTES, strict: bool = True) -> DataFrame:
    """The records of the archives that manifest lists (file, bytes), by ranges of split_bytes, dealt out evenly to tasks.

    page_id, url, record_type, refers_to, payload_bytes and payload_digest; and payload (null for
    revisits) unless digests is set. A response's length and digest are taken from its payload, and
    must be those in its header; a revisit's are of the payload that it stands for. A damaged, cut off
    or lost record is an error that names its place; with strict=False such records are passed over,
    to be counted against the manifest's `records`.
    """
    last = "" if digests else ", payload binary"
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", *([] if digests else ["payload"])]
    schema = pa.schema([pa.field(n, t) for n, t in zip(names, [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()], strict=False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, start, size in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                rows, held = [], 0
                with file_system(name)[0].open_input_file(name.partition("://")[2] or name) as f:
                    for data in records_in(f, start, min(start + split_bytes, size), size, strict):
                        h, payload = parse(data)
                        sha, kind = h["warc-payload-digest"].removeprefix("sha256:"), h["warc-type"]
                        if kind == "response" and (hashlib.sha256(payload).hexdigest() != sha or len(payload) != int(h["x-payload-length"])):
                            raise ValueError(f"{name}: a payload differs from its digest")
                        row = [int(h["x-page-id"]) if "x-page-id" in h else None, h.get("warc-target-uri"), kind, int(h["x-refers-to-page-id"]) if kind == "revisit" else None, int(h["x-payload-length"]), sha]
                        rows.append(row if digests else [*row, payload if kind == "response" else None])
                        held += len(data)
                        if len(rows) >= 5000 or not digests and held > 1 << 23:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    start: Column = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long")))
    total, n = manifest.filter("bytes > 0").agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum(F.ceil(F.col("bytes") / split_bytes)), F.lit(0))).first()
    # A number of its own, which adaptive execution leaves alone: the rows that name the splits are tiny, the splits are not.
    tasks = max(1, -(-total // TASK_BYTES), min(n, 4 * manifest.sparkSession.sparkContext.defaultParallelism))
    splits = manifest.filter("bytes > 0").select("file", start.alias("start"), "bytes").repartition(tasks)
    return splits.mapInArrow(run, f"page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string{last}")


def round_trip(pages: DataFrame, id_col: str = "page_id", body_col: str = "html") -> DataFrame:
    """What reading gives back after writing all pages; one row per row of pages. The archives are removed once they have been read."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    written = write(pages, path, id_col, body_col)
    out = saved(read(written, digests=True), scratch(spark, "warc-records"))
    remove(spark, path)
    if (want := written.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]) != (got := out.count()):
        raise ValueError(f"{want} records were written and {got} read")
    return out
