"""WARC archives of pages: one gzip member per record, written and read by Spark tasks.

Payloads of at least ``min_bytes`` bytes that are equal are stored once: the page with the smallest
page_id has a response record, the others a revisit record that names it. Each task writes archives of
bounded size to a folder all executors share; a file appears under its name only when complete, and a
repeated task writes the same names again. Reading is sequential: compressed blocks go through an
incremental zlib decompressor, each record is framed by its Content-Length, must end where its gzip
member ends, and its digests are verified. A damaged archive raises an error that names the file.

Null html is an empty payload; null url has no target header. Rows of one page_id that hold the
smallest id of their payload are all responses. A null page_id never stands for others; if all pages
of a payload have none, each is a response. An empty table writes no archive.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomart.llm.stages import stored
from foliomart.session import scratch_path

ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 16
MIN_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages have no fetch time; archives must not differ between reruns


def record(kind: str, page, url: str | None, payload: bytes, digest: str, refers_to=None) -> bytes:
    """The bytes of one record before compression. A revisit keeps the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if kind == "revisit" else head + payload
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:x-page:{'' if page is None else page}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:x-page:{refers_to}>")]
    fields.append(("Content-Length", str(len(block))))
    return "".join(["WARC/1.1\r\n", *[f"{k}: {v}\r\n" for k, v in fields], "\r\n"]).encode() + block + b"\r\n\r\n"


def compressed(data: bytes, level: int = 4) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def records(stream, name: str = "archive") -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a compressed archive, verified."""
    waiting, member = b"", 0

    def bad(why: str) -> ValueError:
        return ValueError(f"{name}, record {member}: {why}")

    while True:
        waiting = waiting or stream.read(READ_BYTES)
        if not waiting:
            return
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            if not waiting:
                waiting = stream.read(READ_BYTES)
                if not waiting:
                    raise bad("the archive ends inside a record")
            try:
                parts.append(z.decompress(waiting))
            except zlib.error as error:
                raise bad(str(error)) from error
            waiting = z.unused_data
        data = b"".join(parts)
        end = data.find(b"\r\n\r\n")
        lines = data[:end].decode().split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise bad("no record header")
        headers = {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines[1:])}
        size = int(headers["content-length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) != size or data[end + 4 + size :] != b"\r\n\r\n":
            raise bad("the content length does not fit the record")
        if headers.get("warc-block-digest") != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise bad("the block's digest differs")
        if headers["warc-type"] == "response":
            payload = block[block.index(b"\r\n\r\n") + 4 :]
            if headers["warc-payload-digest"] != f"sha256:{hashlib.sha256(payload).hexdigest()}":
                raise bad("the payload's digest differs")
        yield headers, block
        member += 1


def planned(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, html with digest and the page that stands for an equal payload (``stands``).

    Equal payloads are counted on digests before the shuffle; only digests held twice are joined, and
    the pages' side of that join is a plain exchange, so one payload in a third of all rows is split.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha2("html", 256))
    held = (
        rows.where(F.octet_length("html") >= min_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("stands"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    held = stored(held, "equal-payloads")
    return rows.join(held, "digest", "left")


def write(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write archives into ``folder``; (path, records, bytes) of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        task, out, count, size, number = TaskContext.get(), None, 0, 0, 0

        def closed():
            out.close()
            # the attempt tells apart what a second attempt of the task writes, perhaps in another order
            path = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{number:04d}.warc.gz"
            system.move(f"{root}/{temporary}", f"{root}/{path}")
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{path}"], "records": [count], "bytes": [size]})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    temporary = f"_open-{task.taskAttemptId()}-{number}"
                    out, count, size = system.open_output_stream(f"{root}/{temporary}"), 0, 0
                again = row["stands"] is not None and row["stands"] != row["page_id"]
                kind = "revisit" if again else "response"
                raw = compressed(record(kind, row["page_id"], row["url"], row["html"].encode(), row["digest"], row["stands"]))
                out.write(raw)
                count, size = count + 1, size + len(raw)
                if size >= archive_bytes:
                    yield closed()
                    out, number = None, number + 1
        if out is not None:
            yield closed()

    return planned(pages, min_bytes).mapInArrow(run, "path string, records long, bytes long")


def read(archives: DataFrame) -> DataFrame:
    """The records of the archives in column ``path``: what their headers and verified payloads say."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, name = fs.FileSystem.from_uri(path)
                rows = []
                with system.open_input_stream(name, compression=None) as stream:
                    for headers, block in records(stream, path):
                        head = block[: block.index(b"\r\n\r\n")].decode().lower()
                        size = int(head.split("content-length:", 1)[1].split("\r\n", 1)[0])
                        rows.append(
                            {
                                "page_id": _page(headers["warc-record-id"]),
                                "url": headers.get("warc-target-uri"),
                                "payload_bytes": size,
                                "payload_digest": headers["warc-payload-digest"].removeprefix("sha256:"),
                                "record_type": headers["warc-type"],
                                "refers_to": _page(headers.get("warc-refers-to")),
                            }
                        )
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_pylist(rows, _ROW)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, _ROW)

    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("path").repartition(n, "path").mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


_ROW = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()),
    ]
)


def _page(uri: str | None) -> int | None:
    text = (uri or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(text) if text and text != "None" else None


def round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write all pages to a new folder of the shared space and read the archives back."""
    spark = pages.sparkSession
    made = stored(write(pages, scratch_path(spark, "warc"), min_bytes), "archives")
    return read(made)
