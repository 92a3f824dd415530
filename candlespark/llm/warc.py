"""WARC archives with revisit records: write, read back, resolve.

Headers, not payloads, are shuffled by payload digest to find, for equal
payloads, the one that stays a response; archives are written with fresh headers, in which the others
are revisit records; what is read back is resolved by joining revisits to the
responses that they name.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlespark.llm.staging import located, scratch, staged

#: Smaller payloads are written out every time.
LEAST_BYTES = 1000
#: Archives are closed beyond so many bytes.
ARCHIVE_BYTES = 256 << 20

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITTEN = "path string, n_records long"
RECORDS = "record_id string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to_record string, url string, payload binary"
_NAMES = uuid.UUID("6f1f6d3a-5d1e-4c57-9a55-0a4b5f3f7b1c")


def record_id(page_id: int | None, url: str | None, digest: str, place: str | None = None) -> str:
    """A record's name, the same whenever the same files are read: by its place in them, but for the one response of a payload."""
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}\n{url}\n{digest}' + (f'\n{place}' if place else ''))}>"


def _digest(hexadecimal: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def _line(value: str | None) -> str:
    """A header value: line ends would begin a header of their own."""
    return (value or "").replace("\r", "%0D").replace("\n", "%0A")


def make_record(date: str, page_id: int | None, url: str | None, payload: bytes, digest: str, original: tuple[int | None, str | None] | None, place: str | None = None) -> bytes:
    """One record with fresh headers; ``original`` is the response's (page_id, url) for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if original else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if original else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, url, digest, place)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Payload-Digest: {_digest(digest)}",
        f"WARC-Block-Digest: {_digest(hashlib.sha1(block).hexdigest())}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if original:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(*original, digest)}", f"WARC-Refers-To-Target-URI: {_line(original[1])}", f"WARC-Refers-To-Date: {date}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archived(folder: str, date: str, level: int):
    """Arrow batches of pages with their originals to archives, one gzip member a record; to WRITTEN.

    Every attempt writes under names of its own; only those that it returns count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        part, out, path, size, n, done = TaskContext.get().partitionId(), None, "", 0, 0, []
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "digest", "original_id", "original_url", "revisit", "place")]
            for lo in range(0, batch.num_rows, 256):
                for page_id, url, html, digest, original_id, original_url, revisit, place in zip(*(c.slice(lo, 256).to_pylist() for c in columns), strict=True):
                    if out is None:
                        path, size, n = f"pages-{part:06d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = system.open_output_stream(f"{base}/{path}", compression=None)
                    raw = make_record(date, page_id, url, (html or "").encode(), digest, (original_id, original_url) if revisit else None, place)
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = packer.compress(raw) + packer.flush()
                    out.write(member)
                    size, n = size + len(member), n + 1
                    if size >= ARCHIVE_BYTES:
                        out.close()
                        done.append((f"{folder}/{path}", n))
                        out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{path}", n))
        if done:
            yield pa.RecordBatch.from_pydict({"path": [p for p, _ in done], "n_records": pa.array([k for _, k in done], pa.int64())})

    return run


def members(stream, piece: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of an archive, one record each; an archive that ends within one is refused."""
    inflate, out, data, within = zlib.decompressobj(31), [], b"", False
    while True:
        data = data or stream.read(piece)
        if not data:
            if within:
                raise ValueError("the archive ends within a record")
            return
        out.append(inflate.decompress(data))
        data, within = inflate.unused_data, True
        if inflate.eof:
            yield b"".join(out)
            inflate, out, within = zlib.decompressobj(31), [], False


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers in lower case, block) of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    length = int(headers["content-length"])
    if len(rest) < length:
        raise ValueError("a record shorter than it says")
    return headers, rest[:length]


def read_archives(payloads: bool):
    """Arrow batches of WRITTEN to RECORDS; without ``payloads`` that column is null.

    An archive that holds another number of records than was written is refused.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
        names = ["record_id", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to_record", "url", "payload"]

        def flushed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            for path, n_records in zip(batch.column("path").to_pylist(), batch.column("n_records").to_pylist(), strict=True):
                system, name = fs.FileSystem.from_uri(path)
                rows: list[tuple] = []
                n = 0
                with system.open_input_stream(name, compression=None) as stream:
                    for raw in members(stream):
                        n += 1
                        head, block = parse_record(raw)
                        payload = block.partition(b"\r\n\r\n")[2]
                        response = head["warc-type"] == "response"
                        told = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
                        if response and hashlib.sha1(payload).hexdigest() != told:
                            raise ValueError(f"{path}: a payload that isn't the one of its digest")
                        page = int(head["x-page-id"]) if "x-page-id" in head else None
                        rows.append((head["warc-record-id"], page, head["warc-type"], len(payload) if response else None, told, head.get("warc-refers-to"), head.get("warc-target-uri"), payload if response and payloads else None))
                        if len(rows) == (64 if payloads else 4096):
                            yield flushed(rows)
                            rows = []
                if n != n_records:
                    raise ValueError(f"{path}: {n} records, not {n_records}")
                yield flushed(rows)

    return run


def write_archives(pages: DataFrame, *, least_bytes: int = LEAST_BYTES, date: str = "2024-01-01T00:00:00Z", level: int = 1, folder: str | None = None) -> DataFrame:
    """Write a record per page; (path, n_records) of the archives.

    Of equal payloads of at least ``least_bytes`` one page is the response, that
    with the largest identifier, then URL, and the others are revisits of it,
    repeated rows too (of these the first in file order). A null html is an
    empty payload, a null identifier sorts before all others. A payload may be
    as long as a task's memory allows. Other columns are ignored. An empty table
    makes no archive.

    Headers alone are shuffled by payload digest; what they decide goes back to
    the pages by their place, so that no payload, however common, is a key.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    place = ["__doc_file", "__doc_row"]
    source = located(pages).select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html", *place)
    digest = F.sha1(payload.cast("binary")).alias("digest")
    heads = staged(source.filter(F.octet_length(payload) >= least_bytes).select("page_id", "url", *place, digest, F.octet_length(payload).alias("n_bytes")), "warc-heads")
    # the greatest is the response: known identifiers and URLs first, of repeated rows the first in file order
    by_place = F.struct("__doc_file", "__doc_row")
    own = F.struct(F.col("page_id").isNotNull().alias("has_id"), "page_id", F.col("url").isNotNull().alias("has_url"), "url")
    captures = heads.groupBy("digest", "n_bytes", own.alias("capture")).agg(F.min(by_place).alias("first"), F.count(F.lit(1)).alias("n"))
    originals = captures.groupBy("digest", "n_bytes").agg(F.max(F.struct("capture", "first")).alias("best"), F.sum("n").alias("n")).filter("n > 1")
    originals = staged(originals.select("digest", "n_bytes", "best.capture.page_id", "best.capture.url", F.col("best.first.__doc_file").alias("file"), F.col("best.first.__doc_row").alias("row")).withColumnsRenamed({"page_id": "original_id", "url": "original_url"}), "warc-originals")
    told = heads.drop("page_id", "url").join(originals, ["digest", "n_bytes"]).filter((F.col("file") != F.col("__doc_file")) | (F.col("row") != F.col("__doc_row")))
    revisits = staged(told.select(*place, "original_id", "original_url", F.lit(True).alias("revisit")), "warc-revisits")
    joined = source.join(revisits, place, "left")
    revisit = F.coalesce("revisit", F.lit(False))
    named = F.when(revisit | (F.octet_length(payload) < least_bytes), F.concat_ws("#", *place))
    ready = joined.select("page_id", "url", "html", digest, "original_id", "original_url", revisit.alias("revisit"), named.alias("place"))
    out = folder or scratch(pages.sparkSession, "warc")
    return staged(ready.mapInArrow(archived(out, date, level), WRITTEN), "warc-manifest")


def resolved(archives: DataFrame) -> DataFrame:
    """One row per record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit gets its payload's size and page from the response that it names.
    An archive that is cut short or lacks records is an error.
    """
    paths = archives.select("path", "n_records")
    found = staged(paths.repartition(max(1, paths.count()), "path").mapInArrow(read_archives(payloads=False), RECORDS).drop("payload"), "warc-records")
    named = found.filter("record_type = 'revisit'").select(F.col("refers_to_record").alias("record_id")).distinct()
    targets = found.filter("record_type = 'response'").select("record_id", "page_id", "payload_bytes").join(named, "record_id", "left_semi")
    targets = targets.groupBy("record_id").agg(F.first("page_id").alias("refers_to"), F.first("payload_bytes").alias("full_bytes"))
    revisits = found.filter("record_type = 'revisit'").join(targets.withColumnRenamed("record_id", "refers_to_record"), "refers_to_record", "left")
    responses = found.filter("record_type = 'response'")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    return responses.select(*columns, F.lit(None).cast("bigint").alias("refers_to")).unionByName(revisits.withColumn("payload_bytes", F.col("full_bytes")).select(*columns, "refers_to"))
