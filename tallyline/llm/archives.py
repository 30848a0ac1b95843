"""Conversion of legacy ARC archives to WARC.

An ARC file is a version block and then records, each with one header line and as many
bytes as the line declares. Version 1 lines have five fields and version 2 lines ten; the
length is the last field of either, and the version block says which holds. Nothing is
searched for in bodies: the declared length leads to the next header line.

A WARC record is made for each ARC record: its type from the header, its identifier from
what the record holds, its date from the 14 digits, and SHA-256 digests of block and
payload. Of responses with equal payloads one stays, and the others become revisits that
refer to it. Archives are written by Spark's text writer, one file of gzipped records per
task, so that a lost task is written anew and half-written files never show.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.storing import stored
from tallyline.sources.workspace import new_path

# Fields of the header lines by version, as the version blocks declare them.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
# Records of an archive, and bytes of its records, after which a new file begins. A file is a
# row of the writer and one of the reader, so a task's memory is a few times its bytes.
RECORDS = 4096
FILE_BYTES = 1 << 24
# Payloads of fewer bytes are stored as they are.
LEAST_REVISIT = 100
# Bytes of records that a task hands to Spark at once.
RUN_BYTES = 1 << 22
DATE = "20240101000000"
# Half the time of the default level, and files an eighth larger.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
PAGE_HEADER = "X-Page-Id"

ARC_RECORD = (
    "archive string, offset long, record_id string, warc_type string, uri string, ip string, date string, "
    "media_type string, page_id long, payload_bytes long, payload_digest string, block binary"
)
WARC_RECORD = (
    "archive string, offset long, record_id string, record_type string, uri string, date string, page_id long, "
    "payload_bytes long, payload_digest string, refers_to_id string"
)


def _field(value: str | None, default: str) -> str:
    """A header field: no white space, never empty."""
    kept = "".join(f"%{ord(c):02X}" if c.isspace() or ord(c) < 32 else c for c in value or "")
    return kept or default


def version_block(version: int, name: str, date: str = DATE) -> str:
    body = f"{version} 0 tallyline\n{FIELDS[version]}\n"
    head = [f"filedesc://{name}", "0.0.0.0", date, "text/plain"]
    if version == 2:
        head += ["200", "-", "-", "0", name]
    return " ".join([*head, str(len(body))]) + "\n" + body


def _arc_files(records: int, file_bytes: int):
    """The contents of files, each of a version block and the records after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        version, files = 1 + task % 2, 0
        out, held = [], 0
        for batch in batches:
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not out:
                    out.append(version_block(version, f"pages-{task}-{files}.arc"))
                payload = html or ""
                size = len(payload.encode())
                lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {size}"]
                if page_id is not None:
                    lines.append(f"{PAGE_HEADER}: {page_id}")
                http = "\r\n".join(lines) + "\r\n\r\n"
                head = [_field(url, "unknown:"), "0.0.0.0", DATE, "text/html"]
                if version == 2:
                    head += ["200", "-", "-", "0", f"pages-{task}-{files}.arc"]
                out.append(" ".join([*head, str(len(http.encode()) + size)]) + "\n" + http + payload)
                held += size
                if len(out) > records or held >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array(["\n".join(out)], pa.string())], names=["value"])
                    out, held, files = [], 0, files + 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(["\n".join(out)], pa.string())], names=["value"])

    return run


def write_arc(pages: DataFrame, path: str, records: int = RECORDS, file_bytes: int = FILE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as ARC files of either version, a version per task.

    A file is full after ``records`` records or ``file_bytes`` bytes of payloads; a larger page
    has a file of its own or ends one.
    """
    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    files = rows.mapInArrow(_arc_files(records, file_bytes), "value string")
    files.write.option("lineSep", "\n").options(**GZIP).option("maxRecordsPerFile", 1).text(path)


def _opened(content: bytes):
    plain = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=plain)) if content[:2] == b"\x1f\x8b" else io.BufferedReader(plain)


def _exactly(file, n: int, archive: str) -> bytes:
    data = file.read(n)
    if len(data) < n:
        raise ValueError(f"{archive}: a record of {n} bytes ends after {len(data)}")
    return data


def arc_records(archive: str, content: bytes) -> Iterator[dict]:
    """Records of an ARC file: the fields of their header lines, offset and block."""
    file, at, fields = _opened(content), 0, None
    while line := file.readline():
        offset, at = at, at + len(line)
        head = line.decode("utf-8", errors="replace").rstrip("\r\n")
        if not head:
            continue
        if fields is None:
            size = int(head.rsplit(" ", 1)[1])
            block = _exactly(file, size, archive)
            version = int(block.split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"{archive}: version {version} is not known")
            fields = FIELDS[version].split(" ")
            values = head.rsplit(" ", len(head.split(" ")) - 1)
            found = dict(zip(("URL", "IP-address", "Archive-date", "Content-type"), values, strict=False))
        else:
            values = head.rsplit(" ", len(fields) - 1)
            if len(values) != len(fields):
                raise ValueError(f"{archive}: the header line at {offset} has {len(values)} fields")
            found = dict(zip(fields, values, strict=True))
            block = _exactly(file, int(found["Archive-length"]), archive)
        at += len(block)
        yield found | {"offset": offset, "block": block}


def http_parts(block: bytes) -> tuple[dict[str, str], bytes] | None:
    """Header fields in lower case and payload of an HTTP response; None of anything else."""
    if not block.startswith(b"HTTP/"):
        return None
    head, mark, payload = block.partition(b"\r\n\r\n")
    if not mark:
        return None
    lines = head.decode("utf-8", errors="replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, payload


def _record_id(*parts: bytes) -> str:
    digest = hashlib.sha256(b"\0".join(parts)).digest()
    return f"urn:uuid:{uuid.UUID(bytes=digest[:16], version=5)}"


def synthesised(archive: str, found: dict) -> dict:
    """The WARC fields of an ARC record."""
    block, uri = found["block"], found["URL"]
    date = found["Archive-date"][:14].ljust(14, "0")
    parts = http_parts(block)
    if uri.startswith("filedesc://"):
        kind, media_type, headers, payload = "warcinfo", "application/warc-fields", {}, block
    elif parts:
        kind, media_type, (headers, payload) = "response", "application/http;msgtype=response", parts
    else:
        kind, media_type, headers, payload = "resource", found["Content-type"], {}, block
    page = headers.get(PAGE_HEADER.lower())
    return {
        "archive": archive,
        "offset": found["offset"],
        "record_id": _record_id(uri.encode(), date.encode(), block),
        "warc_type": kind,
        "uri": uri,
        "ip": found["IP-address"],
        "date": f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:]}Z",
        "media_type": media_type,
        "page_id": int(page) if page else None,
        "payload_bytes": len(payload),
        "payload_digest": hashlib.sha256(payload).hexdigest(),
        "block": block,
    }


def _batched(rows: Iterator[dict], schema: pa.Schema, weight: str | None) -> Iterator[pa.RecordBatch]:
    out, held = [], 0
    for row in rows:
        out.append({k: row[k] for k in schema.names})
        held += len(row[weight]) if weight else 0
        if held >= RUN_BYTES or len(out) >= RECORDS:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(n, _TYPES[t]) for n, t in (x.split() for x in ddl.split(", "))])


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            yield path.as_py(), content.as_py()


def _parse_arc(ddl: str):
    schema = _arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (synthesised(p, x) for p, content in _files(batches) for x in arc_records(p, content))
        return _batched(rows, schema, "block" if "block" in schema.names else None)

    return run


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_arc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """The records of all ARC files below ``path`` with the WARC fields made for them."""
    ddl = ARC_RECORD if blocks else ARC_RECORD.removesuffix(", block binary")
    return _archives(spark, path).mapInArrow(_parse_arc(ddl), ddl)


def with_revisits(records: DataFrame) -> DataFrame:
    """archive, offset, refers_to_id of the records that repeat the payload of another.

    Of responses with equal payloads of at least LEAST_REVISIT bytes, that with the smallest
    page_id stays (a null one last, ties by archive and offset).
    """
    large = records.where(f"warc_type = 'response' and payload_bytes >= {LEAST_REVISIT}")
    place = F.struct(F.coalesce("page_id", F.lit((1 << 63) - 1)), "archive", "offset", "record_id")
    first = large.groupBy("payload_digest").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    return (
        large.join(first.where("n > 1"), "payload_digest")
        .where("archive <> first.archive or offset <> first.offset")
        .select("archive", "offset", F.col("first.record_id").alias("refers_to_id"))
    )


def _warc_files(file_bytes: int):
    """The contents of files, without their last line break."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in batches:
            for row in (x for at in range(0, batch.num_rows, 64) for x in batch.slice(at, 64).to_pylist()):
                record = warc_record(row)
                out.append(record)
                held += len(record)
                if held >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"\r\n".join(out)], pa.binary())], names=["value"])
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([b"\r\n".join(out)], pa.binary())], names=["value"])

    return run


def warc_record(x: dict) -> bytes:
    """The bytes of a record but for its last line break, which the writer adds."""
    kind, block = x["warc_type"], x["block"]
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{x['record_id']}>"), ("WARC-Date", x["date"])]
    if kind == "warcinfo":
        block = f"software: tallyline\r\nformat: WARC File Format 1.1\r\ndescription: made from {x['uri']}\r\n".encode()
    else:
        fields += [("WARC-Target-URI", x["uri"]), ("WARC-IP-Address", x["ip"])]
    if x["refers_to_id"]:
        fields[0] = ("WARC-Type", "revisit")
        fields += [
            ("WARC-Refers-To", f"<{x['refers_to_id']}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
        block = block[: len(block) - x["payload_bytes"]]
    if kind == "response":
        fields.append(("WARC-Payload-Digest", f"sha256:{x['payload_digest']}"))
    fields += [
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", x["media_type"]),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n"


def write_warc(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write ``records`` (as of ``read_arc``, with refers_to_id) as gzipped WARC files of about ``file_bytes`` bytes."""
    files = records.mapInArrow(_warc_files(file_bytes), "value binary").select(F.col("value").cast("string"))
    files.write.option("lineSep", "\r\n").options(**GZIP).option("maxRecordsPerFile", 1).text(path)


def warc_records(archive: str, content: bytes) -> Iterator[dict]:
    """Records of a WARC file, digests checked against what they hold."""
    file, at = _opened(content), 0
    while line := file.readline():
        offset, at = at, at + len(line)
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{archive}: no record begins at {offset}")
        fields = {}
        while (line := file.readline()).strip():
            at += len(line)
            name, _, value = line.decode("utf-8", errors="replace").partition(":")
            fields[name.lower()] = value.strip()
        at += len(line)
        block = _exactly(file, int(fields["content-length"]), archive)
        at += len(block)
        if fields["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise ValueError(f"{archive}: the block at {offset} has another digest")
        headers, payload = http_parts(block) or ({}, block)
        digest, page = fields.get("warc-payload-digest", "").removeprefix("sha256:"), headers.get(PAGE_HEADER.lower())
        size = len(payload)
        if fields["warc-type"] == "revisit":
            size = int(headers["content-length"])
        elif digest and digest != hashlib.sha256(payload).hexdigest():
            raise ValueError(f"{archive}: the payload at {offset} has another digest")
        yield {
            "archive": archive,
            "offset": offset,
            "record_id": fields["warc-record-id"].strip("<>"),
            "record_type": fields["warc-type"],
            "uri": fields.get("warc-target-uri"),
            "date": fields["warc-date"],
            "page_id": int(page) if page else None,
            "payload_bytes": size,
            "payload_digest": digest or None,
            "refers_to_id": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
        }


def _parse_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (x for path, content in _files(batches) for x in warc_records(path, content))
    return _batched(rows, _arrow(WARC_RECORD), None)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all WARC files below ``path``, without their blocks."""
    return _archives(spark, path).mapInArrow(_parse_warc, WARC_RECORD)


def convert(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """Write the WARC records of all ARC files below ``arc_path`` to ``warc_path``.

    Archives are parsed once for digests and once for blocks, so that only small rows are
    compared. An archive that ends inside a record, or has an unknown version, raises an error.
    """
    found = stored(read_arc(spark, arc_path, blocks=False), "arc-records")
    referring = stored(with_revisits(found), "revisits")
    write_warc(read_arc(spark, arc_path).join(referring, ["archive", "offset"], "left"), warc_path)


def archive_pages(pages: DataFrame, records: int = RECORDS) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every row of ``pages``.

    The rows (page_id, url, html) are written to ARC files, those converted to WARC files, and
    these read back. A null html is an empty payload; white space in a url is escaped and a
    null url becomes ``unknown:``; rows with a null page_id keep it; repeated rows are records
    of their own, of which all but one revisit it when large enough. Other columns are ignored
    and an empty table gives an empty result.
    """
    spark = pages.sparkSession
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    write_arc(pages, arc, records)
    convert(spark, arc, warc)
    records = stored(read_warc(spark, warc).where("record_type <> 'warcinfo'"), "warc-records")
    meant = records.where("refers_to_id is not null").select(F.col("refers_to_id").alias("record_id")).distinct()
    ids = (
        records.where("record_type = 'response'")
        .join(meant, "record_id", "left_semi")
        .groupBy(F.col("record_id").alias("refers_to_id"))
        .agg(F.min("page_id").alias("refers_to"))
    )
    return records.join(ids, "refers_to_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
