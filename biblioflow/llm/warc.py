"""Legacy archive converter: ARC files to WARC files, and a WARC reader.

ARC files begin with a version block whose last line names the fields of the header lines
that follow (five in version 1, ten in version 2); each record is a header line, whose last
field declares the length, and that many bytes.  The converter makes WARC records of them:
identifiers from the file's name and the record's place, ISO timestamps, types, and SHA-1
digests of payload and block.  Of records with equal payloads that with the largest page id
is the response, the others revisit it and carry no payload.

Spark's own sources and sinks move the bytes (``binaryFile``; ``text`` with the records'
terminator as line separator, which writes bytes as they are), so archives can lie wherever
Spark reads and writes.  A file is read whole by one task; files are as large as the splits
of the table they were written from.  Only (place, digest, page id) is grouped by digest,
pre-aggregated by task; payloads aren't shuffled, each file's decisions come to the file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioflow.llm.components import _written
from biblioflow.llm.words import ship_by_value
from biblioflow.session import scratch_path

#: The field lines of the two ARC versions.
FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
          2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
#: WARC version line and revisit profile.
WARC_VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIRST_DATE = datetime(2001, 1, 1, tzinfo=timezone.utc)
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _unzipped(data: bytes) -> bytes:
    """The bytes of a file, gzip members (one or several) unpacked."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        one = zlib.decompressobj(31)
        out.append(one.decompress(data))
        data = one.unused_data
    return b"".join(out)


def _clean_url(url: str | None) -> str:
    """A header field holds no white space or control characters (null: ``-``)."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "-"


# ARC -----------------------------------------------------------------------------------
def version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 biblioflow\n{FIELDS[version]}\n"
    line = f"filedesc://{name} 0.0.0.0 {FIRST_DATE:%Y%m%d%H%M%S} text/plain "
    return (line + ("" if version == 1 else "200 - - 0 " + name + " ") + f"{len(body)}\n{body}").encode()


def _arc_rows(id_col: str, url_col: str, html_col: str):
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        version, name, offset = 1 + part % 2, f"pages-{part:06d}.arc", 0
        for batch in batches:
            out = []
            if offset == 0 and batch.num_rows:
                out.append(version_block(version, name))
                offset = len(out[0]) + 1
            for page, url, html in zip(*(batch.column(c).to_pylist() for c in (id_col, url_col, html_col))):
                payload = (html or "").encode()
                head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n" + ("" if page is None else f"X-Page-Id: {page}\r\n")
                body = head.encode() + b"\r\n" + payload
                date = f"{FIRST_DATE + timedelta(seconds=(page or 0) % 700_000_000):%Y%m%d%H%M%S}"
                fields = [_clean_url(url), "0.0.0.0", date, "text/html"]
                if version == 2:
                    fields += ["200", hashlib.md5(payload).hexdigest(), "-", str(offset), name]
                record = f"{' '.join(fields)} {len(body)}\n".encode() + body
                out.append(record)
                offset += len(record) + 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
    return run


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """One gzipped ARC file per partition, of version 1 and 2 in turn."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html"))
    records = rows.mapInArrow(_arc_rows("id", "url", "html"), "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.options(**PACKED, lineSep="\n").text(path)


def parse_arc(data: bytes):
    """(offset, {field: value}, record bytes) of each record of an ARC file; the version
    block says which fields a header line has."""
    at, names = 0, None
    while at < len(data):
        if data[at:at + 1] in b"\r\n":  # between records
            at += 1
            continue
        stop = data.index(b"\n", at)
        line = data[at:stop].decode("utf-8").rstrip("\r")
        if names is None:
            if not line.startswith("filedesc:"):
                raise ValueError("an ARC file begins with its version block")
            size = int(line.rsplit(" ", 1)[1])
            block = data[stop + 1:stop + 1 + size].decode("utf-8").split("\n")
            names, version = block[1].split(" "), int(block[0].split(" ")[0])
            if names != FIELDS.get(version, "").split(" "):
                raise ValueError(f"fields of ARC version {version} expected: {block[1]}")
        else:
            record = dict(zip(names, line.rsplit(" ", len(names) - 1)))
            size = int(record["Archive-length"])
            if len(data) < stop + 1 + size:
                raise ValueError("an ARC record is shorter than its declared length")
            yield at, record, data[stop + 1:stop + 1 + size]
        at = stop + 1 + size


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """(HTTP head with its blank line, payload); without a head all is payload."""
    if block.startswith(b"HTTP/"):
        cut = block.find(b"\r\n\r\n")
        if cut >= 0:
            return block[:cut + 4], block[cut + 4:]
    return b"", block


def page_of(head: bytes) -> int | None:
    found = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head)
    return int(found[1]) if found else None


def _arc_digests(batches):
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            rows = [(at, page_of(head), base32_sha1(payload), len(payload), r["URL"], r["Archive-date"])
                    for at, r, block in parse_arc(_unzipped(content.as_py())) for head, payload in [split_http(block)]]
            cols = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([
                pa.array([path] * len(rows), pa.string()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.string()), pa.array(cols[5], pa.string())],
                ["path", "at", "page_id", "digest", "bytes", "url", "date"])


# WARC ----------------------------------------------------------------------------------
def record_id(path: str, at: int) -> str:
    """The same record has the same identifier however often it is converted."""
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{path.rsplit("/", 1)[-1]}#{at}')}>"


def iso_date(date: str) -> str:
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [WARC_VERSION, *(f"{k}: {v}".encode() for k, v in headers), f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block


def _convert(batches):
    """ARC files with their decisions -> WARC records, a warcinfo record before each file's."""
    for batch in batches:
        revisits = batch.column("revisits").to_pylist()
        for path, content, known in zip(batch.column("path").to_pylist(), batch.column("content"), revisits):
            of = {r["at"]: r for r in known or ()}
            info = f"software: biblioflow\r\nformat: WARC File Format 1.1\r\nisPartOf: {path.rsplit('/', 1)[-1]}\r\n".encode()
            out, held = [warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(path, -1)), ("WARC-Date", iso_date(f"{FIRST_DATE:%Y%m%d%H%M%S}")),
                                      ("Content-Type", "application/warc-fields")], info)], 0
            for at, r, block in parse_arc(_unzipped(content.as_py())):
                head, payload = split_http(block)
                again = of.get(at)
                headers = [("WARC-Type", "revisit" if again else "response"), ("WARC-Record-ID", record_id(path, at)), ("WARC-Date", iso_date(r["Archive-date"])),
                           ("WARC-Target-URI", r["URL"]), ("WARC-IP-Address", r["IP-address"]), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
                           ("Content-Type", "application/http; msgtype=response" if head else r["Content-type"])]
                if again:
                    headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(again["of_path"], again["of_at"])),
                                ("WARC-Refers-To-Target-URI", again["of_url"]), ("WARC-Refers-To-Date", iso_date(again["of_date"])),
                                ("Payload-Length", str(len(payload)))]
                    if again["of_page"] is not None:
                        headers.append(("Refers-To-Page-Id", str(again["of_page"])))
                    block = head
                headers.append(("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"))
                out.append(warc_record(headers, block))
                held += len(out[-1])
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def arc_to_warc(spark: SparkSession, arc: str, warc: str, min_bytes: int = 0) -> None:
    """Converts a folder of ARC files into one of gzipped WARC files.

    Payloads of at least ``min_bytes`` that are equal (by SHA-1 and length) are stored once;
    the response among them has the largest page id, of equal ids the last place, and null
    is smaller than any id.  Records without an HTTP head are taken whole."""
    found = _written(_files(spark, arc).mapInArrow(_arc_digests, "path string, at long, page_id long, digest string, bytes long, url string, date string"), "arc-index")
    asked = found.where(F.col("bytes") >= min_bytes)
    place = F.struct(F.coalesce("page_id", F.lit(-(2 ** 63))).alias("order"), "path", "at", "page_id", "url", "date")
    kept = asked.groupBy("digest", "bytes").agg(F.max(place).alias("of"), F.count(F.lit(1)).alias("n")).where("n > 1")
    revisits = (asked.join(kept, ["digest", "bytes"]).where((F.col("path") != F.col("of.path")) | (F.col("at") != F.col("of.at")))
                .groupBy("path").agg(F.collect_list(F.struct(  # one file's records
                    "at", F.col("of.path").alias("of_path"), F.col("of.at").alias("of_at"), F.col("of.page_id").alias("of_page"),
                    F.col("of.url").alias("of_url"), F.col("of.date").alias("of_date"))).alias("revisits")))
    records = _files(spark, arc).join(revisits, "path", "left").mapInArrow(_convert, "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.options(**PACKED, lineSep="\r\n\r\n").text(warc)


def parse_warc(data: bytes):
    """({header: value}, block) of each record of a WARC file, by declared lengths."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"a WARC record expected at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        block = data[stop + 4:stop + 4 + size]
        if len(block) != size or data[stop + 4 + size:stop + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"a WARC record doesn't end where it declares, after byte {at}")
        yield headers, block
        at = stop + 8 + size


def _warc_rows(batches):
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for h, block in parse_warc(_unzipped(content.as_py())):
                kind = h["WARC-Type"]
                if kind not in ("response", "revisit"):
                    continue
                head, payload = split_http(block)
                digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                if base32_sha1(block) != h["WARC-Block-Digest"].removeprefix("sha1:") or kind == "response" and base32_sha1(payload) != digest:
                    raise ValueError(f"record {h['WARC-Record-ID']} isn't what its digest says")
                size = len(payload) if kind == "response" else int(h["Payload-Length"])
                to = h.get("Refers-To-Page-Id")
                rows.append((page_of(head), size, digest, kind, int(to) if to else None, h["WARC-Record-ID"], h.get("WARC-Refers-To"), h["WARC-Target-URI"], h["WARC-Date"]))
            cols = list(zip(*rows)) or [[]] * 9
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "refers_to_record", "target_uri", "warc_date"])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record; a record that isn't what it declares fails."""
    return _files(spark, path).mapInArrow(_warc_rows, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
                                                      "record_id string, refers_to_record string, target_uri string, warc_date string")


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Pages as ARC files, converted to WARC files, read back: one row per page.

    A null html is the empty payload, a null url is ``-`` in the headers, a null id stays
    null; white space in a url is percent-encoded; repeated rows are records of their own;
    an empty table gives no files and no rows; other columns aren't read."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, id_col, url_col, html_col)
    arc_to_warc(spark, arc, warc, min_bytes)
    return read_warc(spark, warc)


ship_by_value(__name__)
