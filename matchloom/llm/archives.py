"""Legacy web archives (ARC, versions 1 and 2) to WARC, and reading WARC back.

ARC is read by its version line, header lines and declared lengths. Each record becomes a WARC record with a
synthesised identifier, timestamp, type and digests; equal payloads are found by digest and size, and all but the first
are written as revisits. WARC files are written by Spark's own text writer, compressed with gzip, whose line separator is the record's end
(two line breaks), so any store that Spark can write will do; they are read whole and parsed by their declared lengths. Files of
either format are bounded by bytes; only a record that is larger alone has a file of its own.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import new_path, stored

_END = "\r\n\r\n"
#: Bytes of records after which an archive is full.
FILE_BYTES = 32_000_000
#: Field names of a URL record's header line in either version, as the version block declares them.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_ARC_RECORD = "name string, place long, version int, url string, ip string, date string, mime string, status int, head binary, payload binary, error string"


def write_arc(name: str, version: int, records: list[tuple[str, str, str, str, bytes]]) -> bytes:
    """An ARC file; records: url, ip, date (14 digits), mime, content (HTTP head and payload)."""
    fields = ARC_FIELDS[version]
    block = f"{version} 0 matchloom\n{fields}\n\n".encode()
    tail = {1: "", 2: f"200 - - 0 {name} "}[version]
    out = [f"filedesc://{name} 0.0.0.0 20240101000000 text/plain {tail}{len(block)}\n".encode(), block]
    at = len(out[0]) + len(block)
    for url, ip, date, mime, content in records:
        middle = {1: "", 2: f"200 {hashlib.md5(content).hexdigest()} - {at} {name} "}[version]
        header = f"{url} {ip} {date} {mime} {middle}{len(content)}\n".encode()
        out += [header, content, b"\n"]
        at += len(header) + len(content) + 1
    return b"".join(out)


class Damaged(ValueError):
    """An ARC file cannot be read on from a place, its second argument."""


def read_arc(raw: bytes) -> Iterator[dict]:
    """Records of an ARC file but the first, which tells the version. Broken or cut-off records raise Damaged, after those before them."""
    at, fields, version = 0, None, 0
    while at < len(raw):
        if raw[at : at + 1] in b"\r\n":
            at += 1
            continue
        end = raw.find(b"\n", at)
        line = raw[at:end].rstrip(b"\r").decode("utf-8", "replace") if end >= 0 else ""
        values = line.split(" ")
        if not line or not values[-1].isdigit():
            raise Damaged(f"no ARC header at {at}", at)
        size = int(values[-1])
        content = raw[end + 1 : end + 1 + size]
        if len(content) < size:
            raise Damaged(f"record at {at} is cut off", at)
        if fields is None:
            first, names, *_ = [*content.decode("utf-8", "replace").splitlines(), "", ""]
            number, fields = (first.split() or [""])[0], names.lower().split()
            if not number.isdigit() or int(number) not in ARC_FIELDS or not {"url", "ip-address", "archive-date", "content-type", "archive-length"} <= set(fields):
                raise Damaged(f"no ARC version at {at}", at)
            version = int(number)
        else:
            if len(values) > len(fields):  # blanks in the URL
                over = len(values) - len(fields)
                values = [" ".join(values[: over + 1]), *values[over + 1 :]]
            if len(values) < len(fields):
                raise Damaged(f"no ARC header at {at}", at)
            yield dict(zip(fields, values, strict=True)) | {"place": at, "version": version, "content": content}
        at = end + 1 + size


def _split_http(content: bytes) -> tuple[int, bytes, bytes]:
    """Status, head and payload of an HTTP response."""
    head, found, payload = content.partition(b"\r\n\r\n")
    if not content.startswith(b"HTTP/") or not found:
        return 0, b"", content
    words = head.split(b"\r\n")[0].split()
    return (int(words[1]) if len(words) > 1 and words[1].isdigit() else 0), head + b"\r\n\r\n", payload


def _pages_to_arc(batches: Iterator[pa.RecordBatch], per_file: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Archives in turn of either version; named by partition and number, as rows can be repeated."""
    made, part, held, size = 0, TaskContext.get().partitionId(), [], 0

    def archive() -> pa.RecordBatch:
        name = f"pages-{part:06}-{made:06}.arc"
        return pa.record_batch([pa.array([name]), pa.array([write_arc(name, 1 + made % 2, held)], pa.binary())], names=["name", "content"])

    for batch in batches:
        for row in range(batch.num_rows):
            page, url, html = (batch.column(c)[row].as_py() for c in ("page_id", "url", "html"))
            payload = (html or "").encode("utf-8", "surrogatepass")
            own = "" if page is None else f"X-Page-Id: {page}\r\n"
            head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n"
            address = "".join(c if c.isprintable() and c != " " else "%20" for c in url or "about:blank")
            held.append((address, "0.0.0.0", "20240131000000", "text/html", head.encode() + payload))
            size += len(payload)
            if len(held) >= per_file or size >= most_bytes:
                made += 1
                yield archive()
                held, size = [], 0
    if held:
        made += 1
        yield archive()


def pages_to_arc(pages: DataFrame, per_file: int = 200, most_bytes: int = FILE_BYTES) -> DataFrame:
    """name, content: ARC files of the pages (page_id, url, html), full after per_file records or most_bytes; null html is an empty payload.
    Names are by partition, so what is read twice must be stored."""
    return pages.select("page_id", "url", "html").mapInArrow(lambda it: _pages_to_arc(it, per_file, most_bytes), "name string, content binary")


def _date_of(text: str) -> str | None:
    """The time of an ARC date, 14 digits or the first of them, as WARC has it; null if it is none."""
    digits = text[:14]
    try:
        full = digits + "00000101000000"[len(digits) :]
        return datetime.strptime(full, "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ") if digits.isdigit() and len(digits) >= 4 else None
    except ValueError:
        return None


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _ARC_RECORD.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.string()]
    for batch in batches:
        for name, raw in zip(batch.column("name").to_pylist(), batch.column("content"), strict=True):
            rows = []
            broken = lambda place, error: (name, place, *[None] * 8, error)  # noqa: B023, E731
            try:
                for r in read_arc(raw.as_py()):
                    date = _date_of(r["archive-date"])
                    if date is None:
                        rows.append(broken(r["place"], f"record at {r['place']} has no date"))
                        continue
                    status, head, payload = _split_http(r["content"])
                    rows.append((name, r["place"], r["version"], r["url"], r["ip-address"], date, r["content-type"], status, head, payload, None))
            except Damaged as e:
                rows.append(broken(e.args[1], e.args[0]))
            # no larger than its archive
            yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def arc_records(archives: DataFrame) -> DataFrame:
    """One row per record of the ARC files (name, content). Where one is damaged, a row with its place there and an error ends it; a record without a date
    is such a row, too, and the ones after it follow."""
    return archives.mapInArrow(_records, _ARC_RECORD)


def record_id(name: Column, place: Column) -> Column:
    """A UUID of version 8 from the SHA-256 of a record's file and place; null if there is none."""
    h = F.sha2(F.concat(name, F.lit("|"), place.cast("string")), 256)
    part = lambda at, n: F.substring(h, at, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-8"), part(14, 3), F.lit("-a"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))


def _bytes_of(row: dict) -> bytes:
    revisit = row["first_id"] is not None
    block = row["head"] if revisit else row["head"] + row["payload"]
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {row['id']}", f"WARC-Date: {row['date']}",
        f"WARC-Target-URI: {row['url']}", f"WARC-IP-Address: {row['ip']}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{row['sha']}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"X-Payload-Length: {row['size']}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {row['first_id']}"]
    return ("\r\n".join([*lines, f"Content-Length: {len(block)}"]) + _END).encode() + block


def _texts(batches: Iterator[pa.RecordBatch], per_file: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """WARC files: records, joined by their end."""
    held, size = [], 0
    of = lambda: pa.record_batch([pa.array([_END.encode().join(held)], pa.binary())], names=["value"])
    for batch in batches:
        columns = batch.column_names
        for row in range(batch.num_rows):
            held.append(_bytes_of({c: batch.column(i)[row].as_py() for i, c in enumerate(columns)}))
            size += len(held[-1])
            if len(held) >= per_file or size >= most_bytes:
                yield of()
                held, size = [], 0
    if held:
        yield of()


def arc_to_warc(archives: DataFrame, path: str, least: int = 100, per_file: int = 2000, most_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the records of the ARC files (name, unique, and content) as WARC files in the folder `path`, each full after per_file records or
    most_bytes.

    Of records with equal payloads of at least `least` bytes, the one with the smallest X-Page-Id (then by file and place)
    is a response and the others revisit it; a record without that field comes after those with it. Equal means the same SHA-256 and size. Heads may hold any bytes.
    Returns name, place, error of damage: the records before it are written, and a damaged archive costs no other one.
    """
    rows = arc_records(archives)
    page = F.regexp_extract(F.decode("head", "ISO-8859-1"), r"(?i)\r\nX-Page-Id: (-?\d+)\r\n", 1)
    rows = rows.withColumn("page", F.when(page != "", page.cast("long"))).withColumn("sha", F.sha2("payload", 256))
    rows = stored(rows.withColumn("size", F.length("payload").cast("long")), "arc-records")
    damage = rows.filter("error is not null").select("name", "place", "error")
    rows = rows.filter("error is null")
    key = F.when(F.col("size") >= least, F.concat_ws(":", "sha", "size"))
    small = rows.select("name", "place", "page", key.alias("key")).filter("key is not null")
    order = F.struct(F.col("page").isNull().alias("none"), "page", "name", "place")
    first = small.groupBy("key").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = small.join(stored(first, "first-records"), "key").filter(~((F.col("name") == F.col("first.name")) & (F.col("place") == F.col("first.place"))))
    later = stored(later.select("name", "place", F.col("first.name").alias("first_name"), F.col("first.place").alias("first_place")), "revisits")
    out = rows.join(later, ["name", "place"], "left")
    out = out.withColumn("id", record_id(F.col("name"), F.col("place"))).withColumn("first_id", record_id(F.col("first_name"), F.col("first_place")))
    text = out.select("url", "ip", "date", "head", "payload", "sha", "size", "id", "first_id").mapInArrow(lambda it: _texts(it, per_file, most_bytes), "value binary")
    # a value is a file; the writer puts the end of the last record after it
    text = text.select(F.col("value").cast("string").alias("value"))
    text.write.option("lineSep", _END).option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)
    return damage


def read_warc_bytes(raw: bytes) -> Iterator[tuple[dict, bytes]]:
    """Headers (lower-case names) and block of each record of a WARC file, plain or gzip, by declared length."""
    raw, at = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw, 0
    while at < len(raw):
        end = raw.find(b"\r\n\r\n", at)
        lines = raw[at:end].decode("utf-8", "replace").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC header at {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        block = raw[end + 4 : end + 4 + size]
        if len(block) < size or raw[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"record at {at} does not end where it should")
        yield headers, block
        at = end + 8 + size


_WARC = "record_id string, record_type string, refers_to_id string, url string, date string, page_id long, payload_bytes long, payload_digest string, payload binary"


def _read(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _WARC.split(", ")]
    kinds = [pa.string()] * 5 + [pa.int64()] * 2 + [pa.string(), pa.binary()]
    for batch in batches:
        for raw in batch.column("content"):
            rows, held = [], 0
            for h, block in read_warc_bytes(raw.as_py()):
                _, head, payload = _split_http(block)
                page = next((x.split(b":")[1] for x in head.split(b"\r\n") if x.lower().startswith(b"x-page-id:")), None)
                digest, size = h["warc-payload-digest"].partition(":")[2], int(h["x-payload-length"])
                if h["warc-type"] == "response" and (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, size):
                    raise ValueError(f"{h['warc-record-id']}: the payload does not have its digest")
                rows.append((h["warc-record-id"], h["warc-type"], h.get("warc-refers-to"), h["warc-target-uri"], h["warc-date"],
                             None if page is None else int(page), size, digest, payload if whole and h["warc-type"] == "response" else None))
                held += size if whole else 0
                if len(rows) >= 256 or held >= FILE_BYTES:
                    yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
                    rows, held = [], 0
            yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def read_warc(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """One row per record of the WARC files in a folder; `payload` of responses if whole."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(lambda it: _read(it, whole), _WARC)


def round_trip(pages: DataFrame, least: int = 100) -> DataFrame:
    """pages to ARC to WARC files and read again: a row for each row of pages, with page_id, url, date, payload_bytes, payload_digest, record_type,
    refers_to.

    Null html is an empty payload and a null url about:blank; a null page_id stays null, comes after all others and is referred to as null.
    Repeated rows are records of their own: of equal payloads, also of one page_id, one is the response. Pages of any length are taken whole, and
    columns besides page_id, url and html are not read. No pages give no rows.
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    arc_to_warc(pages_to_arc(pages), path, least)
    rows = stored(read_warc(spark, path, whole=False), "warc-records")
    columns = ["page_id", "url", "date", "payload_bytes", "payload_digest", "record_type"]
    revisits = rows.filter("record_type = 'revisit'")
    pointed = revisits.select(F.col("refers_to_id").alias("record_id")).distinct()
    targets = stored(rows.join(pointed, "record_id", "left_semi").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")), "targets")
    others = rows.filter("record_type != 'revisit'").select(*columns, F.lit(None).cast("long").alias("refers_to"))
    return others.union(revisits.join(targets, "refers_to_id").select(*columns, "refers_to"))
