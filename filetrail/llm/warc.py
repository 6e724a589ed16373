"""Web archives: converting legacy ARC files to WARC files, and writing and reading both.

An ARC file begins with a version block whose lines say which fields the header line of
each record has; a record is that line and as many bytes as it declares. The converter
makes the WARC identifiers, timestamps, types and digests that such records lack, and
turns repeated payloads into revisits of the first.

Archives are files that tasks write in the shared folder, gzipped record by record. A
file counts only if the manifest of the finished job names it, so attempts that failed or
ran twice leave nothing behind that is read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetrail.llm.store import cut, file_system, new_folder, ship

FILE_BYTES = 64 << 20
FILE_RECORDS = 20_000
MIN_REVISIT = 100
KEY_HEADER = "X-Page-Id"
DATE = "20000101000000"

# The header lines of both ARC versions.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"],
}

MANIFEST = "path string, name string, n_records bigint"
RECORDS = (
    "path string, name string, offset bigint, kind string, record_id string, uri string, date string, key bigint, "
    "payload_bytes bigint, digest string"
)
WARC_RECORDS = (
    "path string, offset bigint, record_type string, record_id string, uri string, date string, key bigint, "
    "payload_bytes bigint, payload_digest string, refers_to_id string"
)


class Output:
    """A gzipped archive file of one task attempt, begun anew when it is large enough."""

    def __init__(self, folder: str, suffix: str, begin):
        self.store, self.root = file_system(folder)
        self.folder, self.suffix, self.begin = folder, suffix, begin
        self.attempt, self.part = uuid.uuid4().hex, TaskContext.get().partitionId()
        self.store.create_dir(f"{self.root}/{self.attempt}")
        self.done: list[tuple[str, str, int]] = []
        self.stream = None

    def add(self, record: bytes) -> None:
        if self.stream is not None and (self.size >= FILE_BYTES or self.records >= FILE_RECORDS):
            self.close()
        if self.stream is None:
            self.name = f"part-{self.part:05d}-{len(self.done):05d}.{self.suffix}"
            path = f"{self.root}/{self.attempt}/{self.name}"
            self.stream = self.store.open_output_stream(path, compression=None)
            self.size = self.records = 0
            self._write(self.begin(self.name))
        self._write(record)
        self.records += 1

    def _write(self, record: bytes) -> None:
        pack = zlib.compressobj(3, zlib.DEFLATED, 31)
        self.stream.write(pack.compress(record) + pack.flush())
        self.size += len(record)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.done.append((f"{self.folder}/{self.attempt}/{self.name}", self.name, self.records))
            self.stream = None

    def manifest(self) -> pa.RecordBatch:
        self.close()
        schema = pa.schema([("path", pa.string()), ("name", pa.string()), ("n_records", pa.int64())])
        columns = list(zip(*self.done, strict=True)) or [[], [], []]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema)


class Input:
    """The bytes of an archive, gzipped or not, read as a stream."""

    def __init__(self, path: str):
        folder, name = path.rsplit("/", 1)
        store, root = file_system(folder)
        self.stream = store.open_input_stream(f"{root}/{name}", compression=None)
        self.data, self.at, self.offset = b"", 0, 0
        head = self.stream.read(1 << 20)
        self.packed = zlib.decompressobj(31) if head[:2] == b"\x1f\x8b" else None
        self._take(head)

    def _take(self, raw: bytes) -> None:
        if self.packed is None:
            self.data += raw
            return
        parts = []
        while raw:
            parts.append(self.packed.decompress(raw))
            raw = self.packed.unused_data
            if self.packed.eof:
                self.packed = zlib.decompressobj(31)  # the next record's member
            else:
                break
        self.data += b"".join(parts)

    def _more(self) -> bool:
        raw = self.stream.read(1 << 20)
        if not raw:
            return False
        self.data, self.at = self.data[self.at:], 0
        self._take(raw)
        return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the file."""
        while (end := self.data.find(b"\n", self.at)) < 0:
            if not self._more():
                end = len(self.data)
                if end == self.at:
                    return None
                break
        out = self.data[self.at:end]
        self.offset += end + 1 - self.at
        self.at = end + 1
        return out.removesuffix(b"\r")

    def read(self, n: int) -> bytes:
        while len(self.data) - self.at < n:
            if not self._more():
                raise ValueError(f"a record ends before its declared length at byte {self.offset}")
        out = self.data[self.at:self.at + n]
        self.at += n
        self.offset += n
        return out


def arc_begin(version: int):
    """The version block that begins an ARC file."""
    def block(name: str) -> bytes:
        body = f"{version} 0 filetrail\n{' '.join(ARC_FIELDS[version])}\n".encode()
        middle = "text/plain" if version == 1 else f"text/plain 200 - - 0 {name}"
        return f"filedesc://{name} 0.0.0.0 {DATE} {middle} {len(body)}\n".encode() + body + b"\n"

    return block


def arc_record(version: int, url: str, date: str, mime: str, block: bytes) -> bytes:
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) or "-"
    extra = "" if version == 1 else "200 - - 0 - "
    return f"{url} 0.0.0.0 {date} {mime} {extra}{len(block)}\n".encode() + block + b"\n"


def read_arc(path: str) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, header fields and block of each record; the version block comes first."""
    source = Input(path)
    fields = None
    while True:
        start, line = source.offset, source.line()
        if line is None:
            return
        if not line:
            continue  # the newline after a block
        text = line.decode("utf-8", "replace")
        if fields is None:
            # The version block's own line has the fields of the version that it begins.
            parts = text.split(" ")
            length = parts[-1]
            names = ARC_FIELDS[1] if len(parts) == 5 else ARC_FIELDS[2]
        else:
            names, parts = fields, text.split(" ")
        # Only the URL may hold spaces, so fields count from the end.
        n = len(names) - 1
        length = parts[-1]
        if len(parts) <= n or not length.isdigit():
            raise ValueError(f"not an ARC header line at byte {start} of {path}")
        header = dict(zip(names, [" ".join(parts[:-n]), *parts[-n:]], strict=True))
        block = source.read(int(length))
        if fields is None:
            lines = block.decode("utf-8", "replace").split("\n")
            listed = lines[1].split() if len(lines) > 1 else []
            version = lines[0].split(" ")[0]
            fields = listed or ARC_FIELDS[int(version) if version in ("1", "2") else 1]
        yield start, header, block


def _http(block: bytes) -> tuple[bytes, bytes]:
    """Headers of a response, blank line included, and its body."""
    found = re.search(rb"\r?\n\r?\n", block)
    return (block[:found.end()], block[found.end():]) if found else (block, b"")


def _header(headers: bytes, name: str) -> str | None:
    found = re.search(rb"^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", headers, re.M | re.I)
    return found[1].decode("utf-8", "replace").strip() if found else None


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d{1,18}|-9223372036854775808|-?9\d{18}|-?[1-8]\d{18}", text) else None


def warc_date(digits: str) -> str:
    """The timestamp of an ARC date; one cut short is filled up, another gives that of ``DATE``."""
    digits = digits if re.fullmatch(r"\d{4,14}", digits) else DATE
    filled = digits + "00000101000000"[len(digits):]
    try:
        moment = datetime.strptime(filled, "%Y%m%d%H%M%S").replace(tzinfo=UTC)
    except ValueError:
        moment = datetime.strptime(DATE, "%Y%m%d%H%M%S").replace(tzinfo=UTC)
    return moment.strftime("%Y-%m-%dT%H:%M:%SZ")


def _converted(path: str, name: str, key_header: str) -> Iterator[dict]:
    """What a WARC record needs, for each record of an ARC file."""
    for offset, header, block in read_arc(path):
        uri = header["URL"]
        kind = "resource"
        headers, payload = b"", block
        if uri.startswith("filedesc://"):
            kind = "warcinfo"
        elif block.startswith(b"HTTP/"):
            kind, (headers, payload) = "response", _http(block)
        yield {
            "offset": offset, "kind": kind, "uri": uri, "date": warc_date(header["Archive-date"]),
            "record_id": f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{offset}#{uri}')}",
            "mime": header["Content-type"], "ip": header["IP-address"], "headers": headers, "payload": payload,
            "key": _number(_header(headers, key_header)), "digest": hashlib.sha256(payload).hexdigest(),
        }


def _rows(rows: list[dict], fields: str) -> pa.RecordBatch:
    types = {"string": pa.string(), "bigint": pa.int64()}
    schema = pa.schema([(n, types[t]) for n, t in (f.split() for f in fields.split(", "))])
    return pa.record_batch([pa.array([r[n] for r in rows], t) for n, t in zip(schema.names, schema.types, strict=True)], schema)


def _index(batches: Iterator[pa.RecordBatch], key_header: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, name in zip(batch.column("path").to_pylist(), batch.column("name").to_pylist(), strict=True):
            rows = [
                r | {"path": path, "name": name, "payload_bytes": len(r["payload"]), "payload": None, "headers": None}
                for r in _converted(path, name, key_header) if r["kind"] != "warcinfo"
            ]
            yield _rows(rows, RECORDS)


def warc_record(r: dict, revisit: dict | None) -> bytes:
    """A record in WARC 1.1; a revisit keeps the headers of its block and names the first."""
    payload = b"" if revisit else r["payload"]
    block = r["headers"] + payload
    kind = "revisit" if revisit else r["kind"]
    lines = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<{r['record_id']}>"), ("WARC-Date", r["date"]),
        ("WARC-Target-URI", r["uri"]), ("WARC-IP-Address", r["ip"]),
        ("WARC-Payload-Digest", f"sha256:{r['digest']}"), ("WARC-Payload-Length", str(len(r["payload"]))),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response" if r["headers"] else r["mime"]),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        lines += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<{revisit['refers_id']}>"),
            ("WARC-Refers-To-Target-URI", revisit["refers_uri"]),
            ("WARC-Refers-To-Date", revisit["refers_date"]),
        ]
    if r["kind"] == "warcinfo":
        lines = [x for x in lines if x[0] not in ("WARC-Target-URI", "WARC-IP-Address")]
        lines.append(("WARC-Filename", r["uri"].removeprefix("filedesc://")))
    head = "WARC/1.1\r\n" + "".join(f"{a}: {b}\r\n" for a, b in lines) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _convert(batches: Iterator[pa.RecordBatch], folder: str, key_header: str) -> Iterator[pa.RecordBatch]:
    info = b"software: filetrail\r\nformat: WARC file version 1.1\r\n"

    def begin(name: str) -> bytes:
        return warc_record({
            "kind": "warcinfo", "record_id": f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}",
            "date": warc_date(DATE), "uri": f"filedesc://{name}", "ip": "", "headers": b"", "payload": info,
            "digest": hashlib.sha256(info).hexdigest(), "mime": "application/warc-fields",
        }, None)

    out = Output(folder, "warc.gz", begin)
    for batch in batches:
        for row in batch.to_pylist():
            revisits = {x["offset"]: x for x in row["revisits"] or ()}
            for r in _converted(row["path"], row["name"], key_header):
                if r["kind"] != "warcinfo":
                    out.add(warc_record(r, revisits.get(r["offset"])))
    yield out.manifest()


def _dealt(files: DataFrame) -> DataFrame:
    """The list of files with a task for each; rows this short would else share one task."""
    return files.repartitionByRange(max(1, files.count()), "path")


def convert(archives: DataFrame, folder: str, min_bytes: int = MIN_REVISIT,
            key_header: str = KEY_HEADER) -> DataFrame:
    """Convert ARC files to WARC files in ``folder``; the manifest of the files written.

    ``archives`` has a row ``path, name`` for each file, at most a few tens of MB large;
    plain and gzipped files of versions 1 and 2 can be mixed. Every record but the version
    blocks becomes one WARC record with an identifier made from file, place and URL, the
    timestamp of its date, and SHA-256 digests of payload and block. Blocks that are HTTP
    responses have type ``response`` and their body as payload, others ``resource``.

    Of HTTP responses with equal payloads of at least ``min_bytes`` bytes the first stays
    whole and the others become ``revisit`` records of it. The first has the smallest
    number in its ``key_header``; without such a header it comes after those with one,
    ordered by identifier. Only digests are shuffled, never payloads.

    A file that isn't ARC, or that ends inside a record, fails with its name and place.
    """
    ship(archives.sparkSession)
    files = archives.select("path", "name")
    index = cut(_dealt(files).mapInArrow(lambda it: _index(it, key_header), RECORDS), "arc-index")
    first = F.struct(F.col("key").isNull().alias("none"), "key", "record_id", "uri", "date")
    large = index.where((F.col("kind") == "response") & (F.col("payload_bytes") >= min_bytes))
    firsts = large.groupBy("digest").agg(F.min(first).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = cut(firsts.select("digest", "first"), "arc-firsts")
    later = cut(
        large.join(firsts, "digest").where("record_id <> first.record_id").select(
            "path", F.struct(
                "offset", F.col("first.record_id").alias("refers_id"), F.col("first.uri").alias("refers_uri"),
                F.col("first.date").alias("refers_date"),
            ).alias("revisit"),
        ), "arc-revisits",
    )
    # A file holds a bounded number of records, so its list of revisits is bounded too.
    lists = later.groupBy(F.col("path").alias("_path")).agg(F.collect_list("revisit").alias("revisits"))
    work = files.join(lists, F.col("path") == F.col("_path"), "left").select("path", "name", "revisits")
    work = cut(work, "arc-work")
    return cut(_dealt(work).mapInArrow(lambda it: _convert(it, folder, key_header), MANIFEST), "warc-files")


def read_warc(path: str) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, named fields (lower-cased names) and block of each record."""
    source = Input(path)
    while True:
        start, line = source.offset, source.line()
        if line is None:
            return
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record at byte {start} of {path}")
        fields = {}
        while line := source.line():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield start, fields, source.read(int(fields["content-length"]))


def _read(batches: Iterator[pa.RecordBatch], key_header: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows = []
            for offset, f, block in read_warc(path):
                kind = f["warc-type"]
                if kind == "warcinfo":
                    continue
                http = f.get("content-type", "").startswith("application/http")
                headers, payload = _http(block) if http else (b"", block)
                if kind == "revisit":
                    size, digest = int(f["warc-payload-length"]), f["warc-payload-digest"].removeprefix("sha256:")
                else:
                    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                    if f.get("warc-payload-digest", f"sha256:{digest}") != f"sha256:{digest}":
                        raise ValueError(f"a payload differs from its digest at byte {offset} of {path}")
                rows.append({
                    "path": path, "offset": offset, "record_type": kind, "record_id": f["warc-record-id"].strip("<>"),
                    "uri": f.get("warc-target-uri"), "date": f["warc-date"], "key": _number(_header(headers, key_header)),
                    "payload_bytes": size, "payload_digest": digest,
                    "refers_to_id": f["warc-refers-to"].strip("<>") if kind == "revisit" else None,
                })
            yield _rows(rows, WARC_RECORDS)


def read_records(archives: DataFrame, key_header: str = KEY_HEADER) -> DataFrame:
    """A row for each record of WARC files, warcinfo records left out.

    Sizes and digests are those of the full payload: of the bytes in the file, which are
    checked, or for revisits the declared ones. A file that isn't WARC, ends inside a record or holds a payload
    that differs from its digest fails with its name and place.
    """
    ship(archives.sparkSession)
    return _dealt(archives.select("path")).mapInArrow(lambda it: _read(it, key_header), WARC_RECORDS)


def _archive(batches: Iterator[pa.RecordBatch], folder: str, version: int | None, key_header: str):
    version = version or 1 + TaskContext.get().partitionId() % 2
    out = Output(folder, "arc.gz", arc_begin(version))
    for batch in batches:
        for key, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            body = (html or "").encode()
            named = "" if key is None else f"{key_header}: {key}\r\n"
            head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n{named}\r\n"
            out.add(arc_record(version, url or "", DATE, "text/html", head.encode() + body))
    yield out.manifest()


def write_arc(pages: DataFrame, folder: str, version: int | None = None,
              key_header: str = KEY_HEADER) -> DataFrame:
    """Write an ARC record for each row of ``page_id, url, html``; the manifest of the files.

    The block is an HTTP response with the html in UTF-8 as its body and the page_id in
    ``key_header``. A null html is an empty body, a null page_id no header, a null or
    empty url ``-``; blanks and control characters of urls are escaped. Repeated rows are
    records of their own. Without ``version``, files of both versions are written.
    """
    ship(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    return cut(rows.mapInArrow(lambda it: _archive(it, folder, version, key_header), MANIFEST), "arc-files")


def archive_pages(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """The records of ``pages`` after a way through ARC files, the converter and WARC files.

    Columns: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type`` and
    ``refers_to``, the page_id of the record that a revisit names. An empty table gives
    no rows; other columns of ``pages`` are ignored.
    """
    spark = ship(pages.sparkSession)
    archives = convert(write_arc(pages, new_folder(spark, "arc")), new_folder(spark, "warc"), min_bytes)
    records = cut(read_records(archives), "warc-records")
    named = cut(
        records.where("record_type = 'response'").select(F.col("record_id").alias("_id"), F.col("key").alias("refers_to")), "warc-ids"
    )
    return records.join(named, F.col("refers_to_id") == F.col("_id"), "left").select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
