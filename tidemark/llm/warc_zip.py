"""Web archives in ZIP packages: a Spark writer, and a reader that fetches records by byte range."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import zlib
from typing import Callable, Iterator, NamedTuple
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder
from ..tables import files
from .common import INNER, keyed_join, small_batches

#: Bytes after which a package is closed (one record may be longer).
PACKAGE_BYTES = 32 << 20
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
#: Fixed values of the WARC 1.1 and ZIP formats.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LOCAL, CENTRAL, END, END64, LOCATOR = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


# --- writing -------------------------------------------------------------------------------------------------------

def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def warc_record(page_id, url: str | None, payload: bytes, refers_to=None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """A response record with the payload, or a revisit record (HTTP head only) of `refers_to`."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": _name(page_id), "WARC-Date": date}
    if url is not None:
        head["WARC-Target-URI"] = quote(url, safe="".join(map(chr, range(33, 127))))
    head |= {"WARC-Payload-Digest": "sha1:" + digest(payload), "Content-Type": "application/http;msgtype=response"}
    if refers_to is None:
        block += payload
    else:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _name(refers_to)}
    head["Content-Length"] = str(len(block))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def package(members: list[tuple[str, bytes]], comment: bytes = b"", zip64: bool = False) -> bytes:
    """A ZIP file of stored members. ZIP64 fields are written where a number needs them, or everywhere if asked for."""
    out, directory = bytearray(), bytearray()
    for name, data in members:
        crc, size, start, raw = zlib.crc32(data), len(data), len(out), name.encode()
        wide = zip64 or max(size, start) >= FULL32
        extra = struct.pack("<HHQQQ", 1, 24, size, size, start) if wide else b""
        shown, at = (FULL32, FULL32) if wide else (size, start)
        version = 45 if wide else 20
        local_extra = extra[:2] + struct.pack("<H", 16) + extra[4:20] if wide else b""
        out += LOCAL + struct.pack("<HHHHHIIIHH", version, 0x800, 0, 0, 33, crc, shown, shown, len(raw), len(local_extra)) + raw + local_extra + data
        directory += CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", version, version, 0x800, 0, 0, 33, crc, shown, shown, len(raw), len(extra), 0, 0, 0, 0, at) + raw + extra
    count, size, start = len(members), len(directory), len(out)
    out += directory
    if wide := zip64 or start >= FULL32 or count >= FULL16:
        out += END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, size, start)
        out += LOCATOR + struct.pack("<IQI", 0, start + size, 1)
    count, size, start = (FULL16, FULL32, FULL32) if wide else (count, size, start)
    return bytes(out + END + struct.pack("<HHHHIIH", 0, 0, count, count, size, start, len(comment)) + comment)


def plan_records(pages: DataFrame, least_bytes: int = 0, id_column: str = "page_id", url_column: str = "url",
                 html_column: str = "html") -> DataFrame:
    """(page_id, url, html, refers_to): refers_to is set for pages that revisit an equal payload of a smaller id.

    Payloads are compared by their SHA-256. Only payloads that occur more than once go into the join, so without many of
    them pages are not shuffled. A null html is an empty payload; a null id never becomes the one that others refer to.
    """
    rows = small_batches(pages).select(F.col(f"`{id_column}`").alias("page_id"), F.col(f"`{url_column}`").alias("url"),
                        F.coalesce(F.col(f"`{html_column}`"), F.lit("")).alias("html"))
    key = F.when(F.octet_length("html") >= least_bytes, F.unhex(F.sha2(F.encode("html", "UTF-8"), 256)))
    rows = rows.withColumn(f"{INNER}key", key)
    shared = rows.select("page_id", f"{INNER}key").filter(F.col(f"{INNER}key").isNotNull()).groupBy(f"{INNER}key").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = keyed_join(rows, shared, f"{INNER}key", "left")
    return joined.select("page_id", "url", "html", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))


def write_packages(planned: DataFrame, folder: str | None = None, package_bytes: int = PACKAGE_BYTES, zip64: bool = False) -> str:
    """Write planned pages as ZIP packages below `folder` (default: a new one in the shared folder); returns it.

    Each task packs its rows into packages of about `package_bytes`: WARC records, each a gzip member of its own, in one stored
    member, and an index of their ranges in another. Spark's text writer commits the files, one row per file, so a failed task
    leaves nothing and any file system that Spark writes to will do; the line feed it adds is the comment of the ZIP file.
    """
    spark = planned.sparkSession
    if folder is None:
        folder = new_folder(spark, "llm-warc")
        fs, path = files._path(spark, folder)
        fs.deleteOnExit(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, index = bytearray(), []

        def close():
            content = package([(WARC_MEMBER, bytes(data)), (INDEX_MEMBER, "".join(index).encode())], b"\n", zip64)[:-1]
            data.clear()
            index.clear()
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                record = gzip.compress(warc_record(page_id, url, html.encode(), refers_to), mtime=0)
                index.append(json.dumps({"record": _name(page_id), "offset": len(data), "length": len(record), "filename": WARC_MEMBER}) + "\n")
                data += record
                if len(data) >= package_bytes:
                    yield close()
        if data:
            yield close()

    packed = planned.select("page_id", "url", "html", "refers_to").mapInArrow(run, "content binary")
    packed.select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).text(folder)
    return folder


# --- reading -------------------------------------------------------------------------------------------------------

Read = Callable[[int, int], bytes]


class Member(NamedTuple):
    name: str
    method: int
    size: int
    header: int


def members(read: Read, size: int) -> list[Member]:
    """The central directory of a ZIP file, ZIP64 included, from its last bytes."""
    tail_at = max(0, size - 22 - FULL16 - 20)
    tail = read(tail_at, size - tail_at)
    end = len(tail)
    while (end := tail.rfind(END, 0, end)) >= 0:
        if end + 22 <= len(tail) and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail):
            break
    else:
        raise ValueError("not a ZIP file")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if end >= 20 and tail[end - 20:end - 16] == LOCATOR:
        at = struct.unpack_from("<Q", tail, end - 12)[0]
        wide = read(at, 56)
        if wide[:4] != END64:
            raise ValueError("the ZIP64 directory is not where its locator says")
        count, length, start = struct.unpack_from("<QQQ", wide, 32)
    directory, at, out = read(start, length), 0, []
    for _ in range(count):
        if directory[at:at + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, full, n, m, c = struct.unpack_from("<IIHHH", directory, at + 20)
        header, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46:at + 46 + n].decode()
        extra, p = directory[at + 46 + n:at + 46 + n + m], 0
        while p + 4 <= len(extra):
            tag, width = struct.unpack_from("<HH", extra, p)
            if tag == 1:  # 64-bit values of the fields that are full, in this order
                q = p + 4
                if full == FULL32:
                    q += 8
                if packed == FULL32:
                    packed, q = struct.unpack_from("<Q", extra, q)[0], q + 8
                if header == FULL32:
                    header, = struct.unpack_from("<Q", extra, q)
            p += 4 + width
        out.append(Member(name, method, packed, header))
        at += 46 + n + m + c
    return out


def data_start(read: Read, member: Member) -> int:
    head = read(member.header, 30)
    if head[:4] != LOCAL:
        raise ValueError(f"no local header of {member.name}")
    return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))


def scan_ranges(read: Read, start: int, size: int, step: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(offset, length) of the gzip members of an archive without an index, from one pass over it."""
    at, begun, inflate, rest = 0, 0, zlib.decompressobj(31), b""
    while at < size or rest:
        if not rest:
            rest = read(start + at, min(step, size - at))
            at += len(rest)
        inflate.decompress(rest)
        rest = inflate.unused_data
        if inflate.eof:
            yield begun, at - len(rest) - begun
            begun, inflate = at - len(rest), zlib.decompressobj(31)


def scan_plain(read: Read, start: int, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of the records of an archive that is not compressed, from their heads alone."""
    at = 0
    while at < size:
        gap = read(start + at, min(64, size - at))
        if rest := len(gap) - len(gap.lstrip(b"\r\n")):  # line ends between records
            at += rest
            continue
        head, window = gap, 4096
        while b"\r\n\r\n" not in head and len(head) < size - at:
            head, window = read(start + at, min(window, size - at)), window * 4
        end = head.find(b"\r\n\r\n")
        if end < 0:
            raise ValueError("a record without an end of its head")
        length = min(end + 4 + int(_fields(head[:end])["content-length"]), size - at)
        yield at, length
        at += length


def _indexed(read: Read, found: dict[str, Member], archives: dict[str, Member]) -> dict[str, set[tuple[int, int]]]:
    """(offset, length) by archive member, as the stored index members name them; lines that name no range or another archive say nothing."""
    names = {**{n.rpartition("/")[2]: n for n in archives}, **{n: n for n in archives}}
    out: dict[str, set[tuple[int, int]]] = {n: set() for n in archives}
    for m in found.values():
        if not (m.name.startswith("indexes/") and m.name.endswith((".cdxj", ".cdx")) and not m.method):
            continue
        for line in read(data_start(read, m), m.size).splitlines():
            try:
                entry = json.loads(line[line.index(b"{"):])
                name, offset, length = names[entry["filename"]], int(entry["offset"]), int(entry["length"])
            except (ValueError, KeyError, TypeError):
                continue
            if 0 <= offset and 0 < length and offset + length <= archives[name].size:
                out[name].add((offset, length))
    return out


def record_ranges(read: Read, size: int) -> Iterator[tuple[int, int]]:
    """(offset in the file, length) of every record of the stored archive members, each once, in order.

    Ranges that an index names are taken from it; what lies between them is read through, so that records an index leaves out are found as well.
    """
    found = {m.name: m for m in members(read, size)}
    archives = {m.name: m for m in found.values() if m.name.startswith("archive/") and m.name.endswith((".warc.gz", ".warc"))}
    for m in archives.values():
        if m.method:
            raise ValueError(f"{m.name} is compressed; ranges can be read from stored members only")
    indexed = _indexed(read, found, archives)
    for name, m in archives.items():
        start, at = data_start(read, m), 0
        scan = scan_ranges if name.endswith(".gz") else scan_plain
        for offset, length in [*sorted(indexed[name]), (m.size, 0)]:
            if offset > at:
                for o, n in scan(read, start + at, offset - at):
                    yield start + at + o, n
            if length and offset >= at:  # a range inside another one is no record of its own
                yield start + offset, length
            at = max(at, offset + length)


def _fields(head: bytes) -> dict[str, str]:
    """The named fields of a head, names in lower case; lines that begin with a space go on with the field before."""
    fields: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
        elif ":" in line:
            last, _, value = line.partition(":")
            last = last.strip().lower()
            fields[last] = value.strip()
    return fields


PAGE = "<urn:x-page:"


def parse_record(raw: bytes) -> dict:
    """A WARC record of any kind (gzip member or plain): its id and page id, payload, and the digest that the payload really has.

    The payload of a record with an HTTP head is what follows that head, of another the whole block. A SHA-1 that the record states has to
    agree. `page_id` and `refers_to` are the texts of ids that this writer gives, null for other records, whose ids stand in `record_id`.
    """
    raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
    head, _, body = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    kind, record_id = fields.get("warc-type", "").lower(), fields.get("warc-record-id")
    block = body[:int(fields["content-length"])]
    http = block[:5].upper() == b"HTTP/" or (kind == "request" and b" HTTP/" in block.partition(b"\r\n")[0])
    http_head, _, rest = block.partition(b"\r\n\r\n")
    payload, http_fields = (rest, _fields(http_head)) if http else (block, {})
    said = fields.get("warc-payload-digest", "")
    said = said.partition(":")[2].upper() if said.lower().startswith("sha1:") else None
    own = (record_id or "").startswith(PAGE)
    length = http_fields.get("content-length", "")
    whole = kind != "revisit"
    if whole and ((said and digest(payload) != said) or (own and length and len(payload) != int(length))):
        raise ValueError(f"payload of {record_id} is not what its record says")

    def page(value: str | None) -> str | None:
        return value[len(PAGE):].removesuffix(">") or None if value and value.startswith(PAGE) else None

    size = len(payload) if whole else int(length) if length.isdecimal() else None
    return {"page_id": page(record_id), "url": fields.get("warc-target-uri"), "record_type": kind, "payload_bytes": size,
            "payload_digest": said if not whole else said or digest(payload), "refers_to": page(fields.get("warc-refers-to")),
            "payload": payload if whole else None, "record_id": record_id}


#: File systems of which pyarrow can read ranges; of others Spark hands over whole packages, and ranges are cut in memory.
RANGED = {"file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss"}
RECORD = {"page_id": "long", "url": "string", "record_type": "string", "payload_bytes": "long", "payload_digest": "string",
          "refers_to": "long", "payload": "binary", "record_id": "string"}


def _opened(path: str):
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    fs, name = pyarrow.fs.FileSystem.from_uri(path)
    return fs.open_input_file(name)


def read_packages(spark: SparkSession, folder: str, columns: tuple[str, ...] = tuple(RECORD), id_type: str = "long") -> DataFrame:
    """One row per WARC record of the packages below `folder`, with the given columns of RECORD.

    `page_id` and `refers_to` are of `id_type`, long or string: the type of the ids that were written. They are null where a record of another
    writer has none (or no number); every record has its `record_id`.

    A package is one unit of work: its directory and index are read from its end, then the records by their ranges, one at
    a time. Nothing is extracted. `payload` is null for revisits; payload_bytes and payload_digest are those of the full
    payload. A payload that differs from its digest, and a compressed archive member, are errors.
    """
    found = spark.read.format("binaryFile").load(folder).filter("length > 0")
    scheme = files._path(spark, folder)[0].getUri().getScheme()
    found = found.select("path", "length") if scheme in RANGED else found.select("path", "length", "content")
    kinds = {**RECORD, "page_id": id_type, "refers_to": id_type}
    types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[kinds[c]] for c in columns]

    def typed(record: dict) -> list:
        if id_type == "long":
            for c in ("page_id", "refers_to"):
                text = record[c]
                record[c] = int(text) if text and re.fullmatch(r"-?[0-9]{1,19}", text) else None
        return [record[c] for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path, size = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if batch.num_columns > 2:
                    whole = pa.BufferReader(batch.column(2)[i].as_buffer())
                else:
                    whole = _opened(path)
                with whole as file:
                    def read(offset, length):
                        return file.read_at(length, offset)

                    rows, held = [], 0
                    for offset, length in record_ranges(read, size):
                        record = parse_record(read(offset, length))
                        rows.append(typed(record))
                        held += len(record["payload"] or b"") if "payload" in columns else 100
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], list(columns))
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], list(columns))

    return found.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in columns))
