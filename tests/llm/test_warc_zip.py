"""ZIP packages of WARC records: round trips, Python's zipfile as a second opinion, edge cases."""

import base64
import glob
import gzip
import hashlib
import io
import random
import zipfile

import pytest

from tidemark.llm import warc_zip
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, first long, content string"


def sha1(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def expected(rows):
    first = {}
    for i, _, h in rows:
        h = h or ""
        if i is not None and (h not in first or i < first[h]):
            first[h] = i
    out = []
    for i, _, h in rows:
        h = h or ""
        response = first.get(h) == i
        out.append((i, len(h.encode()), sha1(h), "response" if response else "revisit", None if response else first[h]))
    return sorted(out, key=repr)


def test_query(spark):
    got = QUERIES["op8_warc_zip"](spark, SMALL)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    pages = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(pages)


def test_cases(spark):
    rows = [(5, "http://a/ b\r\nX: y", "same"), (3, None, "same"), (None, "http://é/", "same"), (9, "", None), (8, "u", ""),
            (1, "u", "\r\n\r\nWARC/1.1\r\n"), (2, "u", "日本 PK\x05\x06" * 30_000), (7, "u", "one"), (7, "u", "one")]
    pages = spark.createDataFrame([(*r, 1, "c") for r in rows], SCHEMA).repartition(2)
    for size, wide in ((1, False), (1 << 20, True)):
        folder = warc_zip.write_packages(warc_zip.plan_records(pages), package_bytes=size, zip64=wide)
        out = warc_zip.read_packages(spark, folder).collect()
        assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out), key=repr) == expected(rows)
        assert {r.page_id: r.payload.decode() for r in out if r.record_type == "response"} == {
            3: "same", 8: "", 1: rows[5][2], 2: rows[6][2], 7: "one"}
        assert {r.page_id: r.url for r in out}[5] == "http://a/%20b%0D%0AX:%20y"
        names = glob.glob(folder.removeprefix("file:") + "/part-*")
        assert len(names) >= (len(rows) if size == 1 else 1)
        for name in names:
            with zipfile.ZipFile(name) as z:
                assert z.testzip() is None
                assert z.namelist() == [warc_zip.WARC_MEMBER, warc_zip.INDEX_MEMBER]
                assert gzip.decompress(z.read(warc_zip.WARC_MEMBER)).startswith(b"WARC/1.1\r\n")


def test_small_payloads_are_all_responses_below_the_bound(spark):
    pages = spark.createDataFrame([(1, "u", "ab", 0, ""), (2, "u", "ab", 0, ""), (3, "u", "abc", 0, ""), (4, "u", "abc", 0, "")], SCHEMA)
    got = {r.page_id: r.refers_to for r in warc_zip.plan_records(pages, least_bytes=3).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}


def test_empty(spark):
    folder = warc_zip.write_packages(warc_zip.plan_records(spark.createDataFrame([], SCHEMA)))
    assert warc_zip.read_packages(spark, folder).count() == 0


def reader(raw):
    return lambda offset, length: raw[offset:offset + length]


@pytest.mark.parametrize("wide", [False, True])
def test_directories_of_another_writer(wide):
    records = [gzip.compress(warc_zip.warc_record(i, f"u{i}", b"x" * i)) for i in range(20)]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"PK\x05\x06 comment"
        z.writestr("datapackage.json", "{}" * 40, zipfile.ZIP_DEFLATED)
        with z.open("archive/a.warc.gz", "w", force_zip64=wide) as f:
            f.write(b"".join(records))
    raw = out.getvalue()
    got = [warc_zip.parse_record(raw[o:o + n]) for o, n in warc_zip.record_ranges(reader(raw), len(raw))]
    assert [r["page_id"] for r in got] == [str(i) for i in range(20)] and [r["payload"] for r in got] == [b"x" * i for i in range(20)]


def test_ranges_are_the_only_reads():
    rng = random.Random(0)
    records = [gzip.compress(warc_zip.warc_record(i, "u", rng.randbytes(20_000))) for i in range(50)]
    raw = warc_zip.package([("archive/a.warc.gz", b"".join(records))], zip64=True)
    starts = [o for o, _ in warc_zip.record_ranges(reader(raw), len(raw))]
    assert len(starts) == 50
    index = "".join('{"filename": "archive/a.warc.gz", "offset": %d, "length": %d}\n' % (o - starts[0], len(r)) for o, r in zip(starts, records))
    raw = warc_zip.package([("archive/a.warc.gz", b"".join(records)), ("indexes/i.cdxj", index.encode())], zip64=True)
    reads = []

    def read(offset, length):
        reads.append(length)
        return raw[offset:offset + length]

    assert len(list(warc_zip.record_ranges(read, len(raw)))) == 50
    assert sum(reads) < 100_000 < len(raw)


def test_bad_files_are_errors():
    with pytest.raises(ValueError, match="not a ZIP"):
        warc_zip.members(reader(b"x" * 100), 100)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/a.warc.gz", b"a" * 100)
    raw = out.getvalue()
    with pytest.raises(ValueError, match="compressed"):
        list(warc_zip.record_ranges(reader(raw), len(raw)))
    record = warc_zip.warc_record(1, "u", b"payload").replace(b"\r\n\r\npayload", b"\r\n\r\nPayload")
    with pytest.raises(ValueError, match="payload"):
        warc_zip.parse_record(gzip.compress(record))


def foreign(kind, block, **fields):
    names = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in fields.items())
    return b"WARC/1.0\r\nwarc-type: " + kind.encode() + b"\r\n" + names.encode() + b"content-length:" + str(len(block)).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def foreign_records():
    page = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-Folded: a\r\n b\r\n\r\n<html>"
    return [foreign("warcinfo", b"software: other\r\n", warc_record_id="<urn:uuid:1>"),
            foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", WARC_Record_ID="<urn:uuid:2>", WARC_Target_URI="http://a/"),
            foreign("response", page, Warc_Record_Id="<urn:uuid:3>", warc_target_uri="http://a/", WARC_Payload_Digest="sha1:" + sha1("<html>")),
            foreign("resource", b"plain \x00 block", WARC_Record_ID="urn:any:4", WARC_Payload_Digest="sha256:abc"),
            foreign("revisit", b"HTTP/1.1 200 OK\r\n\r\n", WARC_Record_ID="<urn:uuid:5>", WARC_Refers_To="<urn:uuid:3>"),
            foreign("metadata", b"", WARC_Record_ID="<urn:uuid:6>")]


WANT = [("<urn:uuid:1>", "warcinfo", b"software: other\r\n"), ("<urn:uuid:2>", "request", b""), ("<urn:uuid:3>", "response", b"<html>"),
        ("urn:any:4", "resource", b"plain \x00 block"), ("<urn:uuid:5>", "revisit", None), ("<urn:uuid:6>", "metadata", b"")]


@pytest.mark.parametrize("named", [[], [0], [1, 3], [2, 2, 5], [0, 1, 2, 3, 4, 5]], ids=str)
@pytest.mark.parametrize("packed", [True, False])
def test_records_of_other_writers(spark, named, packed):
    """No record is lost or read twice, whichever of them the indexes name."""
    records = [gzip.compress(r) if packed else r for r in foreign_records()]
    name = "a.warc.gz" if packed else "a.warc"
    starts = [sum(map(len, records[:i])) for i in range(len(records))]
    sizes = [len(r) if packed else len(r) - 4 for r in records]
    line = lambda i: 'com,a)/ 2024 {"url": "u", "filename": "%s", "offset": "%d", "length": "%d"}\n' % (name, starts[i], sizes[i])
    index = "".join(map(line, named)) + 'broken\n{"filename": "other.warc.gz", "offset": "0", "length": "9"}\n{"url": "no range"}\n'
    raw = warc_zip.package([("archive/" + name, b"".join(records)), ("indexes/index.cdxj", index.encode()), ("indexes/second.cdxj", index.encode()),
                            ("indexes/index.idx", b"!meta"), ("pages/pages.jsonl", b"{}")])
    folder = warc_zip.new_folder(spark, "foreign")
    path = folder.removeprefix("file:")
    __import__("os").makedirs(path)
    with open(path + "/package.wacz", "wb") as f:
        f.write(raw)
    out = warc_zip.read_packages(spark, folder).collect()
    assert [(r.record_id, r.record_type, None if r.payload is None else bytes(r.payload)) for r in out] == WANT
    assert all(r.page_id is None and r.refers_to is None for r in out)
    assert out[2].payload_digest == sha1("<html>") and out[2].url == "http://a/"


def test_ids_of_any_text(spark):
    rows = [("a/1", "u", "same"), ("ä b>", "u", "same"), ("7", "u", "other"), (None, "u", "none")]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    folder = warc_zip.write_packages(warc_zip.plan_records(pages))
    got = {(r.page_id, r.record_type, r.refers_to) for r in warc_zip.read_packages(spark, folder, id_type="string").collect()}
    assert {g for g in got if g[0]} == {("7", "response", None), ("a/1", "response", None), ("ä b>", "revisit", "a/1")}
