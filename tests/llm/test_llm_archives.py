import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from starloom.llm import arc_convert as ac

PAGES = "page_id long, url string, html string"


def sha(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def through(spark, scratch, pages, least=0, volume_bytes=ac.VOLUME_BYTES):
    import uuid

    root = f"{scratch.root}/{uuid.uuid4().hex}"
    ac.write_arc(pages, f"{root}/arc", id_col="page_id", url_col="url", text_col="html", date="20010203040506", volume_bytes=volume_bytes)
    ac.convert(spark, f"{root}/arc", f"{root}/warc", scratch, least=least)
    return ac.read_warc(spark, f"{root}/warc", scratch), root


@pytest.mark.parametrize("least", [0, 5, 10**9])
def test_pages_with_equal_and_odd_payloads(spark, scratch, least):
    rows = [
        (5, "http://a/", "same text"), (3, "http://b/ c", "same text"), (9, None, "same text"), (7, "x", None), (2, "y", ""),
        (11, "z", "HTTP/1.0 500\r\n\r\nWARC/1.1\r\n\r\n\n1 2 3 4 5\n"), (12, "é", "\r\n\r\nπ \x00 end\n"), (None, "n", "same text"),
        (13, "http://long/", "<p>long</p>" * 50_000), (14, "q", "tiny"), (15, "q", "tiny"),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in rows], PAGES + ", digest string").repartition(3)
    found, _ = through(spark, scratch, pages, least, volume_bytes=200)
    got = {r.number: r for r in found.collect()}
    assert len(got) == found.count() == len(rows)
    for key, _, html in rows:
        data = (html or "").encode()
        first = min(k for k, _, h in rows if (h or "") == (html or "") and k is not None)
        revisit = len(data) >= least and key != first
        r = got[key]
        assert (r.size, r.digest, r.sound) == (len(data), sha(data), True)
        assert (r.record_type, r.refers_to) == (("revisit", first) if revisit else ("response", None))
        assert r.date == "2001-02-03T04:05:06Z"
    assert got[3].uri == "http://b/%20c" and got[9].uri == "-"


def test_empty_table(spark, scratch):
    found, _ = through(spark, scratch, spark.createDataFrame([], PAGES))
    assert found.count() == 0


def test_another_run_gives_the_same_records(spark, scratch):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"text {i // 2}") for i in range(20)], PAGES).coalesce(1)
    first, again = (sorted(map(tuple, through(spark, scratch, pages)[0].collect())) for _ in range(2))
    assert first == again


V1 = b"""filedesc://old.arc 0.0.0.0 19961231235959 text/plain 68
1 0 Keeper
URL IP-address Archive-date Content-type Archive-length

http://a/ 1.2.3.4 19970101000000 text/html 29
HTTP/1.0 200 OK

\xff\xfebinary\x00end
dns:a 5.6.7.8 1997 text/dns 5
a A 1
this line is no header
http://b/ 1.2.3.4 20019999 text/html; charset=x 9
no header
http://c/ 1.2.3.4 19970101000000 text/html 500
HTTP/1.0 200 OK

cut"""


def test_version_1_with_damage():
    found = list(ac.arc_records(V1))
    assert [r.url for r in found] == ["filedesc://old.arc", "http://a/", "dns:a", "http://b/", "http://c/"]
    assert found[1].content.endswith(b"\xff\xfebinary\x00end") and found[3].kind == "text/html; charset=x"
    assert [r.truncated for r in found] == [False, False, False, False, True]
    records = list(ac.warc_records(ac.converted(V1, {}) + ac.END))
    assert [f["warc-type"] for f, _ in records] == ["warcinfo", "response", "resource", "resource", "response"]
    assert [f["warc-date"] for f, _ in records] == [
        "1996-12-31T23:59:59Z", "1997-01-01T00:00:00Z", "1996-12-31T23:59:59Z", "1996-12-31T23:59:59Z", "1997-01-01T00:00:00Z",
    ]
    assert records[4][0]["warc-truncated"] == "length" and records[1][0]["warc-ip-address"] == "1.2.3.4"
    for (fields, block), old in list(zip(records, found))[1:]:
        assert block == old.content and fields["warc-block-digest"] == f"sha1:{sha(block)}"
    assert len({f["warc-record-id"] for f, _ in records}) == 5


def test_version_2():
    start = ac.arc_start("new.arc", "20020202020202", 2)
    one = ac.arc_record("http://a/", "1.1.1.1", "20030303030303", "text/html", b"HTTP/1.0 404 X\r\n\r\nbody", 2, len(start) + 1, "new.arc", "404")
    found = list(ac.arc_records(start + b"\n" + one + b"\n"))
    assert [(r.version, r.url) for r in found] == [(2, "filedesc://new.arc"), (2, "http://a/")]
    assert found[1].more == {"Result-code": "404"} and found[1].content.endswith(b"body")
    fields, block = list(ac.warc_records(ac.converted(start + b"\n" + one, {})))[1]
    assert fields["x-arc-result-code"] == "404" and fields["warc-payload-digest"] == f"sha1:{sha(b'body')}"


def test_bytes_that_are_no_text_survive_the_text_sink(spark, scratch):
    data = bytes(range(256)) * 3
    rows = spark.createDataFrame([(bytearray(data),)], "volume binary")
    path = f"{scratch.root}/raw-bytes"
    ac._save_volumes(rows, path, "\n")
    assert ac.unzipped(bytes(ac._volumes(spark, path).select(F.col("content")).first()[0])) == data + b"\n"


def line(url, date, length, content):
    return f"{url} 1.2.3.4 {date} text/plain {length}\n".encode() + content + b"\n"


def test_odd_lengths_and_dates_lose_no_record():
    block = b"1 0 x\nURL IP-address Archive-date Content-type Archive-length\n"
    data = line("filedesc://a.arc", "20010203040506", len(block), block)
    data += line("http://a/", "20010203040506", 3, b"abc") + line("http://b/", "-", 2, b"de")
    data += line("http://c/", "20010203040506", "9" * 5_000, b"no length") + line("http://d/", "7", 1, b"f")
    got = list(ac.arc_records(data))[1:]
    assert [(r.url, r.content, r.truncated) for r in got] == [
        ("http://a/", b"abc", False), ("http://b/", b"de", False), ("http://d/", b"f", False)
    ]
    out = list(ac.warc_records(ac.converted(data, {})))[1:]
    assert [f["warc-date"] for f, _ in out] == ["2001-02-03T04:05:06Z"] * 3


def test_damaged_members_keep_what_they_gave_and_the_next_ones_follow():
    import gzip
    import random

    random.seed(3)
    block = b"2 0 x\nURL IP-address Archive-date Content-type Archive-length\n"
    noise = bytes(random.randrange(256) for _ in range(400_000))
    records = [line("filedesc://a.arc", "20010203040506", len(block), block)[:-1].replace(b"2 0 x", b"1 0 x")]
    records += [line("http://a/", "20010203", 3, b"abc"), line("http://b/", "20010203", len(noise), noise), line("http://c/", "20010203", 2, b"de")]
    members = [gzip.compress(r, mtime=0) for r in records]
    whole = b"".join(members)
    assert ac.unzipped(whole) == b"".join(records)
    assert ac.unzipped(b"no gzip") == b"no gzip" and ac.unzipped(b"") == b""
    cut = len(members[2]) // 2
    hurt = members[2][:cut] + bytes(64) + members[2][cut + 64 :]
    got = list(ac.arc_records(ac.unzipped_parts(members[0] + members[1] + hurt + members[3])))[1:]
    assert [(r.url, r.truncated) for r in got] == [("http://a/", False), ("http://b/", True), ("http://c/", False)]
    assert 0 < len(got[1].content) < len(noise) and noise.startswith(got[1].content[:1000]) and got[2].content == b"de"
    short = list(ac.arc_records(ac.unzipped_parts(whole[: len(whole) - len(members[3]) - 100])))[1:]
    assert [(r.url, r.truncated) for r in short] == [("http://a/", False), ("http://b/", True)]
    assert list(ac.arc_records(ac.unzipped_parts(whole + b"junk")))[-1].url == "http://c/"
    # Each record of what is converted is whole.
    out = list(ac.warc_records(ac.converted(ac.unzipped_parts(members[0] + members[1] + hurt + members[3]), {})))
    assert [f.get("warc-truncated") for f, _ in out] == [None, None, "length", None]


def test_size_of_a_revisit_does_not_come_from_its_http_header():
    head = b"HTTP/1.0 200 OK\r\nContent-Length: 999\r\n\r\n"
    block = b"1 0 x\nURL IP-address Archive-date Content-type Archive-length\n"
    data = line("filedesc://a.arc", "20010203040506", len(block), block) + line("http://a/", "20010203", len(head) + 5, head + b"tiny!")
    offset = list(ac.arc_records(data))[1].offset
    fields, _ = list(ac.warc_records(ac.converted(data, {offset: ("revisit", "<urn:uuid:1>", "http://z/", "x")})))[1]
    assert fields["x-payload-length"] == "5"
