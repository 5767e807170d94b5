"""Converts ARC archives of both versions to WARC, and reads WARC archives.

An ARC archive begins with a version block, which tells how the header lines of its records read; each
record is a header line, with the declared length of what follows, and that content. The converter parses these
lines and lengths and makes equivalent WARC records: an identifier from the archive's declared name and the
record's offset, so that another run gives the same one; the date; the type (the version block becomes warcinfo, an HTTP message
response, all else resource); and the digests of block and payload.

Of records with equal payloads of at least ``least`` bytes, the first is kept, and the others become revisits
that refer to it and hold its HTTP header only. First is the one with the smallest number in the header
``order_header``; records without that number come last, by archive and offset.

Archives are volumes of bounded size, each a row when written and a row when read, in the text and binary sources of Spark,
so any shared folder will do. The payloads meet what is decided about them by volume: only packed volumes are
shuffled, whatever the number of equal payloads.

A header line that does not parse, or declares a length of more than 18 digits, is skipped up to the next line that does. Content
that ends before its declared length, also within a damaged gzip member, is kept and marked truncated. A date that is no date, or
missing (``-``), becomes that of the version block, or the first of 1970. Null texts are empty, null addresses are the address ``-``, white space in an address is escaped.
"""

from __future__ import annotations

import re
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime
from hashlib import sha1
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.workspace import Workspace

VOLUME_BYTES = 16_000_000
ORDER_HEADER = "X-Page-Id"
#: The field names of the two versions of ARC, and the profile of a revisit.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def digest(data: bytes) -> str:
    return b32encode(sha1(data).digest()).decode()


def record_id(name: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=sha1(f'{name} {offset}'.encode()).digest()[:16], version=5)}>"


def iso_date(digits: str, otherwise: str = "1970-01-01T00:00:00Z") -> str:
    try:
        return datetime.strptime(digits[:14].ljust(14, "0"), "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return otherwise


# ARC.


@dataclass
class ArcRecord:
    offset: int
    version: int
    url: str
    ip: str
    date: str
    kind: str
    content: bytes
    truncated: bool
    more: dict[str, str] = field(default_factory=dict)


#: A longer length is none. A date may be missing.
_LENGTH, _DATE = re.compile("[0-9]{1,18}"), re.compile("[0-9]+|-")


def _header(line: bytes, version: int) -> tuple[dict[str, str], int] | None:
    """The fields of a header line, and the declared length; a content type may hold spaces."""
    names, words = FIELDS[version].split(" "), line.decode("utf-8", "replace").split(" ")
    if len(words) < len(names) or not words[0] or not _LENGTH.fullmatch(words[-1]) or not _DATE.fullmatch(words[2]):
        return None
    behind = len(names) - 4
    values = [*words[:3], " ".join(words[3 : len(words) - behind]), *words[len(words) - behind :]]
    return dict(zip(names, values)), int(words[-1])


def arc_records(data: bytes | list[bytes]) -> Iterator[ArcRecord]:
    """The records of an archive, the version block first; its second line tells the version of what follows.

    Between the parts of an archive, something is lost: no record goes on from one to the next.
    """
    before, version = 0, 1
    for part in [data] if isinstance(data, bytes) else data:
        for record in _records(part, before, version):
            version = record.version
            yield record
        before += len(part)


def _records(data: bytes, before: int, version: int) -> Iterator[ArcRecord]:
    at = 0
    while at < len(data):
        stop = data.find(b"\n", at)
        stop = len(data) if stop < 0 else stop
        line = data[at:stop].rstrip(b"\r")
        is_block = line.startswith(b"filedesc:")
        found = None
        if is_block:
            told = data[stop + 1 : stop + 3]
            version = 2 if told.startswith(b"2") else 1
            found = _header(line, version) or _header(line, 3 - version)
        elif line:
            found = _header(line, version)
        if found is None:
            at = stop + 1
            continue
        values, length = found
        content = data[stop + 1 : stop + 1 + length]
        yield ArcRecord(
            before + at,
            version,
            values["URL"],
            values["IP-address"],
            values["Archive-date"],
            values["Content-type"],
            content,
            len(content) < length,
            {k: v for k, v in values.items() if k in ("Result-code", "Checksum", "Location") and v != "-"},
        )
        at = stop + 1 + length


def arc_record(url: str, ip: str, date: str, kind: str, content: bytes, version: int, offset: int, name: str, code: str = "200") -> bytes:
    between = [] if version == 1 else [code, "-", "-", str(offset), name]
    return " ".join([url, ip, date, kind, *between, str(len(content))]).encode() + b"\n" + content


def arc_start(name: str, date: str, version: int) -> bytes:
    """The version block, which ends with an empty line of its own."""
    told = f"{version} 0 starloom\n{FIELDS[version]}\n\n".encode()
    return arc_record(f"filedesc://{name}", "0.0.0.0", date, "text/plain", told, version, 0, name)


def http_message(payload: bytes, headers: list[tuple[str, str]]) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(payload)))])
    return b"HTTP/1.0 200 OK\r\n" + lines.encode() + b"\r\n" + payload


def http_parts(content: bytes) -> tuple[bytes, bytes] | None:
    """Head, with its empty line, and payload of an HTTP message; None if it is none."""
    if not content.startswith(b"HTTP/"):
        return None
    found = re.search(rb"\r?\n\r?\n", content)
    return (content[: found.end()], content[found.end() :]) if found else (content, b"")


def _value(head: bytes, name: str) -> str | None:
    found = re.search(rb"^" + re.escape(name).encode() + rb":[ \t]*(.*?)[ \t]*\r?$", head, re.I | re.M)
    return found[1].decode("utf-8", "replace") if found else None


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?[0-9]{1,19}", text) and -(2**63) <= int(text) < 2**63 else None


#: The first bytes of a gzip member: deflate, and no flag that is not defined.
_MEMBER = re.compile(rb"\x1f\x8b\x08[\x00-\x1f]")
_BYTES_AT_ONCE = 1 << 16


def unzipped_parts(data: bytes) -> list[bytes]:
    """What the members of a gzip file hold, or the data itself if it is no gzip file, in parts without damage.

    Of a damaged member, what comes before the damage ends a part, so that its record ends before its declared length;
    the next member begins another part.
    """
    if not data.startswith(b"\x1f\x8b"):
        return [data]
    parts: list[list[bytes]] = [[]]
    at = 0
    while at < len(data):
        one, now = zlib.decompressobj(31), at
        try:
            while not one.eof and now < len(data):
                parts[-1].append(one.decompress(data[now : now + _BYTES_AT_ONCE]))
                now += _BYTES_AT_ONCE
        except zlib.error:
            pass
        end = min(now, len(data)) - len(one.unused_data) if one.eof else at + 1
        if one.eof and (end == len(data) or _MEMBER.match(data, end)):
            at = end
            continue
        following = _MEMBER.search(data, end)
        at = following.start() if following else len(data)
        parts.append([])
    return [b"".join(p) for p in parts]


def unzipped(data: bytes) -> bytes:
    return b"".join(unzipped_parts(data))


# WARC.


def warc_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """Without the empty lines at its end."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, their names in lower case, and the block of each record."""
    at = data.find(b"WARC/")
    while at >= 0:
        stop = data.find(END, at)
        if stop < 0:
            return
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = _number(fields.get("content-length")) or 0
        yield fields, data[stop + 4 : stop + 4 + length]
        at = data.find(b"WARC/", stop + 4 + length)


def converted(data: bytes | list[bytes], decided: dict[int, tuple[str, str | None, str | None, str | None]]) -> bytes:
    """An ARC archive as WARC; ``decided`` has for an offset the type, and what a revisit refers to."""
    out, name, start = [], "", "1970-01-01T00:00:00Z"
    for r in arc_records(data):
        own = iso_date(r.date, start)
        if r.url.startswith("filedesc:"):
            name, start = r.url.removeprefix("filedesc://"), own
            told = f"software: starloom\r\nformat: WARC File Format 1.1\r\nsource: ARC version {r.version}\r\n".encode()
            ids = [("WARC-Record-ID", record_id(name, r.offset)), ("WARC-Date", own), ("WARC-Filename", name)]
            out.append(warc_record("warcinfo", [*ids, ("Content-Type", "application/warc-fields")], told))
            continue
        headers = [("WARC-Record-ID", record_id(name, r.offset)), ("WARC-Date", own), ("WARC-Target-URI", r.url)]
        if r.ip not in ("", "-"):
            headers.append(("WARC-IP-Address", r.ip))
        http = http_parts(r.content)
        payload = http[1] if http else r.content
        headers.append(("WARC-Payload-Digest", f"sha1:{digest(payload)}"))
        if r.truncated:
            headers.append(("WARC-Truncated", "length"))
        kind, to, to_uri, to_date = decided.get(r.offset, (None, None, None, None))
        kind = kind or ("response" if http else "resource")
        block = r.content
        if kind == "revisit":
            block = http[0] if http else b""
            headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", to or "")]
            headers += [("WARC-Refers-To-Target-URI", to_uri or ""), ("WARC-Refers-To-Date", to_date or "")]
            headers.append(("X-Payload-Length", str(len(payload))))
        headers.append(("WARC-Block-Digest", f"sha1:{digest(block)}"))
        headers += [(f"X-Arc-{k}", v) for k, v in r.more.items()]
        headers.append(("Content-Type", "application/http;msgtype=response" if http else r.kind))
        out.append(warc_record(kind, headers, block))
    return END.join(out)


# On Spark.


def _save_volumes(rows: DataFrame, path: str, separator: str) -> None:
    """One file for each row; a volume is bytes, which the text sink writes as they are, and ends with the separator."""
    volumes = rows.select(F.col("volume").cast("string").alias("value"))
    packed = volumes.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    packed.option("lineSep", separator).option("maxRecordsPerFile", 1).text(path)


def _volumes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def write_arc(pages: DataFrame, path: str, *, id_col: str, url_col: str, text_col: str, date: str, volume_bytes: int = VOLUME_BYTES) -> None:
    """Volumes of one record per row, of ARC version 1 and 2 in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        number, parts, size = 0, [], 0

        def volume() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"\n".join(parts)], pa.binary())], ["volume"])

        for batch in batches:
            for key, url, text in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "text"))):
                if parts and size > volume_bytes:
                    yield volume()
                    number, parts, size = number + 1, [], 0
                version, name = 1 + number % 2, f"{task:06d}-{number:06d}.arc"
                if not parts:
                    parts.append(arc_start(name, date, version))
                    size = len(parts[0]) + 1
                known = [] if key is None else [(ORDER_HEADER, str(key))]
                content = http_message((text or "").encode(), [("Content-Type", "text/html; charset=utf-8"), *known])
                address = quote(url, safe="!#$%&'()*+,/:;=?@[]~|^`{}\"<>\\") if url else "-"
                parts.append(arc_record(address, "0.0.0.0", date, "text/html", content, version, size, name))
                size += len(parts[-1]) + 1
        if parts:
            yield volume()

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(text_col).alias("text"))
    _save_volumes(rows.mapInArrow(run, "volume binary"), path, "\n")


_FOUND = "path string, name string, offset long, uri string, date string, number long, size long, digest string"


def _found(order_header: str):
    """What an ARC volume holds, without the payloads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows, name, start = [], "", "1970-01-01T00:00:00Z"
                for r in arc_records(unzipped_parts(content.as_py())):
                    own = iso_date(r.date, start)
                    if r.url.startswith("filedesc:"):
                        name, start = r.url.removeprefix("filedesc://"), own
                        continue
                    head, payload = http_parts(r.content) or (b"", r.content)
                    number = _number(_value(head, order_header))
                    rows.append((path, name, r.offset, r.url, own, number, len(payload), digest(payload)))
                yield _batch(rows, _FOUND)

    return run


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    names = [x.split(" ") for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(names)], [n for n, _ in names]
    )


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content, decided in zip(batch.column("content"), batch.column("decided").to_pylist()):
            known = {
                d["offset"]: ("revisit", record_id(d["name"], d["first"]), d["uri"], d["date"]) for d in decided or []
            }
            yield pa.RecordBatch.from_arrays([pa.array([converted(unzipped_parts(content.as_py()), known)], pa.binary())], ["volume"])


def convert(spark: SparkSession, arc_path: str, warc_path: str, scratch: Workspace, *, least: int = 0, order_header: str = ORDER_HEADER) -> None:
    """Volume by volume; nothing else of the payloads than their digests is compared."""
    volumes = _volumes(spark, arc_path)
    found = scratch.save(volumes.mapInArrow(_found(order_header), _FOUND), "found")
    order = F.struct(F.col("number").isNull().alias("last"), "number", "name", "offset", "uri", "date")
    firsts = found.where(F.col("size") >= least).groupBy("digest", "size").agg(F.min(order).alias("first"))
    others = found.join(firsts, ["digest", "size"]).where("name != first.name OR offset != first.offset")
    refers = F.struct("offset", "first.name", F.col("first.offset").alias("first"), "first.uri", "first.date")
    # As many as a volume has records.
    decided = others.groupBy("path").agg(F.collect_list(refers).alias("decided"))
    rows = volumes.join(decided.hint("merge"), "path", "left").select("content", "decided")
    _save_volumes(rows.mapInArrow(_convert, "volume binary"), warc_path, END.decode())


_READ = "record_id string, record_type string, uri string, date string, number long, size long, digest string, to string, sound boolean"


def _read(order_header: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for fields, block in warc_records(unzipped(content.as_py())):
                    kind = fields.get("warc-type")
                    if kind not in ("response", "resource", "revisit"):
                        continue
                    head, payload = http_parts(block) or (b"", block)
                    told = (fields.get("warc-payload-digest") or "").removeprefix("sha1:")
                    if kind == "revisit":
                        size = _number(fields.get("x-payload-length") or _value(head, "Content-Length"))
                        own = told
                    else:
                        size, own = len(payload), digest(payload)
                    sound = own == told and fields.get("warc-block-digest") == f"sha1:{digest(block)}"
                    number = _number(_value(head, order_header))
                    rows.append(
                        (
                            fields.get("warc-record-id"), kind, fields.get("warc-target-uri"), fields.get("warc-date"),
                            number, size, own, fields.get("warc-refers-to"), sound,
                        )
                    )
                yield _batch(rows, _READ)

    return run


def read_warc(spark: SparkSession, path: str, scratch: Workspace, *, order_header: str = ORDER_HEADER) -> DataFrame:
    """One row per record, but the warcinfo: record_id, record_type, uri, date, number, size and digest of the payload, sound, refers_to.

    ``refers_to`` is the number of the record that a revisit refers to; ``sound`` tells whether all digests are right.
    """
    rows = scratch.save(_volumes(spark, path).mapInArrow(_read(order_header), _READ), "records")
    whole = rows.where("record_type != 'revisit'").select(F.col("record_id").alias("to"), F.col("number").alias("refers_to"))
    return rows.join(whole, "to", "left").drop("to")
