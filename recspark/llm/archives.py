"""Legacy web archives (ARC, versions 1 and 2) and their conversion to WARC.

Spark's own sinks and sources move the bytes, so any file system that Spark knows will do: an archive is one file, one
gzip member a record, and ends with one line feed after the last member. Archives are cut at a size, so that the task
that reads one holds little.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.sources.scratch import new_path, written

#: Uncompressed bytes after which a new archive begins; one record may be longer.
ARCHIVE_BYTES = 4 * 2**20
#: Payloads below this many bytes are never stored as revisits.
REVISIT_BYTES = 100
#: Revisits that may be broadcast to where payloads are; more are joined by shuffle. A row takes some 200 bytes, so 40 MB.
BROADCAST_REVISITS = 200_000
#: Slots that the records which refer to one original are dealt to when it is looked up.
REFER_SLOTS = 16
LEVEL = 6

# Fixed values of the formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(content: bytes) -> Iterator[bytes]:
    """The members of a gzip file, uncompressed; a file that isn't compressed is one."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    while content[:2] == b"\x1f\x8b":
        z = zlib.decompressobj(31)
        yield z.decompress(content) + z.flush()
        content = z.unused_data


def _bundles(records: Iterator, first, form=lambda record, offset: record) -> Iterator[bytes]:
    """Archives of whole records; ``first(n)`` opens the n-th, ``form`` makes a record's bytes at an offset in it."""
    parts, held, n = [], 0, 0
    for r in records:
        if not parts:
            parts, held = [_member(first(n))], 0
            n += 1
        data = form(r, held)
        parts.append(_member(data))
        held += len(data)
        if held >= ARCHIVE_BYTES:
            yield b"".join(parts)
            parts = []
    if parts:
        yield b"".join(parts)


def _write(contents: DataFrame, path: str) -> None:
    # the text sink writes a string's bytes as they are, whatever they encode
    contents.select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def _chunks(contents: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    for c in contents:
        yield pa.record_batch([pa.array([c], pa.binary())], names=["content"])


# ---- ARC


def _arc_name(url: str | None) -> str:
    return quote(url, safe="/:?#[]@!$&'()*+,;=%-._~") if url else "-"


def _arc_date(first: datetime, page_id: int | None) -> str:
    return (first + timedelta(seconds=(page_id or 0) % (366 * 86_400))).strftime("%Y%m%d%H%M%S")


def _arc_records(batches: Iterator[pa.RecordBatch], first: datetime) -> Iterator[tuple]:
    for b in batches:
        for page_id, url, html in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
            payload = (html or "").encode()
            named = f"X-Page-Id: {page_id}\r\n" if page_id is not None else ""
            head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{named}\r\n".encode()
            yield _arc_name(url), _arc_date(first, page_id), head + payload


def write_arc(pages: DataFrame, path: str, date: str = "20240101000000") -> None:
    """Archives of ``pages`` (page_id, url, html) under ``path``, in turn of version 1 and 2.

    Pages have no date of their own: a record's is ``date`` and as many seconds as its page_id says, within a leap year.
    A null html is an empty payload, a null url the name ``-``; a null page_id leaves its header out and counts as 0.
    """
    opened = datetime.strptime(date, "%Y%m%d%H%M%S")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {"version": 1}

        def first(n: int) -> bytes:
            at["version"] = v = n % 2 + 1
            text = f"{v} 0 recspark\n{ARC_FIELDS[v]}\n\n"
            extra = "200 - - 0 - " if v == 2 else ""
            return f"filedesc://part.arc 0.0.0.0 {date} text/plain {extra}{len(text)}\n{text}\n".encode()

        def line(record: tuple, offset: int) -> bytes:
            name, when, block = record
            extra = f"200 - - {offset} - " if at["version"] == 2 else ""
            return f"{name} 0.0.0.0 {when} text/html {extra}{len(block)}\n".encode() + block + b"\n"

        yield from _chunks(_bundles(_arc_records(batches, opened), first, line))

    _write(pages.select("page_id", "url", "html").mapInArrow(run, "content binary"), path)


def parse_arc(content: bytes) -> Iterator[dict]:
    """The records of one archive: url, ip, date, content_type, block. Header lines follow the version that the archive declares."""
    fields: list[str] | None = None
    for data in members(content):
        at = 0
        while at < len(data):
            if data[at : at + 1] == b"\n":  # between records
                at += 1
                continue
            end = data.index(b"\n", at)
            line = data[at:end].decode("utf-8", "surrogateescape")
            if line.startswith("filedesc://"):
                length = int(line.rsplit(" ", 1)[1])
                head = data[end + 1 : end + 1 + length].split(b"\n")
                version = int(head[0].split(b" ")[0])
                fields = ARC_FIELDS[version].split(" ")
                at = end + 1 + length
                continue
            if fields is None:
                raise ValueError("an ARC archive must open with its version block")
            got = dict(zip(fields, line.rsplit(" ", len(fields) - 1), strict=True))
            length = int(got["Archive-length"])
            yield {"url": got["URL"], "ip": got["IP-address"], "date": got["Archive-date"], "content_type": got["Content-type"], "block": data[end + 1 : end + 1 + length]}
            at = end + 1 + length


def _http(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """Head with its blank line, its fields in lower case, and payload of an HTTP message."""
    head, mark, payload = block.partition(b"\r\n\r\n")
    if not mark:
        return b"", {}, block
    named = (x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:])
    return head + mark, {k.strip().lower(): v.strip() for k, _, v in named}, payload


ARC_ROWS = "page_id long, url string, ip string, date string, head binary, digest string, n_bytes long, payload binary"


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per archived record; without ``payloads`` these are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows = []
                for r in parse_arc(content.as_py()):
                    head, named, payload = _http(r["block"])
                    page = named.get("x-page-id")
                    rows.append((int(page) if page else None, r["url"], r["ip"], r["date"], head, hashlib.sha256(payload).hexdigest(), len(payload), payload if payloads else None))
                types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.binary()]
                cols = list(zip(*rows, strict=True)) or [[] for _ in types]
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=[x.split(" ")[0] for x in ARC_ROWS.split(", ")])

    return _read(spark, path).mapInArrow(run, ARC_ROWS)


# ---- WARC


def record_id(page_id: int | None, digest: str) -> str:
    """An identifier that the page and its payload decide, so that a second run writes the same."""
    return str(uuid.UUID(bytes=hashlib.sha256(f"{page_id}|{digest}".encode()).digest()[:16], version=5))


def _warc(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    named = [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in named) + "\r\n").encode("utf-8", "surrogateescape") + block + b"\r\n\r\n"


def _warc_records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    for b in batches:
        for r in b.to_pylist():
            d = r["date"]
            fields = [
                ("WARC-Record-ID", f"<urn:uuid:{record_id(r['page_id'], r['digest'])}>"),
                ("WARC-Date", f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"),
                ("WARC-Target-URI", r["url"]),
                ("WARC-IP-Address", r["ip"]),
                ("Content-Type", "application/http; msgtype=response"),
                ("WARC-Payload-Digest", f"sha256:{r['digest']}"),
            ]
            if r["refers_to"] is None:
                yield _warc("response", fields, r["head"] + r["payload"])
            else:
                fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:uuid:{record_id(r['refers_to'], r['digest'])}>")]
                yield _warc("revisit", fields, r["head"])


def with_originals(records: DataFrame, narrow: DataFrame) -> DataFrame:
    """``records`` with refers_to, found from ``narrow``, the same rows without payloads: the smallest page_id of equal payloads of at least REVISIT_BYTES, null where that is the record's own.

    Copies are counted per payload before anything is shuffled, and the payloads are dealt by record, so that a payload
    that many pages share fills no task. Without any page_id all are originals, and so are repeated rows of the first.
    """
    narrow = narrow.where(F.col("n_bytes") >= REVISIT_BYTES).select("page_id", "digest").distinct()
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("original"))
    revisits = narrow.join(first, "digest").where("original is not null and not (page_id <=> original)")
    key = F.xxhash64("page_id", "digest")
    revisits = revisits.select(key.alias("__key"), F.col("page_id").alias("__page"), F.col("digest").alias("__digest"), F.col("original").alias("refers_to"))
    revisits = written(revisits, "revisits")
    if revisits.count() <= BROADCAST_REVISITS:
        revisits = F.broadcast(revisits)
    same = (F.col("__record") == F.col("__key")) & F.col("page_id").eqNullSafe(F.col("__page")) & (F.col("digest") == F.col("__digest"))
    return records.withColumn("__record", key).join(revisits, same, "left").drop("__record", "__key", "__page", "__digest")


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """Converts the archives under ``arc_path``: identifiers, dates, types and digests are made from what the ARC headers say."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info = b"software: recspark\r\nformat: WARC File Format 1.1\r\n"
        fields = [("WARC-Record-ID", f"<urn:uuid:{record_id(None, 'warcinfo')}>"), ("WARC-Date", "2024-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")]
        yield from _chunks(_bundles(_warc_records(batches), lambda n: _warc("warcinfo", fields, info)))

    # reading the archives twice costs less than a third copy of all payloads on disk
    narrow = written(read_arc(spark, arc_path, payloads=False).select("page_id", "digest", "n_bytes"), "arc-records")
    _write(with_originals(read_arc(spark, arc_path), narrow).mapInArrow(run, "content binary"), warc_path)


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields in lower case, block) of each record of an archive, by declared lengths."""
    for data in members(content):
        at = 0
        while data[at : at + 5] == b"WARC/":
            end = data.index(b"\r\n\r\n", at)
            lines = data[at:end].decode("utf-8", "surrogateescape").split("\r\n")[1:]
            fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            length = int(fields["content-length"])
            yield fields, data[end + 4 : end + 4 + length]
            at = end + 4 + length + 4


WARC_ROWS = "record_id string, record_type string, page_id long, url string, date string, payload_bytes long, payload_digest string, refers_to_id string"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row per response or revisit record. A response's length and digest are those of the payload that was read; a revisit's are declared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows = []
                for f, block in parse_warc(content.as_py()):
                    if f["warc-type"] not in ("response", "revisit"):
                        continue
                    _, named, payload = _http(block)
                    whole = f["warc-type"] == "response"
                    page = named.get("x-page-id")
                    rows.append((
                        f["warc-record-id"], f["warc-type"], int(page) if page else None, f["warc-target-uri"], f["warc-date"],
                        len(payload) if whole else int(named["content-length"]),
                        hashlib.sha256(payload).hexdigest() if whole else f["warc-payload-digest"].partition(":")[2],
                        f.get("warc-refers-to"),
                    ))
                types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
                cols = list(zip(*rows, strict=True)) or [[] for _ in types]
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=[x.split(" ")[0] for x in WARC_ROWS.split(", ")])

    return _read(spark, path).mapInArrow(run, WARC_ROWS)


def archived_pages(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of ``pages``, from WARC archives that were converted from ARC and read back.

    One row per row of ``pages``; null and empty html have an empty payload, and an empty table gives no rows.
    """
    spark = pages.sparkSession
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    write_arc(pages, arc)
    arc_to_warc(spark, arc, warc)
    back = written(read_warc(spark, warc), "warc-records")
    # most records refer to nothing, and many may refer to one: those without reference aren't joined, the others are dealt to slots
    found = back.where("refers_to_id is not null").withColumn("slot", F.pmod(F.xxhash64("record_id", "page_id", "url"), F.lit(REFER_SLOTS)))
    named = back.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    originals = named.join(found.select("refers_to_id").distinct(), "refers_to_id", "left_semi").distinct()
    originals = originals.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(REFER_SLOTS - 1).cast("long"))))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "url", "date"]
    alone = back.where("refers_to_id is null").withColumn("refers_to", F.lit(None).cast("long"))
    return alone.select(*columns).unionByName(found.join(originals, ["refers_to_id", "slot"], "left").select(*columns))
