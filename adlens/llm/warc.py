"""Legacy archive converter: ARC files to WARC files (operator 5).

ARC 1.0 and 2.0 files start with a version block whose second line names the version;
every record then has one header line of space-separated fields, fixed by the version,
whose last field is the declared length of the record's bytes. The converter trusts the
declared length, not the content, and synthesises what WARC needs and ARC lacks:

* WARC-Record-ID: a name-based UUID of (URI, archive date, record place, payload digest),
  the same in every run;
* WARC-Date: the 14-digit archive date as ISO 8601 (a shorter or broken one is filled up
  from the epoch);
* WARC-Type: ``warcinfo`` for the version block, ``response`` for HTTP records,
  ``resource`` for others, ``revisit`` where a decision table says that another record
  holds the same payload;
* WARC-Block-Digest and WARC-Payload-Digest: SHA-1 in base 32, as usual in WARC files.

Whether a payload is a duplicate is decided over all archives: an index job parses the
ARC files, a groupBy finds for every digest the record that keeps it, and the decisions
of one archive travel to the task that converts it. Files are written as gzip members, one
per record, as usual for both formats; plain files and any other cut into members are read too.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import open_file, partitions, staged, write_file
from adlens.session import scratch_path

FIELDS = {  # record header fields by ARC version, in order
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "code", "checksum", "location", "offset", "file", "length"),
}
ARCHIVED = "20250101000000"
PAGE_HEADER = "X-Page-Id"
_CRLF = b"\r\n"
_SPACE = re.compile(r"[\x00-\x20\x7f]")


def gz(data: bytes, level: int = 1) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class Unpacked:
    """The bytes of an archive read forwards: a plain file, or one or many gzip members in turn
    (one per record as usual, several records in one, or a record over several)."""

    def __init__(self, f, chunk: int = 1 << 18):
        self.f, self.chunk = f, chunk
        self.held, self.pos, self.base = b"", 0, 0  # unpacked bytes, next one, place of the first
        self.raw = f.read(chunk)
        self.zipped, self.z = self.raw[:2] == b"\x1f\x8b", None

    @property
    def at(self) -> int:
        """Place of the next byte in the unpacked archive."""
        return self.base + self.pos

    def _piece(self) -> bytes | None:
        """Some more unpacked bytes (none at the end)."""
        while True:
            if not self.raw:
                self.raw = self.f.read(self.chunk)
                if not self.raw:
                    if self.z is not None:
                        raise ValueError("archive cut off inside a record")
                    return None
            if not self.zipped:
                piece, self.raw = self.raw, b""
                return piece
            if self.z is None:
                self.z = zlib.decompressobj(31)
            try:
                piece = self.z.decompress(self.raw)
            except zlib.error as e:
                raise ValueError(f"bytes left over after a gzip member, or a damaged one: {e}") from e
            self.raw = self.z.unused_data
            if self.z.eof:
                self.z = None
            if piece:
                return piece

    def fill(self, n: int) -> bool:
        """Hold at least ``n`` bytes beyond the next one's place; False if the archive ends before."""
        if len(self.held) - self.pos >= n:
            return True
        parts, size = [self.held[self.pos:]], len(self.held) - self.pos
        self.base += self.pos
        while size < n:
            piece = self._piece()
            if piece is None:
                break
            parts.append(piece)
            size += len(piece)
        self.held, self.pos = b"".join(parts), 0
        return size >= n

    def take(self, n: int) -> bytes:
        if not self.fill(n):
            raise ValueError(f"a record declares {n} bytes and {len(self.held) - self.pos} are left")
        out = self.held[self.pos:self.pos + n]
        self.pos += n
        return out

    def line(self, most: int = 1 << 20) -> bytes:
        """The bytes up to the next newline, without it."""
        size = 1 << 10
        while True:
            whole = self.fill(size)
            end = self.held.find(b"\n", self.pos)
            if end >= 0:
                out = self.held[self.pos:end]
                self.pos = end + 1
                return out
            if not whole or size > most:
                raise ValueError(f"bytes left over that are no record: {self.held[self.pos:self.pos + 60]!r}")
            size *= 4

    def skip_gap(self) -> bool:
        """Pass the line ends between records; False at the end of the archive."""
        while self.fill(1):
            if self.held[self.pos] not in b"\r\n":
                return True
            self.pos += 1
        return False


def arc_header(version: int, url: str, date: str, kind: str, length: int, code: int = 200) -> bytes:
    url = _SPACE.sub(lambda m: f"%{ord(m[0]):02X}", url) or "-"
    own = {"url": url, "ip": "0.0.0.0", "date": date, "type": kind, "code": str(code), "checksum": "-",
           "location": "-", "offset": "0", "file": "-", "length": str(length)}
    return " ".join(own[f] for f in FIELDS[version]).encode("utf-8", "replace") + b"\n"


def arc_version_block(version: int, date: str = ARCHIVED) -> bytes:
    names = {"url": "URL", "ip": "IP-address", "date": "Archive-date", "type": "Content-type", "code": "Result-code",
             "checksum": "Checksum", "location": "Location", "offset": "Offset", "file": "Filename", "length": "Archive-length"}
    body = f"{version} 0 adlens\n".encode() + " ".join(names[f] for f in FIELDS[version]).encode() + b"\n"
    return arc_header(version, "filedesc://pages.arc", date, "text/plain", len(body)) + body + b"\n"


def arc_page(version: int, page_id: str, url: str | None, payload: bytes) -> bytes:
    """One page as an ARC record: header line, HTTP response, newline."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{PAGE_HEADER}: {page_id}\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    return arc_header(version, url or f"urn:page:{page_id}", ARCHIVED, "text/html", len(http) + len(payload)) + http + payload + b"\n"


@dataclass
class ArcRecord:
    offset: int  # place in the unpacked archive
    fields: dict[str, str]
    content: bytes
    opens: bool  # the version block


def read_arc(f) -> Iterator[ArcRecord]:
    """Records of an ARC file of either version, plain or gzipped, the version block first.

    The version stands in the first line of the version block's content; header lines are
    then read by that version's field list. Records are walked by their declared lengths,
    wherever gzip members begin or end. Bytes that are no record raise an error: nothing of
    an archive is passed over.
    """
    version, data = 0, Unpacked(f)
    while data.skip_gap():
        place, line = data.at, data.line().rstrip(b"\r")
        values = line.decode("utf-8", "replace").split(" ")
        if not values[-1].isdecimal():
            raise ValueError(f"bytes left over that are no ARC header line: {line[:80]!r}")
        content = data.take(int(values[-1]))
        opens = not version
        if opens:
            mark = content.split(b" ", 1)[0]
            version = int(mark) if mark.isdigit() else 0
            if version not in FIELDS:
                raise ValueError(f"unknown ARC version {mark[:20]!r}")
        names = FIELDS[version]
        if len(values) < len(names):
            raise ValueError(f"ARC {version} header line with {len(values)} fields: {line[:80]!r}")
        # Spaces inside a URL make extra fields: they belong to the first.
        extra = len(values) - len(names)
        yield ArcRecord(place, dict(zip(names, [" ".join(values[:extra + 1]), *values[extra + 1:]])), content, opens)


def http_parts(content: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(headers by lower-case name, header bytes with the blank line, body) of an HTTP message."""
    head, gap, body = content.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        return {}, b"", content
    headers = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        headers[k.strip().lower().decode("latin-1")] = v.strip().decode("latin-1")
    return headers, head + gap, body


def iso_date(date: str) -> str:
    """14 digits to ISO 8601; what is missing or no digit is filled up from the epoch."""
    d = date if date.isdigit() else ""
    d = (d + "19700101000000"[len(d):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(uri: str, date: str, place: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join((uri, date, place, digest)))}>"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode("utf-8", "replace") + block + _CRLF + _CRLF


def convert(record: ArcRecord, keeper: dict | None = None) -> bytes:
    """The WARC record of an ARC record. ``keeper``: (record_id, uri, date) of the record
    that holds the same payload, if another one does."""
    f = record.fields
    date = iso_date(f["date"])
    if record.opens:
        rid = record_id(f["url"], date, "0", sha1_label(record.content))
        info = b"software: adlens\r\nformat: WARC File Format 1.1\r\nconversion: from ARC\r\n"
        return warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", rid), ("WARC-Date", date),
                            ("Content-Type", "application/warc-fields")], info)
    http, head, payload = http_parts(record.content)
    digest = sha1_label(payload)
    rid = record_id(f["url"], date, http.get(PAGE_HEADER.lower(), str(record.offset)), digest)
    common = [("WARC-Record-ID", rid), ("WARC-Date", date), ("WARC-Target-URI", f["url"]),
              ("WARC-IP-Address", f["ip"]), ("WARC-Payload-Digest", digest)]
    kind = "application/http; msgtype=response" if head else f["type"]
    if keeper:
        return warc_record([("WARC-Type", "revisit"), *common, ("WARC-Block-Digest", sha1_label(head)),
                            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                            ("WARC-Refers-To", keeper["record_id"]), ("WARC-Refers-To-Target-URI", keeper["uri"]),
                            ("WARC-Refers-To-Date", keeper["date"]), ("Content-Type", kind)], head)
    return warc_record([("WARC-Type", "response" if head else "resource"), *common,
                        ("WARC-Block-Digest", sha1_label(record.content)), ("Content-Type", kind)], record.content)


def read_warc(f) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of every record of a WARC file, plain or gzipped,
    walked by declared lengths; block digests are checked and bytes that are no record raise."""
    data = Unpacked(f)
    while data.skip_gap():
        first = data.line().rstrip(b"\r").decode("utf-8", "replace")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record: {first[:40]!r}")
        headers = {}
        while line := data.line().rstrip(b"\r"):
            k, _, v = line.decode("utf-8", "replace").partition(":")
            headers[k.lower()] = v.strip()
        block = data.take(int(headers["content-length"]))
        if "warc-block-digest" in headers and headers["warc-block-digest"] != sha1_label(block):
            raise ValueError(f"block digest differs in {headers.get('warc-record-id')}")
        yield headers, block


# ------------------------------------------------------------------ Spark jobs

def write_arcs(pages: DataFrame, folder: str) -> DataFrame:
    """One ARC file per input partition (versions 1 and 2 in turn): manifest (path, n)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = [0]

        def records():
            version = 0
            for b in batches:
                for page, url, html, part in zip(b["page_id"], b["url"], b["html"], b["part"]):
                    if not version:
                        version = 1 + int(part) % 2
                        yield gz(arc_version_block(version))
                    n[0] += 1
                    yield gz(arc_page(version, page, url, (html or "").encode("utf-8", "replace")))

        path, _ = write_file(folder, "pages.arc.gz", records())
        if n[0]:
            yield pd.DataFrame({"path": [path], "n": n})

    rows = pages.select(F.coalesce(F.col("page_id").cast("string"), F.lit("-")).alias("page_id"), "url", "html",
                        F.spark_partition_id().alias("part"))
    return staged(rows.mapInPandas(run, "path string, n long"), "arcs")


def index_arcs(arcs: DataFrame) -> DataFrame:
    """(path, at, page_id, uri, date, record_id, bytes, digest) of every record in the ARC files."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path in b["path"]:
                rows = []
                with open_file(path) as f:
                    for r in read_arc(f):
                        if r.opens:
                            continue
                        http, _, payload = http_parts(r.content)
                        date, digest = iso_date(r.fields["date"]), sha1_label(payload)
                        page = http.get(PAGE_HEADER.lower(), str(r.offset))
                        rows.append((path, r.offset, page, r.fields["url"], date,
                                     record_id(r.fields["url"], date, page, digest), len(payload), digest))
                yield pd.DataFrame(rows, columns=["path", "at", "page_id", "uri", "date", "record_id", "bytes", "digest"])

    spread = arcs.repartition(partitions(arcs.sparkSession), "path")
    return staged(spread.mapInPandas(run, "path string, at long, page_id string, uri string, date string, record_id string, bytes long, digest string"), "arc-index")


def keepers(index: DataFrame, least: int = 1000) -> DataFrame:
    """(path, at, record_id, uri, date: the keeper's) per record that repeats another's payload of at least ``least``
    bytes: the record with the largest page_id holds it (on a tie the first in (path, place))."""
    large = index.filter(F.col("bytes") >= least)
    order = F.struct(F.col("page_id").cast("long").alias("page"), F.col("path").alias("p"), (-F.col("at")).alias("a"))
    best = (large.groupBy("digest").agg(F.count("*").alias("n"), F.max(order).alias("top"),
                                        F.max_by(F.struct("record_id", "uri", "date"), order).alias("keeper"))
            .filter("n > 1").select("digest", "top", "keeper"))
    return (large.join(best, "digest").filter((F.col("path") != F.col("top.p")) | (-F.col("at") != F.col("top.a")))
            .select("path", "at", "keeper.*"))


def convert_arcs(arcs: DataFrame, revisits: DataFrame, folder: str) -> DataFrame:
    """Convert every ARC file in a task of its own, with its own decisions: manifest (path, n).

    A task holds one record and its archive's decisions, so an archive's size bounds it.
    """
    def run(group: pd.DataFrame) -> pd.DataFrame:
        path = group["path"].iloc[0]
        known = group[group["record_id"].notna()]
        own = {int(a): {"record_id": r, "uri": u, "date": d}
               for a, r, u, d in zip(known["at"], known["record_id"], known["uri"], known["date"])}
        n = [0]

        def records():
            with open_file(path) as f:
                for r in read_arc(f):
                    n[0] += 1
                    yield gz(convert(r, own.get(r.offset)))

        out, _ = write_file(folder, "pages.warc.gz", records())
        return pd.DataFrame({"path": [out], "n": n})

    rows = arcs.select("path").unionByName(revisits, allowMissingColumns=True)  # archives without any decision too
    # The rows are small but each stands for an archive's work: a fixed number of partitions
    # keeps adaptive execution from merging them into one task.
    rows = rows.repartition(partitions(arcs.sparkSession), "path")
    return staged(rows.groupBy("path").applyInPandas(run, "path string, n long"), "warcs")


def read_warcs(warcs: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, digest_hex, record_type, record_id, refers) of every page record."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path in b["path"]:
                rows = []
                with open_file(path) as f:
                    for h, block in read_warc(f):
                        if h["warc-type"] == "warcinfo":
                            continue
                        http, _, payload = http_parts(block)
                        if h["warc-type"] == "revisit":
                            size = int(http["content-length"])
                        else:
                            size = len(payload)
                            if sha1_label(payload) != h["warc-payload-digest"]:
                                raise ValueError(f"payload digest differs in {h['warc-record-id']}")
                        rows.append((http.get(PAGE_HEADER.lower()), size,
                                     base64.b32decode(h["warc-payload-digest"][5:]).hex(), h["warc-type"],
                                     h["warc-record-id"], h.get("warc-refers-to")))
                yield pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "record_id", "refers"])

    spread = warcs.repartition(partitions(warcs.sparkSession), "path")
    return spread.select("path").mapInPandas(run, "page_id string, payload_bytes long, payload_digest string, record_type string, record_id string, refers string")


def round_trip(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Pages to ARC files, ARC to WARC, WARC back to rows: (page_id, payload_bytes,
    payload_digest, record_type, refers_to) per row of ``pages`` (page_id, url, html).

    A null html is an empty payload; a null url gets a URN; a null page_id stays null (its
    rows are no one's keeper while another has a page_id); of equal pages with one page_id
    the first in archive order keeps the payload and the others refer to that page_id;
    extra columns are not carried; an empty table gives no rows.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, "llm-warc")
    arcs = write_arcs(pages, folder)
    revisits = keepers(index_arcs(arcs).withColumn("page_id", F.nullif("page_id", F.lit("-"))), least)
    rows = staged(read_warcs(convert_arcs(arcs, revisits, folder)), "warc-rows")
    page = F.nullif("page_id", F.lit("-")).cast("long")
    held = rows.filter("record_type <> 'revisit'").select(F.col("record_id").alias("refers"), page.alias("refers_to")).dropDuplicates(["refers"])
    # Only revisits look their keeper up; a hot keeper's revisits are split by adaptive skew joins.
    back = rows.filter("refers is not null").join(held, "refers", "left")
    cols = [page.alias("page_id"), "payload_bytes", "payload_digest", "record_type"]
    return (rows.filter("refers is null").select(*cols, F.lit(None).cast("long").alias("refers_to"))
            .unionByName(back.select(*cols, "refers_to")))
