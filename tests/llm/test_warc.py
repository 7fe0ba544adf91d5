import base64
import gzip
import hashlib
import io

import pytest

from adlens.llm import warc

PAGE = b"<p>caf\xc3\xa9</p>\r\n\r\nWARC/1.1\r\n" * 60


def arc_file(version, pages):
    return b"".join(warc.gz(x) for x in [warc.arc_version_block(version), *(warc.arc_page(version, str(i), u, p) for i, (u, p) in enumerate(pages))])


@pytest.mark.parametrize("version", [1, 2])
def test_arc_headers_follow_their_version(version):
    pages = [("http://a.example/x y", PAGE), (None, b""), ("http://b.example/é", b"\n\nfiledesc:// 1 2 3\n")]
    records = list(warc.read_arc(io.BytesIO(arc_file(version, pages))))
    assert [r.opens for r in records] == [True, False, False, False]
    assert list(records[1].fields) == list(warc.FIELDS[version])
    assert [r.fields["url"] for r in records[1:]] == ["http://a.example/x%20y", "urn:page:1", "http://b.example/é"]
    assert [warc.http_parts(r.content)[2] for r in records[1:]] == [p for _, p in pages]
    assert [int(r.fields["length"]) for r in records] == [len(r.content) for r in records]


def test_declared_length_decides():
    head = b"http://a.example/ 0.0.0.0 20010203040506 text/plain 5\n"
    data = warc.gz(warc.arc_version_block(1)) + warc.gz(head + b"12345\n")
    record = list(warc.read_arc(io.BytesIO(data)))[1]
    assert record.content == b"12345"
    headers, block = next(warc.read_warc(io.BytesIO(warc.gz(warc.convert(record)))))
    assert block == b"12345"
    assert headers["warc-type"] == "resource" and headers["warc-date"] == "2001-02-03T04:05:06Z"
    assert headers["warc-payload-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(b"12345").digest()).decode()
    assert headers["warc-record-id"].startswith("<urn:uuid:")
    short = warc.gz(warc.arc_version_block(1)) + warc.gz(head + b"123")
    with pytest.raises(ValueError):
        list(warc.read_arc(io.BytesIO(short)))
    with pytest.raises(ValueError):
        list(warc.read_arc(io.BytesIO(short[:-4])))


def cuts(records, how):
    """An archive's bytes: plain, one member, a member per record, members that end anywhere."""
    whole = b"".join(records)
    if how == "plain":
        return whole
    if how == "one member":
        return warc.gz(whole)
    if how == "a member per record":
        return b"".join(map(warc.gz, records))
    return b"".join(warc.gz(whole[at:at + 37]) for at in range(0, len(whole), 37))


HOW = ["plain", "one member", "a member per record", "members that end anywhere"]


@pytest.mark.parametrize("how", HOW)
@pytest.mark.parametrize("version", [1, 2])
def test_foreign_archives_keep_every_record(version, how):
    pages = [(f"http://a.example/{k}", PAGE[:k * 7] + b"\n" * (k % 4)) for k in range(40)]
    records = [warc.arc_version_block(version), *(warc.arc_page(version, str(k), u, p) for k, (u, p) in enumerate(pages))]
    read = list(warc.read_arc(io.BytesIO(cuts(records, how))))
    assert [warc.http_parts(r.content)[2] for r in read[1:]] == [p for _, p in pages]
    assert len({r.offset for r in read}) == 41
    again = list(warc.read_warc(io.BytesIO(cuts([warc.convert(r) for r in read], how))))
    assert [h["warc-type"] for h, _ in again] == ["warcinfo"] + ["response"] * 40
    assert [block for _, block in again[1:]] == [r.content for r in read[1:]]


@pytest.mark.parametrize("how", HOW)
def test_bytes_left_over_raise(how):
    head = b"http://a.example/ 0.0.0.0 20010203040506 text/plain 5\n"
    for tail in (b"12345 not part of it\n", b"12345\nhalf a header", b"12345\n" + head + b"123"):
        with pytest.raises(ValueError):
            list(warc.read_arc(io.BytesIO(cuts([warc.arc_version_block(1), head + tail], how))))
    arc = warc.ArcRecord(0, {"url": "u", "ip": "-", "date": "2001", "type": "text/plain", "length": "3"}, b"abc", False)
    for tail in (b"junk\n", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"):
        with pytest.raises(ValueError):
            list(warc.read_warc(io.BytesIO(cuts([warc.convert(arc), tail], how))))
    if how != "plain":
        with pytest.raises(ValueError):
            list(warc.read_arc(io.BytesIO(cuts([warc.arc_version_block(1), head + b"12345\n"], how) + b"\0\0\0")))


def test_small_reads_give_the_same_records():
    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(min(n, 5) if n >= 0 else n)
    data = arc_file(2, [("http://a.example/", PAGE), ("http://b.example/", b"")])
    assert list(warc.read_arc(Slow(data))) == list(warc.read_arc(io.BytesIO(data)))
    assert list(warc.read_arc(io.BytesIO(b""))) == []


def test_foreign_archives_through_spark(spark, tmp_path):
    """Files that were not written here: an index and a conversion of plain and single-member archives."""
    paths = []
    for k, how in enumerate(HOW):
        pages = [(f"http://h{k}.example/{i}", PAGE + str(i % 2).encode()) for i in range(9)]
        path = tmp_path / f"foreign{k}.arc"
        path.write_bytes(cuts([warc.arc_version_block(1 + k % 2), *(warc.arc_page(1 + k % 2, str(100 * k + i), u, p) for i, (u, p) in enumerate(pages))], how))
        paths.append((str(path), 9))
    arcs = spark.createDataFrame(paths, "path string, n long")
    index = warc.index_arcs(arcs)
    assert index.count() == 36
    rows = warc.read_warcs(warc.convert_arcs(arcs, warc.keepers(index), str(tmp_path / "out"))).collect()
    assert sorted(int(r["page_id"]) for r in rows) == sorted(100 * k + i for k in range(4) for i in range(9))
    assert sum(r["record_type"] == "response" for r in rows) == 2


def test_urls_with_spaces_and_short_dates():
    head = b"http://a.example/a b c 0.0.0.0 199912 text/plain 1\n"
    record = list(warc.read_arc(io.BytesIO(warc.gz(warc.arc_version_block(1)) + warc.gz(head + b"x\n"))))[1]
    assert record.fields["url"] == "http://a.example/a b c"
    assert warc.iso_date(record.fields["date"]) == "1999-12-01T00:00:00Z"
    assert warc.iso_date("broken") == "1970-01-01T00:00:00Z"


def test_files_are_plain_gzip_members():
    data = arc_file(2, [("http://a.example/", PAGE)])
    assert gzip.decompress(data).startswith(b"filedesc://pages.arc 0.0.0.0 ")


def test_round_trip(spark):
    big, other = "<html>" + "x" * 1500, "<html>" + "é" * 800
    rows = [(1, "http://a.example/1", big, 0), (7, "http://a.example/1", big, 0), (3, None, big, 0), (4, "filedesc://x", other, 0),
            (5, "http://c.example/", "small", 0), (6, "http://c.example/", "small", 0), (8, "http://d.example/", None, 0),
            (9, "http://d.example/", "", 0), (10, "u\nr l", other, 0), (2**55 + 1, "http://e.example/", "<p>\r\n\r\n</p>" * 300, 0), (11, "http://f.example/", "y" * 999, 0), (12, "http://f.example/", "y" * 999, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)
    got = {r["page_id"]: r for r in warc.round_trip(pages).collect()}
    assert len(got) == len(rows)
    for page, _, html, _ in rows:
        body = (html or "").encode()
        keeper = max(p for p, _, h, _ in rows if (h or "").encode() == body)
        r = got[page]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), hashlib.sha1(body).hexdigest())
        again = len(body) >= 1000 and keeper != page
        assert (r["record_type"], r["refers_to"]) == (("revisit", keeper) if again else ("response", None))
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_null_and_repeated_pages(spark):
    html = "<p>" + "z" * 2000
    pages = spark.createDataFrame([(None, None, html), (3, "http://a.example/", html), (3, "http://a.example/", html)], "page_id long, url string, html string")
    rows = warc.round_trip(pages).collect()
    assert sorted((r["record_type"], r["refers_to"]) for r in rows if r["refers_to"]) == [("revisit", 3), ("revisit", 3)]
    assert len(rows) == 3 and {r["payload_bytes"] for r in rows} == {2003}
