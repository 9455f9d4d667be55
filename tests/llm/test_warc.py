"""Archives: exact round trips of both ARC versions and of the WARC files."""

import gzip
import hashlib

import pytest

from lanewatch.llm import warc as w
from lanewatch.llm.common import scratch_dir


def _pages():
    big, utf = "<p>" + "x" * 2000, "<p>é日本" * 300
    rows = [(1, "http://a.com/", big), (2, "http://b.com/x y", big), (3, None, None), (4, "http://c", ""), (5, "http://d", "short"),
            (6, "http://e", "short"), (7, "http://f", utf), (9, "http://g", utf), (8, "http://h", utf), (10, "http://i", "y" * 999),
            (11, "http://j", "y" * 999), (12, "http://k", "z" * 1000), (13, "http://l", "z" * 1000),
            (14, "http://m\n2", "WARC/1.1\r\n\r\n\r\n\r\nfiledesc://x\n\n" * 60), (15, "http://n", "\n\r\n" + "end\r\n\r\n" * 300),
            (16, "http://o", "L" * 300_000)]
    return rows


def _run(spark, rows, **options):
    arc, out = scratch_dir(spark, "arc"), scratch_dir(spark, "warc")
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    w.write_arc(df, arc, **options)
    w.convert(spark, arc, out)
    return arc, out


def test_pages_to_records(spark):
    rows = _pages()
    for segment in (8 << 20, 1500):
        _, out = _run(spark, rows, segment=segment)
        got = {r.page_id: r for r in w.page_records(w.warc_records(spark, out)).collect()}
        assert len(got) == len(rows)
        for page, _, html in rows:
            raw = (html or "").encode()
            same = [p for p, _, h in rows if (h or "").encode() == raw]
            again = len(raw) >= 1000 and page != max(same)
            r = got[page]
            assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
            assert (r.record_type, r.refers_to) == (("revisit", max(same)) if again else ("response", None))


def test_records_hold_pages_bytes(spark):
    rows = _pages()
    arc, out = _run(spark, rows)
    versions, pages = set(), {}
    for f in w._files(spark, arc).collect():
        for _, fields, content in w.parse_arc(w._plain(f.content)):
            versions.add(len(fields)) if fields["URL"].startswith("filedesc") else None
    for f in w._files(spark, out).collect():
        kinds = [r["WARC-Type"] for r, _ in w.parse_warc(w._plain(f.content))]
        assert kinds[0] == "warcinfo"
        for fields, block in w.parse_warc(w._plain(f.content)):
            if fields["WARC-Type"] == "response":
                head, payload = w.http_parts(block)
                pages[int(w._header(head, b"X-Page-Id"))] = payload
            assert fields["WARC-Date"] == "2024-01-01T00:00:00Z" and fields["WARC-Record-ID"].startswith("<urn:uuid:")
    assert versions == {5, 10}
    html = {p: (h or "").encode() for p, _, h in rows}
    assert all(html[p] == x for p, x in pages.items()) and {9, 2, 13, 3, 4, 16} <= set(pages)


def test_both_versions_by_declared_length():
    for version in (1, 2):
        body = b"HTTP/1.0 200 OK\nA: b\n\nline\n\nhttp://fake 0.0.0.0 20240101000000 text/html 3\nabc"
        data = w.arc_head(version, "t.arc", "20010203040506") + w.arc_record(version, b"http://x/ y", "20010203040506", "text/html", 200, body, 0, "t.arc") \
            + b"\n\n" + w.arc_record(version, b"dns:x", "2001", "text/dns", 200, b"\xff\xfe", 9, "t.arc")
        records = list(w.parse_arc(data))
        assert [c for _, _, c in records[1:]] == [body, b"\xff\xfe"] and records[1][1]["URL"] == "http://x/%20y"
        assert [w._message(f, c)[0] for _, f, c in records] == ["warcinfo", "response", "resource"]
        assert w.http_parts(body)[1].startswith(b"line")
        with pytest.raises(ValueError):
            list(w.parse_arc(data[:-3]))
    with pytest.raises(ValueError):
        list(w.parse_arc(data.replace(b"2 0 lanewatch", b"3 0 lanewatch")))
    assert w._iso("20010203040506") == "2001-02-03T04:05:06Z"


def test_bytes_that_are_not_text(spark):
    arc, out = scratch_dir(spark, "arc"), scratch_dir(spark, "warc")
    data = w.arc_head(1, "b.arc", "20240101000000") + w.arc_record(1, b"http://x", "20240101000000", "image/png", 200,
                                                                  b"HTTP/1.1 200 OK\r\nX-Page-Id: 4\r\n\r\n\xff\x00\xfe", 0, "b.arc")
    spark.createDataFrame([(bytearray(data),)], "value binary").selectExpr("cast(value as string) value").write.text(arc)
    w.convert(spark, arc, out)
    r = w.page_records(w.warc_records(spark, out)).collect()
    assert [(x.page_id, x.payload_bytes, x.payload_digest) for x in r] == [(4, 3, hashlib.sha1(b"\xff\x00\xfe").hexdigest())]
    assert any(gzip.decompress(f.content).endswith(b"\xff\x00\xfe\r\n\r\n") for f in w._files(spark, out).collect())


def test_repeated_rows_null_ids_and_no_pages(spark):
    same = "s" * 1200
    _, out = _run(spark, [(1, "u", same), (1, "u", same), (None, "v", same)])
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in w.page_records(w.warc_records(spark, out)).collect()), key=str)
    assert got == [(1, "response", None), (1, "revisit", 1), (None, "revisit", 1)]
    _, out = _run(spark, [])
    assert w.page_records(w.warc_records(spark, out)).count() == 0
