import hashlib

import pytest

from llm_fixtures import no_docs, odd_docs  # noqa: F401

from hearth.llm import archives as A


def test_versions_and_declared_lengths():
    body = b"HTTP/1.0 200 OK\r\n\r\nline\nhttp://fake 1.2.3.4 20240101000000 text/html 5\nmore"
    for version in (1, 2):
        block = A.arc_version_block(version, "n.arc", "19990102030405")
        content = block + A.arc_record(version, "n.arc", len(block), "http://a/ b", "19990102030405", body) + \
            A.arc_record(version, "n.arc", 0, "dns:a", "1999", b"")
        got = list(A.read_arc(content))
        assert [h["url"] for h, _ in got][1:] == ["http://a/ b", "dns:a"] and got[0][0]["url"].startswith("filedesc:")
        assert [b for _, b in got][1:] == [body, b""]
        assert got[1][0]["date"] == "19990102030405" and got[1][0]["type"] == "text/html"
    with pytest.raises(ValueError):
        list(A.read_arc(content[:-20]))
    with pytest.raises(ValueError):
        list(A.read_arc(A.arc_version_block(1, "n", "1999").replace(b"\n1 0", b"\n9 0")))


def test_dates():
    assert A.warc_date("19990102030405") == "1999-01-02T03:04:05Z"
    assert A.warc_date("1999") == "1999-01-01T00:00:00Z"


def test_converter_takes_files_and_other_schemes(spark, tmp_path):
    import gzip
    block = A.arc_version_block(2, "f.arc", "20000101000000")
    content = block + A.arc_record(2, "f.arc", 0, "dns:host", "20000101000000", b"\xff\x00 raw") + \
        A.arc_record(2, "f.arc", 0, "http://h/", "20000101000000", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nhello")
    (tmp_path / "f.arc.gz").write_bytes(gzip.compress(content[:100]) + gzip.compress(content[100:]))
    files = spark.read.format("binaryFile").load(str(tmp_path)).selectExpr("path as name", "content")
    rows = {r.uri: r for r in A.convert_arc(files).collect()}
    assert {r.warc_type for r in rows.values()} == {"warcinfo", "resource", "response"}
    assert bytes(rows["dns:host"].payload) == b"\xff\x00 raw" and bytes(rows["http://h/"].payload) == b"hello"
    A.write_warc(A.with_revisits(A.convert_arc(files)), str(tmp_path / "w"), 2)
    back = {r.uri: r for r in A.read_warc(spark, str(tmp_path / "w")).collect()}
    assert back["dns:host"].payload_digest == hashlib.sha1(b"\xff\x00 raw").hexdigest() and len(back) == 3


def test_pages_against_plain_rules(spark):
    same, other = "x" * 1000, "é" * 700 + "\r\n\r\nWARC/1.1\r\n\r\n"
    pages = [(1, "http://a", same), (5, "http://b", same), (3, None, same), (2, "http://c d", other), (9, "u", other),
             (4, "u", "short"), (6, "u", "short"), (7, "u", None), (8, "u", ""), (5, "again", same), (None, "u", same), (10, "u", "y" * 999)]
    df = spark.createDataFrame([(*p, "k") for p in pages], "page_id long, url string, html string, k1 string").repartition(3)
    got = A.convert_pages(df).collect()
    assert len(got) == len(pages)
    rows = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got)
    want = []
    top = {same: 5, other: 9}
    left = {same: 1, other: 1}
    for page, _, html in sorted(pages, key=lambda p: -(p[0] or 0)):
        payload = (html or "").encode()
        kind, to = "response", None
        if len(payload) >= 1000:
            if page == top[html] and left[html]:
                left[html] = 0
            else:
                kind, to = "revisit", top[html]
        want.append((str(page), len(payload), hashlib.sha1(payload).hexdigest(), kind, to))
    assert rows == sorted(want)
    ids = {r.record_id: r.page_id for r in got}
    assert all(ids[r.refers_to_id] == r.refers_to for r in got if r.record_type == "revisit")


def test_segments_of_both_versions(spark):
    df = spark.createDataFrame([(i, "u", "z" * 100) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    arcs = [list(A.read_arc(bytes(r.content))) for r in A.render_arc(df, segment_bytes=3000).collect()]
    assert len(arcs) > 3 and {len(a[1][0]) for a in arcs} == {5, 10}


def test_empty_table(spark):
    assert A.convert_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
