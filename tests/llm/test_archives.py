import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from sozmill.llm import archives as A


def arc(version, *records):
    block = f"{version} 0 someone\n{A.ARC_FIELDS[version]}\n".encode()
    out = b"filedesc://x.arc 0.0.0.0 19961104142103 text/plain %d\n" % len(block) + block + b"\n"
    for url, body in records:
        more = b"" if version == 1 else b"200 - - 0 x.arc "
        out += url + b" 1.2.3.4 19970102030405 text/html " + more + b"%d\n" % len(body) + body + b"\n"
    return out


@pytest.mark.parametrize("version", [1, 2])
def test_declared_lengths(version):
    trap = b"HTTP/1.1 200 OK\r\n\r\nhttp://x 1.2.3.4 19970102030405 text/html 3\nabc\n\n"
    content = arc(version, (b"http://a/", trap), (b"http://b/", b""), (b"dns:c", b"c"))
    for packed in (content, gzip.compress(content), gzip.compress(content[:90]) + gzip.compress(content[90:])):
        found = list(A.arc_records(packed))
        assert [(r.fields["URL"], r.content, r.truncated) for r in found] == [
            ("http://a/", trap, False), ("http://b/", b"", False), ("dns:c", b"c", False)]
        assert all(content[r.offset:].startswith(r.fields["URL"].encode()) for r in found)


def test_large_and_cut_off(monkeypatch):
    monkeypatch.setattr(A, "CHUNK", 100)
    body = bytes(range(256)) * 40
    content = arc(1, (b"http://a/", body), (b"http://b/", body))
    found = list(A.arc_records(gzip.compress(content)))
    assert [r.content for r in found] == [body, body]
    cut = list(A.arc_records(content[:-5000]))
    assert cut[1].truncated and body.startswith(cut[1].content)
    assert list(A.arc_records(b"")) == []


def test_bad_headers():
    with pytest.raises(ValueError, match="no ARC header at"):
        list(A.arc_records(arc(1, (b"http://a b/", b"x")), "f"))
    with pytest.raises(ValueError, match="version block"):
        list(A.arc_records(b"http://a/ 1.2.3.4 1997 text/html 1\nx\n"))


def test_dates_and_ids():
    assert A.warc_date("19970102030405") == "1997-01-02T03:04:05Z"
    assert A.warc_date("1997") == "1997-01-01T00:00:00Z"
    assert A.record_id("u", "d", "f", 1) == A.record_id("u", "d", "f", 1) != A.record_id("u", "d", "f", 2)


PAGES = [(1, "http://a/", "<p>one</p>"), (2, "http://b b/", "<p>one</p>"), (3, None, None), (4, "x", ""),
         (5, "http://c/", "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (6, "http://d/", "日本" * 5000),
         (6, "http://d/", "日本" * 5000), (None, "http://e/", "<p>one</p>")]


def test_round_trip(session):
    pages = session.createDataFrame(PAGES, "page_id long, url string, html string")
    rows = A.archived(pages.withColumn("digest", F.lit("clash"))).collect()
    got = sorted(((r.page_id or 0), r.payload_bytes, r.record_type, r.refers_to) for r in rows)
    assert got == [
        (0, 10, "revisit", 2), (1, 10, "revisit", 2), (2, 10, "response", None), (3, 0, "revisit", 4),
        (4, 0, "response", None), (5, 38, "response", None), (6, 30000, "response", None), (6, 30000, "revisit", 6)]
    assert len({r.record_id for r in rows}) == len(rows)
    for r in rows:
        html = next(h for i, _, h in PAGES if i == r.page_id) or ""
        assert r.payload_digest == A.base32_sha1(html.encode())
    assert A.archived(pages.limit(0)).count() == 0


def test_files_are_archives(session, tmp_path):
    pages = session.createDataFrame(PAGES, "page_id long, url string, html string").repartition(2)
    A.write_arc(pages, f"{tmp_path}/arc", "page_id", "url", "html")
    A.convert(A.read_arc(session, f"{tmp_path}/arc"), f"{tmp_path}/warc")
    kinds, versions = [], set()
    for path in (tmp_path / "arc").glob("part-*"):
        versions.add(gzip.decompress(path.read_bytes()).split(b"\n")[1][:1])
    for path in (tmp_path / "warc").glob("part-*"):
        content = gzip.decompress(path.read_bytes())
        for headers, block in A.warc_records(content):
            kinds.append(headers["warc-type"])
            if "warc-block-digest" in headers:
                assert headers["warc-block-digest"] == "sha1:" + A.base32_sha1(block)
                assert headers["warc-record-id"].startswith("<urn:uuid:")
            if headers["warc-type"] == "revisit":
                assert headers["warc-profile"] == A.REVISIT_PROFILE and headers["warc-refers-to"]
                assert block.endswith(b"\r\n\r\n")
        assert content.endswith(b"\r\n\r\n")
    assert kinds.count("response") == 4 and kinds.count("revisit") == 4 and "warcinfo" in kinds
    assert versions == {b"1", b"2"}
    assert hashlib.sha1(b"").hexdigest()
