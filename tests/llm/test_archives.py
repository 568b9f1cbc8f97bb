import gzip
import hashlib

import pytest

from matchloom.llm import archives as A


def test_either_version_is_read_by_its_header_and_lengths():
    body = b"HTTP/1.1 404 Not Found\r\nX: y\r\n\r\nline\n2 0 fake\nhttp://no.org 1 2 3 4\n"
    for version in (1, 2):
        raw = A.write_arc("a.arc", version, [("http://x.org/a b", "1.2.3.4", "20010203040506", "text/html", body), ("http://x.org/", "1.2.3.4", "20010203040507", "text/plain", b"")])
        first, second = A.read_arc(raw)
        assert first["url"] == "http://x.org/a b" and first["content"] == body and first["version"] == version
        assert first["archive-date"] == "20010203040506" and second["content"] == b""
        if version == 2:
            assert first["result-code"] == "200" and int(first["offset"]) == first["place"]
        for cut in (raw[:-20], raw.replace(b"filedesc", b"\xff\xffsomething without length\n", 1)):
            with pytest.raises(ValueError):
                list(A.read_arc(cut))


def test_round_trip(spark, tmp_path):
    long, odd = "<p>" + "w " * 100, "é\r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\n" * 5
    pages = [(5, "http://a.org/", long), (3, "http://b.org/x y", long), (9, None, long), (1, "http://c.org", "short"), (2, "http://c.org", "short"), (None, "http://d.org", long),
             (7, "http://e.org", None), (8, "http://f.org", odd), (8, "http://f.org", odd)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, place string").repartition(3)
    got = sorted(A.round_trip(df).collect(), key=lambda r: (r["page_id"] is None, r["page_id"] or 0, r["record_type"]))
    want = {5: ("revisit", 3), 3: ("response", None), 9: ("revisit", 3), 1: ("response", None), 2: ("response", None), 7: ("response", None), None: ("revisit", 3)}
    for r in got:
        html = (next(p[2] for p in pages if p[0] == r["page_id"]) or "").encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(html), hashlib.sha256(html).hexdigest())
        if r["page_id"] != 8:
            assert (r["record_type"], r["refers_to"]) == want[r["page_id"]]
    assert [(r["record_type"], r["refers_to"]) for r in got if r["page_id"] == 8] == [("response", None), ("revisit", 8)]
    assert len(got) == 9


def test_files_are_warc(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://a.org/{i}", f"<p>{i}</p>" * 40) for i in range(30)], "page_id long, url string, html string")
    path = str(tmp_path / "warc")
    A.arc_to_warc(A.pages_to_arc(pages, 7), path, per_file=4)
    records = [r for f in (tmp_path / "warc").glob("part-*") for r in A.read_warc_bytes(f.read_bytes())]
    assert len(records) == 30 and len({h["warc-record-id"] for h, _ in records}) == 30
    for h, block in records:
        assert h["warc-type"] == "response" and h["warc-block-digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
    payloads = {r["page_id"]: bytes(r["payload"]) for r in A.read_warc(spark, path).collect()}
    assert payloads[3] == b"<p>3</p>" * 40
    assert len(payloads) == 30


def test_no_pages(spark):
    assert A.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_old_heads_and_damaged_archives(spark, tmp_path):
    """Heads in Latin-1 or in no encoding at all are kept byte by byte; of a damaged archive the records before the damage are written, and it costs no other one."""
    body = lambda i: f"HTTP/1.0 200 OK\r\nServer: caf\xe9 \xff{i}\r\nX-Page-Id: {i}\r\n\r\n".encode("latin-1") + b"<p>\xe9\xff" * 60 + str(i % 2).encode()
    record = lambda i, date="20010203040506": (f"http://x.org/{i}", "1.2.3.4", date, "text/html", body(i))
    good = A.write_arc("good", 1, [record(1), record(2), record(3)])
    cut = A.write_arc("cut", 2, [record(4), record(5)])[:-30]
    broken = A.write_arc("broken", 1, [record(6)]) + b"no header here\n" + A.write_arc("rest", 1, [record(7)])
    dates = A.write_arc("dates", 1, [record(8, "1999"), record(9, "20019999040506"), record(10, "199912312359")])
    rows = [("good", good), ("cut", cut), ("broken", broken), ("dates", dates), ("empty", b""), ("junk", b"\x00\x01\x02"), ("version", good.replace(b"1 0 matchloom", b"7 0 matchloom"))]
    damage = A.arc_to_warc(spark.createDataFrame(rows, "name string, content binary").repartition(3), str(tmp_path / "warc"))
    got = {r["page_id"]: r for r in A.read_warc(spark, str(tmp_path / "warc")).collect()}
    assert set(got) == {1, 2, 3, 4, 6, 8, 10} and len(got) == 7
    assert [got[i]["date"] for i in (1, 8, 10)] == ["2001-02-03T04:05:06Z", "1999-01-01T00:00:00Z", "1999-12-31T23:59:00Z"]
    assert {i for i, r in got.items() if r["record_type"] == "response"} == {1, 2} and bytes(got[1]["payload"]) == b"<p>\xe9\xff" * 60 + b"1"
    told = {r["name"]: r["error"] for r in damage.collect()}
    assert set(told) == {"cut", "broken", "dates", "junk", "version"}
    assert "cut off" in told["cut"] and "no ARC header" in told["broken"] and "no date" in told["dates"] and "version" in told["version"]
    assert b"Server: caf\xe9 \xff1" in b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "warc").glob("*.gz"))
