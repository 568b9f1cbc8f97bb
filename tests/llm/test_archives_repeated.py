"""Repeated pages that start several archives."""

from matchloom.llm import archives as A


def test_partitions_that_start_alike(spark):
    long = "<p>" + "w " * 100
    one = spark.createDataFrame([(8, "http://f.org", long), (8, "http://f.org", long), (5, "http://a.org", long), (9, "http://g.org", "short")], "page_id long, url string, html string").coalesce(1)
    none = spark.createDataFrame([(None, None, None)] * 4, "page_id long, url string, html string").repartition(2)
    pages = one.union(one).union(one).union(none)
    names = [r["name"] for r in A.pages_to_arc(pages, 2).select("name").collect()]
    assert len(set(names)) == len(names) >= 8
    rows = A.round_trip(pages).collect()
    assert len(rows) == 16
    by_page = lambda p: sorted((r["record_type"], r["refers_to"]) for r in rows if r["page_id"] == p)
    assert by_page(8) == [("revisit", 5)] * 6
    assert by_page(5) == [("response", None)] + [("revisit", 5)] * 2
    assert by_page(9) == [("response", None)] * 3 and by_page(None) == [("response", None)] * 4


def test_files_are_bounded_by_bytes(spark, tmp_path):
    sizes = [10, 3_000_000, 200, 7_000_000, 500_000, 500_000, 500_000, 0, 2_500_000]
    rows = [(i, f"http://a.org/{i}", chr(97 + i) * n) for i, n in enumerate(sizes * 3)]
    rows = [(i, u, h + str(i // len(sizes)) if h else h) for i, u, h in rows]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    archives = A.pages_to_arc(pages, most_bytes=2_000_000)
    assert all(len(list(A.read_arc(bytes(r["content"])))) == 1 or len(r["content"]) < 9_100_000 for r in archives.collect())
    assert max(len(r["content"]) for r in archives.collect()) < 2_000_000 + 7_001_000
    path = str(tmp_path / "warc")
    A.arc_to_warc(archives, path, most_bytes=2_000_000)
    files = [[len(block) for _, block in A.read_warc_bytes(f.read_bytes())] for f in (tmp_path / "warc").glob("part-*")]
    assert all(sum(f[:-1]) < 2_000_000 for f in files) and sum(map(len, files)) == len(rows) and len(files) > 6
    found = {r["page_id"]: (bytes(r["payload"]) if r["payload"] is not None else None, r["record_type"]) for r in A.read_warc(spark, path).collect()}
    assert all(found[i] == (h.encode(), "response") for i, _, h in rows)
    ids = [r["record_id"] for r in A.read_warc(spark, path, whole=False).collect()]
    assert len(set(ids)) == len(rows)


def test_extra_columns(spark):
    pages = spark.createDataFrame([(1, "u", "<p>" * 50, 3, "x", b"y"), (2, "u", "<p>" * 50, 3, "x", b"y")], "page_id long, url string, html string, size int, name string, payload binary")
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in A.round_trip(pages).collect()) == [(1, "response", None), (2, "revisit", 1)]
