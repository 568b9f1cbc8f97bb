"""The text queries against their SQL on a small table with nulls, copies, near copies, repeated lines and odd blanks."""

import random

import duckdb
import pytest

from matchloom.llm.queries import ORACLES, QUERIES


def documents():
    rnd = random.Random(11)
    words = [f"{a}{b}" for a in ("ka", "Lo", "mí", "tes", "x1", "ÉR") for b in ("ra", "NE", "to.", "um,", "9", "#!", "ss")]

    def line(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    common = [line(12), line(30)]
    texts = [None, "", " \t\n\x0b ", "one", "Seven words in this line, that's it", "\n\n"]
    bases = ["\n".join(line(rnd.choice([3, 9, 14, 40])) for _ in range(rnd.choice([1, 4, 8]))) for _ in range(25)]
    for _ in range(220):
        parts = rnd.choice(bases).split("\n")
        if rnd.random() < 0.5:
            at = rnd.randrange(len(parts))
            own = parts[at].split(" ")
            k = rnd.randrange(len(own))
            own[k : k + rnd.choice([0, 1, 1])] = [rnd.choice(words)] * rnd.choice([0, 1, 1])
            parts[at] = " ".join(own)
        if rnd.random() < 0.4:
            parts.insert(rnd.randrange(len(parts) + 1), rnd.choice(common))
        if rnd.random() < 0.1:
            parts += [parts[0]] * 5
        text = "\n".join(parts)
        texts.append(text.upper() if rnd.random() < 0.1 else text)
    texts += [bases[0]] * 20 + [line(4000), "spam " * 300, "x" * 5000, "a b c " * 30]
    rnd.shuffle(texts)
    return [(3 * i, t, rnd.choice(["b", "a", "A", "é", None, "hot", "hot", "hot"])) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame(documents(), "doc_id long, text string, source string").selectExpr("*", "'en' AS lang", "length(text) AS n_chars", "1 AS uid", "2 AS line")
    docs.coalesce(2).write.parquet(f"{path}/documents.parquet")
    rnd = random.Random(3)
    labels = [(3 * i, rnd.choice([0, 1, None]), rnd.choice([0, 0, 1])) for i in range(0, 260, 2)] + [(6, 1, 1), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{path}/labels.parquet")
    pages = [(i, f"http://h{i % 7}.org/{i}", h) for i, h in enumerate([None, "", "short", "short"] + ["<p>" + "é" * (i % 9) * 20 + "\r\n\r\nWARC/1.1\r\n</p>" * 6 for i in range(60)])]
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3).write.parquet(f"{path}/pages.parquet")
    return path


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal(spark, folder, name):
    db = duckdb.connect()
    for table in ("documents", "labels", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    found = QUERIES[name](spark, folder)
    columns = sorted(found.columns)
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    got = [tuple(r[c] for c in columns) for r in found.collect()]
    order = lambda r: tuple(str(v) for v in r)
    assert sorted(got, key=order) == sorted(want, key=order)
    assert got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op3_warc", "op5_quality_classifier"}))
def test_empty_table(spark, tmp_path, name):
    spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0
