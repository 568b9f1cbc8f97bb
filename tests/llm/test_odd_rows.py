"""Nulls in any column, repeated rows, long texts, ties and columns with names that the operators use."""

import pytest
from pyspark.sql import functions as F

from matchloom.llm import exact_dedup, line_dedup, mixing, quality_rules

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
TEXT = "\n".join(" ".join(f"t{i}{j}" for j in range(12)) for i in range(5))
ROWS = [(None, TEXT, None), (None, TEXT, None), (None, None, "a"), (1, TEXT, "a"), (1, TEXT, "a"), (1, "", None), (2, LONG, "b"), (2, LONG.upper(), "b"), (3, "\n\n", "b"), (4, "t00 x", "c")]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    clash = ["uid", "kept", "size", "key", "pos", "line", "n_words", "h", "block", "before", "target", "recipe", "text_key", "place", "host", "row", "words"]
    return df.select("*", *[F.lit(7).alias(c) for c in clash]).repartition(3)


def test_exact_dedup(docs):
    rows = exact_dedup.exact_duplicates(docs).collect()
    assert len(rows) == len(ROWS) and sum(r["kept"] for r in rows) == 5
    by_size = {r["text_sha256"]: r for r in rows if r["kept"]}
    sizes = sorted((r["group_size"], str(r["keep_id"])) for r in by_size.values())
    assert sizes == [(1, "3"), (1, "4"), (2, "1"), (2, "2"), (4, "1")]
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == 5


def test_chunks_follow_the_text():
    import numpy as np

    from matchloom.llm import textbytes as tb

    one = np.frombuffer(LONG.encode(), np.uint8)
    two = np.concatenate([np.frombuffer(b"put in front ", np.uint8), one])
    cuts = [next(exact_dedup.cut_points(x, np.array([0, len(x)]), 11)) for x in (one, two)]
    chunks = [{x[a:b].tobytes() for a, b in zip(c[:-1], c[1:], strict=True)} for x, c in zip((one, two), cuts, strict=True)]
    assert len(chunks[0] & chunks[1]) >= 0.9 * len(chunks[0]) > 20
    assert all(b - a <= 16384 for c in cuts for a, b in zip(c[:-1], c[1:], strict=True))
    assert tb.LOWER[65] == 97


def test_line_dedup(docs):
    rows = line_dedup.deduplicated(docs, with_text=False).collect()
    assert len(rows) == len(ROWS)
    assert sorted((str(r["doc_id"]), r["n_lines"], r["n_equal"], r["n_near"]) for r in rows) == [
        ("1", 0, 0, 0), ("1", 5, 5, 0), ("1", 5, 5, 0), ("2", 1, 0, 0), ("2", 1, 1, 0), ("3", 0, 0, 0), ("4", 1, 0, 0), ("None", 0, 0, 0), ("None", 5, 0, 0), ("None", 5, 5, 0)]
    texts = line_dedup.deduplicated(docs)
    assert set(docs.columns) <= set(texts.columns) | {"kept"}
    assert sorted(len(r["text"] or "") for r in texts.collect()) == sorted([0, 0, 0, 0, 0, 0, len(TEXT), len(LONG), 2, 5])


def test_lines_within_one_word(spark):
    line = "one two three four five six seven eight nine"
    near = [line.replace("five", "FIVE5"), line.replace("five ", ""), line + " ten", "zero " + line, line.replace("nine", "x")]
    far = [line.replace("five", "a").replace("six", "b"), "two one three four five six seven eight nine", "seven words are not enough for it", "seven words are not enough for that"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([line, *near, *far])], "doc_id long, text string")
    got = {r["doc_id"]: r["n_near"] for r in line_dedup.deduplicated(docs, with_text=False).collect()}
    assert [got[i] for i in range(len(got))] == [0, 1, 1, 1, 1, 1, 0, 0, 0, 0]


def test_quality_rules(docs):
    rows = quality_rules.judged(docs).collect()
    assert len(rows) == len(ROWS) and sum(r["kept"] for r in rows) == 6
    assert quality_rules.accepted(docs).columns == docs.columns and quality_rules.accepted(docs).count() == 6


def test_boilerplate_goes_and_copies_do_not_reject_each_other(spark):
    own = lambda i: " ".join(f"v{chr(97 + int(i) // 26)}{chr(97 + int(i) % 26)}{chr(97 + j)}" for j in range(25)) + " and so on to here"
    footer = "all rights reserved 2001 by the makers of this page and its other pages in the world of pages and words"
    rows = [(i, f"{own(i)}\n{footer.replace('2001', str(i))}", "h") for i in range(40)] + [(100 + i, own(99), "h") for i in range(30)] + [(200, footer, "h"), (201, footer, "other")]
    got = {r["doc_id"]: r for r in quality_rules.judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i]["removed_words"] == 21 and got[i]["kept"] for i in range(40))
    assert all(got[100 + i]["removed_words"] == 0 and got[100 + i]["kept"] for i in range(30))
    assert not got[200]["kept"] and got[201]["kept"]


def test_mixing(docs):
    rows = mixing.mixed(docs).collect()
    assert len(rows) == len(ROWS)
    by_source = {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by_source.setdefault(r["source"], []).append(r)
    for group in by_source.values():
        assert abs(sum(r["taken"] for r in group) - group[0]["target"]) <= 0.5
    mix = mixing.repeated(docs)
    assert mix.columns == docs.columns
    words = mix.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert words == sum(r["taken"] for r in rows)


def test_water_fill():
    got = mixing.water_fill({"a": 10, "b": 100, "c": 1000, "d": 0}, {"a": 3, "b": 1, "c": 2, "d": 3}, 1665, 2)
    assert got["a"] == 20 and got["b"] == 200 and got["d"] == 0 and abs(got["c"] - 1445) < 1e-9
    assert mixing.water_fill({}, {}, 0, 2) == {}
