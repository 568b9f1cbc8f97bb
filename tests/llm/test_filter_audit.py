"""The filter audit against plain Python, and its sketch."""

import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from matchloom.llm import filter_audit


def masks(rows):
    out = []
    for doc, text, _ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        smaller = any((o or "") == t and (d is None or d < doc) for d, o, _ in rows if d != doc) if doc is not None else False
        tests = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search(r"[#$%&*|]", t)), smaller]
        out.append(sum(x << i for i, x in enumerate(tests)))
    return out


def brute(rows, labels):
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, t in labels if t == 1 and d is not None}
    out = []
    for part in {s or "" for *_, s in rows}:
        own = [(m, d) for m, (d, _, s) in zip(masks(rows), rows, strict=True) if (s or "") == part]
        lines, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                bit = 1 << "ABCDE".index(f)
                gone = [x for x in left if x[0] & bit]
                fails = sum(m & bit > 0 for m, _ in own)
                left = [x for x in left if not x[0] & bit]
                total[f] += len(gone)
                lines.append((part, "".join(order), step, f, len(left), len(gone), fails - len(gone), sum(m == bit for m, _ in own), sum(d in good for _, d in gone), sum(d in toxic for _, d in gone)))
        out += [(*x[:3], *x[4:], total[x[3]]) for x in lines]
    return sorted(out)


def sample():
    rnd = random.Random(8)
    words = ["Ab", "cd", "ef", "gh#", "É", "IJ", *[f"w{i}" for i in range(60)]]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([3, 40, 60, 90]))) for _ in range(40)] + [None, "", " \t\n", "Q" * 70, " ".join(f"v{i}" for i in range(80)), "x " * 100_000]
    rows = [(rnd.choice([None, *range(150)]), rnd.choice(texts), rnd.choice([None, "", "a", "b", "b", "b"])) for _ in range(220)]
    rows += [(7, texts[0], "a"), (7, texts[0], "a"), (None, texts[0], "b"), (None, texts[0], "b")]
    labels = [(rnd.choice([None, *range(150)]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(120)]
    return rows, labels


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


@pytest.mark.parametrize("most", [filter_audit.MOST_BROADCAST, 0])
def test_against_plain_python(spark, monkeypatch, most):
    """Also where the sketch is too large to be broadcast."""
    monkeypatch.setattr(filter_audit, "MOST_BROADCAST", most)
    rows, labels = sample()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS part", "2 AS mask", "3 AS block", "4 AS hash", "5 AS words", "6 AS n", "7 AS again").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("is_good", F.lit(9)).repartition(2)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in filter_audit.audited(docs, marks).collect()) == brute(rows, labels)


def test_no_labels_and_no_rows(spark):
    rows, _ = sample()
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows[:30], "doc_id long, text string, source string")
    assert sorted(tuple(r[c] for c in COLUMNS) for r in filter_audit.audited(docs, none).collect()) == brute(rows[:30], [])
    assert filter_audit.audited(docs.limit(0), none).count() == 0


def test_sketch_clears_most_texts_and_no_repeat(spark):
    texts = [f"text number {i}" for i in range(4000)]
    rows = [(i, t) for i, t in enumerate(texts + texts[:300] * 2 + ["hot"] * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s")).repartition(7)
    blocks = 9300 * 16 >> 14
    marked = docs.select("text", *filter_audit._hashed(F.col("text"), blocks)).join(filter_audit.sketch(docs, blocks), "block", "left").filter(filter_audit._maybe_repeated())
    told = {r["text"] for r in marked.select("text").distinct().collect()}
    assert set(texts[:300]) | {"hot"} <= told and len(told) < 301 + 0.03 * 4000
    failing = filter_audit.failing(docs).filter(F.col("mask").bitwiseAND(16) > 0)
    assert {r["doc_id"] for r in failing.select("doc_id").collect()} == set(range(4000, 4600)) | set(range(4601, 9600))
