import random

from pyspark.sql import functions as F

from matchloom.llm import quality_model


def corpus(n=1500):
    rnd = random.Random(8)
    plain, bad = [f"wo{i}rd" for i in range(300)], ["awful", "horrid", "vile"]
    docs, labels = [], []
    for i in range(n):
        kind = rnd.choice(["good", "good", "good", "junk", "toxic"])
        words = rnd.choices(plain, k=rnd.choice([30, 80]))
        if kind == "junk":
            words = [w.upper() + "!!" for w in words]
        if kind == "toxic":
            words[rnd.randrange(20)] = rnd.choice(bad)
            words[rnd.randrange(20)] = rnd.choice(bad)
        docs.append((i, " ".join(words), "spam" if kind == "junk" and i % 2 else f"h{i % 5}", "p"))
        labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    return docs, labels


def test_held_out(spark):
    docs, labels = corpus()
    known, rest = [x for x in labels if x[0] % 3], [x for x in labels if not x[0] % 3]
    frame = spark.createDataFrame(docs, "doc_id long, text string, host string, path string").withColumn("n", F.lit("x"))
    lab = spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality_model.judged(frame, lab, F.col("host"), F.col("path")).collect()}
    right = [got[d]["kept"] == bool(q and not t) for d, q, t in rest]
    assert sum(right) / len(right) > 0.95
    spam = next(r for r in got.values() if r["host"] == "spam")
    assert spam["site_quality"] < 0.2 < 0.6 < next(r for r in got.values() if r["host"] == "h1")["site_quality"]


def test_sparse_sites_shrink(spark):
    docs, labels = corpus(600)
    docs.append((9000, docs[0][1], "lone", "q"))
    frame = spark.createDataFrame(docs, "doc_id long, text string, host string, path string")
    lab = spark.createDataFrame([*labels, (9000, 0, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality_model.judged(frame, lab, F.col("host"), F.col("path")).collect()}
    assert 0.2 < got[9000]["site_quality"] < 0.95


def test_nulls_ties_and_no_labels(spark):
    rows = [(None, None, None, None), (1, "", "h", None), (1, "", "h", None), (2, "word " * 20000, None, "p"), (3, "é ü", "h", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (2, None, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        got = quality_model.judged(docs, labels, F.col("host"), F.col("path")).collect()
        assert len(got) == 5 and all(r["p_quality"] is not None for r in got)
    assert all(r["kept"] for r in quality_model.judged(docs, none, F.col("host"), F.col("path")).collect())
    assert quality_model.judged(docs.limit(0), none, F.col("host"), F.col("path")).count() == 0
