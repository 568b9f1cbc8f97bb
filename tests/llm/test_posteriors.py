"""The site levels against plain Python, from the evidence and the labels; conflicting labels; bounds of the sample."""

import math
import random
from collections import defaultdict

from pyspark.sql import functions as F

from matchloom.llm import quality_model


def logit(p):
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def strength(groups, up):
    """groups: (n, rate) of each site; up: the rate of the level above of each."""
    n = sum(g[0] for g in groups)
    spread = sum(g[0] * (g[1] - u) ** 2 for g, u in zip(groups, up)) / n
    chance = sum(u * (1 - u) for u in up) / n
    level = sum(g[0] * u * (1 - u) for g, u in zip(groups, up)) / n
    return min(1e5, max(1.0, level / max(spread - chance, 1e-9) - 1))


def brute(rows, evidence, label):
    """site and p of each row; rows: host, path."""
    value = [e if y is None else float(y) for e, y in zip(evidence, label)]
    by_path, by_host = defaultdict(list), defaultdict(list)
    for i, (h, p) in enumerate(rows):
        by_path[h, p].append(i)
        by_host[h].append(i)
    top = sum(value) / len(value)
    total = lambda at: sum(value[i] for i in at)
    k = strength([(len(x), total(x) / len(x)) for x in by_host.values()], [top] * len(by_host))
    host = {h: (total(x) + k * top) / (len(x) + k) for h, x in by_host.items()}
    k = strength([(len(x), total(x) / len(x)) for x in by_path.values()], [host[h] for h, _ in by_path])
    out = []
    for i, (h, p) in enumerate(rows):
        at = by_path[h, p]
        site = (total(at) - value[i] + evidence[i] + k * host[h]) / (len(at) + k)
        out.append((site, 1 / (1 + math.exp(-(logit(evidence[i]) + logit(site) - logit(top))))))
    return out


def test_against_plain_python(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(900):
        host = rnd.choice(["hot"] * 6 + [f"h{j}" for j in range(25)])
        path = f"p{rnd.randrange(3 if host == 'hot' else 2)}"
        good = 0.9 if host in ("hot", "h1", "h2") else 0.4
        evidence = [min(0.999, max(0.001, rnd.gauss(good, 0.3))), rnd.random() ** 6]
        label = [rnd.choice([None, None, int(rnd.random() < good)]), rnd.choice([None, None, None, int(rnd.random() < 0.1)])]
        rows.append((i // 2, host, path, *evidence, *label))
    kind = "doc_id long, host string, path string, evidence_quality double, evidence_toxic double, quality int, toxic int"
    got = quality_model.posteriors(spark.createDataFrame(rows, kind).repartition(3)).collect()
    want = {}
    for c, e, y in (("quality", 3, 5), ("toxic", 4, 6)):
        want[c] = brute([r[1:3] for r in rows], [r[e] for r in rows], [r[y] for r in rows])
    near = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    expected = sorted(near((r[0], r[1], r[2], r[3], r[4], *want["quality"][i], *want["toxic"][i], want["quality"][i][1] >= 0.5 and want["toxic"][i][1] < 0.3)) for i, r in enumerate(rows))
    found = sorted(near((r["doc_id"], r["host"], r["path"], r["evidence_quality"], r["evidence_toxic"], r["site_quality"], r["p_quality"], r["site_toxic"], r["p_toxic"], r["kept"])) for r in got)
    assert all(a == b or all(x == y if not isinstance(x, float) else abs(x - y) < 1e-6 for x, y in zip(a, b)) for a, b in zip(found, expected))
    assert len(found) == len(expected)


def test_whole_operator_uses_these_posteriors(spark):
    rnd = random.Random(4)
    docs = [(i, " ".join(rnd.choice(["good", "fine", "bad", "poor"]) for _ in range(30)), f"h{i % 4}", f"p{i % 3}") for i in range(300)]
    labels = [(i, int(docs[i][1].count("good") > 7), int(docs[i][1].count("bad") > 9)) for i in range(0, 300, 2)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, host string, path string")
    got = {r["doc_id"]: r for r in quality_model.judged(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), F.col("host"), F.col("path")).collect()}
    by_doc = {d: (q, t) for d, q, t in labels}
    rows = [d[2:] for d in docs]
    for k, c in enumerate(("quality", "toxic")):
        want = brute(rows, [got[d[0]][f"evidence_{c}"] for d in docs], [by_doc[d[0]][k] if d[0] in by_doc else None for d in docs])
        assert all(abs(got[d[0]][f"site_{c}"] - w[0]) < 1e-6 and abs(got[d[0]][f"p_{c}"] - w[1]) < 1e-6 for d, w in zip(docs, want))


def test_conflicting_labels(spark):
    rows = [(1, 1, 0), (1, 0, 1), (2, 1, 0), (2, 1, 0), (2, 0, 1), (3, None, 1), (None, 1, 1), (4, 1, None)]
    got = quality_model.known_labels(spark.createDataFrame(rows, "doc_id long, quality int, toxic int").repartition(4))
    assert sorted((r["doc_id"], r["quality"], r["toxic"]) for r in got.collect()) == [(1, 0, 1), (2, 1, 0), (3, None, 1), (4, 1, None)]


def test_sample_is_bounded_in_rows_and_bytes(spark):
    docs = spark.createDataFrame([(i % 500, "x" * 1000 + str(i // 500)) for i in range(1000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(500)], "doc_id long, quality int, toxic int")
    sample = lambda *most: quality_model.labelled_sample(docs, labels, *most).collect()
    whole = sample(1000, 10**9)
    assert len(whole) == 500 and all(r["text"].endswith("0") for r in whole)
    assert 10 < len(sample(40, 10**9)) < 90 and 10 < len(sample(1000, 40_000)) < 90


def test_columns_of_clashing_names_and_empty_tables(spark):
    """Columns of docs and labels that are named as those the operator makes change nothing; no documents or no labels are no error."""
    rnd = random.Random(6)
    good, bad = [f"fine{i}" for i in range(40)], [f"spam{i}" for i in range(40)]
    rows = [(i, " ".join(rnd.choice(good if i % 3 else bad) for _ in range(30)), f"h{i % 4}", None if i % 7 else "p") for i in range(200)] + [(500, None, None, None), (501, "", "h1", "p"), (None, "fine1 fine2", "h1", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 3 == 0)) for i in range(0, 200, 2)], "doc_id long, quality int, toxic int")
    clash = ["quality", "toxic", "host", "path", "score_quality", "evidence_toxic", "p_quality", "kept", "features", "site_toxic", "uid"]
    of = lambda d, l: sorted(map(str, quality_model.judged(d, l, F.col("source"), F.col("lang")).collect()))
    want = of(docs, labels)
    assert len(want) == len(rows)
    assert of(docs.select("*", *[F.lit("x").alias(c) for c in clash]), labels.select("*", *[F.lit("y").alias(c) for c in ("text", "source", "lang", "host", "kept")])) == want
    assert of(docs.limit(0), labels) == [] and len(of(docs, labels.limit(0))) == len(rows)
