import random
import re

from pyspark.sql import functions as F

from matchloom.llm import ngram_join


def brute(rows, percent=75):
    """Component and set size of each row, from all pairs."""
    sets = []
    for _, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()})
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted((str(d), len(s), str(least.get(root(i)))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def got(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit("x")).withColumn("key", F.lit(1)).repartition(3)
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in ngram_join.linked(docs).collect())


def test_cases_without_words(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c"), (None, "one two three four five six"), (7, "one two three four five six"), (7, "one two three four five six"), (None, "alone here")]
    assert got(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert ngram_join.linked(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_against_all_pairs(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(words) for _ in range(40)]
    bases = [[rnd.choice(words) for _ in range(rnd.choice([3, 5, 6, 8, 12, 30, 90]))] for _ in range(12)]
    rows = []
    for i in range(420):
        text = list(bases[0] if i % 3 == 0 else rnd.choice(bases))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
            at = rnd.randrange(len(text))
            text[at : at + rnd.choice([0, 1])] = [rnd.choice(words)]
        if rnd.random() < 0.3:
            text += passage[: rnd.choice([40, 40, 12])]
        rows.append((i, " ".join(text)))
    want = brute(rows)
    assert got(spark, rows) == want
    assert len({c for _, _, c in want}) > 20
