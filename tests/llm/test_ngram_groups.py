"""Large groups of near copies whose members are linked in part, with tokens that most documents of a chunk hold; against all pairs."""

import random

import pytest

from matchloom.llm import ngram_join

from .test_ngram_join import brute, got


def drifted(rnd, base, words, edits):
    text = list(base)
    for _ in range(edits):
        text[rnd.randrange(len(text))] = rnd.choice(words)
    return text


def family(seed, n, words):
    """Near copies of near copies, some by shared edits, about the limit of similarity."""
    rnd = random.Random(seed)
    base = [rnd.choice(words) for _ in range(70)]
    made = [base]
    for _ in range(n):
        made.append(drifted(rnd, rnd.choice(made[-6:]) if rnd.random() < 0.5 else base, words, rnd.choice([1, 2, 2, 3])))
    return made


def test_groups_about_the_limit(spark):
    words = [f"w{i}" for i in range(500)]
    texts = family(1, 260, words) + family(2, 120, words)
    rnd = random.Random(7)
    rnd.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want = brute(rows)
    assert got(spark, rows) == want
    assert 30 < len({c for _, _, c in want}) < len(rows)


def test_groups_with_tokens_of_their_own(spark):
    """No document of the group is without tokens of its own, and none is the middle."""
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    base = [rnd.choice(words) for _ in range(60)]
    few = [rnd.randrange(60) for _ in range(5)]
    rows = []
    for i in range(200):
        text = list(base)
        for at in rnd.sample(few, rnd.choice([0, 1, 2])):
            text[at] = f"alt{rnd.randrange(2)}"
        text[rnd.randrange(60)] = f"own{i}"
        rows.append((i, " ".join(text)))
    assert got(spark, rows) == brute(rows)


def test_small_components_that_share_frequent_pairs(spark):
    """A template in 700 documents, whose own parts make pairs and single documents."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(2000)]
    template = [rnd.choice(words) for _ in range(60)]
    rows = []
    for i in range(350):
        own = [rnd.choice(words) for _ in range(rnd.choice([12, 20, 24]))]
        rows.append((2 * i, " ".join(template + own)))
        rows.append((2 * i + 1, " ".join(template + own[:-1] + (["end"] if i % 2 else own[-1:] + ["more"]))))
    assert got(spark, rows) == brute(rows)


def test_low_similarities_are_refused(spark):
    with pytest.raises(ValueError):
        ngram_join.linked(spark.createDataFrame([(1, "a")], "doc_id long, text string"), percent=60)


def test_hot_tokens_and_equal_sets_are_sent_once_a_chunk(spark, monkeypatch):
    """A passage in all documents of many chunks and a third of all documents alike: ranges get a row of them for each chunk, whatever the documents."""
    from pyspark.sql import functions as F

    rnd = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [passage if i % 3 == 0 else passage + " " + " ".join(f"w{rnd.randrange(10**6)}" for _ in range(12)) for i in range(6000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(24)
    packed = docs.mapInArrow(lambda it: ngram_join._spread(it, 5, 4, 10_000, 2), ngram_join._PACKED)
    rows = packed.groupBy("kind", "chunk").agg(F.sum(F.octet_length("tokens") / 7).alias("n"), F.sum(F.octet_length("docs") / 2).alias("docs")).collect()
    of = {k: {r["chunk"]: r for r in rows if r["kind"] == k} for k in (ngram_join._TOKENS, ngram_join._SIGNS, ngram_join._HOT, ngram_join._ALIKE)}
    chunks = len(of[ngram_join._HOT])
    assert chunks >= 20 and all(26 <= r["n"] < 40 for r in of[ngram_join._HOT].values())  # the passage's shingles, and no more
    assert sum(r["docs"] for r in of[ngram_join._SIGNS].values()) == 4000 + chunks and sum(r["docs"] for r in of[ngram_join._ALIKE].values()) == 2000 - chunks
    assert sum(r["n"] for r in of[ngram_join._TOKENS].values()) < 4000 * 17
    monkeypatch.setattr(ngram_join, "_SHARE", 0)
    words = [f"w{i}" for i in range(300)]
    family_rows = [(i, " ".join(t)) for i, t in enumerate(family(4, 150, words))]
    family_rows += [(1000 + i, family_rows[i % 3][1]) for i in range(60)]
    assert got(spark, family_rows) == brute(family_rows)


def test_documents_of_a_group_are_compared_with_few_leaders(spark, monkeypatch):
    """A document is in many keys with documents of other components; what it is compared with does not grow with these."""
    from pyspark.sql import functions as F

    met = []
    around = ngram_join._around_leaders

    def counted(rows, near, percent):
        met.append(rows.agg(F.count_distinct("c", "uid"), F.count_distinct("uid"), F.count_distinct("key")).first())
        return around(rows, near, percent)

    monkeypatch.setattr(ngram_join, "_around_leaders", counted)
    words = [f"w{i}" for i in range(500)]
    rows = [(i, " ".join(t)) for i, t in enumerate(family(1, 400, words))]
    assert got(spark, rows) == brute(rows)
    pairs, docs, keys = met[0]
    assert docs > 200 and keys > 20 and pairs <= 1.5 * docs, (pairs, docs, keys)
