"""MinHash near-dedup against all pairs, and its comparison of signatures."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchloom.llm import minhash

from .test_ngram_join import brute


def got(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("size", "key", "keys", "uid", "component", "first", "kept")}).repartition(3)
    found = minhash.near_duplicates(docs, **settings).collect()
    assert all(r["doc_id"] == r["component_id"] for r in found if r["kept"])
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found)


def test_cases_without_words(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c"), (None, "one two three four five six"), (7, "one two three four five six"), (7, "one two three four five six"), (None, "alone here")]
    assert got(spark, rows) == brute(rows, 85)


def edited(rnd, words, text, times):
    text = list(text)
    for _ in range(times):
        at = rnd.randrange(len(text))
        text[at : at + rnd.choice([0, 1])] = [rnd.choice(words)]
    return text


def test_against_all_pairs(spark):
    """Groups about the limit, and a key of very many documents that are not all in one component."""
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(500)]
    bases = [[rnd.choice(words) for _ in range(rnd.choice([3, 6, 9, 40, 120, 300]))] for _ in range(14)] + [[rnd.choice(words) for _ in range(150)]]
    rows = [(i, " ".join(edited(rnd, words, bases[-1] if i % 2 else rnd.choice(bases), rnd.choice([0, 1, 1, 2, 3, 4, 5])))) for i in range(420)]
    rows += [(1000 + i, rows[i % 7][1].upper()) for i in range(90)] + [(2000, " ".join(words) * 60)]
    want = brute(rows, 85)
    assert got(spark, rows) == want
    assert len({c for _, _, c in want}) > 20
    with pytest.raises(ValueError, match="85"):
        minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=80)


def test_keeps_one_row_of_each_component(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(5, text), (3, text + " end"), (9, "other words are here for once"), (3, text + " end"), (None, text), (4, None), (6, None)]
    kept = minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").withColumn("more", F.lit("x")))
    assert kept.columns == ["doc_id", "text", "more"] and sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "4", "6", "9"]


def test_signatures_estimate_similarity():
    rnd = np.random.default_rng(1)
    for share in (0.5, 0.85, 0.95):
        errors = []
        for n in (40, 900, 6000):
            x = rnd.integers(0, 2**64, n, dtype=np.uint64)
            y = np.concatenate([x[: int(n * 2 * share / (1 + share))], rnd.integers(0, 2**64, n - int(n * 2 * share / (1 + share)), dtype=np.uint64)])
            both = len(np.intersect1d(x, y))
            errors.append((minhash.signature(x) == minhash.signature(y)).mean() - both / (2 * n - both))
        assert abs(np.mean(errors)) < 0.06


def test_posterior_bounds():
    """The fewest equal hashes follow from the posterior, by numerical integration."""
    grid = (np.arange(200_000) + 0.5) / 200_000
    for n in (48, 96, 192):
        for miss in (1e-2, 1e-6):
            m = minhash.fewest(n, 0.85, miss)
            tail = lambda k, n=n: (lambda p: p[grid >= 0.85].sum() / p.sum())(np.exp(k * np.log(grid) + (n - k) * np.log1p(-grid) - (k * np.log(0.85) + (n - k) * np.log(0.15))))
            assert tail(m) >= miss > tail(m - 1)
    assert minhash.fewest(48, 0.85, 0.0) == 0


@pytest.mark.parametrize("similarity", [0.85, 0.9])
def test_comparison_misses_few_and_prunes_most(similarity):
    rnd = np.random.default_rng(2)
    n = 20_000

    def compared(s):
        one = rnd.integers(0, 256, (n, 192), dtype=np.uint8)
        two = np.where(rnd.random((n, 192)) < s, one, rnd.integers(0, 256, (n, 192), dtype=np.uint8))
        batch = pa.record_batch([pa.array(range(n)), pa.array(range(n)), pa.array([x.tobytes() for x in one], pa.binary()), pa.array([x.tobytes() for x in two], pa.binary())], names=["a", "b", "one", "two"])
        return sum(b.num_rows for b in minhash._compare(iter([batch]), 0.85, 1e-6))

    assert compared(similarity) >= n - 1 and compared(0.6) < n / 100 and compared(0.3) == 0


def test_near_group_gives_no_pairs(spark):
    """A text and a thousand near copies of it: about as many pairs are verified as there are documents."""
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(900)]
    base = [rnd.choice(words) for _ in range(220)]
    docs = spark.createDataFrame([(i, " ".join(edited(rnd, words, base, 2 if i else 0))) for i in range(1001)], "doc_id long, text string").coalesce(1)
    signed = minhash.stored(docs.mapInArrow(lambda it: minhash._sign(it, 5), minhash._COLUMNS), "test-signatures")
    found = minhash.links(docs, signed.dropDuplicates(["set_one", "set_two"]).drop("set_one", "set_two"), 5, 85, 1e-6)
    assert 1000 <= found.count() < 3000
    assert found.selectExpr("explode(array(a, b)) AS uid").distinct().count() == 1001
