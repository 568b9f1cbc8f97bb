"""Boilerplate lines leave the texts that the quality rules hand on; against plain Python."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from matchloom.llm import quality_rules

from .test_oracles import documents
from .test_pipeline import by_rules, is_common, plain


def test_first_stage_takes_boilerplate_lines_out(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(d, t or "", s) for d, t, s in documents()]
    rows += rows[:40]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    whole, want = by_rules(rows)
    assert Counter(want) != Counter(whole)
    got = pipeline.STAGES[0][1](spark, docs, "")
    assert got.columns == docs.columns
    found = Counter(map(tuple, got.collect()))
    assert found == Counter(want)
    texts, seen = defaultdict(set), defaultdict(set)
    for _, t, s in rows:
        texts[s].add(t)
        for x in t.split("\n"):
            seen[s, plain(x)].add(t)
    assert not any(plain(x) and is_common(seen[s, plain(x)], texts[s]) for _, t, s in found for x in t.split("\n"))


def own(i):
    return " ".join(f"v{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(150))


def test_lines_go_by_place_and_host(spark):
    footer = "Page 7 of the   makers of this page and of its other pages, with all rights reserved to them"
    text = lambda i: f"{footer.replace('7', str(i))}\n\n{own(i)}\n \n{footer}\n"
    rows = [(i, text(i), s, 9) for s in ("h", None) for i in range(20)] + [(25, text(25), "other", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    clean = lambda i: f"\n{own(i)}\n \n"
    assert Counter(map(tuple, quality_rules.accepted(docs).collect())) == Counter((i, t, s, n) if s == "other" else (i, clean(i), s, len(clean(i))) for i, t, s, n in rows)
    places = {(r["doc_id"], r["host"]): r["removed_lines"] for r in quality_rules.judged(docs).collect()}
    assert all(x == ("" if h == "other" else "0,4") for (_, h), x in places.items())


def test_lines_of_a_host_with_most_rows(spark):
    """A passage in over a hundredth of a large host's texts goes there, one in fewer of them stays, and a text with many copies stays whole."""
    passage, rarer = "this passage stands in many a text of the host", "and this one stands in some of them only"
    rows = []
    for i in range(2000):
        lines = [own(i)] + [passage] * (i % 40 == 0) + [rarer] * (i % 133 == 0)
        rows.append((i, "\n".join(lines), "hot"))
    rows += [(5000 + i, own(2500), "hot") for i in range(300)] + [(9000 + i, f"{own(i)}\n{passage}", f"h{i}") for i in range(30)]
    got = {r["doc_id"]: r for r in quality_rules.accepted(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert len(got) == len(rows)
    assert all(got[d]["text"] == (t.replace(f"\n{passage}", "") if s == "hot" else t) for d, t, s in rows)


def test_removed_words_are_those_of_the_removed_lines(spark):
    rows = quality_rules.judged(spark.createDataFrame(documents(), "doc_id long, text string, source string"))
    odd = rows.filter(((F.col("removed_words") > 0) != (F.col("removed_lines") != "")))
    assert odd.count() == 0 and rows.filter("removed_words > 0").count() > 20
