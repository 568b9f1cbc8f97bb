"""The pipeline against plain Python: every stage's verdicts recomputed over all rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import md5
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from matchloom.llm.shared import shared_dir

from .test_ngram_join import brute as components_of
from .test_oracles import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]+", "0", line)).strip(" ").lower()


def is_common(texts, all_texts):
    return len(texts) > 10 and len(texts) > 0.01 * len(all_texts)


def by_rules(rows):
    """The rows that stay, their texts as they were, and as the stage hands them on."""
    lines = {t: [x for x in t.split("\n") if WORD.search(x)] for _, t, _ in rows}
    texts, seen = defaultdict(set), defaultdict(set)
    for _, t, s in rows:
        texts[s].add(t)
        for x in lines[t]:
            seen[s, plain(x)].add(t)
    kept, cleaned = [], []
    for row in rows:
        d, t, s = row
        goes = lambda x: is_common(seen[s, plain(x)], texts[s])  # noqa: B023, E731
        words = WORD.findall(t)
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        many = Counter(windows)
        inside = {j for i, w in enumerate(windows) if many[w] > 1 for j in range(i, i + 8)}
        gone = sum(len(WORD.findall(x)) for x in lines[t] if goes(x))
        left = len(words) - gone
        if len(words) >= 20 and 100 * len(inside) <= 30 * len(words) and left >= 20 and left >= 0.3 * len(words):
            kept.append(row)
            cleaned.append((d, "\n".join(x for x in t.split("\n") if not goes(x)), s))
    return kept, cleaned


def by_copies(rows):
    best = {}
    for row in rows:
        key = ascii_lower(row[1])
        best[key] = max(best.get(key, row), row, key=lambda r: r[0])
    return list(best.values())


def by_near_copies(rows):
    leads = {int(c) for _, _, c in components_of([(r[0], r[1]) for r in rows])}
    return [r for r in rows if r[0] in leads]


def mixed(rows):
    size = {r[0]: len(WORD.findall(r[1])) for r in rows}
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[r[0]] for r in rows if r[2] == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    target, left = {}, set(sources)
    while left:
        level = (1.5 * sum(total.values()) - sum(target.values())) / sum(weight[s] for s in left)
        full = {s for s in left if weight[s] * level >= 2 * total[s]}
        target |= {s: 2.0 * total[s] for s in full} if full else {s: weight[s] * level for s in left}
        left = left - full if full else set()
    out = []
    for s in sources:
        whole, over = divmod(math.floor(target[s] + 0.5), total[s])
        for r in sorted((r for r in rows if r[2] == s), key=lambda r: md5(f"mix|{r[0]}".encode()).hexdigest()[:15]):
            extra = max(0, min(size[r[0]], over))
            over -= extra
            out += [r[:2]] * (whole + (extra == size[r[0]]))
            if 0 < extra < size[r[0]]:
                out.append((r[0], " ".join(WORD.findall(r[1])[:extra])))
    return out


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    rows = documents()
    df = spark.createDataFrame([(*r, "en", 0, "x") for r in rows], "doc_id long, text string, source string, lang string, n_chars long, uid string")
    df.repartition(3).write.parquet(f"{path}/documents.parquet")
    return path, [(d, t or "", s) for d, t, s in rows]


def test_rows(spark, tables):
    pipeline = pytest.importorskip("corpus_pipeline")
    path, rows = tables
    want = mixed(by_near_copies(by_copies(by_rules(rows)[1])))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for d, t in want}
    lengths = sorted((d, len([*tokenizer.encode(t, add_special_tokens=False).ids, 2])) for d, t in want)
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = {p.name for p in folder.glob("*")}
    pieces = pipeline.run(spark, path).collect()
    made = {p.name.rsplit("-", 1)[0] for p in folder.glob("*") if p.name not in before}
    assert "pipeline-mixing" in made and not made & {"pipeline-quality_rules", "pipeline-exact_dedup", "pipeline-ngram_jaccard_join", "recipes", "token-sets", "links", "word-counts"}
    assert sum(r["length"] for r in pieces) == sum(n for _, n in lengths)
    assert sorted((r["doc_id"], r["doc_tokens"]) for r in pieces if r["start"] == 0) == lengths
    for r in pieces:
        if r["doc_tokens"] == len(ids[r["doc_id"]]):
            assert zlib.crc32(np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]
    full = Counter()
    for r in pieces:
        full[r["sequence_id"]] += r["length"]
    assert all(n == 4096 for s, n in full.items() if s != max(full))


def test_stages_keep_columns_and_survive_odd_rows(spark, tables):
    pipeline = pytest.importorskip("corpus_pipeline")
    rnd = random.Random(1)
    text = " ".join(f"w{rnd.randrange(500)}" for _ in range(60))
    rows = [(None, text, None), (None, text, None), (1, text + " end", "a"), (1, text + " end", "a"), (1, text[::-1], "a"), (2, None, None), (3, "", "b"), (4, "z " + text[::-1], "b")]
    docs = spark.createDataFrame([(*r, "k", "u", 5) for r in rows], "doc_id long, text string, source string, key string, uid string, kept int")
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        out.collect()
        assert stage(spark, docs.limit(0), "").count() == 0
    left = pipeline.STAGES[1][1](spark, docs, "").collect()
    assert len(left) == 5
    assert len(pipeline.STAGES[2][1](spark, docs, "").collect()) == 4
    assert pipeline.STAGES[-1][1](spark, docs, "").count() == 8
