"""The Merkle manifest against plain Python."""

import hashlib
import random
import zlib

from matchloom.llm import merkle

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    doc, _, lang, source, n = row
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def climb(nodes, width):
    """Top of a list of digests, and the siblings (before, after) of each, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            run = at[i] // width * width
            paths[i] = [*p, ("".join(nodes[run : at[i]]), "".join(nodes[at[i] + 1 : run + width]))]
            at[i] //= width
        nodes = [sha("".join(nodes[k : k + width])) for k in range(0, len(nodes), width)]
    return nodes[0], paths


def brute(rows, share=5, width=16):
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append(r)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    lower, subroots = {}, []
    for s in order:
        own = sorted(trees[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        lower[s] = own, *climb([leaf_of(r, r[1]) for r in own], width)
        subroots.append(lower[s][1])
    root, upper = climb(subroots, width)
    out = []
    for s, above in zip(order, upper, strict=True):
        own, subroot, paths = lower[s]
        for r, p in zip(own, paths, strict=True):
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % share == 0:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            h = leaf_of(r, text)
            for before, after in p + above:
                h = sha(before + h + after)
            out.append((r[0], leaf_of(r, r[1]), subroot, root, sha("".join(a + b for a, b in p + above)), h, h == root))
    return sorted(map(str, out))


def found(spark, rows, **settings):
    docs = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "1 AS key", "2 AS pos", "3 AS size", "'x' AS h", "4 AS uid", "5 AS path").repartition(3)
    got = merkle.tampered(docs, **settings).collect()
    return sorted(str(tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))) for r in got)


def test_against_plain_python(spark):
    rnd = random.Random(4)
    word = lambda: rnd.choice(["Alpha", "beta", "É", "x", "\n", "ZETA"])
    rows = []
    for source, n in ((None, 17), ("", 1), ("a", 16), ("B", 300), ("é", 33), ("b", 2)):
        rows += [(rnd.randrange(10**6), " ".join(word() for _ in range(rnd.randrange(6))), rnd.choice(["en", None]), source, rnd.choice([None, 3])) for _ in range(n)]
    rows += [(None, None, None, None, None), (None, "Text", "en", "a", 4), (5, "Long " * 200_000, "en", "a", 1_000_000), *rows[:5], *rows[:2]]
    assert found(spark, rows) == brute(rows)
    assert any("False" in x for x in brute(rows))


def test_another_width_and_many_sources(spark):
    rows = [(i, f"T{i}", "en", f"s{i % 13}" if i % 5 else "hot", i) for i in range(80)]
    assert found(spark, rows, width=3, share=2) == brute(rows, 2, 3)


def test_one_row(spark):
    rows = [(10, "Only", None, None, None)]
    assert found(spark, rows) == brute(rows)


def test_windows_hold_one_run(spark):
    rows = [(i, f"t{i}", "en", "s", 2) for i in range(40)]
    plan = merkle.manifest(spark.createDataFrame(rows, COLUMNS))._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and all("run#" in line.split("],")[-2] for line in windows)
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
