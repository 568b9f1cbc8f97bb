"""Near copies of lines of any length are found, held against plain Python."""

import random

from matchloom.llm import line_dedup


def is_near(a, b):
    a, b = sorted((a, b), key=len)
    if len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def test_lines_of_any_length(spark):
    rnd = random.Random(5)
    lines = []
    for n in (7, 8, 9, 16, 17, 40, 499, 500, 501, 502, 4000, 20_000):
        words = [f"w{rnd.randrange(60)}" for _ in range(n)]
        lines.append(words)
        for at in (0, n // 4, n // 2, n - 1):
            lines += [[*words[:at], "new", *words[at + 1 :]], words[:at] + words[at + 1 :], [*words[:at], "put", *words[at:]]]
        lines += [[*words[1:], words[0]], ["x", *words[1:-1], "y"], words[2:]]
    lines.append(["spam"] * 900)
    lines.append(["spam"] * 901)
    rnd.shuffle(lines)
    rows = [(i, " ".join(x)) for i, x in enumerate(lines)]
    got = {r["doc_id"]: (r["n_equal"], r["n_near"]) for r in line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), with_text=False).collect()}
    for i, a in enumerate(lines):
        equal = a in lines[:i]
        near = any(is_near(a, b) and max(len(a), len(b)) >= 8 for b in lines[:i])
        assert got[i] == (int(equal), int(near and not equal)), (i, len(a))


def test_different_lines_of_one_hash_are_told_apart(spark, monkeypatch):
    """With a first hash that only counts characters, equal and near lines are the same as with the real one."""
    import random

    from pyspark.sql import functions as F

    from matchloom.llm import line_dedup

    rnd = random.Random(2)
    line = lambda n: " ".join(f"w{rnd.randrange(30):02}" for _ in range(n))
    lines = [line(rnd.choice([1, 2, 9, 9, 14])) for _ in range(50)]
    texts = ["\n".join(rnd.choice(lines) for _ in range(rnd.choice([0, 1, 4]))) for _ in range(60)] + [x.replace("w1", "w2", 1) for x in lines]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = lambda: sorted(map(str, line_dedup.deduplicated(docs, with_text=False).collect()))
    want = rows()
    monkeypatch.setattr(line_dedup, "_lane", lambda plain: F.length(plain).cast("long"))
    assert rows() == want and "n_equal=0" in str(want)
