"""Markov spans against plain Python, recall on planted keys by length, and keys that hold or touch what the fixed patterns find."""

import hashlib
import random
import re
import string

import pytest

from matchloom.llm import secret_scan

from .test_secret_scan import brute as base_of

KEY = "A-Za-z0-9+/_=-"
STATES = {c: i + 1 for i, c in enumerate("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")}


def brute_spans(text, ratio, least_total=25.0, least_mean=0.9):
    base = [tuple(map(int, x.split(":")[1:])) for x in base_of(text).split(",") if x]
    hidden = {p for s, e in base for p in range(s, e)}
    found = []

    def search(chars, steps, a, b):
        best = (0.0, a, a)
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += steps[j]
                if total > best[0] + 1e-9:
                    best = (total, i, j + 1)
        total, i, j = best
        if total < least_total:
            return []
        n = j - i
        while i > a and chars[i - 1] not in "+/_=-":
            i -= 1
        while j < b and chars[j] not in "+/_=-":
            j += 1
        return ([(i, j)] if total >= least_mean * n else []) + search(chars, steps, a, i) + search(chars, steps, j, b)

    for m in re.finditer(f"[{KEY}]+", text):
        states = [STATES[c] for c in m[0]]
        steps = [ratio[p][s] for p, s in zip([0, *states[:-1]], states)]
        found += [(m.start() + i, m.start() + j) for i, j in search(m[0], steps, 0, len(steps))]
    found = [(s, e) for s, e in found if not all(p in hidden for p in range(s, e))]
    names = base_of(text)
    spans = [(int(x.split(":")[1]), ("assign", "access", "hex", "markov").index(x.split(":")[0]), int(x.split(":")[2])) for x in names.split(",") if x]
    spans = sorted(spans + [(s, 3, e) for s, e in found])
    return ",".join(f"{('assign', 'access', 'hex', 'markov')[k]}:{s}:{e}" for s, k, e in spans), len(found)


STEMS = ["get", "user", "name", "from", "session", "table", "update", "request", "handler", "value", "index", "parse", "house", "wasser"]


def corpus():
    rnd = random.Random(6)
    key = lambda n: "".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(n))
    name = lambda: rnd.choice(["_", "", "-", "/"]).join(rnd.choice(STEMS) for _ in range(rnd.choice([1, 2, 5, 9])))
    rows = []
    for _ in range(700):
        parts = []
        for _ in range(rnd.choice([1, 4, 25])):
            parts.append(rnd.choice([name, name, name, lambda: "é" + name(), lambda: f"token={key(20)}", lambda: key(rnd.choice([9, 12, 18, 30])), lambda: f"a/b/{name()}={key(24)}",
                                     lambda: key(9) + "0123456789abcdef" + key(12), lambda: rnd.randbytes(20).hex(), lambda: f"{key(16)}-{name()}-{key(16)}"])())
        rows.append(rnd.choice([" ", "\n", ", "]).join(parts))
    return rows + [None, "", "x" * 5000]


@pytest.fixture(scope="module")
def scan(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return texts, secret_scan.train(docs), {r["doc_id"]: r for r in secret_scan.scanned(docs).collect()}


def test_spans_against_plain_python(scan):
    texts, ratio, got = scan
    assert len(got) == len(texts)
    many = 0
    for i, t in enumerate(texts):
        spans, n = brute_spans((t or "")[:6000], ratio)
        assert got[i]["spans"] == spans and got[i]["n_markov"] == n, t
        assert got[i]["base_sha256"] == hashlib.sha256(base_of(t or "").encode()).hexdigest()
        many += n
    assert many > 300


@pytest.fixture(scope="module")
def ratio(spark):
    """Of documents with names and labelled secrets only."""
    rnd = random.Random(12)
    key = lambda n: "".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(n))
    name = lambda: rnd.choice(["_", "", "-", "/"]).join(rnd.choice(STEMS) for _ in range(rnd.choice([1, 1, 2, 5, 9])))
    rows = [(i, " ".join(name() for _ in range(30)) + rnd.choice([f" token={key(20)}", f" {rnd.randbytes(16).hex()}", ""])) for i in range(300)]
    return secret_scan.train(spark.createDataFrame(rows, "doc_id long, text string"))


def test_recall_by_length(ratio):
    rnd = random.Random(8)
    for alphabet in (string.ascii_letters + string.digits + "+/", string.ascii_lowercase + string.digits):
        for n in (12, 16, 18, 20, 40, 60):
            keys = ["".join(rnd.choice(alphabet) for _ in range(n)) for _ in range(200)]
            assert sum(bool(secret_scan.stretches(k.encode(), ratio, 25.0, 0.9)) for k in keys) >= 180, (n, alphabet)
    names = ["_".join(rnd.choice(STEMS) for _ in range(6)) for _ in range(300)]
    assert sum(bool(secret_scan.stretches(k.encode(), ratio, 25.0, 0.9)) for k in names) == 0


def test_a_key_is_found_whole_though_it_holds_hex(ratio):
    key = "Zk3Qw9PxLm7RtYv2Bn8" + "0123456789abcdef" + "Hs5DfGj1KqWzXcVb4"
    (a, b), *_ = secret_scan.stretches(key.encode(), ratio, 25.0, 0.9)
    assert (a, b) == (0, len(key))


def test_a_run_of_any_length_is_scanned_in_pieces(monkeypatch):
    """The same stretches whatever the pieces are, and a bounded memory for texts that are one run."""
    import random
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from matchloom.llm import secret_scan

    rnd = random.Random(5)
    ratio = np.full((secret_scan._STATES, secret_scan._STATES), -0.8)
    digits = secret_scan._STATE[list(b"0123456789")]
    ratio[:, digits] = 1.4
    noise = lambda n: "".join(rnd.choice("0123456789" * 3 + "gXYZ+/_") for _ in range(n))
    texts = ["", noise(4000), "x " + noise(30) + " " + "7" * 900 + " é " + noise(500), "plain words only", None, "ab0" * 400, "1" * 64 + "\n" + "2" * 64]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    scan = lambda b: [r for x in secret_scan._scan(iter([b]), ratio, 25.0, 0.9) for r in x.to_pylist()]
    want = scan(batch)
    assert sum(r["n_markov"] for r in want) >= 3
    for piece in (64, 100, 1 << 10):
        monkeypatch.setattr(secret_scan, "_PIECE", piece)
        assert scan(batch) == want, piece
    monkeypatch.undo()
    rng = np.random.default_rng(1)
    for letters, kinds in ((b"0123456789abcdef", (0, 0, 1)), (secret_scan._KEY[:64], None)):
        long = pa.record_batch([pa.array([1], pa.int64()), pa.array([np.frombuffer(letters, np.uint8)[rng.integers(0, len(letters), 50_000_000)].tobytes().decode()])], names=["doc_id", "text"])
        tracemalloc.start()
        found = scan(long)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 1e9, peak
        assert kinds is None or tuple(found[0][k] for k in ("n_assign", "n_access", "n_hex")) == kinds
