import random

from pyspark.sql import functions as F

from matchloom.llm import sharding


def brute(sizes, shards):
    def fits(c):
        n, room = 1, c
        for s in sizes:
            if s > c:
                return False
            if s > room:
                n, room = n + 1, c
            room -= s
        return n <= shards

    low, high = 1, sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def test_capacity_is_the_smallest(spark):
    rnd = random.Random(5)
    for n, hot in ((1, 0), (5, 0), (400, 0), (400, 9000), (3000, 50_000)):
        keys = sorted(rnd.sample(range(2**20), n)) if n < 1000 else sorted(rnd.getrandbits(60) for _ in range(n))
        keys = [k << 8 for k in keys] if n < 1000 else keys
        sizes = [rnd.randint(1, 100) for _ in keys]
        sizes[n // 3] += hot
        groups = spark.createDataFrame(list(zip(keys, sizes, strict=True)), "key long, bytes long")
        for shards in (1, 3, 8):
            capacity, cuts = sharding.capacity_and_cuts(groups, shards, 5)
            assert capacity == brute(sizes, shards), (n, hot, shards)
            loads = [0] * (len(cuts) + 1)
            for k, s in zip(keys, sizes, strict=True):
                loads[sum(k >= c for c in cuts)] += s
            assert max(loads) == capacity and len(loads) <= shards


def test_rows_with_nulls_copies_and_clashing_columns(spark):
    rows = [(1, "a", 5), (2, "a", 6), (None, None, 7), (3, "", 8), (3, "", 8), (4, "x" * 5000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard long").withColumn("slot", F.lit("s"))
    got = sharding.shard_rows(docs, 3).collect()
    assert len(got) == 6
    by_text = {}
    for r in got:
        by_text.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
    assert all(len(v) == 1 for v in by_text.values())
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert {r["size"] for r in got if r["doc_id"] is None} == {1}


def test_empty(spark):
    assert sharding.shard_rows(spark.createDataFrame([], "doc_id long, text string"), 8).count() == 0


def test_whole_result_against_brute_force(spark):
    """Shards are runs of groups in the order of their keys, cut greedily at the smallest capacity."""
    import zlib

    from .test_oracles import documents

    rows = documents() + [(5000 + i, "hot text " * 40, "s") for i in range(150)]
    got = sharding.shard_rows(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3), 8).collect()
    raw = {d: (t or "").encode() for d, t, _ in rows}
    assert len(got) == len(rows)
    assert all((r["size"], r["text_crc32"]) == (len(raw[r["doc_id"]]) + 1, zlib.crc32(raw[r["doc_id"]])) for r in got)
    texts, sizes, shard_of = {}, {}, {}
    for r in got:
        assert texts.setdefault(r["key"], raw[r["doc_id"]]) == raw[r["doc_id"]]
        sizes[r["key"]] = sizes.get(r["key"], 0) + r["size"]
        assert shard_of.setdefault(r["key"], r["shard"]) == r["shard"]
    assert len(texts) == len(set(raw.values()))
    order = sorted(sizes)
    capacity = brute([sizes[k] for k in order], 8)
    shard, room, want = 0, capacity, {}
    for k in order:
        if sizes[k] > room:
            shard, room = shard + 1, capacity
        room -= sizes[k]
        want[k] = shard
    assert shard_of == want
    for s in set(want.values()):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
