import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from matchloom.llm import packing
from matchloom.llm import textbytes as tb

PATH = public_tokenizers.path("word_bpe_49k.json")


def odd_texts(n=1500):
    rnd = random.Random(1)
    signs = [chr(c) for c in [*range(0x250), 0x2028, 0x3000, 0x301, 0x1F600, 0x212A, 0x3A3, 0x3C2, 0xA0, 0x1680, 0x200B, 0xFEFF, 0x130, 0x1100, 0x1161]]
    signs += ["<|endoftext|>", "<|ENDOFTEXT|>", "'s", "we're,", "Word.", "a.b", "é.", "x..", " \n", " ", "..."] * 6
    return ["".join(rnd.choice(signs) for _ in range(rnd.choice([1, 5, 60]))) for _ in range(n)] + ["", " ", "a", None]


def test_ids_are_those_of_the_tokenizer():
    words, texts = packing.Words(PATH, most=700), odd_texts()
    for lo in range(0, len(texts), 100):
        part = texts[lo : lo + 100]
        for a, b, data, offsets in tb.slices(pa.array(part, pa.string()), 2000):
            ids, sizes = words.ids(data, offsets, 2)
            for text, got in zip(part[a:b], np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
                assert got.tolist() == [*words.tokenizer.encode(text or "", add_special_tokens=False).ids, 2], repr(text)


def test_hilbert_visits_each_cell_by_single_steps():
    side = np.arange(8)
    points = np.array(np.meshgrid(side, side, side)).reshape(3, -1).T
    keys = packing.hilbert(points, 3)
    assert sorted(keys) == list(range(512))
    steps = np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_round_trip(spark):
    texts = odd_texts(200) + ["same words"] * 40 + ["long " * 3000]
    rows = [(i if i % 50 else None, t, i) for i, t in enumerate(texts)] + [(1, "again", 0), (1, "again", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long").withColumn("n", F.lit("x")).repartition(3)
    got = packing.packed(docs, PATH, 256).collect()
    tokenizer = packing.Words(PATH).tokenizer
    want = sorted((str(d), (*tokenizer.encode(t or "", add_special_tokens=False).ids, 2)) for d, t, _ in rows)
    by_doc, by_sequence = {}, {}
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        by_doc.setdefault((str(r["doc_id"]), r["uid"]), []).append((r["start"], ids))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    joined = []
    for (doc, _), pieces in by_doc.items():
        pieces.sort()
        assert [p[0] for p in pieces] == [sum(len(q[1]) for q in pieces[:i]) for i in range(len(pieces))]
        joined.append((doc, tuple(i for p in pieces for i in p[1])))
    assert sorted(joined) == want
    for number, spans in by_sequence.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == 256 or number == max(by_sequence)


def test_empty(spark):
    assert packing.packed(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
