"""Words are told apart by their bytes, also those that a polynomial modulo a power of two confuses."""

import random

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from matchloom.llm import packing
from matchloom.llm import textbytes as tb


def thue_morse(n: int) -> str:
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


def spans(words):
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    begins, ends, _ = tb.words(data, np.array([0, len(data)]))
    return data, begins, ends


def test_hashes_of_different_words_differ():
    rnd = random.Random(3)
    words = {"".join(rnd.choice("abcé日") for _ in range(rnd.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 18, 40]))) for _ in range(20_000)}
    words |= {thue_morse(2048), thue_morse(2048).translate(str.maketrans("ab", "ba")), "a\0", "a\0\0", "a" * 8 + "\0", "a" * 8}
    words = sorted(words)
    data, begins, ends = spans(words)
    assert len(begins) == len(words)
    assert len(np.unique(tb.word_hash(data, begins, ends))) == len(words)
    twice, b, e = spans([*words, *words])
    h = tb.word_hash(twice, b, e)
    assert (h[: len(words)] == h[len(words) :]).all()
    assert (np.sort(h[: len(words)]) == np.sort(tb.word_hash(data, begins, ends))).all()


def test_token_ids_of_regular_words():
    path = public_tokenizers.path("word_bpe_49k.json")
    one, two = thue_morse(2048), thue_morse(2048).translate(str.maketrans("ab", "ba"))
    table, tokenizer = packing.Words(path), Tokenizer.from_file(path)
    for texts in ([one, two], [f"{one} {two}"], [two, one]):
        for _, _, data, offsets in tb.slices(pa.array(texts, pa.string())):
            ids, sizes = table.ids(data, offsets, 2)
            got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
            assert got == [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_words_of_one_hash_are_told_apart(monkeypatch):
    data, begins, ends = spans(["a", "b", "a", "a long word of bytes", "b"])
    monkeypatch.setattr(tb, "word_hash", lambda data, begin, end: np.zeros(len(begin), np.uint64))
    at, inverse = packing._distinct(data, begins, ends)
    raw = data.tobytes()
    assert [raw[begins[i] : ends[i]] for i in at[inverse]] == [raw[b:e] for b, e in zip(begins, ends)]


def test_shingles_of_regular_words_differ():
    one, two = thue_morse(2048), thue_morse(2048).translate(str.maketrans("ab", "ba"))
    for _, _, data, offsets in tb.slices(pa.array([f"x {one} y z w", f"x {two} y z w"], pa.string())):
        x, y = tb.word_shingles(data, offsets)
        assert len(x) == len(y) == 1 and x[0] != y[0]
