"""Packing documents into fixed sequences along a space-filling curve.

A document's vector is the mean of random directions, one for each token id, in a few dimensions; its place on a
Hilbert curve orders the documents, so that neighbours are alike. The documents' tokens are then one stream in this
order, cut every `length` tokens: only the last sequence is padded.

The order is a range sort by (Hilbert key, hash), which splits documents of one key; places in the stream come from
sums over the ranges and sums within a range. Only counts are sorted; token ids are moved once, to their pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import textbytes as tb
from .shared import hash60, stored

_DIMENSIONS, _BITS = 3, 16
_TOKENS = "uid long, doc_id long, curve long, n long, ids binary"
_PIECES = "uid long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


_STOP = np.zeros(256, bool)
_STOP[list(b".,!?|")] = True
_ASCII = np.zeros(256, bool)
_ASCII[97:123] = True


def _distinct(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A span of each distinct word, and for each span which of them it is. Words of one hash are told apart by their lanes and lengths."""
    lanes, size = tb.word_lanes(data, begin, end), end - begin
    _, at, inverse = np.unique(tb.word_hash(data, begin, end), return_index=True, return_inverse=True)
    first = at[inverse]
    if all((x == x[first]).all() for x in (*lanes, size)):
        return at, inverse
    _, at, inverse = np.unique(np.rec.fromarrays([*lanes, size]), return_index=True, return_inverse=True)
    return at, inverse


class Words:
    """Token ids of words, by their bytes; a word is tokenized when first met. Words are lower-cased in A-Z, as the vocabulary
    does, and one stop after a letter is a word of its own, as it is a piece of its own. Beyond `most` words the later half is
    forgotten, so its memory is bounded."""

    def __init__(self, path: str, most: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.numbers: dict[bytes, int] = {}
        self.counts, self.starts, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the words, one after the other, and their numbers."""
        plain = np.array([w.isalpha() for w in words], bool)
        joined = self.tokenizer.encode(" ".join(w for w, p in zip(words, plain, strict=True) if p), add_special_tokens=False).ids
        ids = np.array(joined, np.uint32)
        ends = np.flatnonzero(self.is_end[ids]) + 1
        if len(ends) != plain.sum():  # a word of letters gave several pieces, or none
            plain[:] = False
            ids, ends = ids[:0], ends[:0]
        counts = np.zeros(len(words), np.int64)
        counts[plain] = np.diff(np.concatenate([[0], ends]))
        others = [x.ids for x in self.tokenizer.encode_batch([w for w, p in zip(words, plain, strict=True) if not p], add_special_tokens=False)]
        counts[~plain] = [len(x) for x in others]
        flat = np.zeros(counts.sum(), np.uint32)
        of_plain = np.repeat(plain, counts)
        flat[of_plain] = ids
        flat[~of_plain] = [i for x in others for i in x]
        return flat, counts

    def _number(self, words: list[bytes]) -> np.ndarray:
        if len(self.numbers) > self.most:
            keep = self.most // 2
            self.numbers = {w: n for w, n in self.numbers.items() if n < keep}
            self.counts, self.starts = self.counts[:keep], self.starts[:keep]
            self.flat = self.flat[: self.starts[-1] + self.counts[-1]]
        get = self.numbers.get
        found = np.array([get(w, -1) for w in words], np.int64)
        new = np.flatnonzero(found < 0)
        if len(new):
            fresh = [words[i] for i in new.tolist()]
            flat, counts = self._encoded([w.decode("utf-8", "replace") for w in fresh])
            found[new] = len(self.counts) + np.arange(len(new))
            self.numbers.update(zip(fresh, found[new].tolist(), strict=True))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.flat = np.concatenate([self.flat, flat])
        return found

    def ids(self, data: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the rows of a slice, `end` after each row's, and their numbers. Blanks part tokens in this vocabulary and
        are dropped, so a text's ids are those of its words."""
        low = data if b"<|" in data.tobytes() else tb.LOWER[data]  # names of special tokens stay as they are
        begins, ends, first = tb.words(low, offsets)
        if len(begins) == 0:
            return np.full(len(offsets) - 1, end, np.uint32), np.ones(len(offsets) - 1, np.int64)
        parted = _STOP[low[ends - 1]] & _ASCII[low[np.maximum(ends - 2, 0)]] & (ends - begins > 1)
        upto = np.concatenate([[0], np.cumsum(1 + parted)])
        first = upto[first]
        begins, ends = np.repeat(begins, 1 + parted), np.repeat(ends, 1 + parted)
        second = upto[1:][parted] - 1
        ends[second - 1] -= 1
        begins[second] = ends[second] - 1
        at, inverse = _distinct(low, begins, ends)
        raw = low.tobytes()
        numbers = self._number([raw[b:e] for b, e in zip(begins[at].tolist(), ends[at].tolist(), strict=True)])[inverse]
        counts = self.counts[numbers]
        upto = np.concatenate([[0], np.cumsum(counts)])
        flat = self.flat[np.repeat(self.starts[numbers] - upto[:-1], counts) + np.arange(upto[-1])]
        stops = upto[first]
        return np.insert(flat, stops[1:], np.uint32(end)), np.diff(stops) + 1


_kept: dict[str, Words] = {}


def words_of(path: str) -> Words:
    """One table for all tasks of a worker."""
    if path not in _kept:
        _kept[path] = Words(path)
    return _kept[path]


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each point (columns of whole numbers under 2**bits) on the Hilbert curve, by the transform of axes
    to transposed bits (Skilling 2004)."""
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    n, q = len(x), 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t = np.where((x[-1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            key = (key << 1) | (((v ^ t) >> b) & 1)
    return key


def _tokens(batches: Iterator[pa.RecordBatch], path: str, end: int, seed: int) -> Iterator[pa.RecordBatch]:
    words = words_of(path)
    directions = np.random.default_rng(seed).standard_normal((65536, _DIMENSIONS)).astype(np.float32)
    middle = directions.mean(0)
    uid = TaskContext.get().partitionId() << 40
    for batch in batches:
        numbers = batch.column("doc_id").cast(pa.int64())
        for lo, hi, data, offsets in tb.slices(batch.column("text")):
            ids, sizes = words.ids(data, offsets, end)
            stops = np.cumsum(sizes)
            means = np.add.reduceat(directions[ids], stops - sizes) / sizes[:, None]
            place = np.tanh((means - middle) * np.sqrt(np.minimum(sizes, 256))[:, None] / 4)  # means of long texts lie closer
            curve = hilbert(((place + 1) / 2 * (2**_BITS - 1)).astype(np.int64), _BITS)
            packed_ids = pa.array([x.tobytes() for x in np.split(ids.astype("<u2"), stops[:-1])], pa.binary())
            yield pa.record_batch(
                [pa.array(range(uid, uid + hi - lo), pa.int64()), numbers.slice(lo, hi - lo), pa.array(curve), pa.array(sizes, pa.int64()), packed_ids],
                names=["uid", "doc_id", "curve", "n", "ids"],
            )
            uid += hi - lo


def _cut(batches: Iterator[pa.RecordBatch], length: int, whole: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for uid, doc, at, n, raw in zip(*(batch.column(c).to_pylist() for c in ("uid", "doc_id", "at", "n", "ids")), strict=True):
            ids = np.frombuffer(raw, "<u2").astype("<u4")
            start = 0
            while start < n:
                sequence, offset = divmod(at + start, length)
                size = min(n - start, length - offset)
                piece = ids[start : start + size].tobytes()
                rows.append((uid, doc, start, size, zlib.crc32(piece), n, sequence, offset, piece if whole else None))
                start += size
        kinds = [pa.int64()] * 8 + [pa.binary()]
        names = [c.split()[0] for c in _PIECES.split(", ")]
        yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def packed(docs: DataFrame, tokenizer: str, length: int = 4096, end: int = 2, seed: int = 11, whole: bool = True) -> DataFrame:
    """One row per piece: uid, doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if whole, the ids (unsigned 32 bits).

    A document's ids are those of its text and then `end`; null counts as empty and has that one id. The vocabulary must have
    under 65536 ids and part its tokens at blanks. Repeated rows are packed each, and a null doc_id stays null. A text of any length is tokenized whole and cut
    into as many pieces as it needs; columns besides doc_id and text are not read. No documents give no rows.
    """
    # the queue of a worker holds few batches, as texts may be long
    rows = stored(docs.select("doc_id", "text").mapInArrow(lambda it: _tokens(it, tokenizer, end, seed), _TOKENS), "tokens")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["curve", "tie", "uid"]
    small = rows.select("uid", "curve", hash60(F.col("doc_id"), F.col("uid")).alias("tie"), "n")
    ranges = stored(small.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranges")
    sums = ranges.groupBy("part").agg(F.sum("n").alias("sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = sums.select("part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranges.withColumn("local", F.coalesce(F.sum("n").over(inner), F.lit(0)))
    places = stored(local.join(starts, "part").select("uid", (F.col("base") + F.col("local")).alias("at")), "places")
    return rows.select("uid", "doc_id", "n", "ids").join(places, "uid").mapInArrow(lambda it: _cut(it, length, whole), _PIECES)
