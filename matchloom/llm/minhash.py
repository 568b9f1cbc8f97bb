"""MinHash near-dedup with sequential Bayesian verification.

A document's signature has BANDS times ROWS smallest hashes of its shingles. Documents that agree in a whole band share a key. Equal sets are put
together first, by a hash of the set, so only different sets have keys. The signatures of two documents are compared in batches: after each, the similarity s has
a posterior Beta(m + 1, n - m + 1) after m of n equal hashes, and a pair goes once the chance that s reaches the limit is under the miss probability. The survivors are
verified on their whole sets. Kept as bytes, hashes agree by chance in one case of 256, which only lets more pairs through.

Pairs are found without the pairs of a key. Each document is first compared with one other, the leader of most of its keys. Only keys whose documents then still are in several
components are looked at again: those of few documents give their pairs, and for larger ones ngram_join's prefixes of differences from the key's leader find the pairs that can be linked,
exactly and without all pairs of the key. That leader is the first document of a component and need not have the key.

With 32 bands of 6, two documents of similarity 0.85 share no key once in 4 million times; the miss probability of the comparison is one in a million.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .components import components
from .ngram_join import RARE, _around_leaders, _verified
from .shared import keep_rows, stored

BANDS, ROWS = 32, 6
#: Hashes that are compared before the posterior is looked at again.
BATCH = 48
_rng = np.random.default_rng(85)
_FLIP = _rng.integers(0, 2**32, (BANDS * ROWS, 1), dtype=np.uint32)
_TIMES = _rng.integers(0, 2**32, (BANDS * ROWS, 1), dtype=np.uint32) | np.uint32(1)
_COLUMNS = "uid long, doc_id long, text_key long, size int, set_one long, set_two long, signature binary, keys array<long>"


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest of the 32-bit hashes of a set under each of the functions."""
    low = ((shingles >> np.uint64(32)) ^ shingles).astype(np.uint32)
    least = np.full(len(_FLIP), 2**32 - 1, np.uint32)
    for a in range(0, len(low), 2048):
        np.minimum(least, ((low[None, a : a + 2048] ^ _FLIP) * _TIMES).min(axis=1), out=least)
    return least


def _keys(signatures: np.ndarray) -> np.ndarray:
    """A key for each band of each signature."""
    bands = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    return tb.mix((bands * tb._PLACE[:ROWS]).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * tb._PLACE[60])


def _sign(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    uid = TaskContext.get().partitionId() << 40
    names = [c.split()[0] for c in _COLUMNS.split(", ")]
    for batch in batches:
        ids = batch.column("doc_id").cast(pa.int64())
        for lo, hi, data, offsets in tb.slices(batch.column("text")):
            sets = tb.word_shingles(data, offsets, width)
            full = [len(s) > 0 for s in sets]
            signs = np.stack([signature(s) for s in sets])
            keys = _keys(signs).astype(np.int64)
            ends = [xxhash.xxh3_128_digest(s.data) for s in sets]
            halves = np.frombuffer(b"".join(ends), np.int64).reshape(-1, 2)
            texts = [xxhash.xxh64_intdigest(data[a:b], 42) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.record_batch(
                [pa.array(range(uid, uid + hi - lo), pa.int64()), ids.slice(lo, hi - lo), pa.array(np.array(texts, np.uint64).view(np.int64)), pa.array([len(s) for s in sets], pa.int32()),
                 pa.array(halves[:, 0], mask=~np.array(full)), pa.array(halves[:, 1], mask=~np.array(full)), pa.array([s.tobytes() for s in signs.astype(np.uint8)], pa.binary()),
                 pa.array([k.tolist() if f else None for k, f in zip(keys, full, strict=True)], pa.list_(pa.int64()))],
                names=names,
            )
            uid += hi - lo


def fewest(n: int, similarity: float, miss: float) -> int:
    """The least number of equal hashes of n with which the similarity is reached with a probability of `miss` or more, every similarity being as likely before."""
    # P(Beta(m + 1, n - m + 1) >= t) is P(Binomial(n + 1, t) <= m)
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def _compare(batches: Iterator[pa.RecordBatch], similarity: float, miss: float) -> Iterator[pa.RecordBatch]:
    ends = range(BATCH, BANDS * ROWS + 1, BATCH)
    least = [fewest(n, similarity, miss) for n in ends]
    for batch in batches:
        of = [np.frombuffer(b"".join(x.as_buffer() for x in batch.column(c)), np.uint8).reshape(batch.num_rows, -1) for c in ("one", "two")]
        open_pairs, equal = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
        for end, m in zip(ends, least, strict=True):
            part = [x[open_pairs, end - BATCH : end] for x in of]
            equal = equal + (part[0] == part[1]).sum(axis=1)
            stays = equal >= m
            open_pairs, equal = open_pairs[stays], equal[stays]
        yield batch.select(["a", "b"]).take(pa.array(open_pairs))


def survivors(pairs: DataFrame, sets: DataFrame, percent: int, miss: float) -> DataFrame:
    """The pairs (a, b) that the comparison of their signatures lets through."""
    of = lambda x, name: sets.select(F.col("uid").alias(x), F.col("signature").alias(name))
    both = pairs.join(of("a", "one"), "a").join(of("b", "two"), "b").select("a", "b", "one", "two")
    return both.mapInArrow(lambda it: _compare(it, percent / 100, miss), "a long, b long")


def _shingled(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in tb.slices(batch.column("text")):
            sets = [s.astype(np.int64) for s in tb.word_shingles(data, offsets, width)]
            ends = np.cumsum([0, *map(len, sets)])
            tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))
            columns = [batch.column(c).slice(lo, hi - lo) for c in ("uid", "size")]
            yield pa.record_batch([*columns, tokens], names=["uid", "size", "tokens"])


def _whole_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Stored: uid, size, tokens of the wanted documents (uid, doc_id, text_key, size), whose texts are read again."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(F.col("doc_id").alias("of_doc"), F.xxhash64(text).alias("of_text"), text.alias("text"))
    found = keyed.join(wanted, F.col("of_doc").eqNullSafe(F.col("doc_id")) & (F.col("of_text") == F.col("text_key"))).select("uid", "size", "text")
    sets = stored(found.mapInArrow(lambda it: _shingled(it, width), "uid long, size int, tokens array<long>"), "whole-sets")
    # rows alike in doc_id and text come several times
    return sets if sets.groupBy("uid").count().filter("count > 1").isEmpty() else stored(sets.dropDuplicates(["uid"]), "whole-sets")


def links(docs: DataFrame, sets: DataFrame, width: int, percent: int, miss: float) -> DataFrame:
    """Stored: verified pairs (a, b) of uids of different sets that connect all linked documents. sets: the columns of signatures, one row for each set."""
    indexed = sets.select("uid", "size", F.explode("keys").alias("key"))
    least = indexed.groupBy("key").agg(F.min(F.struct("uid", "size")).alias("x"), F.count("*").alias("n")).filter("n > 1")
    alike = (100 * F.least("size", "x.size") >= percent * F.greatest("size", "x.size")) & (F.col("uid") != F.col("x.uid"))
    led = stored(indexed.join(least, "key").filter(alike).select("uid", F.col("x.uid").alias("leader")), "led")
    best = led.groupBy("uid", "leader").agg(F.count("*").alias("n")).groupBy("uid").agg(F.max_by("leader", F.struct("n", -F.col("leader"))).alias("b"))
    one = stored(survivors(best.select(F.col("uid").alias("a"), "b"), sets, percent, miss), "first-pairs")
    # the documents of keys with several documents of alike sizes; no others have links
    wanted = led.select("uid").union(led.select(F.col("leader").alias("uid"))).distinct()
    whole = _whole_sets(docs, sets.select("uid", "doc_id", "text_key", "size").join(wanted, "uid"), width)
    found = stored(_verified(one, whole, percent), "first-links")
    labels = components(found).withColumnRenamed("node", "uid")
    labelled = stored(sets.select("uid", "size", "keys").join(wanted, "uid").join(labels, "uid", "left").withColumn("component", F.coalesce("component", "uid")), "labelled")
    labelled = labelled.select("uid", "size", "component", F.explode("keys").alias("key"))
    # the first document of a component leads all keys that the component is in: so documents that meet in many keys are compared with one leader
    several = labelled.groupBy("key").agg(F.min("component").alias("c"), F.max("component").alias("y"), F.count("*").alias("n")).filter("c < y").drop("y")
    mixed = stored(labelled.join(several, "key"), "mixed-keys")
    few = mixed.filter(F.col("n") <= RARE)
    near = (F.col("x.key") == F.col("y.key")) & (F.col("x.uid") < F.col("y.uid")) & (F.col("x.component") != F.col("y.component"))
    near = near & (100 * F.least("x.size", "y.size") >= percent * F.greatest("x.size", "y.size"))
    pairs = few.alias("x").join(few.alias("y"), near).select(F.col("x.uid").alias("a"), F.col("y.uid").alias("b")).distinct()
    pairs = survivors(pairs, sets, percent, miss)
    around, apart = _around_leaders(mixed.filter((F.col("n") > RARE) & (F.col("uid") != F.col("c"))), whole, percent)
    left = stored(pairs.union(survivors(apart, sets, percent, miss)).distinct(), "pairs")
    return stored(found.union(around).union(_verified(left, whole, percent)), "links")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 85, miss: float = 1e-6) -> DataFrame:
    """One row per document: uid, doc_id, text_key, n_shingles, component_id (smallest doc_id reachable by links, its own included), kept.

    Words are lower-cased in A-Z. A document's set is its distinct runs of `width` words, or the whole sequence if shorter; null, empty or blank
    texts have an empty set and are linked with nothing. kept marks one document of each component: one with that doc_id. Repeated rows are rows of their own.
    A null doc_id is passed over unless there is no other. Very long texts are taken whole; columns besides doc_id and text are not read, and no rows give
    no rows. percent: 85 or more, for which the bands are made. Every link that is found is exact; of those at the limit one in some 100,000 is missed.
    """
    if percent < 85:
        raise ValueError("percent must be 85 or more")
    signed = stored(docs.select("doc_id", "text").mapInArrow(lambda it: _sign(it, width), _COLUMNS), "signatures")
    firsts = signed.filter("size > 0").groupBy("set_one", "set_two", "size").agg(F.min("uid").alias("first"))
    firsts = stored(firsts, "first-sets")
    sets = stored(signed.join(firsts.select(F.col("first").alias("uid")), "uid", "left_semi").drop("set_one", "set_two"), "distinct-sets")
    labels = components(links(docs, sets, width, percent, miss)).withColumnRenamed("node", "first")
    rows = signed.select("uid", "doc_id", "text_key", "size", "set_one", "set_two").join(firsts, ["set_one", "set_two", "size"], "left")
    rows = stored(rows.withColumn("first", F.coalesce("first", "uid")).join(labels, "first", "left").withColumn("component", F.coalesce("component", "first")), "labelled-rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")
    least = rows.groupBy("component").agg(F.min(order).alias("lead"))
    joined = rows.join(stored(least, "least"), "component")
    return joined.select("uid", "doc_id", "text_key", F.col("size").cast("long").alias("n_shingles"), F.col("lead.doc_id").alias("component_id"), (F.col("uid") == F.col("lead.uid")).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 85, miss: float = 1e-6) -> DataFrame:
    """The rows of docs that near_duplicates keeps, one of each component, with all columns of docs."""
    rows = stored(near_duplicates(docs, width, percent, miss), "near-duplicates")
    return keep_rows(docs, rows, F.xxhash64(F.coalesce("text", F.lit(""))), "text_key", "kept")
