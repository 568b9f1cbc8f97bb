"""Jaccard join on word shingles by token-combination prefixes.

Every shingle's number of documents is counted, and a document's shingles are ordered from rare to frequent. Two
documents with a similarity of at least t share a token among the first |x| - ceil(t|x|) + 1 of either;
tokens of one document only never match, and a document with too many of these is out. A shared rare
token is found by an index of the rare tokens of this prefix. Where no rare token is shared, the shared ones are frequent,
and the prefix is extended until it holds more shared tokens than the documents can have unshared frequent ones
plus one: then two shared tokens are neighbours in both, so the index holds the pairs of neighbouring frequent tokens.
The number of keys of a document is linear in its length.

Candidates are verified by the exact intersection of their shingles (ids of 56 bits). Each document is first checked against
one partner, the leader of most of its keys: the document with the fewest tokens of its own, near the middle of
a group. What could still join different components is found without the pairs of a key:

- Keys of few documents give their pairs.
- The documents of any other key are checked against the key's leader. For two of them that it does not link, only the
  tokens in which they differ from the leader matter: the frequent tokens of the group are gone, and with h(x) such tokens they
  must share at least (h(x) + h(y) - D) / 2 of them, D being the most that linked documents may differ by. So the
  prefix method is used again on these differences, whose tokens of one document come first and use up most prefixes. As one of the two is not linked with the leader,
  a document near the leader must share more than half of its differences.

Tokens are shuffled as packed arrays, by hash range and then by chunk of documents. A token that many documents of a chunk hold is sent as
one count a chunk, and its documents go straight to their chunk; many is fewer the more chunks there are, so that a range grows with the chunks
of one token and not with its documents. Of a chunk's equal sets one is sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .components import components
from .shared import keep_rows, stored

#: Tokens of up to so many documents are rare.
RARE = 32
_PLANES = 7
_TOKENS, _SIGNS, _HEADER, _COPIES, _HOT, _LISTS, _ALIKE = range(7)
#: Tokens that so many documents of a chunk hold are counted in the chunk; fewer where there are so many chunks that a token would have more than _SHARE of them.
_MANY = 256
_SHARE = 170_000
#: Bytes of text for each hash range, about a sixth as many tokens.
_RANGE_BYTES = 100_000_000
_PACKED = "bucket int, chunk long, kind int, docs binary, tokens binary, codes binary, ids array<long>"


def _planes(values: np.ndarray, n: int = _PLANES) -> bytes:
    """The low n bytes of sorted values, byte by byte: the upper bytes are alike and compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :n].T).tobytes()


def _values(raw: bytes, n: int = _PLANES) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(n, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :n] = planes.T
    return out.reshape(-1).view(np.uint64)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    names = ["bucket", "chunk", "kind", "docs", "tokens", "codes", "ids"]
    return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _by_bucket(chunk: int, kind: int, tokens: np.ndarray, docs: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Rows of sorted tokens, one for each hash range."""
    bucket = ((tokens >> np.uint64(24)) * np.uint64(buckets)) >> np.uint64(32)
    edges = np.flatnonzero(np.diff(bucket)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(tokens)], strict=True):
        if b > a:
            yield int(bucket[a]), chunk, kind, docs[a:b].tobytes(), _planes(tokens[a:b]), None, None


def _spread(batches: Iterator[pa.RecordBatch], width: int, buckets: int, chunk_tokens: int, many: int) -> Iterator[pa.RecordBatch]:
    """Chunks of documents as rows: their tokens and signatures by hash range, and a header. Of equal sets of a chunk the first sends the signature."""
    chunk = TaskContext.get().partitionId() << 24
    held: list[np.ndarray] = []
    ids: list = []
    texts: list[int] = []

    def emit() -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(x) for x in held])
        docs = np.repeat(np.arange(len(held), dtype=np.uint16), sizes)
        tokens = np.concatenate(held)
        sums = np.zeros(len(tokens) + 1, np.uint64)
        np.cumsum(tb.mix(tokens), out=sums[1:])
        ends = np.cumsum(sizes)
        signs = tb.mix(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64)) >> np.uint64(8)
        full = np.flatnonzero(sizes)
        full = full[np.argsort(signs[full], kind="stable")]
        order = np.argsort(tokens, kind="stable")
        tokens, docs = tokens[order], docs[order]
        begins, lengths = _runs(tokens)
        hot = lengths >= many
        if hot.any():
            here, counts = np.repeat(hot, lengths), lengths[hot].astype(np.uint32)
            often = tokens[begins[hot]]
            yield _rows([*_by_bucket(chunk, _HOT, often, counts, buckets)])
            yield _rows([(chunk % buckets, chunk, _LISTS, docs[here].tobytes(), _planes(often), counts.tobytes(), None)])
            tokens, docs = tokens[~here], docs[~here]
        yield _rows([*_by_bucket(chunk, _TOKENS, tokens, docs, buckets)])
        begins, lengths = _runs(signs[full])
        first = full[begins].astype(np.uint16)
        yield _rows([*_by_bucket(chunk, _SIGNS, signs[full][begins], first, buckets)])
        alike = np.repeat(first, lengths) != full
        if alike.any():
            yield _rows([(chunk % buckets, chunk, _ALIKE, full[alike].astype(np.uint16).tobytes(), None, np.repeat(first, lengths)[alike].tobytes(), None)])
        yield _rows([(chunk % buckets, chunk, _HEADER, None, sizes.astype(np.uint32).tobytes(), np.array(texts, np.uint64).tobytes(), ids)])

    for batch in (whole.slice(i, 16_384) for whole in batches for i in range(0, whole.num_rows, 16_384)):  # a chunk stays under 65,536 documents
        numbers = batch.column("doc_id").cast(pa.int64()).to_pylist()
        for lo, hi, data, offsets in tb.slices(batch.column("text")):
            for x in tb.word_shingles(data, offsets, width):
                x = x >> np.uint64(8)
                held.append(x if (x[1:] != x[:-1]).all() else np.unique(x))
            ids += numbers[lo:hi]
            texts += [xxhash.xxh64_intdigest(data[a:b], 42) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            if sum(map(len, held)) >= chunk_tokens or len(held) >= 40_000:
                yield from emit()
                chunk, held, ids, texts = chunk + 1, [], [], []
    if held:
        yield from emit()


def _documents(rows: dict, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and uids (chunk and place in it) of the rows of one kind."""
    at = [i for i, k in enumerate(rows["kind"]) if k == kind]
    tokens = [_values(rows["tokens"][i]) for i in at]
    uids = [np.frombuffer(rows["docs"][i], np.uint16).astype(np.int64) + (rows["chunk"][i] << 16) for i in at]
    return (np.concatenate(tokens), np.concatenate(uids)) if at else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and lengths of the runs of equal sorted values."""
    begins = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return begins, np.diff(np.concatenate([begins, [len(values)]]))


def _code(counts: np.ndarray) -> np.ndarray:
    """A number of documents in a byte: itself if rare, else by its logarithm."""
    return np.where(counts <= RARE, counts, RARE + np.log2(np.maximum(counts, 1)).astype(np.int64)).astype(np.uint8)


def _count(table: pa.Table) -> pa.Table:
    """One hash range: the tokens of two or more documents go back to their chunks with a code of their number, and
    documents with equal sets with the first of them."""
    rows = table.to_pydict()
    out = [(None, rows["chunk"][i], k, rows["docs"][i], rows["tokens"][i], rows["codes"][i], rows["ids"][i]) for i, k in enumerate(rows["kind"]) if k in (_HEADER, _LISTS, _ALIKE)]
    tokens, uids = _documents(rows, _TOKENS)
    order = np.argsort(tokens)
    tokens, uids = tokens[order], uids[order]
    begins, lengths = _runs(tokens)
    totals = lengths.copy()
    hot = [i for i, k in enumerate(rows["kind"]) if k == _HOT]
    if hot:
        each = [_values(rows["tokens"][i]) for i in hot]
        often, which = np.unique(np.concatenate(each), return_inverse=True)
        sums = np.zeros(len(often), np.int64)
        np.add.at(sums, which, np.concatenate([np.frombuffer(rows["docs"][i], np.uint32) for i in hot]))
        if len(begins):
            at = np.minimum(np.searchsorted(tokens[begins], often), len(begins) - 1)
            same = tokens[begins][at] == often
            sums[same] += lengths[at[same]]
            totals[at[same]] = sums[same]
        for i, x in zip(hot, each, strict=True):
            out.append((None, rows["chunk"][i], _HOT, None, rows["tokens"][i], _code(sums[np.searchsorted(often, x)]).tobytes(), None))
    codes = np.repeat(_code(totals), lengths)
    several = codes > 1
    tokens, uids, codes = tokens[several], uids[several], codes[several]
    order = np.argsort(uids, kind="stable")  # tokens stay sorted within a document
    tokens, uids, codes = tokens[order], uids[order], codes[order]
    begins, lengths = _runs(uids >> 16)
    for a, n in zip(begins.tolist(), lengths.tolist(), strict=True):
        b = a + n
        out.append((None, int(uids[a] >> 16), _TOKENS, (uids[a:b] & 65535).astype(np.uint16).tobytes(), _planes(tokens[a:b]), codes[a:b].tobytes(), None))
    signs, uids = _documents(rows, _SIGNS)
    order = np.lexsort((uids, signs))
    signs, uids = signs[order], uids[order]
    begins, lengths = _runs(signs)
    first = np.repeat(uids[begins], lengths)
    copies = uids != first
    uids, first = uids[copies], first[copies]
    order = np.argsort(uids)
    uids, first = uids[order], first[order]
    begins, lengths = _runs(uids >> 16)
    for a, n in zip(begins.tolist(), lengths.tolist(), strict=True):
        out.append((None, int(uids[a] >> 16), _COPIES, (uids[a : a + n] & 65535).astype(np.uint16).tobytes(), None, None, first[a : a + n].tolist()))
    return pa.Table.from_batches([_rows(out)]).drop_columns(["bucket"])


_SETS = "uid long, doc_id long, text_key long, size int, first long, tokens array<long>, keys array<long>, parity array<long>"


def _keys(tokens: np.ndarray, codes: np.ndarray, size: int, percent: int) -> np.ndarray:
    """Index keys of one document; tokens: those of several documents, from rare to frequent."""
    least = -(-size * percent // 100)
    alone = size - len(tokens)
    rare = int(np.searchsorted(codes, RARE, "right"))
    keys = tokens[: max(0, min(rare, size - least + 1 - alone))]
    if alone + rare > size - least:
        return keys
    # |x|, |y| of a pair differ by t at most, so x and y differ in at most (1-t)/(1+t) (|x|+|y|) <= (1-t)/t |x| tokens
    spare = size * (100 - percent) // percent - alone - rare
    end = min(len(tokens), size - least + max(0, spare) + 2 - alone)
    frequent = tokens[rare:end]
    return np.concatenate([keys, tb.mix(frequent[:-1] * tb._PLACE[0] + frequent[1:] * tb._PLACE[1])])


def _gather(table: pa.Table, percent: int) -> pa.Table:
    """One chunk: each document with the first document of the same set, and its tokens in order unless it is a copy or can have no partner."""
    rows = table.to_pydict()
    at = rows["kind"].index(_HEADER)
    chunk, sizes, ids = rows["chunk"][at], np.frombuffer(rows["tokens"][at], np.uint32), rows["ids"][at]
    first = np.arange(len(sizes), dtype=np.int64) + (chunk << 16)
    for i, kind in enumerate(rows["kind"]):
        if kind == _COPIES:
            first[np.frombuffer(rows["docs"][i], np.uint16)] = rows["ids"][i]
    if _ALIKE in rows["kind"]:
        i = rows["kind"].index(_ALIKE)
        first[np.frombuffer(rows["docs"][i], np.uint16)] = first[np.frombuffer(rows["codes"][i], np.uint16)]
    tokens, uids = _documents(rows, _TOKENS)
    codes = [np.frombuffer(rows["codes"][i], np.uint8) for i, k in enumerate(rows["kind"]) if k == _TOKENS]
    codes = np.concatenate(codes) if codes else np.zeros(0, np.uint8)
    own = (uids & 65535).astype(np.int64)
    if _LISTS in rows["kind"]:
        lists = rows["kind"].index(_LISTS)
        often, counts = _values(rows["tokens"][lists]), np.frombuffer(rows["codes"][lists], np.uint32).astype(np.int64)
        hot = [i for i, k in enumerate(rows["kind"]) if k == _HOT]
        told = np.concatenate([_values(rows["tokens"][i]) for i in hot])
        code = np.concatenate([np.frombuffer(rows["codes"][i], np.uint8) for i in hot])[np.argsort(told)]  # of the same tokens, sorted
        tokens, codes = np.concatenate([tokens, np.repeat(often, counts)]), np.concatenate([codes, np.repeat(code, counts)])
        own = np.concatenate([own, np.frombuffer(rows["docs"][lists], np.uint16).astype(np.int64)])
    shared = np.bincount(own, minlength=len(sizes))
    wanted = (first & 65535 == np.arange(len(sizes))) & (first >> 16 == chunk) & (shared * 100 >= sizes.astype(np.int64) * percent) & (sizes > 0)
    keep = wanted[own]
    tokens, codes, own = tokens[keep], codes[keep], own[keep]
    order = np.lexsort((tokens, codes, own))
    tokens, codes, own = tokens[order], codes[order], own[order]
    ends = np.searchsorted(own, np.arange(len(sizes) + 1))
    sets, keys, parity = [None] * len(sizes), [None] * len(sizes), [None] * len(sizes)
    for i in np.flatnonzero(wanted).tolist():
        t, c = tokens[ends[i] : ends[i + 1]], codes[ends[i] : ends[i + 1]]
        sets[i], keys[i] = t.astype(np.int64), _keys(t, c, int(sizes[i]), percent).astype(np.int64)
        parity[i] = np.packbits(np.bincount((t & np.uint64(255)).astype(np.int64), minlength=256) & 1).view(np.int64)
    return pa.table(
        [pa.array(np.arange(len(sizes)) + (chunk << 16), pa.int64()), pa.array(ids, pa.int64()), pa.array(np.frombuffer(rows["codes"][at], np.int64)), pa.array(sizes.astype(np.int32)), pa.array(first),
         pa.array(sets, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64())),
         pa.array(parity, pa.list_(pa.int64()))],
        names=["uid", "doc_id", "text_key", "size", "first", "tokens", "keys", "parity"],
    )


def token_sets(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """Stored: uid, doc_id, text_key (xxhash64 of the text), size of the set, first (uid of the first document with the same set), tokens (those
    that other documents have), keys, and the parities of the numbers of tokens in 256 classes."""
    # hash ranges of some 20 million tokens, and chunks that bring some dozens to each
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // _RANGE_BYTES)
    chunk_tokens = min(16_000_000, max(2_000_000, 64 * buckets))
    many = max(2, min(_MANY, _SHARE // (1 + size // min(6 * chunk_tokens, 64_000_000))))
    packed = docs.select("doc_id", "text").mapInArrow(lambda it: _spread(it, width, buckets, chunk_tokens, many), _PACKED)
    counted = packed.groupBy("bucket").applyInArrow(_count, _PACKED.partition(", ")[2])
    return stored(counted.groupBy("chunk").applyInArrow(lambda t: _gather(t, percent), _SETS), "token-sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the similarity; tokens of one document only are not in sets and not needed."""
    of = lambda x: sets.select(F.col("uid").alias(x), F.col("size").alias(f"size_{x}"), F.col("tokens").alias(f"tokens_{x}"))
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    close = 100 * both >= percent * (F.col("size_a") + F.col("size_b") - both)
    return pairs.join(of("a"), "a").join(of("b"), "b").filter(close).select("a", "b")


def _possible(x: str, y: str, percent: int) -> Column:
    """Whether two documents can be linked: by the numbers of their tokens and of those that any other document has, and as a token
    that only one of them has changes the parity of a class."""
    size, most = F.col(f"{x}.size") + F.col(f"{y}.size"), F.least(f"{x}.shared", f"{y}.shared")
    apart = size - F.col(f"{x}.shared") - F.col(f"{y}.shared")
    for i in range(4):
        apart += F.bit_count(F.col(f"{x}.p{i}").bitwiseXOR(F.col(f"{y}.p{i}")))
    return (most * 100 >= (size - most) * percent) & (apart * (100 + percent) <= size * (100 - percent))


def links(sets: DataFrame, percent: int = 75) -> DataFrame:
    """Stored: verified pairs (a, b) of uids of different sets that connect all linked documents. Not every link inside
    a component is among them."""
    near = sets.filter(F.col("tokens").isNotNull()).withColumn("shared", F.size("tokens"))
    near = near.select("*", *[F.col("parity")[i].alias(f"p{i}") for i in range(4)])
    bounds = ["size", "shared", "p0", "p1", "p2", "p3"]
    indexed = near.select("uid", *bounds, F.explode(F.array_distinct("keys")).alias("key"))
    # a key's leader is the document with the fewest tokens of its own
    leader = F.struct((F.col("size") - F.col("shared")).alias("own"), "uid", *bounds)
    least = indexed.groupBy("key").agg(F.min(leader).alias("x"), F.count("*").alias("n")).filter("n > 1").drop("n")
    led = indexed.alias("d").join(least, "key").filter(F.col("d.uid") != F.col("x.uid")).filter(_possible("d", "x", percent))
    led = led.groupBy("d.uid", F.col("x.uid").alias("a")).agg(F.count("*").alias("n"), F.first("x.own").alias("own"))
    best = F.struct("n", -F.col("own"), -F.col("a"))
    one = stored(led.groupBy("uid").agg(F.max_by("a", best).alias("a")).select("a", F.col("uid").alias("b")), "first-pairs")
    found = stored(_verified(one, near, percent), "first-links")
    labels = stored(components(found), "first-components")
    # each component has one head, which led most of its links, and the head of a key's largest component leads the key: so documents that meet in many keys are compared with one leader
    size = labels.groupBy("component").agg(F.count("*").alias("members"))
    led_most = found.groupBy("a").agg(F.count("*").alias("n")).join(labels.withColumnRenamed("node", "a"), "a")
    heads = led_most.groupBy("component").agg(F.max_by("a", F.struct("n", -F.col("a"))).alias("head")).join(size, "component")
    labelled = near.select("uid", *bounds, "keys").join(labels.join(heads, "component").withColumnRenamed("node", "uid"), "uid", "left")
    whole = [F.coalesce("component", "uid").alias("component"), F.coalesce("members", F.lit(1)).alias("members"), F.coalesce("head", "uid").alias("head")]
    labelled = labelled.select("uid", *bounds, *whole, F.explode(F.array_distinct("keys")).alias("key"))
    largest = F.max_by("head", F.struct("members", -F.col("component")))
    several = labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"), largest.alias("c"))
    several = several.filter("x < y").drop("x", "y")
    mixed = stored(labelled.drop("members", "head").join(several, "key"), "mixed-keys")
    few = mixed.filter(F.col("n") <= RARE)
    pairs = few.alias("x").join(few.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.uid") < F.col("y.uid")) & (F.col("x.component") != F.col("y.component")) & _possible("x", "y", percent))
    pairs = stored(pairs.select(F.col("x.uid").alias("a"), F.col("y.uid").alias("b")).distinct(), "few-pairs")
    around, apart = _around_leaders(mixed.filter((F.col("n") > RARE) & (F.col("uid") != F.col("c"))), near, percent)
    tested = one.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = stored(pairs.union(apart).distinct(), "pairs").join(tested, ["a", "b"], "left_anti")
    return stored(found.union(around).union(_verified(left, near, percent)), "links")


def _around_leaders(rows: DataFrame, near: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links of documents with the leaders c of their keys, and pairs (a, b) that can be linked and are not both linked with a leader.

    rows: uid, c and component for each key of more than a few documents. For a leader with tokens t that any other document has, a document's
    differences are the tokens that it has and t has not, or the other way round; `h` is their number. Of two documents that are linked, at most
    D tokens are in one only; they share at least (h + h' - D) / 2 of their differences. Tokens that only one document of the leader's has as a
    difference come first in the order, then rare ones.
    """
    ratio = (100 - percent) / (100 + percent)
    members = rows.select("c", "uid", "component").distinct()
    of = near.select("uid", "size", "tokens")
    joined = members.join(of, "uid").join(of.toDF("c", "size_c", "tokens_c"), "c")
    fresh, gone = F.array_except("tokens", "tokens_c"), F.array_except("tokens_c", "tokens")
    joined = joined.withColumn("fresh", fresh).withColumn("diffs", F.concat("fresh", gone)).withColumn("both", F.size("tokens") - F.size("fresh"))
    joined = joined.select(
        "c", "uid", "component", "size", "size_c", "diffs", (F.size("diffs") + F.col("size") - F.size("tokens")).alias("h"),
        (F.col("size_c") - F.size("tokens_c")).alias("own_c"), (100 * F.col("both") >= percent * (F.col("size") + F.col("size_c") - F.col("both"))).alias("linked"),
    )
    joined = stored(joined, "around-leaders")
    around = joined.filter("linked").select(F.col("c").alias("a"), F.col("uid").alias("b"))
    # where all are linked with the leader, nothing is left to find
    groups = stored(joined.groupBy("c").agg(F.min("h").alias("least_h"), F.max("size").alias("most"), F.min("linked").alias("all_linked")).filter("not all_linked").drop("all_linked"), "leader-groups")
    open_rows = joined.join(groups, "c")
    reach = ratio * (F.col("size") + F.least(F.col("most").cast("double"), F.col("size") * 100 / percent))  # D at most
    near_one = (F.col("h") - F.col("own_c") + ratio * (F.col("size_c") - F.col("size"))) / 2  # the other one is not linked with the leader
    far_one = F.greatest(F.col("h") - reach, (F.col("h") + F.col("least_h") - reach) / 2)
    needed = F.greatest(F.lit(1), F.ceil(F.when(F.col("linked"), near_one).otherwise(far_one) - 1e-6))
    open_rows = open_rows.withColumn("needed", needed.cast("int")).withColumn("reach", reach)
    each = open_rows.select("c", "uid", F.explode("diffs").alias("token"))
    counts = each.groupBy("c", "token").agg(F.count("*").alias("n")).filter("n > 1")
    ordered = each.join(counts, ["c", "token"]).groupBy("c", "uid").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("order"))  # no longer than two documents
    kept = ["c", "uid", "component", "size", "h", "linked"]
    indexed = open_rows.join(ordered, ["c", "uid"]).withColumn("sh", F.size("order")).filter("sh >= needed")
    indexed = indexed.select(*kept, "sh", F.posexplode(F.slice("order", 1, F.col("sh") - F.col("needed") + 1)).alias("pos", "x")).select(*kept, "sh", "pos", F.col("x.token").alias("token"))
    # a leader's own tokens are left out of the differences; so documents that differ from it by hardly more can be linked with hardly linked ones without a shared difference
    close = F.when(F.col("linked"), F.col("h") * (1 - ratio) <= F.col("own_c") + 1).otherwise(F.col("h") <= F.col("reach"))
    bare = open_rows.filter(F.col("own_c") > 0).filter(close).select(*kept, F.lit(None).cast("int").alias("sh"), F.lit(0).alias("pos"), F.lit(None).cast("long").alias("token"))
    indexed = stored(indexed.union(bare), "difference-index")
    x, y = indexed.filter("not linked").alias("x"), indexed.alias("y")
    once = F.col("y.linked") | (F.col("x.uid") < F.col("y.uid"))
    most = F.coalesce(F.least(F.col("x.sh") - F.col("x.pos"), F.col("y.sh") - F.col("y.pos")), F.lit(0))
    can = (F.col("x.h") + F.col("y.h") - 2 * most) * (100 + percent) <= (100 - percent) * (F.col("x.size") + F.col("y.size"))
    same = (F.col("x.c") == F.col("y.c")) & F.col("x.token").eqNullSafe(F.col("y.token")) & (F.col("x.uid") != F.col("y.uid"))
    pairs = x.join(y, same & once & (F.col("x.component") != F.col("y.component")) & can)
    return around, pairs.select(F.least("x.uid", "y.uid").alias("a"), F.greatest("x.uid", "y.uid").alias("b")).distinct()


def linked(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """One row per document: uid, doc_id, text_key, n_shingles, component_id (smallest doc_id reachable by links, its own included), leads.

    Words are lower-cased in A-Z. A document's set is its distinct runs of `width` words, or the whole sequence if shorter; null, empty or blank
    texts have an empty set and are linked with nothing. Repeated rows are rows of their own. leads marks one
    document of each component: one with that doc_id. A null doc_id is passed over unless there is no other. Very long texts are taken whole; columns
    besides doc_id and text are not read, and no rows give no rows. percent: 67 or more, as below it two linked documents need not share neighbouring tokens.
    """
    if percent < 67:
        raise ValueError("percent must be 67 or more")
    sets = token_sets(docs, width, percent)
    labels = stored(components(links(sets, percent)), "components")
    rows = sets.select("uid", "doc_id", "text_key", "size", "first").join(labels.withColumnRenamed("node", "first"), "first", "left")
    rows = rows.withColumn("component", F.coalesce("component", "first"))
    least = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.min_by("uid", F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).alias("lead"))
    joined = rows.join(stored(least, "least"), "component")
    return joined.select("uid", "doc_id", "text_key", F.col("size").cast("long").alias("n_shingles"), "component_id", (F.col("uid") == F.col("lead")).alias("leads"))


def keep_leads(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """The rows of docs that lead their components, one for each, with all columns of docs."""
    rows = stored(linked(docs, width, percent), "linked")
    return keep_rows(docs, rows, F.xxhash64(F.coalesce("text", F.lit(""))), "text_key", "leads")
