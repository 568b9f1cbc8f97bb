"""Exact dedup by content-defined chunk recipes.

A text, lower-cased in A-Z only, is cut where a rolling hash of its last 16 bytes says so, so that equal
stretches are cut alike. Each chunk gets a weak fingerprint; chunks of one fingerprint are told
apart by length and SHA-256, and every distinct chunk is named after its first place (row, position). A text's recipe
is the ordered list of these names, and equal texts are those with equal recipes: only the recipes
are shuffled, never the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .shared import keep_rows, stored

_WINDOW, _LEAST, _MOST = 16, 256, 16384
_RECIPE = "uid long, doc_id long, text_sha256 string, chunks array<struct<weak:long,size:int,sha:binary>>"


def cut_points(data: np.ndarray, offsets: np.ndarray, bits: int) -> Iterator[list[int]]:
    """For each row its cuts, first and last included: where the window's hash has `bits` zeros, at
    least 256 and at most 16384 bytes apart."""
    sums = tb.rolling(data)
    begin = np.arange(max(0, len(data) - _WINDOW + 1))
    marks = begin[(tb.span_hash(sums, begin, begin + _WINDOW) & np.uint64((1 << bits) - 1)) == 0] + _WINDOW
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        cuts = [a]
        for m in marks[np.searchsorted(marks, a + _LEAST) : np.searchsorted(marks, b)].tolist():
            if m - cuts[-1] < _LEAST:
                continue
            while m - cuts[-1] > _MOST:
                cuts.append(cuts[-1] + _MOST)
            if m > cuts[-1]:
                cuts.append(m)
        while b - cuts[-1] > _MOST:
            cuts.append(cuts[-1] + _MOST)
        if b > cuts[-1]:
            cuts.append(b)
        yield cuts


def _recipes(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    uid = TaskContext.get().partitionId() << 40
    chunk = pa.struct([("weak", pa.int64()), ("size", pa.int32()), ("sha", pa.binary())])
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        for lo, hi, data, offsets in tb.slices(texts):
            data = tb.LOWER[data]
            view, whole, rows = memoryview(data), [], []
            for cuts in cut_points(data, offsets, bits):
                whole.append(hashlib.sha256(view[cuts[0] : cuts[-1]]).hexdigest())
                parts = [view[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                rows.append([(xxhash.xxh64_intdigest(p) - 2**63, len(p), hashlib.sha256(p).digest()) for p in parts])
            yield pa.record_batch(
                [pa.array(range(uid, uid + hi - lo), pa.int64()), ids.slice(lo, hi - lo).cast(pa.int64()), pa.array(whole, pa.string()),
                 pa.array([[dict(weak=w, size=n, sha=s) for w, n, s in r] for r in rows], pa.list_(chunk))],
                names=["uid", "doc_id", "text_sha256", "chunks"],
            )
            uid += hi - lo


def recipes(docs: DataFrame, chunk_bits: int = 11) -> DataFrame:
    """uid, doc_id, text_sha256 and the recipe: an array of chunk names in order. Chunks have about
    256 + 2**chunk_bits bytes. Stored."""
    cut = stored(docs.select("doc_id", "text").mapInArrow(lambda it: _recipes(it, chunk_bits), _RECIPE), "chunks")
    places = cut.select("uid", F.posexplode("chunks").alias("pos", "c")).select("uid", "pos", "c.*")
    named = stored(places.groupBy("weak", "size", "sha").agg(F.min(F.struct("uid", "pos")).alias("name")), "chunk-names")
    recipe = (
        places.join(named, ["weak", "size", "sha"])
        .groupBy("uid")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("named"))
        .select("uid", F.col("named.name").alias("recipe"))
    )
    out = cut.select("uid", "doc_id", "text_sha256").join(recipe, "uid", "left")
    empty = F.array().cast("array<struct<uid:long,pos:int>>")
    return stored(out.withColumn("recipe", F.coalesce("recipe", empty)), "recipes")


def exact_duplicates(docs: DataFrame, chunk_bits: int = 11) -> DataFrame:
    """One row per document: uid, doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the row
    with the largest doc_id stays, and of several rows with that doc_id exactly one; a null doc_id is
    the smallest. Other columns are ignored. A text of any length is taken whole, as chunks; no rows give no rows.
    """
    rows = recipes(docs, chunk_bits)
    groups = rows.groupBy("recipe").agg(F.max(F.struct("doc_id", "uid")).alias("keep"), F.count("*").alias("group_size"))
    joined = rows.join(stored(groups, "groups"), "recipe")
    return joined.select(
        "uid", "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("uid") == F.col("keep.uid")).alias("kept"), "text_sha256"
    )


def keep_one(docs: DataFrame, chunk_bits: int = 11) -> DataFrame:
    """The rows of docs that exact_duplicates keeps, with all columns of docs."""
    rows = stored(exact_duplicates(docs, chunk_bits), "duplicates")
    lowered = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return keep_rows(docs, rows, F.sha2(lowered, 256), "text_sha256", "kept")
