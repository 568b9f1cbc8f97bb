"""Filter interaction audit with a counting-Bloom duplicate prepass.

Five filters are applied in all orders. Four look at one document; the fifth rejects a text that a document with a smaller doc_id has, anywhere in the table. To
find these, each task counts the cells of its texts in a counting-Bloom sketch, once for each distinct text and with counters that stop at two, and the sketches are merged by block. A text
with a cell that is counted once is in one document only and is cleared. Only the other texts, the repeats and about one in 200 of the rest, are shuffled, whole,
for the smallest doc_id of each.

What a document fails is a mask of five bits. Counts by mask add up to all that the orders ask for: of the documents that a set of filters leaves, of those that
a filter removes after that set, and so on. So the documents are counted once for each part and mask, and the 120 orders are made of 32 counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BLANK, stored

FILTERS = "ABCDE"
_SETS = 1 << len(FILTERS)
#: Cells of the sketch for each document, cells that a text has, cells of a block (as a power of two).
_CELLS, _PROBES, _BITS = 16, 3, 14
#: A merged sketch of up to so many bytes is broadcast: that of some 16 million documents. Beyond, texts are dealt to its blocks, so they move once more.
MOST_BROADCAST = 32_000_000
#: Texts that a task counts together.
_HELD = 1_000_000


def _cells(hashes: np.ndarray) -> np.ndarray:
    """The cells of each text within its block, one column for each probe."""
    return np.stack([(hashes >> np.uint64(_BITS * i)) & np.uint64((1 << _BITS) - 1) for i in range(_PROBES)], 1)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketches of a task's texts: block, cells that were counted and, as bits, whether more than once. Equal texts count twice at most."""
    blocks: list[np.ndarray] = []
    hashes: list[np.ndarray] = []

    def emit() -> Iterator[pa.RecordBatch]:
        pairs = np.stack([np.concatenate(blocks), np.concatenate(hashes)], 1)
        texts, times = np.unique(pairs, axis=0, return_counts=True)
        cell = (texts[:, :1] << _BITS) | _cells(texts[:, 1].astype(np.uint64)).astype(np.int64)
        cells, at = np.unique(cell.ravel(), return_inverse=True)
        counts = np.bincount(at.ravel(), np.repeat(np.minimum(times, 2), _PROBES), len(cells))
        block = cells >> _BITS
        edges = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
        rows = [(int(block[a]), (cells[a:b] & ((1 << _BITS) - 1)).astype(np.uint16).tobytes(), np.packbits(counts[a:b] > 1).tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        for i in range(0, len(rows), 4096):
            part = rows[i : i + 4096]
            yield pa.record_batch([pa.array([r[k] for r in part], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], names=["block", "cells", "twice"])

    held = 0
    for batch in batches:
        blocks.append(batch.column("block").to_numpy())
        hashes.append(batch.column("hash").to_numpy(zero_copy_only=False))
        held += batch.num_rows
        if held >= _HELD:
            yield from emit()
            blocks, hashes, held = [], [], 0
    if held:
        yield from emit()


def _merged(table: pa.Table) -> pa.Table:
    """One block of the sketches: words of 64 cells each, with a bit for each cell that counts two or more."""
    counts = np.zeros(1 << _BITS, np.uint8)
    for cells, twice in zip(table.column("cells"), table.column("twice"), strict=True):
        at = np.frombuffer(cells.as_buffer(), np.uint16)
        counts[at] = np.minimum(counts[at] + 1 + np.unpackbits(np.frombuffer(twice.as_buffer(), np.uint8), count=len(at)), 2)
    words = np.packbits(counts > 1, bitorder="little").view(np.int64)
    return pa.table([pa.array([table.column("block")[0].as_py()], pa.int64()), pa.array([words.tolist()], pa.list_(pa.int64()))], names=["block", "words"])


def _hashed(text: Column, blocks: int) -> tuple[Column, Column]:
    return F.pmod(F.xxhash64(text), F.lit(blocks)).alias("block"), F.xxhash64(F.lit(1), text).alias("hash")


def sketch(docs: DataFrame, blocks: int) -> DataFrame:
    """Stored: block, words (a bit for each cell that is counted twice or more) of the texts of docs."""
    parts = docs.select(*_hashed(F.coalesce("text", F.lit("")), blocks)).mapInArrow(_sketches, "block long, cells binary, twice binary")
    return stored(parts.groupBy("block").applyInArrow(_merged, "block long, words array<long>"), "sketch")


def _maybe_repeated() -> Column:
    """Whether all cells of a text (hash) are counted twice or more in its block's words."""
    out = F.lit(True)
    for i in range(_PROBES):
        cell = F.shiftrightunsigned("hash", _BITS * i).bitwiseAND(F.lit((1 << _BITS) - 1))
        out = out & (F.getbit(F.element_at("words", (F.shiftright(cell, 6) + 1).cast("int")), cell.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return out


def failures(text: Column, words: Column) -> Column:
    """Mask of the filters that a document fails by itself: A is 1, B 2, C 4, D 8."""
    n, distinct, capitals = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long"), F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    tests = [n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * F.length(text).cast("long"), text.rlike(r"[#$%&*|]")]
    return sum((F.when(test, 1 << i).otherwise(0) for i, test in enumerate(tests)), F.lit(0))


def failing(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: doc_id, part (source, or empty), mask (see failures; E is 16).

    A null text is empty. E: a row with a smaller doc_id has the same text; a null doc_id is smaller than any other, and rows with one doc_id do
    not reject each other. Texts of any length are taken whole; columns besides doc_id, text and source are not read.
    """
    blocks = max(1, -(-docs.count() * _CELLS >> _BITS))
    repeats = sketch(docs, blocks)
    if blocks << (_BITS - 3) <= MOST_BROADCAST:
        repeats = F.broadcast(repeats)
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("*", *_hashed(F.col("text"), blocks)).join(repeats, "block", "left")
    again = F.when(F.coalesce(_maybe_repeated(), F.lit(False)), F.col("text")).alias("again")
    words = F.filter(F.split("text", f"{BLANK}+"), lambda w: w != "")
    rows = rows.select("doc_id", "part", "text", again, words.alias("words"))
    rows = stored(rows.select("doc_id", "part", failures(F.col("text"), F.col("words")).alias("mask"), "again"), "filter-masks")
    maybe = rows.filter("again is not null")
    least = maybe.groupBy("again").agg(F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("none"), F.count("*").alias("n")).filter("n > 1").drop("n")
    told = maybe.join(least, "again", "left")
    later = F.col("doc_id").isNotNull() & (F.col("none") | (F.col("doc_id") > F.col("least")))
    told = told.select("doc_id", "part", (F.col("mask") + F.when(F.coalesce(later, F.lit(False)), 16).otherwise(0)).alias("mask"))
    return rows.filter("again is null").select("doc_id", "part", "mask").union(told)


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents, and those with a label of quality = 1 or toxic = 1, of each part and mask. Of several labels of a document
    one of either kind is enough; labels without a doc_id speak for none."""
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic"))
    joined = rows.join(marks, "doc_id", "left")
    return joined.groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("is_good").alias("good"), F.count_if("is_toxic").alias("toxic"))


def orders() -> list[tuple[str, int, int, int]]:
    """filter_order, step, the filter's number, and the set of filters before it."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(FILTERS[i] for i in order), step, f, before))
            before |= 1 << f
    return out


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, filter_order and step of counts (part, mask, n, good, toxic; a row for each part and mask at most): kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley."""
    each = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("m"))  # 32 at most
    bit = lambda f: F.call_function("shiftleft", F.lit(1), f)
    # by set of filters, what passes all of it
    passing = lambda c: F.transform(
        F.sequence(F.lit(0), F.lit(_SETS - 1)),
        lambda s: F.aggregate("m", F.lit(0).cast("long"), lambda a, x: a + F.when(x["mask"].bitwiseAND(s) == 0, x[c]).otherwise(0)),
    )
    each = each.select("part", "m", *[passing(c).alias(c) for c in ("n", "good", "toxic")])
    only = F.transform(
        F.sequence(F.lit(0), F.lit(len(FILTERS) - 1)),
        lambda f: F.aggregate("m", F.lit(0).cast("long"), lambda a, x: a + F.when(x["mask"] == bit(f), x["n"]).otherwise(0)),
    )
    table = orders()
    # how often a filter comes right after a set, summed over all orders
    times = {(f, before): sum((g, b) == (f, before) for _, _, g, b in table) for _, _, f, before in table}
    removed = lambda c, f, before: F.get(c, F.lit(before)) - F.get(c, F.lit(before | 1 << f))
    shapley = F.array(*[sum((removed("n", f, b) * k for (g, b), k in times.items() if g == f), F.lit(0).cast("long")) for f in range(len(FILTERS))])
    each = each.select("part", "n", "good", "toxic", only.alias("only"), shapley.alias("shapley"))
    steps = F.from_json(F.lit("[" + ",".join(f'{{"o":"{o}","s":{s},"f":{f},"b":{b}}}' for o, s, f, b in table) + "]"), "array<struct<o:string,s:int,f:int,b:int>>")
    rows = each.select("*", F.explode(steps).alias("x"))
    after = F.col("x.b").bitwiseOR(bit(F.col("x.f")))
    lost = lambda c: F.get(c, F.col("x.b")) - F.get(c, after)
    fails = F.get("n", F.lit(0)) - F.get("n", bit(F.col("x.f")))
    return rows.select(
        "part", F.col("x.o").alias("filter_order"), F.col("x.s").alias("step"), F.get("n", after).alias("kept"), lost("n").alias("removed"), (fails - lost("n")).alias("redundant"),
        F.get("only", F.col("x.f")).alias("unique_fails"), lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.get("shapley", F.col("x.f")).alias("shapley"),
    )


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of the five filters over docs (doc_id, text, source) and labels (doc_id, quality, toxic): a row for each part (source; null and empty
    are one part, empty), order of the filters and step.

    Filters: A under 50 words, B 100 times the distinct words under 65 times the words, C 100 times the capitals A-Z over 5 times the code points, D holds any of
    `#$%&*|`, E see failing. Repeated rows count each. Columns of other names are not read, and no documents give no rows.
    """
    return interactions(stored(mask_counts(failing(docs), labels), "mask-counts"))
