"""Merkle manifest of a dataset by lag and lead windows. DataFrame functions only.

Rows are leaves. The leaves of a source, in the order of doc_id, form a tree in which every `width` consecutive nodes become one of the next level, and the
tops of the sources form another tree. At each level a window over one run of nodes (its key is tree and run, so it never holds more than `width` rows) gives
lag and lead columns of fixed offsets. Masked by slot and run length they are the siblings of a node, and in the first row of a run the
lead columns are the other children, so that row hashes the parent. Levels shrink by the width, so only leaves and their parents are of any size.

Proofs are made from the top down: a node's path is its own siblings and then its parent's path. Each level joins the next one by tree and run, by which its
window has dealt the rows already. Numbering within a source goes over ranges of the order, so that a source with most of the rows is never in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

WIDTH = 16
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<before:string,after:string>>"


def _field(value: Column) -> Column:
    """`-` for null, else the number of bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[_field(v) for v in values]), 256)


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with pos, the place within `key` by `order`, and size, the rows of the key. Rows are counted by ranges of the order first. Stored."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = stored(rows.repartitionByRange(parts, "key", *order).withColumn("range", F.spark_partition_id()), "merkle-ranges")
    counts = ranges.groupBy("key", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    spans = counts.select("key", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.sum("n").over(Window.partitionBy("key")).alias("size"))
    inner = Window.partitionBy("key", "range").orderBy(*order)
    placed = ranges.withColumn("place", F.row_number().over(inner)).join(spans, ["key", "range"])
    return stored(placed.withColumn("pos", F.col("base") + F.col("place") - 1).drop("range", "place", "base"), "merkle-nodes")


def _runs(nodes: DataFrame, width: int) -> tuple[DataFrame, Window]:
    """Nodes of trees that go on: with their run, slot and the length of the run; and the window over a run."""
    open_nodes = nodes.filter("size > 1").withColumns({"run": F.floor(F.col("pos") / width), "slot": (F.col("pos") % width).cast("int")})
    return open_nodes.withColumn("length", F.least(F.lit(width).cast("long"), F.col("size") - F.col("run") * width).cast("int")), Window.partitionBy("key", "run").orderBy("slot")


def _later(window: Window, width: int) -> list[Column]:
    """The nodes after a node in its run, empty where there are none."""
    return [F.when(F.col("slot") + k < F.col("length"), F.lead("h", k).over(window)).otherwise(F.lit("")) for k in range(1, width)]


def _earlier(window: Window, width: int) -> list[Column]:
    return [F.when(F.col("slot") >= k, F.lag("h", k).over(window)).otherwise(F.lit("")) for k in range(width - 1, 0, -1)]


def _levels(nodes: DataFrame, width: int) -> list[DataFrame]:
    """The nodes (key, pos, size, h) and all levels above, each stored. A tree ends at the level where its size is 1."""
    levels, most = [nodes], nodes.agg(F.max("size")).first()[0] or 0
    while most > 1:
        runs, window = _runs(levels[-1], width)
        hashed = runs.select("key", "run", "slot", "size", F.sha2(F.concat("h", *_later(window, width)), 256).alias("h")).filter("slot = 0")
        levels.append(stored(hashed.select("key", F.col("run").alias("pos"), F.ceil(F.col("size") / width).alias("size"), "h"), "merkle-level"))
        most = -(-most // width)
    return levels


def _paths(levels: list[DataFrame], tops: DataFrame, carried: list[str], width: int) -> DataFrame:
    """The lowest level with path (siblings before and after a node, level by level) and the columns `carried`, which come down from tops (key, path, *carried)."""
    above = None
    for i, nodes in enumerate(reversed(levels)):
        own = [c for c in nodes.columns if c not in ("key", "pos", "size")] if i == len(levels) - 1 else []
        ended = nodes.filter("size = 1").join(tops, "key").select("key", "pos", *own, "path", *carried)
        if above is not None:
            runs, window = _runs(nodes, width)
            step = F.struct(F.concat(*_earlier(window, width)).alias("before"), F.concat(*_later(window, width)).alias("after")).alias("step")
            up = above.select("key", F.col("pos").alias("run"), "path", *carried)
            joined = runs.select("key", "run", "pos", *own, step).join(up, ["key", "run"])
            ended = ended.union(joined.select("key", "pos", *own, F.concat(F.array("step"), "path").alias("path"), *carried))
        above = ended
    return above


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def proof(path: Column) -> Column:
    """All siblings of a path, from the leaf up and from left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


def manifest(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per row of docs (doc_id, text, lang, source, n_chars): doc_id, leaf, subroot, root and path.

    A null source is a source of its own and comes first, a null doc_id comes before any other of its source, and a null in any column is a value unlike any
    other. Rows with one doc_id follow each other by their leaf; repeated rows are leaves of their own, alike, so their order among
    themselves does not matter. Texts of any length are hashed whole. Other columns are not read, and no rows give no rows.
    """
    return _manifest(docs, width, F.lit(None).cast("string")).select("doc_id", F.col("h").alias("leaf"), "subroot", "root", "path")


def _manifest(docs: DataFrame, width: int, text: Column) -> DataFrame:
    """Leaves as h, and `other`: the leaf with another text, null where that is null."""
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))  # in the order of sources, null first
    other = F.when(text.isNotNull(), leaf_hash(*values[:-1], text))
    leaves = docs.select("doc_id", key.alias("key"), leaf_hash(*values).alias("h"), other.alias("other"), F.monotonically_increasing_id().alias("uid"))
    lower = _levels(_numbered(stored(leaves, "merkle-leaves"), ["doc_id", "h", "uid"]).drop("uid"), width)
    subroots = lower[0].filter("size = 1").select("key", "h")
    for level in lower[1:]:
        subroots = subroots.union(level.filter("size = 1").select("key", "h"))
    upper = _levels(_numbered(stored(subroots.select(F.lit(0).alias("key"), F.col("key").alias("source_key"), "h"), "merkle-subroots"), ["source_key"]), width)
    root = upper[-1].select("key", F.array().cast(_PATH).alias("path"), F.col("h").alias("root"))
    tops = _paths(upper, root, ["root"], width).select(F.col("source_key").alias("key"), "path", F.col("h").alias("subroot"), "root")
    return _paths(lower, stored(tops, "merkle-tops"), ["subroot", "root"], width)


def tampered(docs: DataFrame, share: int = 5, width: int = WIDTH) -> DataFrame:
    """The manifest of docs held against a copy of them with changes: a row for each row of docs, with doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    In the copy, A-Z are lower-cased in the texts of rows where `share` divides the CRC-32 of the decimal doc_id; a null text stays, and rows
    with a null doc_id are not changed. Each row's root is folded from its own leaf in the copy and the siblings of the manifest; verified tells whether
    that is the root. Rows whose text has no capitals verify in any case. Odd rows as in manifest.
    """
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % share == 0, F.translate("text", _CAPITALS, _SMALL))
    rows = _manifest(docs, width, changed)
    root = folded(F.coalesce("other", "h"), F.col("path"))
    rows = rows.select("doc_id", F.col("h").alias("leaf"), "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), root.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
