"""Mixing sources to target weights by capped water-filling. DataFrame functions only.

Sources get words in proportion to their weights, but none more than a given number of times its own words; what is
over goes to the others by weight, until none is above its limit. The documents of a source are then taken in
the order of a seeded hash: every one as often as whole repetitions fit, and the first ones once more, until
the target is met; of the last of these only the leading words are taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import WORD, hash60, running, stored


def water_fill(sizes: dict, weights: dict, total: float, most: float) -> dict:
    """The target of each source; sizes and weights by source."""
    limits = {s: most * n for s, n in sizes.items()}
    targets, left, open_sources = {}, float(total), set(sizes)
    while open_sources:
        weight = sum(weights[s] for s in open_sources)
        level = (total - sum(targets.values())) / weight
        full = {s for s in open_sources if weights[s] * level >= limits[s]}
        if not full:
            return targets | {s: weights[s] * level for s in open_sources}
        targets |= {s: limits[s] for s in full}
        open_sources -= full
    return targets


def mixed(docs: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix", numbered: bool = False) -> DataFrame:
    """One row per document: uid (that of docs, if numbered), doc_id, source, size, source_size, target, whole, extra, taken.

    size counts the words; null texts have none. Sources stand by code point, null last, and take the
    weights in turn. The mix takes `whole` repetitions and then the first `extra` words. Repeated rows are rows
    of their own, in any order among themselves as they are alike. Texts of any length count whole; columns besides doc_id, text, source and, if numbered, uid are not
    read. The driver gets one row per source, which is a dataset's name. No documents give no rows.
    """
    spark = docs.sparkSession
    uid = F.col("uid") if numbered else F.monotonically_increasing_id()
    rows = stored(
        docs.select(
            uid.alias("uid"), "doc_id", "source", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
            hash60(F.lit(seed), F.col("doc_id")).alias("h"),
        ), "word-counts",
    )
    found = {r["source"]: (r["n"], r["words"]) for r in rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("n")).collect()}
    sizes = {s: found[s][1] for s in sorted(found, key=lambda s: (s is None, s or ""))}
    by_weight = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    targets = water_fill(sizes, by_weight, share * sum(sizes.values()), most)
    plan = []
    for s, size in sizes.items():
        words = int(targets[s] + 0.5)
        plan.append((s, size, float(targets[s]), words // size if size else 0, words % size if size else 0))
    kind = "source string, source_size long, target double, whole long, over long"
    table = spark.createDataFrame(plan, T._parse_datatype_string(kind)) if plan else spark.createDataFrame([], kind)
    ordered = running(rows, ["source"], ["h", "doc_id", "size", "uid"], F.col("size"), "before")
    joined = ordered.alias("d").join(table.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    extra = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("over") - F.col("before")))
    return joined.select(
        "uid", "d.doc_id", "d.source", "size", "source_size", "target", "whole", extra.alias("extra"), (F.col("size") * F.col("whole") + extra).alias("taken")
    )


def repeated(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken whole, and once more with the leading words only where so few
    are taken (words joined by a blank; n_chars is theirs if docs has it). Columns are those of docs."""
    texts = stored(docs.withColumn("__loom_uid", F.monotonically_increasing_id()), "numbered")
    plan = mixed(texts.withColumn("uid", F.col("__loom_uid")), numbered=True, **settings).select(F.col("uid").alias("__loom_uid"), "size", "whole", "extra")
    plan = plan.toDF("__loom_uid", "__loom_size", "__loom_whole", "__loom_extra")
    full = F.col("__loom_whole") + F.when((F.col("__loom_extra") == F.col("__loom_size")) & (F.col("__loom_size") > 0), 1).otherwise(0)
    part = F.when((F.col("__loom_extra") > 0) & (F.col("__loom_extra") < F.col("__loom_size")), F.array(F.col("__loom_extra"))).otherwise(F.array().cast("array<long>"))
    times = F.concat(F.array_repeat(F.lit(-1).cast("long"), full.cast("int")), part)  # -1: whole
    out = texts.join(plan.withColumn("__loom_words", times).filter(F.size("__loom_words") > 0), "__loom_uid").withColumn("__loom_take", F.explode("__loom_words"))
    lead = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)), 1, F.col("__loom_take").cast("int")), " ")
    out = out.withColumn("text", F.when(F.col("__loom_take") >= 0, lead).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__loom_take") >= 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
