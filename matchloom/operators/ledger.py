"""The ledger of match ids and their outcomes. Every function returns a new table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources import landing

RETRYABLE = ("discovered", "failed")
MOST_ATTEMPTS = 3
MOST_ERROR_CHARS = 300
# The reasons that end a walk.
TERMINAL_REASONS = ("reached --until floor", "no more results")


def insert_or_ignore(ledger: DataFrame, rows: DataFrame, order: list[Column]) -> DataFrame:
    """The rows to add: those with ids that the ledger does not have, of several with one id the first by `order`."""
    columns = rows.columns
    first = rows.groupBy("match_id").agg(F.min_by(F.struct(*columns), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("r")).select("r.*")
    return first.join(ledger.select("match_id"), "match_id", "left_anti").select(*columns)


def pending(ledger: DataFrame, limit: int | None = None, walks: list[str] | None = None) -> DataFrame:
    """Ids still to be fetched, the newest match first."""
    rows = ledger.filter(F.col("status").isin(*RETRYABLE) & (F.col("attempts") < MOST_ATTEMPTS))
    if walks:
        rows = rows.filter(S.in_walks(walks))
    rows = rows.orderBy(F.col("start_time").desc_nulls_last(), F.col("match_id").desc())
    return rows.limit(limit) if limit else rows


def numbered(rows: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """rows with their place within a group by order, from 0, as `name`. order: as in orderBy; rows alike in it are in any order.

    Rows are dealt out by sampled ranges of group and order, so that a group is never in one task. They are stored, as ranges must not change between
    counting and numbering: each range is counted, and numbers start after the earlier ranges of its group.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = rows.repartitionByRange(parts, *group, *order).withColumn("__range", F.spark_partition_id())
    path = landing.shared_path(rows.sparkSession, "ranges")
    ranges.write.parquet(path)
    ranges = rows.sparkSession.read.schema(ranges.schema).parquet(path)
    before = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = ranges.groupBy(*group, "__range").agg(F.count("*").alias("__n")).withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    starts = starts.toDF(*[f"__g{i}" for i in range(len(group))], "__of", "__base")
    same = F.col("__range") == F.col("__of")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    inner = Window.partitionBy("__range", *group).orderBy(*order)
    placed = ranges.withColumn("__place", F.row_number().over(inner)).join(starts, same)
    return placed.select(*rows.columns, (F.col("__base") + F.col("__place") - 1).alias(name))


def batches(rows: DataFrame, size: int = 6) -> DataFrame:
    """Ids of each walk in the order of pending(), cut into chunks: source, label, match_id, batch. A walk is numbered over ranges of its order, so that no task holds
    it whole, however many matches start in one second or have no time."""
    order = [F.col("start_time").desc_nulls_last(), F.col("match_id").desc()]
    found = numbered(rows.select("source", "label", "start_time", "match_id"), ["source", "label"], order, "place")
    return found.select("source", "label", "match_id", F.floor(F.col("place") / size).alias("batch"))


def split_responses(responses: DataFrame) -> DataFrame:
    """responses: batch, ids (array), payload (JSON text). One row per id: batch, match_id, outcome (found, failed, missing), error, record.

    Alias mN is ids[N]. An error with a path to such an alias is that id's, the last one counting; one without is for every id that has
    no error yet at its place. Found wins over an error; an alias that maps to no id is ignored.
    """
    kind = "struct<data:map<string,variant>,errors:array<struct<message:string,path:array<string>>>>"
    parsed = responses.withColumn("r", F.from_json("payload", kind)).withColumn("errors", F.coalesce("r.errors", F.array().cast("array<struct<message:string,path:array<string>>>")))
    rows = parsed.select("batch", F.posexplode("ids").alias("pos", "match_id"), "r.data", "errors")
    alias = F.concat(F.lit("m"), F.col("pos").cast("string"))
    record = F.try_element_at("data", alias)
    path = lambda e: F.try_element_at(e["path"], F.lit(1))
    own = F.filter("errors", lambda e: F.coalesce(path(e).rlike("^m") & (F.regexp_extract(path(e), r"^m\s*\+?0*(\d+)\s*$", 1) == F.col("pos").cast("string")), F.lit(False)))
    general = F.filter("errors", lambda e: ~F.coalesce(path(e).startswith("m"), F.lit(False)))
    message = lambda e: F.substring(F.coalesce(e["message"], F.lit("None")), 1, MOST_ERROR_CHARS)
    error = F.when(F.size(own) > 0, message(F.try_element_at(own, F.lit(-1)))).when(F.size(general) > 0, message(F.try_element_at(general, F.lit(1))))
    found = record.isNotNull() & ~F.is_variant_null(record)
    outcome = F.when(found, "found").when(error.isNotNull(), "failed").otherwise("missing")
    return rows.select("batch", "match_id", outcome.alias("outcome"), F.when(~found, error).alias("error"), F.when(found, F.to_json(record)).alias("record"))


def apply_outcomes(ledger: DataFrame, outcomes: DataFrame, raw_file: str) -> DataFrame:
    """The ledger after a fetch: one more attempt for each id; found ids get the shard's name and keep their last error, the others get their error
    (null if missing)."""
    o = outcomes.select("match_id", F.col("outcome"), F.col("error"))
    status = F.when(F.col("outcome") == "found", "fetched").when(F.col("outcome").isNotNull(), F.col("outcome")).otherwise(F.col("status"))
    found, hit = F.col("outcome") == "found", F.col("outcome").isNotNull()
    joined = ledger.join(o, "match_id", "left")
    out = joined.withColumns(
        {
            "status": status,
            "attempts": F.col("attempts") + hit.cast("int"),
            "raw_file": F.when(found, F.lit(raw_file)).otherwise(F.col("raw_file")),
            "last_error": F.when(hit & ~found, F.col("error")).otherwise(F.col("last_error")),
        }
    )
    return out.select(*ledger.columns)


def batch_outcomes(outcomes: DataFrame) -> DataFrame:
    is_ = lambda x: F.count_if(F.col("outcome") == x).alias(x)
    return outcomes.groupBy("batch").agg(is_("found"), is_("failed"), is_("missing"))


def without_walks(ledger: DataFrame, walks: list[str], include_fetched: bool = False) -> DataFrame:
    """The ledger without the walks' rows; fetched ones stay unless asked for."""
    gone = F.coalesce(S.in_walks(walks), F.lit(False))
    return ledger.filter(~gone if include_fetched else ~gone | F.col("status").eqNullSafe(F.lit("fetched")))


def of_walks(ledger: DataFrame, walks: list[str], include_fetched: bool = False) -> DataFrame:
    """The rows that without_walks leaves out."""
    gone = F.coalesce(S.in_walks(walks), F.lit(False))
    return ledger.filter(gone if include_fetched else gone & ~F.col("status").eqNullSafe(F.lit("fetched")))


def removal_tally(ledger: DataFrame, walks: list[str], include_fetched: bool = False) -> DataFrame:
    """what, n: rows removed by status, or kept_fetched."""
    what = F.col("status") if include_fetched else F.when(F.col("status") == "fetched", "kept_fetched").otherwise(F.col("status"))
    return ledger.filter(S.in_walks(walks)).groupBy(what.alias("what")).agg(F.count("*").alias("n"))


def walk_spans(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("source", "label").agg(F.count("*").alias("n"), F.min("start_time").alias("earliest"), F.max("start_time").alias("latest"))


def cursors(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy(S.walk_key(F.col("source"), F.col("label")).alias("key")).agg(F.min("match_id").alias("cursor"))


def walk_state(log: DataFrame) -> DataFrame:
    """log: source, label, pages, reason, ended_at. All pages, the last reason, and whether that ends the walk."""
    rows = log.groupBy("source", "label").agg(F.sum("pages").alias("pages_done"), F.max_by("reason", "ended_at").alias("reason"))
    return rows.withColumn("state", F.when(F.col("reason").isin(*TERMINAL_REASONS), "done").otherwise("open"))


def walk_status(ledger: DataFrame, walks: DataFrame) -> DataFrame:
    """Counts of walks beside their records; either may be absent."""
    spans = walk_spans(ledger).withColumn("key", S.walk_key(F.col("source"), F.col("label"))).drop("source", "label")
    known = walks.select(S.walk_key(F.col("source"), F.col("label")).alias("key"), "pages_done", "reason", "state")
    return spans.join(known, "key", "full").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def dead_streaks(outcomes: DataFrame, length: int = 3, block: int = 10_000) -> DataFrame:
    """run, seq of the first batch of each run at which `length` answered batches in a row found nothing. outcomes: run, seq, found.

    A run of any length: its batches are numbered over ranges and looked at in blocks, and the last length - 1 of a block are carried over to the next one.
    """
    block = max(block, length)
    placed = numbered(outcomes.select("run", "seq", "found"), ["run"], [F.col("seq")], "place")
    own = F.floor(F.col("place") / block)
    carried = F.col("place") % block > block - length
    rows = placed.withColumn("own", own).withColumn("block", F.explode(F.when(carried, F.array(own, own + 1)).otherwise(F.array(own))))
    last = Window.partitionBy("run", "block").orderBy("place").rowsBetween(1 - length, 0)
    rows = rows.withColumn("found_lately", F.sum("found").over(last)).withColumn("batches", F.count("*").over(last))
    dead = (F.col("found_lately") == 0) & (F.col("batches") == length) & (F.col("own") == F.col("block"))
    return rows.filter(dead).groupBy("run").agg(F.min("seq").alias("seq"))
