"""The sampling frame: why a match summary is left out, and reports by page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

# The reasons as reports show them, the lobby type of ranked matches and the rate where none can be measured.
TOO_NEW, TOO_OLD, NOT_SAMPLED, LOW_RANK, NOT_RANKED = "too new", "below --until", "not sampled", "below --min-rank", "not ranked"
RANKED_LOBBY = 7
DEFAULT_ID_RATE = 30.0


def drop_reason(cutoff: float, min_rank: int, until: int | None = None, sample: float = 1.0, ranked_only: bool = False) -> Column:
    """The first rule that leaves a summary out, or null. A start of 0 or null passes the time rules; rank and lobby hold for
    public matches only, where no rank is below any floor."""
    start = F.when(F.col("start_time") != 0, F.col("start_time"))
    public = F.col("source") == "public"
    out = F.when(start > cutoff, TOO_NEW)
    if until:
        out = out.when(start < until, TOO_OLD)
    out = out.when(~S.sampled(F.col("match_id"), sample), NOT_SAMPLED)
    out = out.when(public & (F.col("avg_rank_tier").isNull() | (F.col("avg_rank_tier") < min_rank)), LOW_RANK)
    return out.when(public & ~F.col("lobby_type").eqNullSafe(RANKED_LOBBY), NOT_RANKED) if ranked_only else out


def keep(rows: DataFrame, **rules) -> DataFrame:
    return rows.filter(drop_reason(**rules).isNull())


def reason_counts(rows: DataFrame, **rules) -> DataFrame:
    return rows.groupBy("page", F.coalesce(drop_reason(**rules), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def page_bounds(rows: DataFrame) -> DataFrame:
    """Of all rows of a page, kept or not; the least id is the next cursor."""
    return rows.groupBy("page").agg(F.min("match_id").alias("cursor"), F.min("start_time").alias("earliest"), F.max("start_time").alias("latest"), F.count("*").alias("n"))


def reached_floor(rows: DataFrame, floor: int) -> DataFrame:
    """Pages whose newest row is older than the floor."""
    start = F.when(F.col("start_time") != 0, F.col("start_time"))
    return rows.groupBy("page").agg(F.max(start).alias("newest")).filter(F.col("newest") < floor)


def id_rate(rows: DataFrame) -> DataFrame:
    """Ids per second over each page's rows with a time; a default where there are too few or they span no time."""
    timed = F.col("start_time").isNotNull() & (F.col("start_time") != 0)
    t, i = F.when(timed, F.col("start_time")), F.when(timed, F.col("match_id"))
    sums = rows.groupBy("page").agg(F.count(t).alias("n"), (F.max(t) - F.min(t)).alias("span"), (F.max(i) - F.min(i)).alias("ids"))
    return sums.select("page", F.when((F.col("n") < 2) | (F.col("span") <= 0), F.lit(DEFAULT_ID_RATE)).otherwise(F.col("ids") / F.col("span")).alias("rate"))


def with_ids(rows: DataFrame) -> DataFrame:
    """Without placeholders, which have no id."""
    return rows.filter(F.coalesce("match_id", F.lit(0)) != 0)
