"""Dimension tables: releases from three sources, items with their recipe graph, catalogue gaps, leagues and teams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def trusted_versions(versions: DataFrame, until: int) -> DataFrame:
    return versions.filter(F.col("asOfDateTime") <= until)


def dated(entries: DataFrame, source: str) -> DataFrame:
    """Patch rows of {name, date, pos}; entries without a name or a date that parses are left out."""
    rows = entries.select("name", S.epoch(F.col("date")).alias("start_ts"), F.lit(source).alias("source"), "pos")
    return rows.filter((F.coalesce("name", F.lit("")) != "") & (F.coalesce("start_ts", F.lit(0)) != 0))


def merged_patches(sources: list[DataFrame]) -> DataFrame:
    """One row per name from sources (name, start_ts, source, pos) in rising precedence; within a source the later entry wins."""
    rows = None
    for rank, df in enumerate(sources):
        part = df.select("name", "start_ts", "source", F.lit(rank).alias("rank"), "pos")
        rows = part if rows is None else rows.unionByName(part)
    best = rows.groupBy("name").agg(F.max_by(F.struct("start_ts", "source"), F.struct("rank", "pos")).alias("b"))
    return best.select("name", "b.start_ts", "b.source")


def disagreements(a: DataFrame, b: DataFrame) -> DataFrame:
    """Names that two sources date differently."""
    left, right = a.select("name", F.col("start_ts").alias("a_start_ts")), b.select("name", F.col("start_ts").alias("b_start_ts"))
    return left.join(right, "name").filter("a_start_ts != b_start_ts")


def edges(constants: DataFrame) -> DataFrame:
    """item_id, pos, component_id of items (short_name, id, components): component names that are no item's are left out."""
    known = constants.filter("id is not null")
    parts = known.select(F.col("id").alias("item_id"), F.posexplode("components").alias("pos", "component"))
    return parts.join(known.select(F.col("short_name").alias("component"), F.col("id").alias("component_id")), "component").select("item_id", "pos", "component_id")


def items_meta(constants: DataFrame) -> DataFrame:
    """Items with flags and the recipe graph in both directions; items without an id are left out, as are the names of such."""
    graph = edges(constants)
    down = graph.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("pos", "component_id"))).alias("c")).select("item_id", F.col("c.component_id").alias("components"))
    up = graph.groupBy(F.col("component_id").alias("item_id")).agg(F.sort_array(F.collect_list("item_id")).alias("built_into"))
    rows = constants.filter("id is not null").select(
        F.col("id").alias("item_id"), "short_name", S.filled(F.col("dname"), F.col("short_name")).alias("display_name"), "cost", F.col("qual").alias("quality"),
        F.col("short_name").startswith("recipe_").alias("is_recipe"), F.col("qual").eqNullSafe("consumable").alias("is_consumable"), "tier",
    )
    none = F.array().cast("array<long>")
    joined = rows.join(down, "item_id", "left").join(up, "item_id", "left")
    return joined.withColumns({c: F.coalesce(c, none) for c in ("components", "built_into")})


def taxonomy(meta: DataFrame) -> DataFrame:
    terminal = (F.size("components") > 0) & (F.size("built_into") == 0)
    return meta.agg(F.count_if("is_consumable").alias("consumables"), F.count_if(terminal).alias("terminal_items"))


def absent_from(ids: DataFrame, others: DataFrame, key: str, other: str) -> DataFrame:
    """Rows whose key is NOT IN the others' keys: none if these hold a null, and no row with a null key unless they are empty."""
    return ids.sparkSession.sql(f"SELECT * FROM {{ids}} WHERE {key} NOT IN (SELECT {other} FROM {{others}})", ids=ids, others=others)


def search(rows: DataFrame, name: str, pattern: str, order: str, limit: int = 25) -> DataFrame:
    """Rows whose name contains the pattern in any case, the highest `order` first (null as 0)."""
    found = rows.filter(S.contains_text(F.col(name), pattern))
    return found.orderBy(F.coalesce(F.col(order), F.lit(0)).desc(), F.col(name)).limit(limit)


def league_teams(matches: DataFrame) -> DataFrame:
    """league_id, team_id, name of the teams on either side; the first match that has a team gives its name, or else its id."""
    side = lambda s, n: matches.select("league_id", F.col(f"{s}_team_id").alias("team_id"), F.col(f"{s}_name").alias("name"), F.struct("pos", F.lit(n)).alias("at"))
    both = side("radiant", 0).union(side("dire", 1)).filter(F.coalesce("team_id", F.lit(0)) != 0)
    first = both.groupBy("league_id", "team_id").agg(F.min_by(F.struct("name"), "at").alias("f"))
    return first.select("league_id", "team_id", S.filled(F.col("f.name"), F.col("team_id").cast("string")).alias("name"))


def league_span(matches: DataFrame) -> DataFrame:
    start = F.coalesce("start_time", F.lit(0).cast("long"))
    return matches.groupBy("league_id").agg(F.count("*").alias("matches"), F.min(start).alias("earliest"), F.max(start).alias("latest"))


def history(team_matches: DataFrame, since: int, limit: int | None = None) -> DataFrame:
    """Matches of each team from `since` on (a null start is 0), the newest `limit` of each. Rank filters run before the shuffle (Spark's
    group limit), so a team's rows are cut on the way."""
    rows = team_matches.filter(F.coalesce("start_time", F.lit(0)) >= since)
    if limit is None:
        return rows
    newest = Window.partitionBy("team_id").orderBy(F.col("start_time").desc(), F.col("match_id").desc())
    return rows.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= limit).drop("rank")
