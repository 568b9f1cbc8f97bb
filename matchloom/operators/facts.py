"""Fact tables from landed matches, and analyses of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources import landing, schemas
from .asof import asof

MATCH_COLUMNS = {
    "id": "match_id", "gameVersionId": "version_id", "startDateTime": "start_time", "durationSeconds": "duration_s", "didRadiantWin": "radiant_win",
    "lobbyType": "lobby_type", "gameMode": "game_mode", "rank": "avg_rank", "endDateTime": "end_time", "leagueId": "league_id", "seriesId": "series_id",
    "radiantTeamId": "radiant_team_id", "direTeamId": "dire_team_id", "firstBloodTime": "first_blood_time_s",
    "towerStatusRadiant": "tower_status_radiant", "towerStatusDire": "tower_status_dire",
}
PLAYER_COLUMNS = {
    "steamAccountId": "account_id", "heroId": "hero_id", "isRadiant": "is_radiant", "isVictory": "is_victory", "lane": "lane", "role": "role",
    "position": "position", "networth": "networth", "level": "level", "kills": "kills", "deaths": "deaths", "assists": "assists",
    "numLastHits": "last_hits", "numDenies": "denies", "goldPerMinute": "gpm", "experiencePerMinute": "xpm", "heroDamage": "hero_damage",
    "towerDamage": "tower_damage", "heroHealing": "hero_healing", "imp": "imp", "award": "award",
}
FANTASY = ("match_id", "hero_id", "account_id", "is_parsed", "kills", "deaths", "last_hits", "denies", "gpm", "camps_stacked", "runes_taken", "obs_wards_killed")
_EVENT_PLAYER = ("heroId", "isRadiant", "isVictory")


def each(rows: DataFrame, items: Column | str, name: str) -> DataFrame:
    """One row per element of a list, as explode gives them: none for a null or empty list. Spark puts a filter on the size of what explode takes below
    it, so that a list that is made on the way would be made twice; the outer form has no such filter."""
    return rows.select("*", F.posexplode_outer(items).alias("__at", name)).filter("__at is not null").drop("__at")


def with_players(raw: DataFrame) -> DataFrame:
    """One row per match and player, `p`; a match without players has none."""
    return each(raw, "players", "p").drop("players")


def player_columns() -> dict[str, Column]:
    """Columns of the players' fact by name, over rows of with_players."""
    stats = F.col("p.stats")
    return {
        **{n: F.col(c) for c, n in MATCH_COLUMNS.items()},
        "is_parsed": F.col("parsedDateTime").isNotNull(),
        **{n: F.col(f"p.{c}") for c, n in PLAYER_COLUMNS.items()},
        "camps_stacked": S.last_element(stats["campStack"]),
        "runes_taken": S.length(stats["runes"]),
        "obs_wards_killed": S.count_where(stats["wardDestruction"], lambda x: x["isWard"]),
        "kill_events": S.length(stats["killEvents"]),
        "inventory": F.array(*[F.col(f"p.{c}") for c in schemas.ITEM_SLOTS]),
        "backpack": F.array(*[F.col(f"p.{c}") for c in schemas.BACKPACK_SLOTS]),
        "neutral_item": F.col("p.neutral0Id"),
        "patch": F.col("patch"),
    }


def players(raw: DataFrame, patches: DataFrame, *columns: str) -> DataFrame:
    """The players' fact, or the given columns of it only; raw needs no other fields than theirs."""
    found = player_columns()
    return with_players(asof(raw, patches)).select(*[found[c].alias(c) for c in columns or found])


def _events(raw: DataFrame, patches: DataFrame, field: str, columns: dict[str, str], player: tuple = _EVENT_PLAYER) -> DataFrame:
    rows = each(with_players(asof(raw, patches)), f"p.stats.{field}", "e")
    return rows.select(
        F.col("id").alias("match_id"), *[F.col(f"p.{c}").alias(PLAYER_COLUMNS[c]) for c in player],
        *[F.col(f"e.{c}").alias(n) for c, n in columns.items()], "patch",
    )


def purchases(raw: DataFrame, patches: DataFrame) -> DataFrame:
    """One row per purchase; none for players whose list is null or empty."""
    return _events(raw, patches, "itemPurchases", {"itemId": "item_id", "time": "purchase_time_s"})


def kill_events(raw: DataFrame, patches: DataFrame) -> DataFrame:
    return _events(raw, patches, "killEvents", {"time": "kill_time_s"})


def hero_winrate(facts: DataFrame) -> DataFrame:
    return facts.groupBy("patch", "hero_id").agg(F.count("*").alias("n"), F.avg(F.col("is_victory").cast("int")).alias("win_rate"))


def with_player(events: DataFrame, facts: DataFrame, *columns: str) -> DataFrame:
    """Events with columns of their player, by match, hero and patch."""
    keys = ["match_id", "hero_id", "patch"]
    return events.join(facts.select(*keys, *columns), keys)


def purchases_with_player(raw: DataFrame, patches: DataFrame, *fields: str) -> DataFrame:
    """Purchases with fields of the players of their match and hero, as with_player gives them, but looked up within the match before it is
    taken apart, so that nothing is shuffled."""
    rows = with_players(asof(raw, patches).withColumn("others", F.col("players")))
    rows = each(each(rows, F.filter("others", lambda q: q["heroId"] == F.col("p.heroId")), "q"), "p.stats.itemPurchases", "e")
    return rows.select(
        F.col("id").alias("match_id"), F.col("p.heroId").alias("hero_id"), F.col("e.itemId").alias("item_id"), F.col("e.time").alias("purchase_time_s"),
        *[F.col(f"q.{c}").alias(PLAYER_COLUMNS[c]) for c in fields], "patch",
    )


def _purchased(players, own: Column | None = None) -> Column:
    """Ids of the items that players (of one hero only, if `own` is given) bought, as a list."""
    kept = F.filter(players, lambda q: q["stats"]["itemPurchases"].isNotNull() & (F.lit(True) if own is None else q["heroId"] == own))
    return F.flatten(F.transform(kept, lambda q: q["stats"]["itemPurchases"]["itemId"]))


def held_and_bought(raw: DataFrame, patches: DataFrame) -> DataFrame:
    """One row per filled slot of parsed matches: match_id, hero_id, patch, item_id, and whether the match logs a purchase of the item by the hero. Nothing is
    shuffled, as a match's purchases are looked up before it is taken apart."""
    rows = with_players(asof(raw, patches).filter("parsedDateTime is not null").withColumn("others", F.col("players")))
    slots = F.array(*[F.col(f"p.{c}") for c in (*schemas.ITEM_SLOTS, *schemas.BACKPACK_SLOTS)])
    rows = rows.select(F.col("id").alias("match_id"), F.col("p.heroId").alias("hero_id"), "patch", slots.alias("held"), _purchased("others", F.col("p.heroId")).alias("bought"))
    rows = each(rows, "held", "item_id").filter("item_id is not null").drop("held")
    return rows.withColumn("logged", F.coalesce(F.array_contains("bought", F.col("item_id")), F.lit(False))).drop("bought")


def bought_items(raw: DataFrame, patches: DataFrame) -> DataFrame:
    """One row per match and item bought in it: match_id, patch, item_id."""
    rows = asof(raw, patches).select(F.col("id").alias("match_id"), "patch", F.array_distinct(_purchased("players")).alias("items"))
    return each(rows, "items", "item_id").drop("items")


def held_items(facts: DataFrame) -> DataFrame:
    """One row per filled slot of inventory and backpack."""
    held = each(facts, F.concat("inventory", "backpack"), "item_id").filter("item_id is not null")
    return held.select("match_id", "hero_id", "patch", "is_parsed", "item_id")


def fantasy_inputs(facts: DataFrame) -> DataFrame:
    """Per player; null where a match was not parsed."""
    return facts.select(*FANTASY)


def purchase_class(items: DataFrame) -> Column:
    """Of a row joined with items_meta; the first that applies."""
    built = F.size("built_into") > 0
    return (
        F.when(F.col("is_consumable"), "consumable").when(F.col("is_recipe"), "recipe").when(built, "component")
        .when((F.size("components") > 0) & ~built, "terminal").otherwise("other")
    )


def classified(events: DataFrame, meta: DataFrame) -> DataFrame:
    cut = meta.select("item_id", "is_consumable", "is_recipe", "components", "built_into")
    return events.join(cut, "item_id").withColumn("item_class", purchase_class(cut))


def class_counts(events: DataFrame, meta: DataFrame) -> DataFrame:
    """Purchases per class of item, counted by item before they meet the items."""
    rows = classified(events.groupBy("item_id").agg(F.count("*").alias("n")), meta)
    return rows.groupBy("item_class").agg(F.sum("n").alias("n"))


def timeline(events: DataFrame, time: str = "purchase_time_s") -> DataFrame:
    """Per minute from the horn; what comes before it is one bucket, -1."""
    minute = F.when(F.col(time) < 0, F.lit(-1).cast("long")).otherwise(F.floor(F.col(time) / 60))
    return events.groupBy(minute.alias("minute")).agg(F.count("*").alias("n"))


def item_availability(events: DataFrame, distinct: bool = False) -> DataFrame:
    """Matches per patch and item; a pair without matches is 0 where the item occurs in any patch. distinct: events are one for each match and item."""
    n = F.count("match_id") if distinct else F.countDistinct("match_id")
    seen = events.groupBy("patch", "item_id").agg(n.alias("matches"))
    path, kind = landing.shared_path(seen.sparkSession, "availability"), seen.schema  # else counted once for each side of the grid
    seen.write.parquet(path)
    seen = seen.sparkSession.read.schema(kind).parquet(path)
    grid = seen.select("patch").distinct().crossJoin(seen.select("item_id").distinct())  # two dimensions: releases and items
    return grid.join(seen, ["patch", "item_id"], "left").withColumn("matches", F.coalesce("matches", F.lit(0).cast("long")))
