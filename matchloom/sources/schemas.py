"""Pinned schemas of landed matches, dimensions and the ledger, as DDL."""

from __future__ import annotations

from pyspark.sql import types as T


STATS = (
    "struct<itemPurchases:array<struct<itemId:bigint,time:bigint>>,campStack:array<bigint>,"
    "runes:array<struct<rune:string,time:bigint>>,wardDestruction:array<struct<time:bigint,isWard:boolean>>,"
    "killEvents:array<struct<time:bigint>>>"
)
_PLAYER_LONGS = ["networth", "level", "kills", "deaths", "assists", "numLastHits", "numDenies", "goldPerMinute", "experiencePerMinute",
                 "heroDamage", "towerDamage", "heroHealing", "imp"]
ITEM_SLOTS = [f"item{k}Id" for k in range(6)]
BACKPACK_SLOTS = [f"backpack{k}Id" for k in range(3)]
PLAYER = (
    "struct<steamAccountId:bigint,heroId:bigint,isRadiant:boolean,isVictory:boolean,lane:string,role:string,position:string,"
    + "".join(f"{c}:bigint," for c in _PLAYER_LONGS)
    + "award:string,"
    + "".join(f"{c}:bigint," for c in [*ITEM_SLOTS, *BACKPACK_SLOTS, "neutral0Id"])
    + f"stats:{STATS}>"
)
#: A landed match. It is never inferred: an absent key is a null, not a missing column.
RAW = (
    "id bigint, didRadiantWin boolean, durationSeconds bigint, startDateTime bigint, endDateTime bigint, gameVersionId bigint,"
    "lobbyType string, gameMode string, rank bigint, parsedDateTime bigint, leagueId bigint, seriesId bigint, radiantTeamId bigint,"
    f"direTeamId bigint, firstBloodTime bigint, towerStatusRadiant bigint, towerStatusDire bigint, players array<{PLAYER}>"
)


def with_player(fields: tuple) -> T.StructType:
    """RAW, with the given fields of players only."""
    whole = T.StructType.fromDDL(RAW)
    players = T.ArrayType(T.StructType([f for f in whole["players"].dataType.elementType.fields if f.name in fields]))
    return T.StructType([T.StructField(f.name, players) if f.name == "players" else f for f in whole.fields])


PATCHES = ("name string, start_ts bigint, source string")
VERSIONS = ("id bigint, name string, asOfDateTime bigint")
ITEMS_META = (
    "item_id bigint, short_name string, display_name string, cost bigint, quality string, is_recipe boolean, is_consumable boolean,"
    "components array<bigint>, tier bigint, built_into array<bigint>"
)
CATALOGUE = ("id bigint, displayName string, shortName string")
ITEM_CONSTANTS = "map<string,struct<id:bigint,dname:string,cost:bigint,qual:string,tier:bigint,components:array<string>>>"
SUMMARIES = ("match_id bigint, start_time bigint, avg_rank_tier bigint, lobby_type bigint, game_mode bigint, source string, label string, page bigint")
OVERRIDES = ("name string, date string")
LEDGER = (
    "match_id bigint, source string, label string, start_time bigint, avg_rank_tier bigint, lobby_type bigint, game_mode bigint,"
    "status string, attempts bigint, raw_file string, last_error string, discovered_at bigint"
)


def field_paths(schema: T.DataType | str, prefix: str = "") -> list[str]:
    """Dotted paths of all fields, inner ones included."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, prefix)
    if not isinstance(schema, T.StructType):
        return []
    out = []
    for f in schema.fields:
        out += [prefix + f.name, *field_paths(f.dataType, f"{prefix}{f.name}.")]
    return out
