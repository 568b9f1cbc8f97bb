"""The engine's tables derived from the driver tables, by expressions that are the same in Spark and in DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: name, first day.
PATCHES = [("1.0", "1995-03-01"), ("1.1", "1996-01-10"), ("1.1b", "1996-09-01"), ("1.20", "1997-06-15"), ("1.3", "1998-04-01"), ("2.0", "1999-02-01"), ("2.0a", "2000-05-01")]
#: id, name, first day on which matches carry it; 180 is a week late, and 182 stays.
VERSIONS = [(176, "0.9", "1970-01-01"), (177, "1.0", "1995-03-01"), (178, "1.1", "1996-01-10"), (179, "1.1b", "1996-09-01"), (180, "1.20", "1997-06-22"), (181, "1.3", "1998-04-01"), (182, "2.0", "1999-02-01")]
NOW = 1706659200  # 2024-01-31


def seconds(day: str) -> int:
    import datetime

    return int(datetime.datetime.fromisoformat(day).replace(tzinfo=datetime.timezone.utc).timestamp())


_VERSION_CASE = "CASE " + " ".join(f"WHEN {{start}} >= {seconds(d)} THEN {i}" for i, _, d in reversed(VERSIONS[1:])) + " ELSE 176 END"
MATCH = {
    "id": "o_orderkey", "didRadiantWin": "o_orderkey % 2 = 0", "durationSeconds": "1200 + o_orderkey % 2400", "startDateTime": "start",
    "endDateTime": "start + 1200 + o_orderkey % 2400", "gameVersionId": f"CAST({_VERSION_CASE.format(start='start')} AS BIGINT)", "lobbyType": "o_orderpriority",
    "gameMode": "o_orderstatus", "rank": "o_custkey % 80",
    "parsedDateTime": "CASE WHEN o_orderkey % 20 <> 0 THEN start + 1800 + o_orderkey % 2400 END",
    "leagueId": "CASE WHEN o_orderstatus = 'P' THEN o_custkey % 25 END", "seriesId": "CAST(NULL AS BIGINT)",
    "radiantTeamId": "CASE WHEN o_orderstatus = 'P' THEN o_custkey % 100 END", "direTeamId": "CASE WHEN o_orderstatus = 'P' THEN o_custkey * 7 % 100 END",
    "firstBloodTime": "o_orderkey % 300", "towerStatusRadiant": "o_orderkey % 2048", "towerStatusDire": "o_custkey % 2048",
}
PLAYER = {
    "steamAccountId": "l_suppkey", "heroId": "l_partkey % 150 + 1", "isRadiant": "l_linenumber <= 3", "isVictory": "(l_linenumber <= 3) = (o_orderkey % 2 = 0)",
    "lane": "l_returnflag", "role": "l_linestatus", "position": "CASE WHEN l_linenumber <= 5 THEN concat('POSITION_', CAST(l_linenumber AS STRING)) END",
    "networth": "CAST(floor(l_extendedprice) AS BIGINT)", "level": "CAST(l_linenumber + 10 AS BIGINT)", "kills": "l_partkey % 20", "deaths": "l_suppkey % 15",
    "assists": "(l_partkey + l_suppkey) % 25", "numLastHits": "l_partkey % 300", "numDenies": "l_partkey % 30", "goldPerMinute": "300 + l_partkey % 400",
    "experiencePerMinute": "250 + l_suppkey % 500", "heroDamage": "l_partkey * 7 % 30000", "towerDamage": "l_partkey * 3 % 10000", "heroHealing": "l_suppkey * 11 % 5000",
    "imp": "l_partkey % 100 - 50", "award": "CASE WHEN l_returnflag = 'A' THEN 'MVP' END",
    **{f"item{k}Id": f"(l_partkey + {k}) % 2000" for k in range(5)}, "item5Id": "CASE WHEN l_linenumber <> 7 THEN (l_partkey + 5) % 2000 END",
    **{f"backpack{k}Id": f"(l_partkey + {100 + k}) % 2000" for k in range(3)}, "neutral0Id": "(l_partkey + 200) % 2000",
}
_ENTRIES = "transform(sequence(0, l_linenumber - 1), k -> {})"


def _entries(entry: str) -> str:
    """Entries that depend on their places k alone: the first of a fixed list, where it is long enough, instead of being made for every player."""
    fixed = "array(" + ", ".join(re.sub(r"\bk\b", str(k), entry) for k in range(8)) + ")"
    return f"CASE WHEN l_linenumber BETWEEN 1 AND 8 THEN slice({fixed}, 1, l_linenumber) ELSE {_ENTRIES.format(entry)} END"


def _sparse(entry: str) -> str:
    return f"CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 13 = 1 THEN array() ELSE {_entries(entry)} END"


_STATS = {
    "itemPurchases": _ENTRIES.format("named_struct('itemId', (l_partkey + 7 * k) % 2000, 'time', CAST(90 * k - 79 AS BIGINT))"),
    "campStack": f"CASE WHEN l_partkey % 11 = 0 THEN array() ELSE {_entries('CAST(k AS BIGINT)')} END",
    "runes": _sparse("named_struct('rune', concat('r', CAST(k AS STRING)), 'time', CAST(120 * k AS BIGINT))"),
    "wardDestruction": _sparse("named_struct('time', CAST(60 * k AS BIGINT), 'isWard', CASE WHEN k % 3 = 0 THEN NULL ELSE k % 3 = 1 END)"),
    "killEvents": _sparse("named_struct('time', CAST(100 * k - 150 AS BIGINT))"),
}
START = "unix_seconds(CAST(o_orderdate AS TIMESTAMP))"
SUMMARY = {
    "match_id": "event_id", "start_time": "start", "avg_rank_tier": "CASE WHEN user_id % 10 <> 0 THEN 10 * (1 + user_id % 8) + 1 + event_id % 5 END",
    "lobby_type": "CAST(CASE WHEN event_type IN ('view', 'click') THEN 7 ELSE 0 END AS BIGINT)", "game_mode": "user_id % 3",
    "source": "CASE WHEN event_type = 'signup' THEN 'pro' ELSE 'public' END", "label": "concat('w', CAST(user_id % 4 AS STRING))",
    "page": "CAST(floor(event_id / 100) AS BIGINT)",
}
LEDGER_EXTRA = {
    "status": "CASE WHEN event_id % 7 <= 3 THEN 'discovered' WHEN event_id % 7 = 4 THEN 'fetched' WHEN event_id % 7 = 5 THEN 'missing' ELSE 'failed' END",
    "attempts": "event_id % 4", "raw_file": "CASE WHEN event_id % 7 = 4 THEN 'part-0.jsonl.gz' END",
    "last_error": "CASE WHEN event_id % 7 = 6 THEN concat('e', CAST(event_id % 3 AS STRING)) END", "discovered_at": f"CAST({NOW} AS BIGINT)",
}
ITEM = {
    "short_name": "{name}", "id": "CASE WHEN p_partkey % 50 <> 7 THEN p_partkey END", "dname": "CASE WHEN p_partkey % 9 = 0 THEN '' WHEN p_partkey % 9 <> 1 THEN p_name END",
    "cost": "CASE WHEN p_partkey % 17 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(floor(p_retailprice) AS BIGINT) END",
    "qual": "CASE WHEN p_size < 5 THEN 'consumable' WHEN p_size < 30 THEN 'common' END", "tier": "CASE WHEN p_size > 40 THEN CAST(p_size % 5 AS BIGINT) END",
}


def item_name(key: str) -> str:
    return f"concat(CASE WHEN {key} % 10 = 3 THEN 'recipe_' ELSE '' END, 'item_', CAST({key} AS STRING))"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _exprs(fields: dict[str, str]) -> list:
    return [F.expr(e).alias(n) for n, e in fields.items()]


def raw(spark: SparkSession, sf: str, match: tuple | None = None, player: tuple | None = None, stats: tuple | None = None, by_id: bool = False, by_line: bool = False) -> DataFrame:
    """Nested matches: one per order that has lines. match, player, stats: the fields to make at either level (None: all; id always; no stats for an empty
    tuple). Only the lines' own columns are shuffled; records are made after that. by_id: each partition ascends by id, by a sort before records are made. by_line: a player
    is made of a line by itself, which Spark compiles, and players are put together after that; to be written within landing.in_order, or tasks sort whole players."""
    wanted = lambda have, want: have if want is None else {k: have[k] for k in have if k in want}
    match_fields = {"id": MATCH["id"]} | wanted(MATCH, match)
    inner, lists = wanted(PLAYER, player), wanted(_STATS, stats)
    used = set(re.findall(r"\bl_\w+", " ".join([*inner.values(), *lists.values()]))) | {"l_linenumber"}
    lines = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders").withColumn("start", F.expr(START))
    of = lambda fields: ", ".join(f"'{n}', {e}" for n, e in fields.items())
    if lists:
        inner = inner | {"stats": f"CASE WHEN o_orderkey % 20 <> 0 THEN named_struct({of(lists)}) END"}
    record = f"named_struct({of(inner)})"
    if by_line:
        players, record = "players", re.sub(r"\bo_orderkey\b", "l_orderkey", record)  # all that a player takes from its order
        lines = lines.select("l_orderkey", *sorted(used - {"l_orderkey"})).repartition("l_orderkey").sortWithinPartitions("l_orderkey")
        lines = lines.select("l_orderkey", F.expr(record).alias("player")).groupBy("l_orderkey").agg(F.collect_list("player").alias("players"))
    else:
        players, record = "transform(lines, x -> {})", re.sub(r"\bl_", "x.l_", record)
        lines = lines.select("l_orderkey", F.struct(*sorted(used)).alias("line")).groupBy("l_orderkey").agg(F.collect_list("line").alias("lines"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    joined = joined.sortWithinPartitions("l_orderkey") if by_id else joined
    return joined.select(*_exprs(match_fields), F.expr(players.format(record)).alias("players"))


def matches(spark: SparkSession, sf: str) -> DataFrame:
    """The matches without their players."""
    orders = table(spark, sf, "orders").withColumn("start", F.expr(START))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return orders.join(lines, "o_orderkey", "left_semi").select(*_exprs(MATCH))


def patches(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, seconds(d), "override") for n, d in PATCHES], "name string, start_ts bigint, source string")


def versions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, n, seconds(d)) for i, n, d in VERSIONS], "id bigint, name string, asOfDateTime bigint")


def summaries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("start", F.expr("unix_seconds(CAST(ts AS TIMESTAMP))")).select(*_exprs(SUMMARY))


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("start", F.expr("unix_seconds(CAST(ts AS TIMESTAMP))"))
    fields = {k: v for k, v in SUMMARY.items() if k != "page"} | LEDGER_EXTRA
    names = ["match_id", "source", "label", "start_time", "avg_rank_tier", "lobby_type", "game_mode", "status", "attempts", "raw_file", "last_error", "discovered_at"]
    return events.select(*_exprs({n: fields[n] for n in names}))


def constants(spark: SparkSession, sf: str) -> DataFrame:
    """Items with the short names of their components."""
    fields = ITEM | {"short_name": item_name("p_partkey")}
    of = lambda n: item_name(f"CAST(floor(p_partkey / {n}) AS BIGINT)")
    parts = F.expr(f"CASE WHEN p_partkey % 4 = 0 THEN array({of(2)}, {of(3)}) END")
    return table(spark, sf, "part").select(*_exprs(fields), parts.alias("components"))


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").filter("p_partkey % 40 <> 1").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("displayName"))
    return rows.union(spark.range(5000, 5010).select("id", F.concat(F.lit("new "), F.col("id").cast("string"))))


def league_matches(spark: SparkSession, sf: str) -> DataFrame:
    rows = matches(spark, sf).filter("leagueId IS NOT NULL")
    name = lambda c: F.expr(f"CASE WHEN {c} % 7 = 0 THEN '' WHEN {c} % 7 <> 1 THEN concat('team ', CAST({c} AS STRING), '-', CAST(id % 2 AS STRING)) END")
    return rows.select(
        F.col("id").alias("match_id"), F.col("leagueId").alias("league_id"), F.col("startDateTime").alias("start_time"), F.col("radiantTeamId").alias("radiant_team_id"),
        F.col("direTeamId").alias("dire_team_id"), name("radiantTeamId").alias("radiant_name"), name("direTeamId").alias("dire_name"), F.col("id").alias("pos"),
    )


def team_matches(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """A row for each team of a match. Orders and lines are joined once: a match gives both its teams, or its one. rows: the league matches, if they are made already."""
    teams = F.array_distinct(F.array("radiant_team_id", "dire_team_id"))
    rows = league_matches(spark, sf) if rows is None else rows
    return rows.select(F.explode(teams).alias("team_id"), "match_id", "start_time").distinct()


#: The same tables for DuckDB.
_DUCK_EPOCH = "CAST(floor(epoch({})) AS BIGINT)"


def _duck(fields: dict[str, str]) -> str:
    return ", ".join(f'{e} AS "{n}"' for n, e in fields.items())


CTES = {
    "m": f"m AS (SELECT {_duck(MATCH)} FROM (SELECT *, {_DUCK_EPOCH.format('o_orderdate')} AS start FROM orders) WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))",
    "patches": "patches(name, start_ts) AS (VALUES " + ", ".join(f"('{n}', CAST({seconds(d)} AS BIGINT))" for n, d in PATCHES) + ")",
    "versions": "versions(id, name, asOfDateTime) AS (VALUES " + ", ".join(f"(CAST({i} AS BIGINT), '{n}', CAST({seconds(d)} AS BIGINT))" for i, n, d in VERSIONS) + ")",
    "mp": "mp AS (SELECT m.*, pt.name AS patch FROM m ASOF JOIN patches pt ON m.startDateTime >= pt.start_ts)",
    "pl": f"pl AS (SELECT mp.*, {_duck(PLAYER)}, l_linenumber, l_partkey FROM mp JOIN lineitem ON mp.id = l_orderkey JOIN orders ON o_orderkey = l_orderkey)",
    "players": 'players AS (SELECT id AS match_id, "gameVersionId" AS version_id, "startDateTime" AS start_time, "durationSeconds" AS duration_s, "didRadiantWin" AS radiant_win, '
    '"lobbyType" AS lobby_type, "gameMode" AS game_mode, rank AS avg_rank, "endDateTime" AS end_time, "leagueId" AS league_id, "seriesId" AS series_id, '
    '"radiantTeamId" AS radiant_team_id, "direTeamId" AS dire_team_id, "firstBloodTime" AS first_blood_time_s, "towerStatusRadiant" AS tower_status_radiant, '
    '"towerStatusDire" AS tower_status_dire, "parsedDateTime" IS NOT NULL AS is_parsed, "steamAccountId" AS account_id, "heroId" AS hero_id, "isRadiant" AS is_radiant, '
    '"isVictory" AS is_victory, lane, role, position, networth, level, kills, deaths, assists, "numLastHits" AS last_hits, "numDenies" AS denies, "goldPerMinute" AS gpm, '
    '"experiencePerMinute" AS xpm, "heroDamage" AS hero_damage, "towerDamage" AS tower_damage, "heroHealing" AS hero_healing, imp, award, '
    'CASE WHEN "parsedDateTime" IS NOT NULL AND l_partkey % 11 <> 0 THEN CAST(l_linenumber - 1 AS BIGINT) END AS camps_stacked, '
    + ", ".join(
        f'CASE WHEN "parsedDateTime" IS NULL OR l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 13 = 1 THEN 0 ELSE {e} END AS {n}'
        for n, e in (("runes_taken", "CAST(l_linenumber AS BIGINT)"), ("obs_wards_killed", "CAST((l_linenumber + 1) // 3 AS BIGINT)"), ("kill_events", "CAST(l_linenumber AS BIGINT)"))
    )
    + ", "
    + ", ".join(f'"{s}" AS {n}' for s, n in [*((f"item{k}Id", f"slot{k}") for k in range(6)), *((f"backpack{k}Id", f"pack{k}") for k in range(3))])
    + ', "neutral0Id" AS neutral_item, patch FROM pl)',
    "purchases": 'purchases AS (SELECT id AS match_id, "heroId" AS hero_id, "isRadiant" AS is_radiant, "isVictory" AS is_victory, (l_partkey + 7 * k) % 2000 AS item_id, '
    'CAST(90 * k - 79 AS BIGINT) AS purchase_time_s, patch FROM (SELECT *, unnest(range(l_linenumber)) AS k FROM pl WHERE "parsedDateTime" IS NOT NULL))',
    "kills": 'kills AS (SELECT id AS match_id, "heroId" AS hero_id, "isRadiant" AS is_radiant, "isVictory" AS is_victory, CAST(100 * k - 150 AS BIGINT) AS kill_time_s, patch '
    'FROM (SELECT *, unnest(range(l_linenumber)) AS k FROM pl WHERE "parsedDateTime" IS NOT NULL AND l_partkey % 13 > 1))',
    "summaries": f"summaries AS (SELECT {_duck(SUMMARY)} FROM (SELECT *, {_DUCK_EPOCH.format('ts')} AS start FROM events))",
    "ledger": f"ledger AS (SELECT {_duck({k: v for k, v in SUMMARY.items() if k != 'page'} | LEDGER_EXTRA)} FROM (SELECT *, {_DUCK_EPOCH.format('ts')} AS start FROM events))",
    "constants": f"constants AS (SELECT {_duck(ITEM | {'short_name': item_name('p_partkey')})}, p_partkey FROM part)",
    "edges": "edges AS (SELECT c.id AS item_id, e.pos, d.id AS component_id FROM (SELECT id, unnest([0, 1]) AS pos, unnest(["
    + ", ".join(item_name(f"p_partkey // {n}") for n in (2, 3))
    + "]) AS component FROM constants WHERE p_partkey % 4 = 0 AND id IS NOT NULL) e JOIN constants c ON c.id = e.id JOIN constants d ON d.short_name = e.component WHERE d.id IS NOT NULL)",
    "meta": "meta AS (SELECT c.id AS item_id, short_name, COALESCE(NULLIF(dname, ''), short_name) AS display_name, cost, qual AS quality, starts_with(short_name, 'recipe_') AS is_recipe, "
    "COALESCE(qual = 'consumable', FALSE) AS is_consumable, tier, COALESCE((SELECT string_agg(component_id, ',' ORDER BY pos) FROM edges WHERE item_id = c.id), '') AS components, "
    "COALESCE((SELECT string_agg(item_id, ',' ORDER BY item_id) FROM edges WHERE component_id = c.id), '') AS built_into FROM constants c WHERE c.id IS NOT NULL)",
    "catalogue": "catalogue AS (SELECT p_partkey AS id, p_name AS \"displayName\" FROM part WHERE p_partkey % 40 <> 1 UNION ALL SELECT range, concat('new ', range) FROM range(5000, 5010))",
    "lm": 'lm AS (SELECT id AS match_id, "leagueId" AS league_id, "startDateTime" AS start_time, "radiantTeamId" AS radiant_team_id, "direTeamId" AS dire_team_id, '
    + ", ".join(f"CASE WHEN \"{c}\" % 7 = 0 THEN '' WHEN \"{c}\" % 7 <> 1 THEN concat('team ', CAST(\"{c}\" AS STRING), '-', CAST(id % 2 AS STRING)) END AS {n}" for c, n in (("radiantTeamId", "radiant_name"), ("direTeamId", "dire_name")))
    + ' FROM m WHERE "leagueId" IS NOT NULL)',
    "tm": "tm AS (SELECT radiant_team_id AS team_id, match_id, start_time FROM lm UNION SELECT dire_team_id, match_id, start_time FROM lm)",
}
_NEEDS = {"mp": ["m", "patches"], "pl": ["mp"], "players": ["pl"], "purchases": ["pl"], "kills": ["pl"], "edges": ["constants"], "meta": ["edges"], "lm": ["m"], "tm": ["lm"]}


def sql(query: str, *names: str) -> str:
    """query with the CTEs that it names, and those that they need."""
    out: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, []):
            add(n)
        if name not in out:
            out.append(name)

    for name in names:
        add(name)
    return ("WITH " + ", ".join(CTES[n] for n in out) + " " if out else "") + query
