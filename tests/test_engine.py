"""Behaviour that SQL does not show: files, errors, ties, nulls and plans."""

import gzip

import pytest
from pyspark.sql import functions as F

from matchloom.functions import scalars as S
from matchloom.operators import asof, dims, facts, frame, ledger, quality
from matchloom.sources import landing, schemas

PATCHES = "name string, start_ts bigint"


def test_asof_bounds_ties_and_nulls(spark):
    patches = spark.createDataFrame([("b", 200), ("a", 100), ("c", 200), ("d", 90_000)], PATCHES)
    rows = spark.createDataFrame([(t,) for t in (None, 99, 100, 199, 200, 89_999, 90_000, 10_000_000_000)], "startDateTime bigint")
    got = {r["startDateTime"]: r["patch"] for r in asof.asof(rows, patches).collect()}
    assert got == {100: "a", 199: "a", 200: "c", 89_999: "c", 90_000: "d", 10_000_000_000: "d"}
    assert asof.asof(rows, patches.limit(0)).columns == ["startDateTime", "patch"]
    plan = asof.asof(rows, patches)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_nearest_takes_the_lower_id_of_two(spark):
    rows = spark.createDataFrame([(7, 10), (3, 30), (5, None)], "id bigint, t bigint")
    got = asof.nearest(spark.createDataFrame([(20,), (28,)], "target bigint"), rows, "target", "t", "id").collect()
    assert {r["target"]: (r["id"], r["distance"]) for r in got} == {20: (3, 10), 28: (3, 2)}


def test_nearest_against_all_pairs(spark):
    import random

    rnd = random.Random(2)
    for span, n, m in ((100, 40, 25), (10_000_000, 60, 40), (86_400 * 3, 5, 60), (10_000_000, 200, 1)):
        rows = [(rnd.choice([1, -1]) * i, rnd.randrange(span)) for i in range(n)]
        targets = [(rnd.randrange(-span // 2, span * 2), "x") for _ in range(m)] + [(None, "y")]
        got = asof.nearest(spark.createDataFrame(targets, "target bigint, note string"), spark.createDataFrame(rows, "id bigint, t bigint"), "target", "t", "id").collect()
        want = [(t, note, *min((abs(x - t), i) for i, x in rows)[::-1]) for t, note in targets if t is not None]
        assert sorted((r["target"], r["note"], r["id"], r["distance"]) for r in got) == sorted(want)
    none = spark.createDataFrame([], "id bigint, t bigint")
    assert asof.nearest(spark.createDataFrame([(1,)], "target bigint"), none, "target", "t", "id").count() == 0
    assert asof.nearest(spark.createDataFrame([], "target bigint"), none, "target", "t", "id").count() == 0
    plan = asof.nearest(spark.createDataFrame([(1,), (5,)], "target bigint"), spark.createDataFrame([(1, 2)], "id bigint, t bigint"), "target", "t", "id")
    assert "NestedLoop" not in plan._jdf.queryExecution().executedPlan().toString()


def raw(spark, *matches):
    import json

    return spark.read.schema(schemas.RAW).option("mode", "FAILFAST").json(spark.sparkContext.parallelize([json.dumps(m) for m in matches]))


def test_null_lists_are_not_empty_lists(spark):
    stats = {"campStack": [0, 1, 4], "runes": [], "wardDestruction": [{"time": 1, "isWard": True}, {"time": 2, "isWard": None}, {"time": 3, "isWard": False}], "killEvents": [{"time": -5}]}
    df = raw(
        spark,
        {"id": 1, "startDateTime": 5, "parsedDateTime": 9, "players": [{"heroId": 1, "stats": stats}, {"heroId": 2, "stats": {"campStack": []}}, {"heroId": 3}]},
        {"id": 2, "startDateTime": 5, "players": []},
        {"id": 3, "startDateTime": 5},
    )
    patches = spark.createDataFrame([("7.40", 0)], PATCHES)
    got = {r["hero_id"]: r for r in facts.players(df, patches).collect()}
    names = ["camps_stacked", "runes_taken", "obs_wards_killed", "kill_events"]
    assert [got[1][n] for n in names] == [4, 0, 1, 1]
    assert [got[2][n] for n in names] == [got[3][n] for n in names] == [None] * 4
    assert set(got) == {1, 2, 3} and len(facts.players(df, patches).columns) == 46
    assert [r["kill_time_s"] for r in facts.kill_events(df, patches).collect()] == [-5]


def test_wrong_type_fails_the_scan(spark):
    with pytest.raises(Exception, match="(?i)malformed|cannot parse|fail"):
        raw(spark, {"id": "x"}).collect()


def test_shard_health(spark, tmp_path):
    whole = gzip.compress(b'{"id": 1}\n' * 5000)
    for name, data in (("good", whole), ("cut", whole[: len(whole) // 2]), ("plain", b'{"id": 1}\n'), ("zero", b"")):
        (tmp_path / f"{name}.jsonl.gz").write_bytes(data)
    got = {r["file"].rsplit("/", 1)[1].split(".")[0]: r for r in landing.shard_health(spark, str(tmp_path)).collect()}
    assert {n for n, r in got.items() if r["ok"]} == {"good"} and got["plain"]["reason"] == "not gzip" and "EOF" in got["cut"]["reason"]
    summary = landing.landing_summary(spark, str(tmp_path)).first()
    assert summary["shards"] == 4 and summary["bytes"] > len(whole)


def test_a_damaged_shard_costs_its_own_rows_only(spark, tmp_path):
    import json

    line = lambda i: (json.dumps({"id": i, "startDateTime": 5, "players": [{"heroId": i}]}) + "\n").encode()
    whole = gzip.compress(b"".join(map(line, range(1000, 1900))))
    (tmp_path / "deep").mkdir()
    for name, data in (("good", gzip.compress(line(1) + line(2))), ("deep/good", gzip.compress(line(3))), ("cut", whole[: len(whole) // 2]), ("plain", line(9)), ("zero", b"")):
        (tmp_path / f"{name}.jsonl.gz").write_bytes(data)
    rows = landing.scan_healthy(spark, str(tmp_path))
    patches = spark.createDataFrame([("7.40", 0)], PATCHES)
    assert sorted(r["hero_id"] for r in facts.players(rows, patches).collect()) == [1, 2, 3]
    (tmp_path / "none").mkdir()
    (tmp_path / "none/bad.gz").write_bytes(b"x")
    assert landing.scan_healthy(spark, str(tmp_path / "none")).count() == 0


def test_writers_compute_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda i: (seen.add(1), i)[1], "bigint").asNondeterministic()
    rows = spark.range(50).select(counted("id").alias("id"))
    assert landing.write_landing(rows, str(tmp_path / "raw")) and seen.value == 50
    assert landing.write_landing(rows, str(tmp_path / "raw")) and spark.read.json(str(tmp_path / "raw")).count() == 100
    assert landing.write_dimension(rows, str(tmp_path / "dim")) and seen.value == 150
    assert landing.write_dimension(rows.limit(3), str(tmp_path / "dim")) and spark.read.parquet(str(tmp_path / "dim")).count() == 3
    assert not landing.write_dimension(rows.limit(0), str(tmp_path / "dim")) and spark.read.parquet(str(tmp_path / "dim")).count() == 3
    assert sorted(p.name for p in tmp_path.iterdir()) == ["dim", "raw"]


class Renames:
    """A file system whose n-th rename says no."""

    def __init__(self, fs, fails):
        self.fs, self.fails, self.n = fs, fails, 0

    def rename(self, old, new):
        self.n += 1
        return False if self.n == self.fails else self.fs.rename(old, new)

    def __getattr__(self, name):
        return getattr(self.fs, name)


def test_publish_survives_a_failing_rename(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "out")
    fact = lambda *p: spark.createDataFrame([(i, x) for i, x in enumerate(p)], "id bigint, patch string")
    read = lambda n: sorted(r["patch"] for r in landing.read_fact(spark, f"{folder}/{n}", "id bigint, patch string").collect())
    landing.publish({"a": fact("7.40"), "b": fact("7.40")}, folder)
    files = landing._files
    for fails in (1, 2, 3, 4):

        def failing(spark, path, fails=fails):
            fs, of = files(spark, path)
            return Renames(fs, fails), of

        monkeypatch.setattr(landing, "_files", failing)
        with pytest.raises(OSError, match="rename"):
            landing.publish({"a": fact("8.0"), "b": fact("8.0")}, folder)
        assert read("a") == ["7.40"] and read("b") == ["7.40"], fails
        assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a", "b"]
    monkeypatch.setattr(landing, "_files", files)
    landing.publish({"a": fact("8.0"), "b": fact("8.0"), "c": fact("8.0")}, folder)
    assert read("a") == read("b") == read("c") == ["8.0"] and len(list((tmp_path / "out").iterdir())) == 3


def test_shared_folder_is_asked_for_on_a_cluster(spark):
    class Conf:
        get = staticmethod(lambda *a: None)

    class Context:
        getCheckpointDir = staticmethod(lambda: None)
        master, applicationId = "spark://host:7077", "app"

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        landing.shared_path(Session, "x")


def test_purchases_with_player_are_those_of_the_join(spark):
    buy = lambda *items: {"itemPurchases": [{"itemId": i, "time": 60 * i} for i in items]}
    df = raw(
        spark,
        {"id": 1, "startDateTime": 5, "players": [{"heroId": 1, "lane": "a", "stats": buy(1, 2, 1)}, {"heroId": 1, "lane": "b", "stats": buy(2)}, {"heroId": None, "lane": "c", "stats": buy(7)}, {"heroId": 3, "lane": "d"}]},
        {"id": 2, "startDateTime": 6, "players": []}, {"id": 3, "startDateTime": 7}, {"id": 4, "startDateTime": 7, "players": [{"heroId": 3, "stats": buy(2, 2)}, {"heroId": 4, "stats": None}]},
    )
    patches = spark.createDataFrame([("7.40", 0)], PATCHES)
    columns = ["match_id", "hero_id", "item_id", "purchase_time_s", "lane", "patch"]
    want = facts.with_player(facts.purchases(df, patches), facts.players(df, patches), "lane").select(*columns).collect()
    got = facts.purchases_with_player(df, patches, "lane").select(*columns).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 10
    items = facts.bought_items(df, patches)
    assert sorted((r["match_id"], r["item_id"]) for r in items.collect()) == [(1, 1), (1, 2), (1, 7), (4, 2)]
    table = lambda x: sorted(map(str, x.collect()))
    held = raw(
        spark,
        {"id": 1, "startDateTime": 5, "parsedDateTime": 9, "players": [{"heroId": 1, "item0Id": 1, "backpack2Id": 1851, "stats": buy(1)}, {"heroId": 1, "item1Id": 2, "item2Id": 5, "stats": buy(2)}, {"heroId": None, "item0Id": 7, "stats": buy(7)}]},
        {"id": 2, "startDateTime": 5, "players": [{"heroId": 1, "item0Id": 1}]}, {"id": 3, "startDateTime": 5, "parsedDateTime": 9, "players": [{"heroId": 2, "item0Id": 1847}]},
    )
    assert table(quality.unlogged_share(facts.held_and_bought(held, patches))) == table(quality.unlogged_rate(facts.players(held, patches), facts.purchases(held, patches)))
    assert table(facts.item_availability(items, distinct=True)) == table(facts.item_availability(facts.purchases(df, patches)))


def test_no_rows_leave_no_files(spark, tmp_path):
    none = spark.createDataFrame([], "id bigint")
    assert not landing.write_landing(none, str(tmp_path / "raw")) and not landing.write_dimension(none, str(tmp_path / "dim"))
    assert list(tmp_path.iterdir()) == []


def test_publish_replaces_all_or_nothing(spark, tmp_path):
    folder = str(tmp_path / "out")
    fact = lambda *p: spark.createDataFrame([(i, x) for i, x in enumerate(p)], "id bigint, patch string")
    landing.publish({"a": fact("7.40", "7.41"), "b": fact("7.40")}, folder)
    with pytest.raises(ValueError, match="no rows"):
        landing.publish({"a": fact("8.0"), "b": fact()}, folder)
    rows = landing.read_fact(spark, f"{folder}/a", "id bigint, patch string")
    assert sorted(r["patch"] for r in rows.collect()) == ["7.40", "7.41"]
    landing.publish({"a": fact("7.41"), "b": fact("7.41")}, folder)
    assert sorted(p.name for p in (tmp_path / "out/a").glob("patch=*")) == ["patch=7.41"]
    assert [p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("_")] == []
    plan = landing.read_fact(spark, f"{folder}/a", "id bigint, patch string").filter("patch = '7.41'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(patch" in plan


def test_iso_dates(spark):
    texts = ["2025-05-03T01:02:03.5Z", "2025-05-03T01:02:03Z", "2025-05-03", "soon", None, ""]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(S.epoch(F.col("t"))).collect()]
    assert got == [1746234123, 1746234123, 1746230400, None, None, None]


def test_walk_selectors(spark):
    df = spark.createDataFrame([("pro", "a"), ("public", "a"), ("x:y", "b"), (None, "a")], "source string, label string")
    assert df.filter(S.in_walks(["pro:a", "x:y:b"])).count() == 2 and df.filter(S.in_walks([" a "])).count() == 3
    for bad in ("", ":a", "a:", " : "):
        with pytest.raises(ValueError):
            S.in_walks([bad])


def test_drop_reason_order(spark):
    kind = "match_id bigint, source string, start_time bigint, avg_rank_tier bigint, lobby_type bigint"
    rules = {"cutoff": 1000, "min_rank": 50, "until": 100, "sample": 0.5, "ranked_only": True}
    rows = [(9999, "public", 1001, None, 0), (9999, "public", 99, None, 0), (9999, "public", 100, None, 0), (1, "public", 1000, 49, 7), (1, "public", 500, None, 7), (1, "public", 500, 50, None),
            (1, "public", None, 50, 7), (1, "public", 0, 50, 7), (1, "pro", 500, None, 0)]
    got = [r[0] for r in spark.createDataFrame(rows, kind).select(frame.drop_reason(**rules)).collect()]
    assert got == ["too new", "below --until", "not sampled", "below --min-rank", "below --min-rank", "not ranked", None, None, None]


def test_split_responses(spark):
    rows = [
        ("a", [10, 11, 12], '{"data":{"m0":{"id":10},"m1":null},"errors":[{"message":"first","path":["m1"]},{"message":"second","path":["m1","x"]},{"message":"gone","path":["m7"]},{"message":"odd","path":["mx"]}]}'),
        ("b", [20, 21], '{"data":null,"errors":[{"message":"' + "e" * 400 + '"},{"message":"late"}]}'),
        ("c", [30], '{"data":{"m0":{"id":30}},"errors":[{"message":"general","path":["query"]}]}'),
        ("d", [40], "{}"),
    ]
    got = {r["match_id"]: r for r in ledger.split_responses(spark.createDataFrame(rows, "batch string, ids array<bigint>, payload string")).collect()}
    assert {i: r["outcome"] for i, r in got.items()} == {10: "found", 11: "failed", 12: "missing", 20: "failed", 21: "failed", 30: "found", 40: "missing"}
    assert got[11]["error"] == "second" and got[20]["error"] == "e" * 300 and got[10]["record"] == '{"id":10}' and got[30]["error"] is None


def test_dead_streak_needs_three_in_a_row(spark):
    rows = [("a", i, f) for i, f in enumerate([0, 0, 1, 0, 0, 0, 0])] + [("b", i, 0) for i in range(2)]
    assert [tuple(r) for r in ledger.dead_streaks(spark.createDataFrame(rows, "run string, seq int, found int")).collect()] == [("a", 5)]


def test_merge_precedence(spark):
    kind = "name string, start_ts bigint, source string, pos bigint"
    low, high = spark.createDataFrame([("x", 1, "low", 0), ("y", 2, "low", 1)], kind), spark.createDataFrame([("x", 5, "high", 0), ("x", 6, "high", 1)], kind)
    assert sorted(tuple(r) for r in dims.merged_patches([low, high]).collect()) == [("x", 6, "high"), ("y", 2, "low")]


def test_not_in_keeps_null_rules(spark):
    a, b = spark.createDataFrame([(1,), (2,), (None,)], "id bigint"), spark.createDataFrame([(1,)], "k bigint")
    assert [r["id"] for r in dims.absent_from(a, b, "id", "k").collect()] == [2]
    assert dims.absent_from(a, b.union(spark.createDataFrame([(None,)], "k bigint")), "id", "k").count() == 0


def test_recipe_graph_keeps_duplicates_and_order(spark):
    kind = "short_name string, id bigint, dname string, cost bigint, qual string, tier bigint, components array<string>"
    rows = [("sword", 1, "", 9, None, None, ["blade", "none", "blade", "hilt"]), ("blade", 2, "Blade", 0, "consumable", None, None), ("hilt", 3, None, 1, None, None, []), ("ghost", None, None, 1, None, None, ["blade"]),
            ("recipe_sword", 4, "R", 1, None, None, ["hilt"])]
    got = {r["item_id"]: r for r in dims.items_meta(spark.createDataFrame(rows, kind)).collect()}
    assert got[1]["components"] == [2, 2, 3] and got[2]["built_into"] == [1, 1] and got[3]["built_into"] == [1, 4] and got[1]["built_into"] == []
    assert got[1]["display_name"] == "sword" and got[4]["is_recipe"] and got[2]["is_consumable"] and not got[1]["is_consumable"]
    assert dims.taxonomy(dims.items_meta(spark.createDataFrame(rows, kind))).first().asDict() == {"consumables": 1, "terminal_items": 2}


def test_observed_paths_are_merged_over_elements(spark):
    lines = spark.createDataFrame([('{"a":[{"b":1},{"c":{"d":null}}],"e":[]}', "x"), ('{"f":1}', "y"), (" ", "z")], "value string, file string")
    got = {}
    for r in quality.observed_paths(lines, F.col("file")).collect():
        got.setdefault(r["group"], set()).add(r["path"])
    assert got == {"x": {"a", "a.b", "a.c", "a.c.d", "e"}, "y": {"f"}}


def test_batches_are_cut_within_walks(spark):
    kind = "match_id bigint, source string, label string, start_time bigint"
    rows = [(i, "s", "a" if i % 3 else "b", None if i == 5 else (i % 50) * 40_000) for i in range(200)]
    got = ledger.batches(spark.createDataFrame(rows, kind), 7).collect()
    for label in "ab":
        order = sorted((r for r in rows if r[2] == label), key=lambda r: (r[3] is None, -(r[3] or 0), -r[0]))
        want = {r[0]: i // 7 for i, r in enumerate(order)}
        found = {r["match_id"]: r["batch"] for r in got if r["label"] == label}
        assert found == want


def test_batches_without_times_go_by_id(spark):
    kind = "match_id bigint, source string, label string, start_time bigint"
    rows = [(i * 137, "s", "a", None if i % 2 else 86_400 + i % 5) for i in range(300)]
    order = sorted(rows, key=lambda r: (r[3] is None, -(r[3] or 0), -r[0]))
    got = {r["match_id"]: r["batch"] for r in ledger.batches(spark.createDataFrame(rows, kind)).collect()}
    assert got == {r[0]: i // 6 for i, r in enumerate(order)}


def _asof_brute(rows, releases):
    out = []
    for i, t in rows:
        known = [(s, n) for n, s in releases if t is not None and s is not None and s <= t]
        if known:
            out.append((i, t, max(known)[1]))
    return sorted(out)


def test_merged_asof_against_brute_force(spark):
    """Spans of any width, a hot instant on a start and between starts, equal starts, nulls, nested columns and a column of the same name."""
    import random

    rnd = random.Random(5)
    for span, n, m in ((100, 60, 300), (10**13, 50, 200), (5, 30, 200), (10**6, 1, 50)):
        releases = [(f"r{i}", rnd.randrange(span)) for i in range(n)] + [("none", None)]
        hot = rnd.choice([s for _, s in releases[:-1]])
        rows = [(i, rnd.choice([None, hot, hot, hot + 1, *[rnd.randrange(-span // 3, span * 2) for _ in range(6)]])) for i in range(m)]
        left = spark.createDataFrame(rows, "id bigint, startDateTime bigint").selectExpr("*", "array(id) AS list", "named_struct('x', id) AS nest").repartition(3)
        got = asof.asof_merged(left, spark.createDataFrame(releases, PATCHES))
        assert got.columns == [*left.columns, "patch"]
        assert sorted((r["id"], r["startDateTime"], r["patch"]) for r in got.collect()) == _asof_brute(rows, releases)
        assert all(r["list"] == [r["id"]] and r["nest"]["x"] == r["id"] for r in got.collect())
    clash = asof.asof_merged(left.withColumn("patch", F.lit("old")), spark.createDataFrame(releases, PATCHES))
    assert clash.columns == [*left.columns, "patch"] and "old" not in {r["patch"] for r in clash.collect()}


def test_starts_in_milliseconds_and_many_releases(spark):
    rows = spark.createDataFrame([(1_700_000_000 + i,) for i in range(50)], "startDateTime bigint")
    two = spark.createDataFrame([("a", 1_600_000_000), ("b", 1_700_000_010_000)], PATCHES)
    assert {r["patch"] for r in asof.asof(rows, two).collect()} == {"a"}
    many = spark.range(1_000_000).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("name"), (F.col("id") * 1000).alias("start_ts"))
    times = spark.range(20_000).select((F.col("id") * 49_999 + 7).alias("startDateTime")).union(spark.range(30_000).select(F.lit(500_000_123).alias("startDateTime")))
    got = asof.asof(times, many)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert got.filter(F.col("patch") != F.concat(F.lit("r"), F.floor(F.col("startDateTime") / 1000).cast("string"))).count() == 0 and got.count() == 50_000
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_hot_instant_is_in_several_parts(spark):
    times = spark.range(9000).select(F.when(F.col("id") < 6000, F.lit(77)).otherwise(F.col("id")).alias("t"), "id")
    line = asof.Line(times.select("t"), spark.createDataFrame([(77,)], "t bigint"))
    sizes = {r["p"]: r["count"] for r in times.groupBy(line.part(F.col("t"), F.xxhash64("id")).alias("p")).count().collect()}
    assert len(sizes) == 3 and max(sizes.values()) < 4200  # nothing is before the first cut


def test_nearest_of_many_targets(spark):
    import random

    rnd = random.Random(3)
    for span, n, m in ((60, 80, 50), (10**13, 70, 40), (3, 50, 5), (1000, 1, 30)):
        rows = [(rnd.choice([1, -1]) * i, rnd.choice([7, rnd.randrange(span)])) for i in range(n)] + [(999, None)]
        targets = [(rnd.choice([7, rnd.randrange(-span // 2, span * 2)]), "x") for _ in range(m)] + [(None, "y")]
        small = spark.createDataFrame([(t,) for t, _ in targets if t is not None], "t bigint").distinct()
        timed = spark.createDataFrame([(t, i) for i, t in rows if t is not None], "time bigint, key bigint").repartition(3)
        want = {t: min((abs(x - t), i) for i, x in rows if x is not None) for t, _ in targets if t is not None}
        for r in asof._beside(small, timed).collect():
            sides = [(x["time"] - r["t"], x["key"]) for x in [r["after"]] if x] + [(r["t"] - x["time"], -x["key"]) for x in [r["before"]] if x]
            assert min(sides) == want[r["t"]]
        got = asof.nearest(spark.createDataFrame(targets, "target bigint, note string"), spark.createDataFrame(rows, "id bigint, t bigint"), "target", "t", "id")
        assert sorted((r["target"], r["distance"], r["id"]) for r in got.collect()) == sorted((t, *want[t]) for t, _ in targets if t is not None)
    rows = spark.range(200_000).select("id", (F.col("id") * 37).alias("t"))
    targets = spark.range(1_000_000).select((F.col("id") * 7).alias("target"))
    got = asof.nearest(targets, rows, "target", "t", "id")
    assert got.filter((F.col("id") != F.least(F.ceil((F.col("target") - 18) / 37), F.lit(199_999)))).count() == 0 and got.count() == 1_000_000


def test_shards_are_read_once_and_to_a_limit(spark, tmp_path):
    """Reading stops at the limit; a shard that is damaged after it still gives its first records, and a health probe gives none."""
    import io
    import json
    import random

    from matchloom.sources import shards

    rnd = random.Random(1)
    text = b"".join(json.dumps({"id": i, "x": rnd.random()}).encode() + b"\n\n" for i in range(100_000))
    whole = gzip.compress(text[: len(text) // 2]) + gzip.compress(text[len(text) // 2 :])  # two members
    (tmp_path / "a.gz").write_bytes(whole)
    (tmp_path / "b.gz").write_bytes(whole[:-100_000])
    rows = landing.scan_shards(spark, str(tmp_path), 200).collect()
    ends = {r["file"].rsplit("/", 1)[1]: r for r in rows if r["record"] is None}
    assert all(r["reason"] is None and r["records"] == 200 and r["bytes"] <= 300_000 < len(whole) / 4 for r in ends.values()) and len(rows) == 402
    assert [json.loads(r["record"])["id"] for r in rows if r["record"] and r["file"].endswith("a.gz")] == list(range(200))
    rows = landing.scan_shards(spark, str(tmp_path)).groupBy("file").agg(F.count("record").alias("n"), F.max("bytes").alias("bytes"), F.max("records").alias("records"), F.max("reason").alias("reason"))
    got = {r["file"].rsplit("/", 1)[1]: r for r in rows.collect()}
    assert (got["a.gz"]["n"], got["a.gz"]["bytes"], got["a.gz"]["records"], got["a.gz"]["reason"]) == (100_000, len(whole), 100_000, None)
    assert got["b.gz"]["n"] == 0 and "EOF" in got["b.gz"]["reason"]
    assert landing.scan_shards(spark, str(tmp_path), give="health").filter("record is not null").count() == 0
    assert landing.scan_shards(spark, f"file://{tmp_path}/none").count() == 0

    class Once(io.BytesIO):
        """Cannot be read again from the start, as a store's stream."""

        def seek(self, *_):
            raise OSError("read twice")

    class Failing(io.RawIOBase):
        def read(self, size=-1):
            raise OSError("the store is away")

    *records, end = shards.read_shard(Once(whole))
    assert sum(map(len, records)) == 100_000 and end == (None, 100_000, len(whole)) and max(map(len, records)) <= shards.BATCH_RECORDS
    with pytest.raises(OSError, match="away"):
        list(shards.read_shard(Failing()))


def test_shards_of_a_store_that_only_spark_opens(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    from matchloom.sources import shards

    whole = gzip.compress(b'{"id": 1}\n' * 900)
    for name, data in (("a.gz", whole), ("b.gz", whole[:-9]), ("c.gz", b"plain")):
        (tmp_path / name).write_bytes(data)
    of = lambda: {(m, g): sorted(str(r[1:]) for r in landing.scan_shards(spark, str(tmp_path), m, g).collect()) for m, g in ((None, "records"), (7, "records"), (None, "health"), (None, "names"))}
    want = of()
    monkeypatch.setattr(shards, "store_of", lambda folder: (_ for _ in ()).throw(pa.ArrowInvalid("Unrecognized filesystem type")))
    assert of() == want and len(want[None, "records"]) == 903 and len(want[7, "records"]) == 17


def test_landing_summary_is_the_sum_of_the_files(spark, tmp_path):
    rows = spark.range(5000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
    for _ in range(3):
        landing.write_landing(rows.repartition(4), str(tmp_path / "raw"))
    sizes = [p.stat().st_size for p in (tmp_path / "raw").glob("*.gz")]
    assert len(sizes) == 12 and landing.landing_summary(spark, str(tmp_path / "raw")).first().asDict() == {"shards": 12, "bytes": sum(sizes)}


def test_dead_streaks_with_cuts_at_every_place(spark):
    import random

    rnd = random.Random(4)
    rows = [(run, i * 3, int(rnd.random() < share)) for run, n, share in (("a", 60, 0.5), ("b", 50, 0.8), ("c", 2, 0.0), ("d", 40, 0.3), (None, 30, 0.4)) for i in range(n)]
    want = {}
    for run in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == run]
        for i in range(2, len(own)):
            if not any(x[2] for x in own[i - 2 : i + 1]):
                want[run] = own[i][1]
                break
    df = spark.createDataFrame(rows, "run string, seq int, found int").repartition(5)
    for block in (3, 4, 7, 10_000):
        assert {r["run"]: r["seq"] for r in ledger.dead_streaks(df, block=block).collect()} == want, block


def test_batches_of_one_second_are_in_several_tasks(spark):
    kind = "match_id bigint, source string, label string, start_time bigint"
    rows = [(i * 7919 % 100_003, "s", "a", 1000 if i % 5 else None if i % 3 else i) for i in range(4000)] + [(i, None, "a", 5) for i in range(40)]
    df = spark.createDataFrame(rows, kind).repartition(3)
    placed = ledger.numbered(df.select("source", "label", "start_time", "match_id"), ["source", "label"], [F.col("start_time").desc_nulls_last(), F.col("match_id").desc()], "place")
    for source in ("s", None):
        own = sorted((r for r in rows if r[1] == source), key=lambda r: (r[3] is None, -(r[3] or 0), -r[0]))
        got = {r["match_id"]: r["place"] for r in placed.filter(F.col("source").eqNullSafe(F.lit(source))).collect()}
        assert got == {r[0]: i for i, r in enumerate(own)}
    ranges = spark.read.parquet(placed.inputFiles()[0].rsplit("/", 1)[0]).groupBy("__range").count().collect()
    assert len(ranges) == 4 and max(r["count"] for r in ranges) < 2000


STORED = "match_id bigint, source string, label string, start_time bigint, status string, attempts bigint, raw_file string, last_error string"


def stored_ledger(spark, path, n=400, buckets=32):
    from matchloom.sources.ledger_store import LedgerStore

    rows = [(i, "pro" if i % 3 else "public", f"w{i % 4}", i * 10, ("discovered", "failed", "fetched", "missing")[i % 4], i % 3, None, None) for i in range(n)]
    full = spark.createDataFrame(rows, STORED).selectExpr("*", "CAST(NULL AS BIGINT) avg_rank_tier", "CAST(NULL AS BIGINT) lobby_type", "CAST(NULL AS BIGINT) game_mode", "7L discovered_at")
    return LedgerStore.create(full, path, buckets), full


def same(a, b, *columns):
    of = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert of(a) == of(b)


def test_stored_ledger_writes_touched_buckets_only(spark, tmp_path):
    """The life of ids: added, fetched, failed, removed; each change writes its own buckets, and the ledger's side has no exchange."""
    store, full = stored_ledger(spark, str(tmp_path / "ledger"))
    columns = ["match_id", "status", "attempts", "raw_file", "last_error", "label", "discovered_at"]
    same(store.read(), full, *columns)
    before = {b: list(r) for b, r in store.runs.items()}
    outcomes = spark.createDataFrame([(5, "found", None), (77, "failed", "no"), (123, "missing", None), (200, "found", None), (201, "failed", "x"), (399, "missing", None)], "match_id bigint, outcome string, error string")
    touched = store.apply_outcomes(outcomes, "part-1.gz")
    changed = [b for b in store.runs if store.runs[b] != before[b]]
    assert 0 < len(touched) <= 6 and sorted(map(int, changed)) == touched and store.version == 2
    full = ledger.apply_outcomes(full, outcomes, "part-1.gz")
    same(store.read(), full, *columns)
    plan = ledger.apply_outcomes(store.read(touched), F.broadcast(outcomes), "x")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("BroadcastExchange") == 1
    store.remove_walks(["pro:w1", "w3"])
    full = ledger.without_walks(full, ["pro:w1", "w3"])
    same(store.read(), full, *columns)
    assert store.remove_walks(["nowhere"]) == [] and store.version == 3
    store.remove_walks(["w0"], include_fetched=True)
    full = ledger.without_walks(full, ["w0"], include_fetched=True)
    same(store.read(), full, *columns)
    runs = {p.name for p in (tmp_path / "ledger/data").iterdir()}
    gone = store.vacuum(1)
    same(store.read(), full, *columns)
    assert gone and {p.name for p in (tmp_path / "ledger/data").iterdir()} == runs - set(gone)


def test_new_ids_are_added_without_a_look_at_the_ledger(spark, tmp_path):
    import shutil

    store, full = stored_ledger(spark, str(tmp_path / "ledger"), 400, 8)
    kind = "match_id bigint, source string, label string, start_time bigint"
    fresh = spark.createDataFrame([(i, "pro", label, i) for i in range(350, 460) for label in ("z", "a")], kind)
    want = ledger.insert_or_ignore(full.select("match_id"), fresh, [F.col("label")])
    added = store.insert_or_ignore(fresh, [F.col("label")])
    same(added, want, *added.columns)
    assert added.count() == 60 and store.read().count() == 460 and store.read().select("match_id").distinct().count() == 460
    assert store.insert_or_ignore(fresh, [F.col("label")]).count() == 0 and store.version == 2
    assert store.insert_or_ignore(spark.createDataFrame([(None, "pro", "b", 1)], kind), [F.col("label")]).count() == 0
    for i in range(3):  # further runs, which are then written as one
        assert store.insert_or_ignore(spark.createDataFrame([(1000 + i, "pro", "b", 1), (3, "pro", "b", 1)], kind), [F.col("label")]).count() == 1
    rows = store.read().collect()
    compacted = store.compact(1)
    assert compacted and all(len(r) == 1 for r in store.runs.values()) and sorted(map(str, store.read().collect())) == sorted(map(str, rows))
    for run in (tmp_path / "ledger/data").iterdir():
        shutil.rmtree(run / "rows")  # only the filters are left
    new = spark.createDataFrame([(i, "pro", "b", 1) for i in range(10_000, 10_060) if i not in {r["match_id"] for r in store._maybe_known(spark.range(10_000, 10_060).select(F.col("id").alias("match_id"))).collect()}], kind)
    assert new.count() > 40 and store.insert_or_ignore(new, [F.col("label")]).count() == new.count()


def test_filters_know_all_ids_and_few_others(spark, tmp_path):
    store, _ = stored_ledger(spark, str(tmp_path / "ledger"), 6000, 4)
    known = store._maybe_known(spark.range(6000).select(F.col("id").alias("match_id")))
    assert known.count() == 6000
    assert store._maybe_known(spark.range(10_000, 16_000).select(F.col("id").alias("match_id"))).count() < 600


def test_two_writers_of_a_ledger(spark, tmp_path):
    from matchloom.sources.ledger_store import LedgerStore
    from matchloom.sources.versions import Conflict

    store, _ = stored_ledger(spark, str(tmp_path / "ledger"), 40, 4)
    other = LedgerStore(spark, str(tmp_path / "ledger"))
    outcomes = spark.createDataFrame([(5, "found", None)], "match_id bigint, outcome string, error string")
    store.apply_outcomes(outcomes, "one.gz")
    with pytest.raises(Conflict):
        other.apply_outcomes(outcomes, "two.gz")
    other.refresh()
    assert [r["raw_file"] for r in other.read().filter("match_id = 5").collect()] == ["one.gz"]
    other.apply_outcomes(outcomes, "two.gz")
    assert [r["raw_file"] for r in LedgerStore(spark, str(tmp_path / "ledger")).read().filter("match_id = 5").collect()] == ["two.gz"]


def test_published_versions(spark, tmp_path, monkeypatch):
    """A reader between the steps of a publication sees the old tables; a failing put leaves them."""
    from matchloom.sources import versions

    folder, kind = str(tmp_path / "out"), "id bigint, patch string"
    fact = lambda *p: spark.createDataFrame([(i, x) for i, x in enumerate(p)], kind)
    read = lambda: {n: sorted(r["patch"] for r in versions.Reader(spark, folder).table(n, kind).collect()) for n in ("a", "b")}
    assert versions.current(spark, folder) == (0, {})
    assert versions.publish({"a": fact("7.40", "7.41"), "b": fact("7.40")}, folder) == {"a": 2, "b": 1}
    old, seen = versions.Reader(spark, folder), []

    def watched(df, path):
        versions.write_fact(df, path)
        seen.append(read())

    versions.publish({"a": fact("8.0"), "b": fact("8.0", "8.1")}, folder, watched)
    assert seen == [{"a": ["7.40", "7.41"], "b": ["7.40"]}] * 2 and read() == {"a": ["8.0"], "b": ["8.0", "8.1"]}
    assert sorted(r["patch"] for r in old.table("a", kind).collect()) == ["7.40", "7.41"]
    with pytest.raises(ValueError, match="no rows"):
        versions.publish({"a": fact("9"), "b": fact()}, folder)
    put = versions.put
    monkeypatch.setattr(versions, "put", lambda *a: (_ for _ in ()).throw(OSError("the store is away")))
    with pytest.raises(OSError, match="away"):
        versions.publish({"a": fact("9")}, folder)
    monkeypatch.setattr(versions, "put", put)
    assert read() == {"a": ["8.0"], "b": ["8.0", "8.1"]} and len(list((tmp_path / "out/data").iterdir())) == 2
    (tmp_path / "out/_versions/0000000003.json").write_text('{"tables": {"a"')  # a pointer that is being written
    assert read() == {"a": ["8.0"], "b": ["8.0", "8.1"]}
    with pytest.raises(versions.Conflict):
        versions.publish({"b": fact("9")}, folder)
    (tmp_path / "out/_versions/0000000003.json").unlink()
    versions.publish({"b": fact("9")}, folder)
    assert read() == {"a": ["8.0"], "b": ["9"]} and len(versions.vacuum_tables(spark, folder, 1)) == 1 and read() == {"a": ["8.0"], "b": ["9"]}


def test_restated_facts_rewrite_what_changed(spark, tmp_path):
    from matchloom.sources.fact_store import FactStore, changed_intervals

    old = spark.createDataFrame([("a", 100), ("b", 200), ("c", 300), ("d", 400)], PATCHES)
    df = raw(spark, *[{"id": i, "startDateTime": 10 * i, "players": [{"heroId": 1}, {"heroId": 2}]} for i in range(60)])
    schema = facts.players(df, old).schema

    def stored(name):
        store = FactStore(spark, str(tmp_path / name), schema)
        assert store.append(facts.players(df.filter("id < 30"), old), 0) and store.append(facts.players(df.filter("id >= 30"), old), 1) and not store.append(facts.players(df, old), 1)
        same(store.read(), facts.players(df, old), *schema.names)
        return store

    cases = {
        "moved": ([("a", 100), ("b", 200), ("c", 340), ("d", 400)], ["b", "c"]), "same": ([("a", 100), ("b", 200), ("c", 300), ("d", 400)], []),
        "new": ([("a", 100), ("b", 200), ("b2", 250), ("c", 300), ("d", 400), ("e", 9999)], ["b", "b2", "d", "e"]), "gone": ([("a", 100), ("c", 300), ("d", 400)], ["a", "b"]),
        "later": ([("a", 150), ("b", 200), ("c", 300), ("d", 400)], ["a"]), "earlier": ([("a", 50), ("b", 200), ("c", 300), ("d", 400)], ["a"]),
        "renamed": ([("A", 100), ("b", 200), ("c", 300), ("d", 400)], ["A", "a"]),
    }
    for name, (rows, touched) in cases.items():
        store, new = stored(name), spark.createDataFrame(rows, PATCHES)
        before = dict(store.parts)
        assert store.restate(old, new, lambda: df, facts.players) == touched, name
        same(store.read(), facts.players(df, new), *schema.names)
        assert all(store.parts[p] == x for p, x in before.items() if p not in touched)
        if name == "earlier":
            with pytest.raises(ValueError, match="earlier"):
                stored("again").restate(old, new)
        if name == "moved":
            assert [tuple(r) for r in changed_intervals(old, new).collect()] == [(300, 340, "c", "b")]
            assert store.read(["b"]).select("patch").distinct().count() == 1 and len(store.vacuum(1)) == 0 and store.read().count() == 100


def test_observed_paths_of_unlike_values(spark):
    """Odd keys, and keys with records in one place and scalars in another, within a text and between texts."""
    texts = ['{"a":{"b":1},"c":[{"d":1},5,[{"e":{"f":null}}],{"d":{"g":2}}]}', '{"a":"text","c":[]}', '{"x y":1,"q`t":{"z: w":"s"},"a,b>":{"A":1,"a":2},"VARIANT":1}', '[{"top":[[1],[{"k":2}]]}]', "5", '{"a":{"h":[]}}']
    lines = spark.createDataFrame([(t, "g") for t in texts] + [('{"n":{"only":1}}', None)], "value string, file string")
    got = {}
    for r in quality.observed_paths(lines, F.col("file")).collect():
        got.setdefault(r["group"], set()).add(r["path"])
    want = {"a", "a.b", "a.h", "c", "c.d", "c.d.g", "c.e", "c.e.f", "x y", "q`t", "q`t.z: w", "a,b>", "a,b>.A", "a,b>.a", "VARIANT", "top", "top.k"}
    assert got == {"g": want, "": {"n", "n.only"}}
    assert quality.observed_paths(lines.limit(0)).count() == 0
