"""What no single task may hold: shards, dimensions and facts come in pieces, and rows of a fact are not sorted by release."""

import glob
import gzip
import json
import zlib
from collections import defaultdict

import pytest

from matchloom.operators import asof
from matchloom.plans import derive, queries
from matchloom.sources import landing, schemas

from .test_queries import folder  # noqa: F401  the small tables


@pytest.fixture
def several(spark):
    """Shuffles that are not merged into one task, as large ones are not."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_shards_come_in_pieces(several, folder):  # noqa: F811
    path = queries._vintages(several, folder)
    for shard in ("new/part=0", "new/part=1", "old/part=2"):
        assert len(glob.glob(f"{path}/{shard}/*.gz")) > 1
    rows = queries._lines(several, folder, 3).collect()
    got, ids = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r["file"]].append(json.loads(r["value"])["id"])
    for r in several.read.parquet(f"{folder}/lineitem.parquet").select("l_orderkey").distinct().collect():
        ids[f"{'new' if r[0] % 3 else 'old'}/{r[0] % 4}"].append(r[0])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v)[:3] for k, v in ids.items()}


def test_damaged_shards_are_whole_but_no_larger_than_others(several, folder, monkeypatch):  # noqa: F811
    """The damaged vintage has all its matches, in an order by id in each piece, in a fraction of the bytes of their JSON."""
    paths = []
    monkeypatch.setattr(landing, "scan_healthy", lambda s, path, f=landing.scan_healthy, **k: (paths.append(path), f(s, path, **k))[1])
    read = {r["id"] for r in queries.scan_healthy_shards(several, folder).collect()}
    pieces = [open(p, "rb").read() for p in glob.glob(f"{paths[0]}/old/part=*/*.gz")]
    lines = [list(map(json.loads, zlib.decompress(p).splitlines())) for p in pieces]
    size = sum(len(zlib.decompress(p)) for p in pieces)
    assert 0 < 2 * sum(map(len, pieces)) < size
    assert not any(p.startswith(b"\x1f\x8b") for p in pieces)
    assert all(x == sorted(x, key=lambda r: r["id"]) for x in lines)
    found = {r["id"]: len(r["players"]) for x in lines for r in x}
    every = {r[0]: r[1] for r in several.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_orderkey").count().collect()}
    assert found == {k: n for k, n in every.items() if k % 3 == 0} and read == {k for k in every if k % 3}
    players = [p for x in lines for r in x for p in r["players"]]
    assert not any("award" in p or "stats" in p for p in players) and not any("leagueId" in r for x in lines for r in x)


def test_shards_are_made_line_by_line(spark, folder, monkeypatch):  # noqa: F811
    """Neither vintage sorts or makes whole players in lists, and the old one makes no field that it lacks."""
    plans, raw = [], derive.raw
    explain = lambda df: spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    monkeypatch.setattr(derive, "raw", lambda *a, **k: plans.append((df := raw(*a, **k), explain(df))) or df)
    queries._vintages(spark, folder)
    assert len(plans) == 2 and all("ObjectHashAggregate" not in p and "lambda" not in p and p.count("Sort [l_orderkey") == 1 for _, p in plans)
    fields = [set(schemas.field_paths(df.schema)) for df, _ in plans]
    lacks = fields[0] - fields[1]
    assert set(queries._OLD_LACKS) <= lacks and all(p in queries._OLD_LACKS or p.startswith("players.stats.") for p in lacks) and not fields[1] - fields[0]


def test_a_dimension_has_no_single_writer(several, tmp_path):
    rows = several.range(400).groupBy("id").count()
    landing.write_dimension(rows, str(tmp_path / "dim"))
    assert len(glob.glob(f"{tmp_path}/dim/*.parquet")) > 1 and several.read.parquet(str(tmp_path / "dim")).count() == 400


def test_a_fact_is_written_without_a_sort(spark, tmp_path, monkeypatch):
    """The setting holds while a fact is written and not beyond it."""
    key, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(key)
    rows = spark.range(100).selectExpr("id", "concat('1.', id % 40) AS patch")  # more releases than folders that can be open
    monkeypatch.setattr(landing, "unsorted_folders", lambda s, f=landing.unsorted_folders: (seen.append(1), f(s))[1])
    landing.write_fact(rows, str(tmp_path / "fact"))
    assert seen and spark.conf.get(key) == before
    assert sorted(landing.read_fact(spark, str(tmp_path / "fact"), rows.schema).collect()) == sorted(rows.collect())


def test_team_matches_join_lines_once(spark, folder):  # noqa: F811
    plan = derive.team_matches(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 1


def test_fixed_entries_are_those_that_were_made(spark):
    rows = spark.range(-1, 20).selectExpr("CAST(id AS INT) AS l_linenumber", "id * 5 AS l_partkey")
    for name, entry in (("campStack", "CAST(k AS BIGINT)"), ("killEvents", "named_struct('time', CAST(100 * k - 150 AS BIGINT))")):
        made = derive._ENTRIES.format(entry)
        where = "l_partkey % 11 <> 0" if name == "campStack" else "l_partkey % 13 > 1"
        both = rows.filter(where).selectExpr(f"{derive._STATS[name]} AS got", f"{made} AS want").collect()
        assert both and all(r["got"] == r["want"] for r in both)


def test_fields_of_players_are_pinned_alone(spark, tmp_path):
    spark.createDataFrame([('{"id":1,"players":[{"heroId":3,"isRadiant":true,"stats":{"campStack":[1]}},{"isRadiant":false}]}',)], "value string").write.text(str(tmp_path / "x"))
    rows = landing.scan_raw(spark, str(tmp_path / "x"), player=("isRadiant",)).select("id", "players").collect()
    assert [(r["id"], [p.asDict() for p in r["players"]]) for r in rows] == [(1, [{"isRadiant": True}, {"isRadiant": False}])]


def test_healthy_shards_are_read_with_the_wanted_fields(spark, tmp_path, folder, monkeypatch):  # noqa: F811
    """Only the wanted fields of players are taken apart; every player is there, also a null one."""
    (tmp_path / "x.json.gz").write_bytes(gzip.compress(b'{"id":1,"players":[{"heroId":3,"isRadiant":true,"stats":{"campStack":[1]}},null,{}]}\n{"id":2,"players":[]}\n{"id":3}\n'))
    rows = landing.scan_healthy(spark, str(tmp_path), player=("isRadiant",)).select("id", "players").collect()
    assert [(r["id"], r["players"] and [p and p.asDict() for p in r["players"]]) for r in rows] == [(1, [{"isRadiant": True}, None, {"isRadiant": None}]), (2, []), (3, None)]
    (tmp_path / "y.json.gz").write_bytes(gzip.compress(b'{"id":4,"players":[{"isRadiant":"no"}]}\n'))
    with pytest.raises(Exception, match="(?i)malformed|cannot parse|fail"):
        landing.scan_healthy(spark, str(tmp_path), player=("isRadiant",)).collect()
    asked = []
    monkeypatch.setattr(landing, "scan_healthy", lambda *a, f=landing.scan_healthy, **k: (asked.append(k), f(*a, **k))[1])
    queries.scan_healthy_shards(spark, folder)
    assert asked == [{"player": ("heroId",)}]


def test_many_targets_meet_one_row_for_each_time(spark, monkeypatch):
    monkeypatch.setattr(asof, "MOST_BROADCAST", 0)
    met = []
    monkeypatch.setattr(asof, "_beside", lambda small, timed, f=asof._beside: (met.append(timed.count()), f(small, timed))[1])
    rows = spark.createDataFrame([(k, k % 3 * 100) for k in range(300, 0, -1)], "id bigint, t bigint")
    got = asof.nearest(spark.createDataFrame([(40,), (60,), (150,), (999,), (None,)], "target bigint"), rows, "target", "t", "id").collect()
    assert met == [3] and sorted((r["target"], r["id"], r["distance"]) for r in got) == [(40, 3, 40), (60, 1, 40), (150, 1, 50), (999, 2, 799)]


def test_the_whole_players_fact_makes_no_purchases(spark, folder, monkeypatch):  # noqa: F811
    made, raw = [], derive.raw
    monkeypatch.setattr(derive, "raw", lambda *a, **k: made.append(raw(*a, **k)) or made[-1])
    queries.players_fact(spark, folder)
    fields = schemas.field_paths(made[0].schema)
    assert "players.stats.killEvents" in fields and "players.stats.itemPurchases" not in fields
