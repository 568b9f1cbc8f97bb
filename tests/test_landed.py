"""Matches made line by line and landed."""

from pyspark.sql import functions as F

from matchloom.operators import facts
from matchloom.plans import derive
from matchloom.sources import landing
from matchloom.streaming import landing as streaming
from tests.test_queries import TABLES, rows


def tables(spark, path):
    data = rows()
    data["orders"].append((None, 1, "P", 1.5, data["orders"][0][4], "2-HIGH"))
    line = data["lineitem"][0]
    data["lineitem"] += [(None, *line[1:]), (data["orders"][5][0], None, None, 9, *line[4:8], None, None, line[10])]
    for name in ("orders", "lineitem"):
        spark.createDataFrame(data[name], TABLES[name]).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def plan(spark, df):
    return spark._jvm.PythonSQLUtils.explainString(df.filter("1 = 1")._jdf.queryExecution(), "simple")


def test_players_made_line_by_line_are_the_same(spark, tmp_path):
    folder = tables(spark, tmp_path)
    as_text = lambda df: sorted(map(str, df.withColumn("players", F.sort_array(F.transform("players", lambda p: F.to_json(p)))).collect()))
    for fields in ({}, {"match": (), "player": ("heroId",), "stats": ()}, {"match": ("rank",), "player": ("isVictory",), "stats": ("runes",)}):
        by_line, want = derive.raw(spark, folder, **fields, by_line=True), derive.raw(spark, folder, **fields)
        assert by_line.schema == want.schema
        assert as_text(by_line) == as_text(want) and by_line.count() > 200


def test_landed_players_are_compiled_and_not_sorted(spark, tmp_path):
    folder = tables(spark, tmp_path)
    with landing.in_order(spark):
        found = plan(spark, derive.raw(spark, folder, by_line=True))
    assert "lambda" not in found and "ObjectHashAggregate" not in found
    at = [found.index(x) for x in ("SortAggregate", "Project [l_orderkey", "Sort [l_orderkey", "Exchange")]
    assert at == sorted(at) and found.count("Sort [l_orderkey") == 1  # lines are sorted before they are players, once


def test_landing_takes_tasks_by_what_they_write(spark, tmp_path, monkeypatch):
    keys = ("spark.sql.execution.useObjectHashAggregateExec", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(k) for k in keys]
    monkeypatch.setattr(landing, "LANDED_BYTES", 1 << 20)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        wide = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition("id")
        landing.write_landing(wide, str(tmp_path / "raw"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(list((tmp_path / "raw").glob("*.gz"))) > 8  # a task for each core before
    assert [spark.conf.get(k) for k in keys] == before


def test_folded_files_are_zstd_as_published_ones(spark, tmp_path):
    folder, patches = tables(spark, tmp_path), derive.patches(spark)
    raw = derive.raw(spark, folder, by_line=True)
    landing.write_landing(raw, str(tmp_path / "raw"))
    streaming.fold(spark, str(tmp_path / "raw"), patches, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert list((tmp_path / "out").glob("*/*.zstd.parquet"))
    got = landing.read_fact(spark, str(tmp_path / "out"), facts.players(raw, patches).schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, facts.players(raw, patches).select(*got.columns).collect()))


def test_folds_take_few_shards_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "READ_BYTES", 1)  # of any two shards none go together
    folder, patches = tables(spark, tmp_path), derive.patches(spark)
    raw = spark.createDataFrame(derive.raw(spark, folder).collect(), derive.raw(spark, folder).schema)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for k in range(3):
        landing.write_landing(raw.filter(F.col("id") % 3 == k).repartition(4), str(tmp_path / "raw"))
    streaming.fold(spark, str(tmp_path / "raw"), patches, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert len({p.name[:10] for p in (tmp_path / "out").glob("*/*.parquet")}) == len(list((tmp_path / "raw").glob("*.gz"))) == 12
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
