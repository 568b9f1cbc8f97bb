"""Every query against its SQL on small tables."""

import datetime
import math
import random

import duckdb
import pytest

from matchloom.plans import queries  # noqa: F401
from matchloom.plans.registry import ORACLES, QUERIES

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def rows():
    rnd = random.Random(7)
    day = lambda y, n: datetime.datetime(y, 1, 1) + datetime.timedelta(days=rnd.randrange(n), seconds=rnd.randrange(86400))
    priority = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
    orders = [(i, rnd.randrange(100), rnd.choice("OFPP"), 1.5, day(1995, 2200) if i % 30 else datetime.datetime(1997, 6, 18), rnd.choice(priority)) for i in range(300)]
    lines = [(rnd.randrange(290), rnd.randrange(400), rnd.randrange(40), rnd.randrange(1, 8), 1.0, rnd.randrange(99999) / 7, 0.0, 0.0, rnd.choice("ANR"), rnd.choice("OF"), day(1995, 2200)) for _ in range(900)]
    kinds = ["view", "click", "purchase", "signup"]
    events = [(i, datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=i * 2500 + rnd.randrange(900)), rnd.randrange(60), rnd.choice(kinds), 0.5, '{"k":%d}' % i if i % 3 else '{"x":1}' if i % 2 else None) for i in range(1000)]
    return {
        "region": [(i, f"R{i}") for i in range(5)],
        "nation": [(i, rnd.choice(["JAPAN", "France", "ROMANIA", "Peru"]) + f"_{i}", i % 5) for i in range(25)],
        "customer": [(i, f"C{i}", rnd.randrange(25), 1.0, "S") for i in range(400)],
        "supplier": [(i, f"Supplier#{i}", i % 25, rnd.choice([None, i * 1.5])) for i in range(40)],
        "part": [(i, f"part {i}", "b", "t", rnd.randrange(1, 50), 900 + i / 3) for i in range(400)],
        "orders": orders, "lineitem": lines, "events": events,
    }


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    for name, data in rows().items():
        spark.createDataFrame(data, TABLES[name]).coalesce(2).write.parquet(f"{path}/{name}.parquet")
    return path


def plain(v):
    v = v.item() if hasattr(v, "item") else v
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return str(v)
    return "nan" if math.isnan(v) else f"{float(v):.9g}"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equal(spark, folder, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    found = QUERIES[name](spark, folder)
    columns = sorted(found.columns)
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    got = [[plain(r[c]) for c in columns] for r in found.collect()]
    assert sorted(got) == sorted([plain(v) for v in r] for r in want)
    assert got
