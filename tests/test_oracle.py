"""Every registered query against its checking SQL on the test tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from logtally import bridge

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


def _norm(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    return value


def _sorted(rows):
    return sorted(rows, key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_checking_sql(spark, duck, name):
    ours = entry.queries()[name](spark, SF)
    theirs = duck.execute(entry.oracle_sql()[name])
    columns = sorted(ours.columns)
    order = [d[0] for d in theirs.description]
    assert columns == sorted(order)
    expected = _sorted(
        [_norm(r[order.index(c)]) for c in columns] for r in theirs.fetchall()
    )
    got = _sorted([_norm(r[c]) for c in columns] for r in ours.collect())
    assert len(got) == len(expected)
    assert got == expected
    assert got or name in entry.EMPTY_BY_NATURE


def test_every_query_is_known():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_drift_sees_the_source_columns(spark, monkeypatch):
    lines = bridge.lines
    monkeypatch.setattr(bridge, "lines", lambda rows, *others: lines(rows, *others).drop("ip"))
    got = {r["item"]: r["actual"] for r in entry.queries()["contract_drift"](spark, SF).collect()}
    assert got["1. source carries ip"] == "no"
    assert got["2. source columns"] == "[account_id, action, created_at, detail, id, source, status, user_agent]"
