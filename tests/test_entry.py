"""The driver contract: entry() smoke run and every query against its oracle at sf0.001."""

from __future__ import annotations

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerlight import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, decimal.Decimal):
        return str(int(v)) if v == v.to_integral_value() else str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def rows_by_name(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["agent_id", "agent_name"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables missing")
@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cur = duck.execute(entry.oracle_sql()[name])
    ocols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert rows_by_name(df.columns, df.collect()) == rows_by_name(ocols, cur.fetchall())


@pytest.mark.parametrize("name", ["agent_totals", "agent_documents", "territory_markdown",
                                  "outstanding_stock_monthly", "month_agent_grid", "tables_xml"])
def test_warehouse_and_source_paths_agree(spark, name):
    direct = sorted(entry.queries()[name](spark, SF).collect())
    catalog.USE_WAREHOUSE = True
    try:
        warehouse = sorted(entry.queries()[name](spark, SF).collect())
    finally:
        catalog.USE_WAREHOUSE = False
    assert warehouse == direct
