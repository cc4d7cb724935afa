"""Registered queries over the generated tables, each with its SQL oracle.

Every query reads the whole generated tables through
``ledgerlight.sources.testdata.load_model`` and returns a DataFrame whose
columns carry the same names as the matching oracle SQL.  The oracle is
written independently against the raw tables (DuckDB dialect, ANSI where
possible) from the model's semantics; it never calls this package.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlight.sources.testdata import ORACLE_VIEWS, load_model, read_table

QueryFn = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
AS_OF = dt.date(1999, 1, 1)
PURCHASE_CUTOFF = dt.date(1998, 12, 1)  # AS_OF minus one month
ONE_AGENT = 7

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn
    return wrap


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)


def _load_all() -> None:
    # importing the modules runs their @register decorators
    from ledgerlight.queries import (  # noqa: F401
        documents, ingest, quality, stats, stock, territory, xml,
    )


# Every query derives the model from the given tables.  Set to True to read it from a
# warehouse written once per session instead (month-partitioned facts, as a deployment
# stores them), as the two ``*_warehouse`` queries always do.
USE_WAREHOUSE = False

_WAREHOUSES: dict[tuple[int, str, str], tuple[SparkSession, object]] = {}


def materialized(spark: SparkSession, sf_dir: str):
    """The generated tables written once per session as a warehouse (facts by month, summaries)."""
    from ledgerlight.operators.ingest import files_batch_id
    from ledgerlight.plans.session import scratch_path
    from ledgerlight.plans.sinks import Warehouse
    key = (id(spark), sf_dir.rstrip("/"), files_batch_id(spark, [sf_dir]))  # changed files: written anew
    hit = _WAREHOUSES.get(key)
    if hit is not None and hit[0] is spark and spark.sparkContext._jsc is not None:
        return hit[1]
    wh = Warehouse(scratch_path(spark, "warehouse"))
    wh.materialize(load_model(spark, sf_dir))
    _WAREHOUSES[key] = (spark, wh)
    return wh


_MODELS: dict[tuple, tuple[SparkSession, object]] = {}


def model(spark: SparkSession, sf_dir: str, up_to: dt.date | None = None):
    """The model the registered queries read (lazy frames, reused per live session).

    ``up_to``: the query only needs facts up to this date, so later month
    partitions are pruned before any file is opened.
    """
    if not USE_WAREHOUSE:
        return load_model(spark, sf_dir)
    key = (id(spark), sf_dir.rstrip("/"), up_to)
    hit = _MODELS.get(key)
    if hit is not None and hit[0] is spark and spark.sparkContext._jsc is not None:
        return hit[1]
    m = materialized(spark, sf_dir).model(spark, up_to=up_to)  # lists the warehouse files once
    _MODELS[key] = (spark, m)
    return m


def read_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def with_views(body: str) -> str:
    """Prefix an oracle body (starting with further CTEs or SELECT) with the model views."""
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"{ORACLE_VIEWS}\n{body}"
    return f"{ORACLE_VIEWS},\n{body}"


def d(day: dt.date) -> str:
    return f"DATE '{day.isoformat()}'"
