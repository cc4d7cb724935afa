"""Seeded pseudo-random numbers as plain integer column arithmetic.

``rand_key`` chains multiplicative congruential steps (modulus 2^31 - 1,
multiplier 48271) over a seed and key columns.  Every intermediate value
stays below 2^47, so it never overflows a 64-bit integer, runs inside
whole-stage codegen and gives the same numbers in any SQL engine, which
keeps sampling reproducible across re-executions (a lost task recomputes
the same rows) and checkable against an SQL oracle.  Key columns must be
non-negative integers.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MODULUS = 2147483647
MULTIPLIER = 48271


def _step(acc: Column, value: Column) -> Column:
    return (acc * F.lit(MULTIPLIER) + value % F.lit(MODULUS)) % F.lit(MODULUS)


def rand_key(seed: int, *cols: Column) -> Column:
    """Deterministic integer in [0, 2^31 - 1) from a seed and key columns."""
    acc = F.lit(seed % MODULUS).cast("bigint")
    for c in cols:
        acc = _step(acc, c.cast("bigint"))
    return _step(_step(acc, F.lit(0)), F.lit(0))


def rand_key_sql(seed: int, *exprs: str) -> str:
    """The same function as SQL text (for oracles and SQL users)."""
    acc = f"CAST({seed % MODULUS} AS BIGINT)"
    for e in [*exprs, "0", "0"]:
        acc = f"(({acc}) * {MULTIPLIER} + (CAST({e} AS BIGINT) % {MODULUS})) % {MODULUS}"
    return acc


def month_number(col: Column) -> Column:
    return F.year(col) * F.lit(12) + F.month(col) - F.lit(1)


def day_number(col: Column) -> Column:
    return F.datediff(col, F.lit("1970-01-01").cast("date"))
