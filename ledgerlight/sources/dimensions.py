"""Dimension tables from plain rows, with generated keys.

``build_dimensions`` turns name lists into the three dimension frames the
way a SERIAL column would: keys 1..n in row order.  Territory owners are
given by agent name and resolved to keys; an unknown owner name is an
error, an owner of None leaves the territory unowned.  New members added
later get keys through ``operators.quality.assign_keys``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ledgerlight.schema import AGENT, PRODUCT, TERRITORY


def build_dimensions(spark: SparkSession,
                     agents: list[tuple[str, dt.date | None]],
                     products: list[tuple[str, int]],
                     territories: list[tuple[str | None, str, str]]) -> dict[str, DataFrame]:
    """agents: (name, release_date); products: (name, unit_price); territories: (owner name, city, district)."""
    agent_ids = {name: i for i, (name, _) in enumerate(agents, start=1)}
    if len(agent_ids) != len(agents):
        raise ValueError("agent names must be unique")
    if len({name for name, _ in products}) != len(products):
        raise ValueError("product names must be unique")
    if len({(c, d) for _, c, d in territories}) != len(territories):
        raise ValueError("(city, district) must be unique")
    unknown = {o for o, _, _ in territories if o is not None and o not in agent_ids}
    if unknown:
        raise ValueError(f"unknown territory owners: {sorted(unknown)}")
    return {
        "agent": spark.createDataFrame([(agent_ids[n], n, r) for n, r in agents], AGENT),
        "product": spark.createDataFrame([(i, n, p) for i, (n, p) in enumerate(products, start=1)], PRODUCT),
        "territory": spark.createDataFrame(
            [(i, None if o is None else agent_ids[o], c, d) for i, (o, c, d) in enumerate(territories, start=1)],
            TERRITORY),
    }
