"""As-of statistics per agent and product (the snapshot and its roll-ups).

Semantics kept from the model:

* sales count up to and including ``as_of``;
* purchases count up to and including ``as_of`` minus ``lag_months``
  (one month: goods are sold the month after they are taken);
* only pairs with an eligible purchase appear; sales of a pair without
  one are dropped;
* ``debt = bought - sold`` (may be negative), ``profit = revenue - cost``
  stays NULL for a pair with no sale, so an agent's profit leaves out the
  cost of goods it has not sold yet.

Plan shape: both fact tables are filtered at the scan (literal dates) and
aggregated to one row per (agent, product) with partial aggregation before
any shuffle, so a hot agent or product is reduced map-side.  The two
aggregates share their hash partitioning, so the left join adds no
exchange.  Dimensions are joined after aggregation (``cost`` is
``unit_price * sum(amount)``), which keeps the fact rows out of every
dimension join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlight.functions.dates import DateLike, as_date, shift_months
from ledgerlight.model import Model
from ledgerlight.plans.joins import keep_known, maybe_broadcast

MEASURES = ["qty_bought", "cost", "qty_sold", "revenue", "debt", "profit"]
PAIR = ["agent_id", "product_id"]


def _for_agent(df: DataFrame, agent_id: int | None) -> DataFrame:
    return df if agent_id is None else df.filter(F.col("agent_id") == F.lit(agent_id))


def sales_by_pair(model: Model, as_of: DateLike | None = None, agent_id: int | None = None) -> DataFrame:
    """Quantity and revenue sold per (agent, product) up to ``as_of`` inclusive."""
    day = as_date(as_of)
    sold = _for_agent(model.sale, agent_id).filter(F.col("date_sold") <= F.lit(day))
    pairs = sold.groupBy(*PAIR).agg(
        F.sum("amount_sold").alias("qty_sold"),
        F.sum("price").alias("revenue"),
    )
    # the seller must be a known agent (key-only filter on the aggregated pairs)
    return keep_known(pairs, model.agent, "agent_id")


def purchases_by_pair(model: Model, as_of: DateLike | None = None, lag_months: int = 1,
                      agent_id: int | None = None) -> DataFrame:
    """Quantity and cost bought per (agent, product) up to ``as_of - lag_months`` inclusive."""
    cutoff = shift_months(as_date(as_of), -lag_months)
    bought = _for_agent(model.purchase, agent_id).filter(F.col("date_bought") <= F.lit(cutoff))
    pairs = bought.groupBy(*PAIR).agg(F.sum("amount_bought").alias("qty_bought"))
    prices = maybe_broadcast(model.product.select("product_id", "unit_price"))
    return (keep_known(pairs, model.agent, "agent_id")
            .join(prices, "product_id")
            .select(*PAIR, "qty_bought", (F.col("unit_price") * F.col("qty_bought")).alias("cost")))


def agent_product_stats(model: Model, as_of: DateLike | None = None, lag_months: int = 1,
                        agent_id: int | None = None) -> DataFrame:
    """The snapshot: one row per purchasing pair with the six measures (nulls kept)."""
    bought = purchases_by_pair(model, as_of, lag_months, agent_id)
    sold = sales_by_pair(model, as_of, agent_id)
    return (bought.join(sold, PAIR, "left")
            .select(
                *PAIR, "qty_bought", "cost", "qty_sold", "revenue",
                (F.col("qty_bought") - F.coalesce(F.col("qty_sold"), F.lit(0))).alias("debt"),
                (F.col("revenue") - F.col("cost")).alias("profit"),
            ))


def agent_stats(model: Model, as_of: DateLike | None = None, agent_id: int | None = None,
                snapshot: DataFrame | None = None) -> DataFrame:
    """Totals per agent; agents without eligible purchases appear with zeros."""
    pairs = snapshot if snapshot is not None else agent_product_stats(model, as_of, agent_id=agent_id)
    totals = pairs.groupBy("agent_id").agg(*[F.sum(m).alias(m) for m in MEASURES])
    agents = _for_agent(model.agent.select("agent_id", "agent_name"), agent_id)
    # one totals row per agent: broadcastable whenever the agent table is
    return (agents.join(maybe_broadcast(totals, bounded_by=model.agent), "agent_id", "left")
            .select("agent_id", "agent_name",
                    *[F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in MEASURES]))


def agent_stats_from_named(model: Model, named: DataFrame, agent_id: int | None = None,
                           extra: list[F.Column] | None = None) -> DataFrame:
    """Totals per agent from zero-filled pair rows (same result as ``agent_stats``).

    Summing zero-filled values equals zero-filling the sums, so a caller
    that already holds the named pairs avoids a second pass over the facts.
    ``extra`` aggregates (aliased) are computed in the same pass and kept.
    """
    extra = extra or []
    totals = named.groupBy("agent_id").agg(*[F.sum(m).alias(m) for m in MEASURES], *extra)
    agents = _for_agent(model.agent.select("agent_id", "agent_name"), agent_id)
    kept = [c for c in totals.columns if c not in MEASURES and c != "agent_id"]
    return (agents.join(maybe_broadcast(totals, bounded_by=model.agent), "agent_id", "left")
            .select("agent_id", "agent_name",
                    *[F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in MEASURES], *kept))


def agent_product_named(model: Model, as_of: DateLike | None = None, agent_id: int | None = None,
                        snapshot: DataFrame | None = None) -> DataFrame:
    """Snapshot rows with agent and product names, every measure zero-filled."""
    pairs = snapshot if snapshot is not None else agent_product_stats(model, as_of, agent_id=agent_id)
    names = maybe_broadcast(model.product.select("product_id", "product_name"))
    agents = maybe_broadcast(model.agent.select("agent_id", "agent_name"))
    return (pairs.join(agents, "agent_id").join(names, "product_id")
            .select("agent_id", "agent_name", "product_id", "product_name",
                    *[F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in MEASURES]))
