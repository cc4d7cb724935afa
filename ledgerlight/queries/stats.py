"""Agent / product statistics queries."""

from __future__ import annotations

import datetime as dt

from ledgerlight.catalog import AS_OF, ONE_AGENT, PURCHASE_CUTOFF, d, model, register, with_views
from ledgerlight.operators import stats


def snapshot_cte(as_of: dt.date = AS_OF, cutoff: dt.date = PURCHASE_CUTOFF,
                 agent_id: int | None = None) -> str:
    """Oracle CTEs sold_pairs, bought_pairs, snapshot (nulls kept)."""
    s_filter = "" if agent_id is None else f"AND s.agent_id = {agent_id}"
    b_filter = "" if agent_id is None else f"AND b.agent_id = {agent_id}"
    return f"""
sold_pairs AS (
  SELECT s.agent_id, s.product_id,
         CAST(sum(s.amount_sold) AS BIGINT) AS qty_sold, CAST(sum(s.price) AS BIGINT) AS revenue
  FROM sale s JOIN agent a ON a.agent_id = s.agent_id
  WHERE s.date_sold <= {d(as_of)} {s_filter}
  GROUP BY s.agent_id, s.product_id
), bought_pairs AS (
  SELECT b.agent_id, b.product_id, CAST(sum(b.amount_bought) AS BIGINT) AS qty_bought,
         CAST(sum(p.unit_price * b.amount_bought) AS BIGINT) AS cost
  FROM purchase b JOIN agent a ON a.agent_id = b.agent_id JOIN product p ON p.product_id = b.product_id
  WHERE b.date_bought <= {d(cutoff)} {b_filter}
  GROUP BY b.agent_id, b.product_id
), snapshot AS (
  SELECT b.agent_id, b.product_id, b.qty_bought, b.cost, s.qty_sold, s.revenue,
         b.qty_bought - coalesce(s.qty_sold, 0) AS debt, s.revenue - b.cost AS profit
  FROM bought_pairs b LEFT JOIN sold_pairs s ON s.agent_id = b.agent_id AND s.product_id = b.product_id
)"""


MEASURES = ["qty_bought", "cost", "qty_sold", "revenue", "debt", "profit"]


def _agent_totals_sql(agent_id: int | None) -> str:
    sums = ",\n       ".join(f"CAST(coalesce(sum(x.{m}), 0) AS BIGINT) AS {m}" for m in MEASURES)
    where = "" if agent_id is None else f"WHERE a.agent_id = {agent_id}"
    return with_views(f"""{snapshot_cte(agent_id=agent_id)}
SELECT a.agent_id, a.agent_name,
       {sums}
FROM agent a LEFT JOIN snapshot x ON x.agent_id = a.agent_id
{where}
GROUP BY a.agent_id, a.agent_name""")


def _named_sql(agent_id: int | None) -> str:
    cols = ",\n       ".join(f"CAST(coalesce(x.{m}, 0) AS BIGINT) AS {m}" for m in MEASURES)
    return with_views(f"""{snapshot_cte(agent_id=agent_id)}
SELECT x.agent_id, a.agent_name, x.product_id, p.product_name,
       {cols}
FROM snapshot x JOIN agent a ON a.agent_id = x.agent_id JOIN product p ON p.product_id = x.product_id""")


# no as-of day given: today in the session's time zone, which is UTC
_TODAY = "CAST(now() AT TIME ZONE 'UTC' AS DATE)"


@register("agent_totals_today", _agent_totals_sql(None).replace(d(AS_OF), _TODAY).replace(
    d(PURCHASE_CUTOFF), f"CAST({_TODAY} - INTERVAL 1 MONTH AS DATE)"))
def agent_totals_today(spark, sf_dir):
    return stats.agent_stats(model(spark, sf_dir))


@register("sales_by_pair", with_views(f"""{snapshot_cte()}
SELECT agent_id, product_id, qty_sold, revenue FROM sold_pairs"""))
def sales_by_pair(spark, sf_dir):
    return stats.sales_by_pair(model(spark, sf_dir, up_to=AS_OF), AS_OF)


@register("purchases_by_pair", with_views(f"""{snapshot_cte()}
SELECT agent_id, product_id, qty_bought, cost FROM bought_pairs"""))
def purchases_by_pair(spark, sf_dir):
    return stats.purchases_by_pair(model(spark, sf_dir, up_to=AS_OF), AS_OF)


@register("agent_product_snapshot", with_views(f"""{snapshot_cte()}
SELECT * FROM snapshot"""))
def agent_product_snapshot(spark, sf_dir):
    return stats.agent_product_stats(model(spark, sf_dir, up_to=AS_OF), AS_OF)


@register("agent_totals", _agent_totals_sql(None))
def agent_totals(spark, sf_dir):
    return stats.agent_stats(model(spark, sf_dir, up_to=AS_OF), AS_OF)


@register("agent_totals_one", _agent_totals_sql(ONE_AGENT))
def agent_totals_one(spark, sf_dir):
    return stats.agent_stats(model(spark, sf_dir, up_to=AS_OF), AS_OF, agent_id=ONE_AGENT)


@register("agent_product_named", _named_sql(None))
def agent_product_named(spark, sf_dir):
    return stats.agent_product_named(model(spark, sf_dir, up_to=AS_OF), AS_OF)


@register("agent_product_named_one", _named_sql(ONE_AGENT))
def agent_product_named_one(spark, sf_dir):
    return stats.agent_product_named(model(spark, sf_dir, up_to=AS_OF), AS_OF, agent_id=ONE_AGENT)
