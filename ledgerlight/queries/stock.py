"""Outstanding stock and seeded sampling queries."""

from __future__ import annotations

import datetime as dt

from ledgerlight.catalog import AS_OF, model, register, with_views
from ledgerlight.functions.dates import shift_months
from ledgerlight.functions.random import rand_key_sql
from ledgerlight.operators import sampling, stock

SERIES_START = dt.date(1998, 1, 1)
SERIES_MONTHS = 14
SAMPLE_SEED = 7
NOISE_SEED = 11

OUTSTANDING_SQL = with_views(f"""
bought AS (
  SELECT b.agent_id, b.product_id, sum(b.amount_bought) AS q
  FROM purchase b JOIN agent a ON a.agent_id = b.agent_id JOIN product p ON p.product_id = b.product_id
  WHERE b.date_bought < DATE '{AS_OF}' GROUP BY 1, 2
), sold AS (
  SELECT agent_id, product_id, sum(amount_sold) AS q FROM sale WHERE date_sold < DATE '{AS_OF}' GROUP BY 1, 2
)
SELECT b.agent_id, b.product_id, CAST(b.q - coalesce(s.q, 0) AS BIGINT) AS debt
FROM bought b LEFT JOIN sold s ON s.agent_id = b.agent_id AND s.product_id = b.product_id
WHERE b.q - coalesce(s.q, 0) > 0""")

MONTHLY_SQL = with_views(f"""
months AS (
  SELECT CAST(m AS DATE) AS month
  FROM generate_series(DATE '{SERIES_START}', DATE '{SERIES_START}' + INTERVAL {SERIES_MONTHS - 1} MONTH,
                       INTERVAL 1 MONTH) t(m)
), bought AS (
  SELECT m.month, b.agent_id, b.product_id, sum(b.amount_bought) AS q
  FROM months m JOIN purchase b ON b.date_bought < m.month
  JOIN agent a ON a.agent_id = b.agent_id JOIN product p ON p.product_id = b.product_id
  GROUP BY 1, 2, 3
), sold AS (
  SELECT m.month, s.agent_id, s.product_id, sum(s.amount_sold) AS q
  FROM months m JOIN sale s ON s.date_sold < m.month GROUP BY 1, 2, 3
)
SELECT b.month, b.agent_id, b.product_id, CAST(b.q - coalesce(s.q, 0) AS BIGINT) AS debt
FROM bought b LEFT JOIN sold s ON s.month = b.month AND s.agent_id = b.agent_id AND s.product_id = b.product_id
WHERE b.q - coalesce(s.q, 0) > 0""")

# the same at every month start from the first purchase's month to the month after the last one
HISTORY_SQL = MONTHLY_SQL.replace(f"""SELECT CAST(m AS DATE) AS month
  FROM generate_series(DATE '{SERIES_START}', DATE '{SERIES_START}' + INTERVAL {SERIES_MONTHS - 1} MONTH,
                       INTERVAL 1 MONTH) t(m)""", """SELECT CAST(unnest(generate_series(date_trunc('month', min(date_bought)),
    date_trunc('month', max(date_bought)) + INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS month FROM purchase""")

_MONTH_NO = "(year(month) * 12 + month(month) - 1)"
SAMPLE_SQL = with_views(f"""
groups AS (
  SELECT agent_id, CAST(date_trunc('month', date_bought) AS DATE) AS month, product_id,
         CAST(sum(amount_bought) AS BIGINT) AS qty
  FROM purchase GROUP BY 1, 2, 3
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY agent_id, month
                               ORDER BY {rand_key_sql(SAMPLE_SEED, 'agent_id', _MONTH_NO, 'product_id')},
                                        product_id) AS pick_no,
         1 + {rand_key_sql(SAMPLE_SEED + 1, 'agent_id', _MONTH_NO)} % 7 AS k
  FROM groups
)
SELECT agent_id, month, product_id, qty, CAST(pick_no AS BIGINT) AS pick_no FROM ranked WHERE pick_no <= k""")

GRID_SQL = with_views("""
months AS (
  SELECT CAST(unnest(generate_series(date_trunc('month', min(date_bought)), date_trunc('month', max(date_bought)),
                                     INTERVAL 1 MONTH)) AS DATE) AS month
  FROM purchase
), activity AS (
  SELECT agent_id, CAST(date_trunc('month', date_bought) AS DATE) AS month,
         CAST(count(DISTINCT product_id) AS BIGINT) AS n_products, CAST(sum(amount_bought) AS BIGINT) AS qty
  FROM purchase GROUP BY 1, 2
)
SELECT m.month, a.agent_id, coalesce(x.n_products, 0) AS n_products, coalesce(x.qty, 0) AS qty
FROM agent a JOIN months m ON TRUE
LEFT JOIN activity x ON x.agent_id = a.agent_id AND x.month = m.month""")

_DAY_NO = f"(DATE '{AS_OF}' - DATE '1970-01-01')"
NOISE_SQL = OUTSTANDING_SQL.replace("SELECT b.agent_id, b.product_id, CAST(b.q - coalesce(s.q, 0) AS BIGINT) AS debt",
                                    "SELECT b.agent_id, b.product_id, CAST(b.q - coalesce(s.q, 0) AS BIGINT) AS debt, "
                                    "p2.unit_price") \
    .replace("FROM bought b LEFT JOIN sold s ON s.agent_id = b.agent_id AND s.product_id = b.product_id\nWHERE",
             "FROM bought b LEFT JOIN sold s ON s.agent_id = b.agent_id AND s.product_id = b.product_id\n"
             "JOIN product p2 ON p2.product_id = b.product_id\nWHERE")
NOISE_SQL = f"""SELECT agent_id, product_id, debt, price_permille,
  CAST(x // 1000 + CASE WHEN x % 1000 > 500 OR (x % 1000 = 500 AND (x // 1000) % 2 = 1) THEN 1 ELSE 0 END AS BIGINT)
    AS revenue
FROM (
  SELECT *, unit_price * debt * price_permille AS x
  FROM (
    SELECT *, CAST(600 + {rand_key_sql(NOISE_SEED, 'agent_id', 'product_id', _DAY_NO)} % 901 AS BIGINT) AS price_permille
    FROM ({NOISE_SQL}) o
  ) p
) q"""


@register("outstanding_stock", OUTSTANDING_SQL)
def outstanding_stock(spark, sf_dir):
    return stock.outstanding_stock(model(spark, sf_dir, up_to=AS_OF), AS_OF)


@register("outstanding_stock_monthly", MONTHLY_SQL)
def outstanding_stock_monthly(spark, sf_dir):
    last = shift_months(SERIES_START, SERIES_MONTHS - 1)  # rows count only before the last month start
    return stock.outstanding_stock_monthly(model(spark, sf_dir, up_to=last), SERIES_START, SERIES_MONTHS)


@register("outstanding_stock_history", HISTORY_SQL)
def outstanding_stock_history(spark, sf_dir):
    """Every month start that the purchases span, and the one after."""
    m = model(spark, sf_dir)
    first, months = stock.purchase_months(m)
    return stock.outstanding_stock_monthly(m, first, months + 1)


@register("sample_products_per_agent", SAMPLE_SQL)
def sample_products_per_agent(spark, sf_dir):
    return sampling.sample_products_per_agent_month(model(spark, sf_dir), SAMPLE_SEED, 7)


@register("month_agent_grid", GRID_SQL)
def month_agent_grid(spark, sf_dir):
    """All months from the first purchase to the last."""
    m = model(spark, sf_dir)
    first, months = stock.purchase_months(m)
    return sampling.agent_month_grid(m, first, months)


@register("noisy_revenue", NOISE_SQL)
def noisy_revenue(spark, sf_dir):
    return sampling.restock_revenue(model(spark, sf_dir, up_to=AS_OF), AS_OF, NOISE_SEED)


RANDOM_ROWS, RANDOM_SEED, TERRITORY_SEED = 25, 17, 13


@register("random_rows", with_views(f"""
keyed AS (SELECT date_bought, agent_id, product_id, amount_bought,
  {rand_key_sql(RANDOM_SEED, "agent_id", "product_id", "amount_bought")} AS r FROM purchase)
SELECT date_bought, agent_id, product_id, amount_bought,
  CAST(row_number() OVER (ORDER BY r, date_bought, agent_id, product_id, amount_bought) AS BIGINT) AS pick_no
FROM keyed QUALIFY pick_no <= {RANDOM_ROWS}"""))
def random_rows(spark, sf_dir):
    return sampling.random_rows(model(spark, sf_dir).purchase, RANDOM_ROWS, RANDOM_SEED,
                                ["agent_id", "product_id", "amount_bought"])


@register("random_territory_per_owner", with_views(f"""
SELECT agent_id, territory_id, city, district FROM territory WHERE agent_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY agent_id ORDER BY {rand_key_sql(TERRITORY_SEED, "agent_id", "territory_id")},
  territory_id) = 1"""))
def random_territory_per_owner(spark, sf_dir):
    return sampling.random_territory_per_owner(model(spark, sf_dir), TERRITORY_SEED)
