"""Hand-checked fixtures (see FIXTURES.md).

``invoice_model``: 8 agents, 9 products, 28 territories and two invented
monthly invoices (16 purchases dated 2024-03-01, 15 sales dated
2024-04-01), written as compact ``agent/product:qty`` and
``agent/product@territory:qty=revenue`` codes.  Names are neutral; ids
follow the row order.

``edge_model``: three agents, three products, four territories (one
unowned) covering month-end clamps, unsold pairs, negative debt, a sale
without purchase, an inactive agent and strict vs inclusive dates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from ledgerlight.model import Model
from ledgerlight.schema import AGENT, PRODUCT, PURCHASE, SALE, TERRITORY

UNIT_PRICES = [9, 14, 6, 11, 5, 13, 4, 17, 8]
TERRITORIES_PER_AGENT = [3, 5, 2, 4, 6, 1, 3, 4]

PURCHASES = """
1/1:40 1/3:25 1/8:12
2/2:31 2/5:64 2/7:18 2/9:27
3/4:45 3/6:20
5/1:33 5/2:15 5/9:50 5/4:21
6/3:70
8/5:36 8/8:11
"""

SALES = """
1/1@2:30=400 1/3@2:25=120 1/8@6:10=260
2/2@6:31=350 2/5@4:50=410 2/7@9:18=95 2/9@16:20=230
3/4@9:45=610 3/6@5:20=145
5/1@16:33=300 5/2@20:15=260 5/9@16:41=390
6/3@21:64=380
8/5@25:36=150 8/8@22:11=240
"""

PURCHASE_DAY = dt.date(2024, 3, 1)
SALE_DAY = dt.date(2024, 4, 1)


def agent_name(i: int) -> str:
    return f"Agent {i:02d}"


def product_name(i: int) -> str:
    return f"Product {chr(ord('A') + i - 1)}"


def territory_rows() -> list[tuple[int, int, str, str]]:
    rows, tid = [], 1
    for owner, n in enumerate(TERRITORIES_PER_AGENT, start=1):
        for k in range(1, n + 1):
            rows.append((tid, owner, f"City {owner}", f"District {owner}-{k}"))
            tid += 1
    return rows


def parse_purchases() -> list[tuple[dt.date, int, int, int]]:
    out = []
    for code in PURCHASES.split():
        pair, qty = code.split(":")
        agent, product = pair.split("/")
        out.append((PURCHASE_DAY, int(agent), int(product), int(qty)))
    return out


def parse_sales() -> list[tuple[dt.date, int, int, int, int, int]]:
    out = []
    for code in SALES.split():
        left, revenue = code.split("=")
        pair, qty = left.split(":")
        ap, territory = pair.split("@")
        agent, product = ap.split("/")
        out.append((SALE_DAY, int(product), int(agent), int(territory), int(qty), int(revenue)))
    return out


def invoice_model(spark: SparkSession) -> Model:
    agents = [(i, agent_name(i), None) for i in range(1, 9)]
    products = [(i, product_name(i), p) for i, p in enumerate(UNIT_PRICES, start=1)]
    return Model(
        agent=spark.createDataFrame(agents, AGENT),
        product=spark.createDataFrame(products, PRODUCT),
        territory=spark.createDataFrame(territory_rows(), TERRITORY),
        purchase=spark.createDataFrame(parse_purchases(), PURCHASE),
        sale=spark.createDataFrame(parse_sales(), SALE),
    )


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


EDGE_AGENTS = [(1, "A", None), (2, "B", None), (3, "C", d("2025-05-10"))]
EDGE_PRODUCTS = [(1, "P1", 10), (2, "P2", 3), (3, "P3", 5)]
EDGE_TERRITORIES = [(1, 1, "North", "n1"), (2, 1, "North", "n2"), (3, 2, "South", "s1"), (4, None, "West", "w1")]
EDGE_PURCHASES = [
    (d("2024-01-31"), 1, 1, 10),
    (d("2024-02-29"), 1, 1, 5),
    (d("2024-01-31"), 1, 2, 4),
    (d("2024-01-31"), 2, 1, 2),
    (d("2024-03-01"), 2, 2, 7),
]
# (date_sold, product_id, agent_id, territory_id, amount_sold, price)
EDGE_SALES = [
    (d("2024-03-30"), 1, 1, 1, 8, 100),
    (d("2024-03-31"), 1, 1, 3, 3, 40),
    (d("2024-03-31"), 1, 2, 4, 5, 70),
    (d("2024-03-15"), 3, 3, 1, 6, 60),
]


def edge_model(spark: SparkSession) -> Model:
    return Model(
        agent=spark.createDataFrame(EDGE_AGENTS, AGENT),
        product=spark.createDataFrame(EDGE_PRODUCTS, PRODUCT),
        territory=spark.createDataFrame(EDGE_TERRITORIES, TERRITORY),
        purchase=spark.createDataFrame(EDGE_PURCHASES, PURCHASE),
        sale=spark.createDataFrame(EDGE_SALES, SALE),
    )
