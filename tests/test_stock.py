from __future__ import annotations

import datetime as dt

from fixtures import edge_model

from ledgerlight.functions.dates import shift_months
from ledgerlight.operators import stock
from ledgerlight.sources.testdata import load_model


def test_edge_outstanding(spark):
    rows = {(r.agent_id, r.product_id): r.debt for r in stock.outstanding_stock(edge_model(spark), "2024-03-31").collect()}
    assert rows == {(1, 1): 7, (1, 2): 4, (2, 1): 2, (2, 2): 7}


def test_month_shift_clamps():
    assert shift_months(dt.date(2024, 3, 31), -1) == dt.date(2024, 2, 29)
    assert shift_months(dt.date(2024, 1, 31), 1) == dt.date(2024, 2, 29)
    assert shift_months(dt.date(2023, 12, 15), 1) == dt.date(2024, 1, 15)


def test_monthly_equals_pointwise(spark):
    m = load_model(spark, "/root/testdata/sf0.001")
    start, months = dt.date(1997, 11, 1), 5
    monthly = {(r.month, r.agent_id, r.product_id): r.debt
               for r in stock.outstanding_stock_monthly(m, start, months).collect()}
    pointwise = {}
    for i in range(months):
        day = shift_months(start, i)
        for r in stock.outstanding_stock(m, day).collect():
            pointwise[(day, r.agent_id, r.product_id)] = r.debt
    assert monthly == pointwise
    assert len(monthly) > 0
