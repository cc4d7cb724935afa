"""Property tests: operators against plain-Python brute force on random frames."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings, strategies as st

from ledgerlight.functions.dates import shift_months
from ledgerlight.model import Model
from ledgerlight.operators import stats, stock, territory
from ledgerlight.schema import AGENT, PRODUCT, PURCHASE, SALE, TERRITORY

BASE = dt.date(2024, 1, 1)
AGENTS = [(1, "A", None), (2, "B", None), (3, "C", None)]
PRODUCTS = [(1, "P1", 7), (2, "P2", 3)]
TERRITORIES = [(1, 1, "X", "x1"), (2, 1, "X", "x2"), (3, 2, "Y", "y1"), (4, None, "Z", "z1")]

day = st.integers(min_value=0, max_value=120).map(lambda n: BASE + dt.timedelta(days=n))
purchase_rows = st.lists(st.tuples(day, st.sampled_from([1, 2, 3]), st.sampled_from([1, 2]),
                                   st.integers(1, 50)), max_size=25)
sale_rows = st.lists(st.tuples(day, st.sampled_from([1, 2]), st.sampled_from([1, 2, 3]),
                               st.sampled_from([1, 2, 3, 4]), st.integers(1, 50), st.integers(0, 500)),
                     max_size=25)
as_of = st.integers(min_value=0, max_value=130).map(lambda n: BASE + dt.timedelta(days=n))
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def make(spark, purchases, sales):
    return Model(agent=spark.createDataFrame(AGENTS, AGENT), product=spark.createDataFrame(PRODUCTS, PRODUCT),
                 territory=spark.createDataFrame(TERRITORIES, TERRITORY),
                 purchase=spark.createDataFrame(purchases, PURCHASE), sale=spark.createDataFrame(sales, SALE))


def brute_pairs(purchases, sales, day_):
    cutoff = shift_months(day_, -1)
    price = {p: u for p, _, u in PRODUCTS}
    bought, sold = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for d, a, p, q in purchases:
        if d <= cutoff:
            bought[(a, p)][0] += q
            bought[(a, p)][1] += q * price[p]
    for d, p, a, t, q, r in sales:
        if d <= day_:
            sold[(a, p)][0] += q
            sold[(a, p)][1] += r
    out = {}
    for key, (qb, cost) in bought.items():
        s = sold.get(key)
        qs, rev = (s[0], s[1]) if s else (None, None)
        out[key] = (qb, cost, qs, rev, qb - (qs or 0), None if rev is None else rev - cost)
    return out


@SETTINGS
@given(purchases=purchase_rows, sales=sale_rows, day_=as_of)
def test_snapshot_and_totals_match_brute_force(spark, purchases, sales, day_):
    m = make(spark, purchases, sales)
    expected = brute_pairs(purchases, sales, day_)
    got = {(r.agent_id, r.product_id): tuple(r[c] for c in stats.MEASURES)
           for r in stats.agent_product_stats(m, day_).collect()}
    assert got == expected
    totals = {r.agent_id: tuple(r[c] for c in stats.MEASURES) for r in stats.agent_stats(m, day_).collect()}
    for agent, _, _ in AGENTS:
        rows = [v for (a, _), v in expected.items() if a == agent]
        want = tuple(sum(v[i] or 0 for v in rows) for i in range(6))
        assert totals[agent] == want


@SETTINGS
@given(purchases=purchase_rows, sales=sale_rows, day_=as_of)
def test_territory_split_matches_brute_force(spark, purchases, sales, day_):
    m = make(spark, purchases, sales)
    owner = {t: o for t, o, _, _ in TERRITORIES}
    expected = {t: [0, 0] for t, o, _, _ in TERRITORIES if o is not None}
    for d, p, a, t, q, r in sales:
        if d < day_ and owner[t] is not None:
            expected[t][0 if a == owner[t] else 1] += q
    got = {r.territory_id: [r.qty_own, r.qty_competitor] for r in territory.district_sales(m, day_).collect()}
    assert got == expected


@SETTINGS
@given(purchases=purchase_rows, sales=sale_rows)
def test_monthly_stock_matches_pointwise_brute_force(spark, purchases, sales):
    m = make(spark, purchases, sales)
    got = {(r.month, r.agent_id, r.product_id): r.debt
           for r in stock.outstanding_stock_monthly(m, BASE, 5).collect()}
    expected = {}
    for i in range(5):
        month = shift_months(BASE, i)
        bought, sold = defaultdict(int), defaultdict(int)
        for d, a, p, q in purchases:
            if d < month:
                bought[(a, p)] += q
        for d, p, a, t, q, r in sales:
            if d < month:
                sold[(a, p)] += q
        for key, q in bought.items():
            if q - sold[key] > 0:
                expected[(month, *key)] = q - sold[key]
    assert got == expected
