from __future__ import annotations

import datetime as dt

from fixtures import edge_model, invoice_model
from pyspark.sql import functions as F

from ledgerlight.functions.dates import as_date
from ledgerlight.operators import stats

MEASURES = stats.MEASURES


def by_agent(df):
    return {r.agent_id: tuple(r[m] for m in MEASURES) for r in df.collect()}


def test_invoice_totals_before_purchase_cutoff_are_zero(spark):
    out = by_agent(stats.agent_stats(invoice_model(spark), dt.date(2024, 3, 31)))
    assert len(out) == 8
    assert all(v == (0, 0, 0, 0, 0, 0) for v in out.values())


def test_invoice_totals_at_sale_day(spark):
    out = by_agent(stats.agent_stats(invoice_model(spark), dt.date(2024, 4, 1)))
    expected = {
        1: (77, 714, 65, 780, 12, 66),
        2: (140, 1042, 119, 1085, 21, 43),
        3: (65, 755, 65, 755, 0, 0),
        5: (119, 1138, 89, 950, 30, 43),
        6: (70, 420, 64, 380, 6, -40),
        8: (47, 367, 47, 390, 0, 23),
    }
    for agent in (4, 7):
        expected[agent] = (0, 0, 0, 0, 0, 0)
    assert out == expected


def test_edge_snapshot_keeps_nulls(spark):
    snap = stats.agent_product_stats(edge_model(spark), "2024-03-31")
    rows = {(r.agent_id, r.product_id): tuple(r[m] for m in MEASURES) for r in snap.collect()}
    assert rows == {
        (1, 1): (15, 150, 11, 140, 4, -10),
        (1, 2): (4, 12, None, None, 4, None),
        (2, 1): (2, 20, 5, 70, -3, 50),
    }


def test_edge_agent_profit_excludes_unsold_cost(spark):
    out = by_agent(stats.agent_stats(edge_model(spark), "2024-03-31"))
    assert out == {1: (19, 162, 11, 140, 8, -10), 2: (2, 20, 5, 70, -3, 50), 3: (0, 0, 0, 0, 0, 0)}


def test_edge_named_rows_zero_filled(spark):
    named = stats.agent_product_named(edge_model(spark), "2024-03-31")
    rows = {(r.agent_name, r.product_name): tuple(r[m] for m in MEASURES) for r in named.collect()}
    assert rows[("A", "P2")] == (4, 12, 0, 0, 4, 0)
    assert ("C", "P3") not in rows
    assert len(rows) == 3


def test_agent_filter(spark):
    m = edge_model(spark)
    assert by_agent(stats.agent_stats(m, "2024-03-31", agent_id=2)) == {2: (2, 20, 5, 70, -3, 50)}
    named = stats.agent_product_named(m, "2024-03-31", agent_id=1)
    assert {r.product_id for r in named.collect()} == {1, 2}


def test_totals_equal_sum_of_pairs_on_generated_data(spark):
    from ledgerlight.sources.testdata import load_model
    m = load_model(spark, "/root/testdata/sf0.001")
    totals = stats.agent_stats(m, "1999-01-01")
    named = stats.agent_product_named(m, "1999-01-01")
    summed = named.groupBy("agent_id").agg(*[F.sum(c).alias(c) for c in MEASURES])
    joined = totals.join(summed, "agent_id", "left").select(
        "agent_id", *[(F.coalesce(summed[c], F.lit(0)) == totals[c]).alias(c) for c in MEASURES])
    assert all(all(r[c] for c in MEASURES) for r in joined.collect())
    bad = named.filter(F.col("debt") != F.col("qty_bought") - F.col("qty_sold")).count()
    assert bad == 0


def test_no_day_means_today_in_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    days = {}
    try:
        for name, hours in [("Pacific/Kiritimati", 14), ("Etc/GMT+12", -12), ("UTC", 0)]:
            spark.conf.set("spark.sql.session.timeZone", name)
            here = dt.timezone(dt.timedelta(hours=hours))
            before = dt.datetime.now(here).date()
            days[name] = as_date(None)
            assert before <= days[name] <= dt.datetime.now(here).date()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert days["Pacific/Kiritimati"] > days["Etc/GMT+12"]  # 26 hours apart


def test_sales_of_tomorrow_do_not_count_today(spark):
    model = edge_model(spark)
    today = as_date(None)
    later = model.sale.withColumn("date_sold", F.lit(today + dt.timedelta(days=2)))
    sold = lambda sale: stats.sales_by_pair(model.with_facts(sale=sale)).count()
    assert sold(later) == 0
    assert sold(model.sale.withColumn("date_sold", F.lit(today))) > 0
