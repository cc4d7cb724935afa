from __future__ import annotations

import datetime as dt

import render
from fixtures import edge_model, invoice_model
from pyspark.sql import functions as F

from ledgerlight.model import Model
from ledgerlight.operators import report_md, territory
from ledgerlight.schema import SALE, TERRITORY


def district_table(df):
    return {r.territory_id: (r.qty_own, r.qty_competitor) for r in df.collect()}


def test_invoice_territories_strict_date(spark):
    m = invoice_model(spark)
    day0 = district_table(territory.district_sales(m, "2024-04-01"))
    assert len(day0) == 28 and all(v == (0, 0) for v in day0.values())
    day1 = district_table(territory.district_sales(m, "2024-04-02"))
    expected = {2: (55, 0), 4: (50, 0), 5: (0, 20), 6: (31, 10), 9: (45, 18), 16: (74, 20), 20: (15, 0), 21: (64, 0), 22: (0, 11), 25: (36, 0)}
    for tid, value in day1.items():
        assert value == expected.get(tid, (0, 0)), tid


def test_invoice_seller_ranking(spark):
    m = invoice_model(spark)
    window = sorted(territory.seller_ranking(m, "2024-04-02").collect())
    distributed = sorted(territory.seller_ranking(m, "2024-04-02", small_limit=1).collect())
    assert window == distributed
    ranking = territory.seller_ranking(m, "2024-04-02")
    got = {}
    for r in ranking.orderBy("owner_id", "rank_no").collect():
        got.setdefault(r.owner_id, []).append((r.seller_name, r.qty_sold))
    assert got == {1: [('Agent 01', 55)], 2: [('Agent 02', 81), ('Agent 03', 20), ('Agent 01', 10)], 3: [('Agent 03', 45), ('Agent 02', 18)], 5: [('Agent 05', 89), ('Agent 02', 20)], 6: [('Agent 06', 64)], 7: [('Agent 08', 11)], 8: [('Agent 08', 36)]}


def test_rollup_total_row_and_sections(spark):
    m = invoice_model(spark)
    rolled = territory.territory_rollup(m, "2024-04-02")
    totals = {r.owner_id: (r.qty_own, r.qty_competitor, r.qty_total)
              for r in rolled.filter("is_total = 1").collect()}
    assert totals[2] == (81, 30, 111)
    assert totals[4] == (0, 0, 0)
    last = rolled.filter("owner_id = 2").orderBy(F.col("line_no").desc()).first()
    assert last.is_total == 1 and last.line_no == 6
    secs = territory.sections(m).orderBy("section_no").collect()
    assert [s.section_no for s in secs] == list(range(1, 9))
    assert [s.owner_id for s in secs] == list(range(1, 9))


EDGE_MD_0331 = """# Territory statistics

Overview of every territory with its total sales: who owns it and which districts it is split into.
How much was sold there, and how much of it by competing agents.

## 1) North

### 1.1) Overall results

**Managed by: A**

| District | Sold by owner | Sold by competitors | Sold in total |
|---|---|---|---|
| n1 | 8 | 6 | 14 |
| n2 | 0 | 0 | 0 |
| **Total** | **8** | **6** | **14** |

### 1.2) Individual results

1) A - 8
2) C - 6

## 2) South

### 2.1) Overall results

**Managed by: B**

| District | Sold by owner | Sold by competitors | Sold in total |
|---|---|---|---|
| s1 | 0 | 0 | 0 |
| **Total** | **0** | **0** | **0** |

### 2.2) Individual results


"""


def test_edge_markdown_document(spark):
    text = render.markdown(report_md.territory_markdown(edge_model(spark), "2024-03-31"))
    assert text == EDGE_MD_0331


def test_edge_markdown_next_day_and_filter(spark):
    m = edge_model(spark)
    text = render.markdown(report_md.territory_markdown(m, "2024-04-01"))
    assert "| s1 | 0 | 3 | 3 |" in text and "1) A - 3" in text
    assert "West" not in text and "w1" not in text
    only_b = render.markdown(report_md.territory_markdown(m, "2024-04-01", agent_id=2))
    assert "## 1) South" in only_b and "North" not in only_b


def test_czech_headings(spark):
    text = render.markdown(report_md.territory_markdown(edge_model(spark), "2024-03-31",
                                                         headings=report_md.CZECH))
    assert text.startswith("# Statistiky teritorii\n\n")
    assert "| **Celkem** | **8** | **6** | **14** |\n\n### 1.2) Jednotlive vysledkly\n\n1) A - 8\n" in text


def test_district_order_ignores_punctuation_and_accents(spark):
    names = ["St. Anne Quay", "Pier 9", "stäube", "Stanford", "Pier-10", "Sta. Mira"]
    rows = [(i + 1, 1, "Town", n) for i, n in enumerate(names)]
    base = edge_model(spark)
    m = Model(agent=base.agent, product=base.product, territory=spark.createDataFrame(rows, TERRITORY),
              purchase=base.purchase.limit(0), sale=base.sale.limit(0))
    want = ["Pier-10", "Pier 9", "Sta. Mira", "Stanford", "St. Anne Quay", "stäube", None]
    for limit in (None, 1):  # window path, then the distributed path
        rolled = territory.territory_rollup(m, "2024-01-01", small_limit=limit).orderBy("line_no")
        assert [r.district for r in rolled.collect()] == want


def test_one_owner_sums_only_the_owned_territories(spark):
    m = edge_model(spark)
    for owner in [r.agent_id for r in m.agent.collect()]:
        whole = territory.district_sales(m, "2024-03-31").filter(f"owner_id = {owner}")
        one = territory.district_sales(m, "2024-03-31", agent_id=owner)
        assert sorted(one.collect()) == sorted(whole.collect())
        ranks = territory.seller_ranking(m, "2024-03-31").filter(f"owner_id = {owner}")
        assert sorted(territory.seller_ranking(m, "2024-03-31", agent_id=owner).collect()) == sorted(ranks.collect())


def _two_city_model(spark):
    """Agent 1 owns Lake and Oak in two towns (Lake in both) and Fern; agent 2 owns another Lake."""
    base = edge_model(spark)
    places = [(1, 1, "East", "Lake"), (2, 1, "East", "Oak"), (3, 1, "West", "Lake"), (4, 1, "West", "Fern"), (5, 2, "West", "Lake")]
    day = dt.date(2024, 1, 5)
    sales = [(day, 1, 1, 1, 5, 1), (day, 1, 2, 1, 2, 1), (day, 1, 1, 3, 7, 1), (day, 1, 3, 4, 9, 1), (day, 1, 1, 5, 4, 1),
             (dt.date(2024, 2, 1), 1, 1, 1, 100, 1)]
    names = ["date_sold", "product_id", "agent_id", "territory_id", "amount_sold", "price"]
    order = [f.name for f in SALE.fields] if hasattr(SALE, "fields") else [c.split()[0] for c in SALE.split(",")]
    rows = [tuple(dict(zip(names, r))[c] for c in order) for r in sales]
    return Model(agent=base.agent, product=base.product, territory=spark.createDataFrame(places, TERRITORY),
                 purchase=base.purchase.limit(0), sale=spark.createDataFrame(rows, SALE))


def test_sections_by_owner_alone(spark):
    m = _two_city_model(spark)
    for limit in (None, 1):  # window path, then the distributed path
        lines = territory.owner_rollup(m, "2024-02-01", small_limit=limit).filter("owner_id = 1").orderBy("line_no").collect()
        assert [(r.city, r.district, r.qty_own, r.qty_competitor) for r in lines] == [
            ("West", "Fern", 0, 9), ("East", "Lake", 12, 2), ("West", "Lake", 12, 2), ("East", "Oak", 0, 0),
            ("East", None, 12, 2), ("West", None, 12, 11)]
        ranks = territory.owner_seller_ranking(m, "2024-02-01", small_limit=limit).filter("owner_id = 1").orderBy("rank_no")
        assert [(r.city, r.seller_id, r.qty_sold) for r in ranks.collect()] == [
            ("West", 3, 9), ("West", 1, 7), ("East", 1, 5), ("East", 2, 2)]
    other = territory.owner_rollup(m, "2024-02-01").filter("owner_id = 2").orderBy("line_no").collect()
    assert [(r.district, r.qty_own, r.qty_competitor) for r in other] == [("Lake", 0, 4), (None, 0, 4)]
    text = render.markdown(report_md.territory_markdown(m, "2024-02-01", by_owner=True))
    assert text.count("| Lake | 12 | 2 | 14 |\n| Lake | 12 | 2 | 14 |\n| Oak | 0 | 0 | 0 |\n") == 2  # both sections of agent 1
    assert "## 1) East" in text and "## 2) West" in text and "## 3) West" in text


def test_by_owner_equals_sections_when_owners_have_one_city(spark):
    m = invoice_model(spark)
    both = [render.markdown(report_md.territory_markdown(m, "2024-04-02", by_owner=flag)) for flag in (False, True)]
    assert both[0] == both[1]
