from __future__ import annotations

from fixtures import edge_model

from ledgerlight.operators import quality
from ledgerlight.schema import SALE_KEY


def test_cascade_delete(spark):
    kept, counts = quality.cascade_delete_agent(edge_model(spark), 1)
    assert {r.table_name: r.n_deleted for r in counts.collect()} == {
        "agent": 1, "territory": 2, "purchase": 3, "sale": 3}
    assert kept.sale.count() == 1 and kept.territory.count() == 2


def test_cascade_delete_product_and_territory(spark):
    m = edge_model(spark)
    for column, cascade, tables in (("product_id", quality.cascade_delete_product, ["product", "purchase", "sale"]),
                                    ("territory_id", quality.cascade_delete_territory, ["territory", "sale"])):
        for value in (1, 99):
            kept, counts = cascade(m, value)
            lost = {r.table_name: r.n_deleted for r in counts.collect()}
            assert sorted(lost) == sorted(tables)
            for name, table in m.tables().items():
                left = kept.tables()[name]
                assert table.count() - left.count() == lost.get(name, 0)
                if name in tables:
                    assert left.filter(f"{column} = {value}").count() == 0 and (value == 99) == (lost[name] == 0)


def test_assign_keys(spark):
    m = edge_model(spark)
    names = spark.createDataFrame([("Z",), ("B",), ("D",), ("Z",)], "agent_name string")
    got = {r.agent_name: r.agent_id for r in quality.assign_keys(names, m.agent, "agent_name", "agent_id").collect()}
    assert got == {"D": 4, "Z": 5}


def test_orphans_and_duplicates(spark):
    m = edge_model(spark)
    sale = m.sale.unionByName(m.sale.limit(1))
    assert quality.duplicate_keys(sale, SALE_KEY).first().n_rows == 2
    broken = m.with_facts(sale=m.sale.withColumn("territory_id", m.sale.territory_id + 10))
    reasons = {r.reason for r in quality.orphan_rows(broken).collect()}
    assert reasons == {"unknown territory"}


def test_build_dimensions_serial_keys(spark):
    import pytest

    from ledgerlight.sources.dimensions import build_dimensions
    dims = build_dimensions(spark, [("A", None), ("B", None)], [("P1", 10)],
                            [("A", "North", "n1"), (None, "West", "w1")])
    assert [tuple(r) for r in dims["territory"].orderBy("territory_id").collect()] == [
        (1, 1, "North", "n1"), (2, None, "West", "w1")]
    with pytest.raises(ValueError):
        build_dimensions(spark, [("A", None)], [], [("Z", "c", "d")])
