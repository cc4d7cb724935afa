from __future__ import annotations

import json

import render
from fixtures import edge_model, invoice_model

from ledgerlight.operators import report_json, stats


def test_edge_document_is_valid_json(spark):
    doc = json.loads(render.document(report_json.agent_documents(edge_model(spark), "2024-03-31")))
    agents = doc["agents"]
    assert [a["agent_name"] for a in agents] == ["A", "B", "C"]
    a = agents[0]
    assert a["qty_bought"] == "19" and a["profit"] == "-10"
    assert [c["product_name"] for c in a["data"]] == ["P1", "P2"]
    assert a["data"][1]["profit"] == "0"
    assert agents[2]["data"] is None


def test_reference_keys(spark):
    frags = report_json.agent_documents(
        invoice_model(spark), "2024-04-01", root=report_json.REFERENCE_ROOT,
        agent_keys=report_json.REFERENCE_AGENT_KEYS, product_keys=report_json.REFERENCE_PRODUCT_KEYS)
    doc = json.loads(render.document(frags))
    first = doc["dealers"][0]
    assert list(first) == ["street_name", "amount_bought", "amount_payed", "amount_sold", "amount_gained",
                           "debt", "profit", "data"]
    assert first["data"] is not None and list(first["data"][0])[0] == "drug_name"
    nulls = [a["street_name"] for a in doc["dealers"] if a["data"] is None]
    assert nulls == ["Agent 04", "Agent 07"]


def test_empty_document(spark):
    doc = render.document(report_json.agent_documents(edge_model(spark), "2024-03-31", agent_id=99))
    assert json.loads(doc) == {"agents": None}


def test_children_round_trip(spark):
    m = edge_model(spark)
    parsed = report_json.parse_children(report_json.agent_documents(m, "2024-03-31"))
    named = stats.agent_product_named(m, "2024-03-31")
    cols = ["agent_id", "product_id", "product_name", *stats.MEASURES]
    assert sorted(parsed.select(cols).collect()) == sorted(named.select(cols).collect())


def test_stats_json_lines(spark):
    totals = stats.agent_stats(edge_model(spark), "2024-03-31")
    docs = {r.agent_id: json.loads(r.doc) for r in report_json.agent_stats_json(totals).collect()}
    assert docs[1] == {"agent_name": "A", "qty_bought": 19, "cost": 162, "qty_sold": 11, "revenue": 140,
                       "debt": 8, "profit": -10}


def test_array_documents(spark):
    m = edge_model(spark)
    doc = json.loads(render.array(report_json.agent_stats_document(m, "2024-03-31")))
    assert [d["agent_name"] for d in doc] == ["A", "B", "C"] and doc[2]["qty_bought"] == 0
    pairs = json.loads(render.array(report_json.agent_product_document(m, "2024-03-31")))
    assert [(d["agent_name"], d["product_name"]) for d in pairs] == [("A", "P1"), ("A", "P2"), ("B", "P1")]
    none = render.array(report_json.agent_product_document(m, "2024-03-31", agent_id=3))
    assert none == "null"


def test_written_parts_concatenate_to_the_document(spark, workdir):
    import glob

    from ledgerlight.operators import report_md
    from ledgerlight.sources.testdata import load_model
    m = load_model(spark, "/root/testdata/sf0.001")
    frags = report_json.agent_documents(m, "1999-01-01")
    report_json.write_document(frags, f"{workdir}/doc")
    parts = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{workdir}/doc/part-*")))
    assert json.loads(parts) == json.loads(render.document(frags))
    lines = report_md.territory_markdown(m, "1999-01-01")
    report_md.write_lines(lines, f"{workdir}/md")
    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{workdir}/md/part-*")))
    assert text == render.markdown(lines)


def test_document_rows_read_back(spark):
    m = edge_model(spark)
    rows = report_json.document_rows(m, "2024-03-31", products=1)
    assert rows.count() == 4  # A's two products are split, C's data is null
    read = report_json.read_documents(rows)
    assert [r.agent_name for r in read.filter("product_id IS NULL").collect()] == ["C"]
    cols = ["agent_id", "agent_name", "product_id", "product_name", *stats.MEASURES]
    named = stats.agent_product_named(m, "2024-03-31")
    assert sorted(read.filter("product_id IS NOT NULL").select(cols).collect()) == sorted(named.select(cols).collect())
    by_product = report_json.profit_per_product(read, m.agent).orderBy("product_name", "agent_no")
    assert [(r.product_name, r.agent_no, r.agent_name) for r in by_product.collect()] == [
        ("P1", 1, "A"), ("P1", 2, "B"), ("P2", 1, "A")]


def test_documents_that_hold_nothing(spark):
    docs = spark.createDataFrame([(None,), ("",), ("no json",), ('{"agents":null}',),
                                  ('{"agents":[{"agent_id":7,"agent_name":"G","data":[]}]}',)], "doc string")
    assert [(r.agent_id, r.product_id) for r in report_json.read_documents(docs).collect()] == [(7, None)]
