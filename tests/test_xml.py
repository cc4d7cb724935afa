from __future__ import annotations

import xml.etree.ElementTree as ET

import pytest
import render
from fixtures import edge_model

from ledgerlight.model import Model
from ledgerlight.operators import report_xml
from ledgerlight.schema import AGENT


def test_export_document(spark):
    m = edge_model(spark)
    text = render.xml(report_xml.tables_xml(spark, m.tables(), [("agent", None), ("territory", 1)]))
    lines = text.splitlines()
    assert lines[0] == "<tables>"
    assert lines[1] == "<agent><!--Data for table: agent. And ID = ALL-->"
    assert lines[2] == ('<info data="agent_table_info"><tablename>agent</tablename><tablecols>'
                        "<column>agent_id - bigint</column><column>agent_name - character varying</column>"
                        "<column>release_date - date</column></tablecols><num_of_rows>3</num_of_rows></info>")
    assert '<row><agent_id>1</agent_id><agent_name>A</agent_name><release_date xsi:nil="true"/></row>' in lines
    assert "<row><agent_id>3</agent_id><agent_name>C</agent_name><release_date>2025-05-10</release_date></row>" in lines
    assert "<territory><!--Data for table: territory. And ID = 1-->" in lines
    assert any("<num_of_rows>4</num_of_rows>" in line for line in lines)  # whole table counted
    assert sum(1 for line in lines if line.startswith("<row><territory_id>")) == 1
    root = ET.fromstring(text.replace("<!--", "<!-- ").replace("-->", " -->"))
    assert [child.tag for child in root] == ["agent", "territory"]


def test_escaping(spark):
    agents = spark.createDataFrame([(1, 'Tom & "Jerry" <x>', None)], AGENT)
    m = edge_model(spark)
    tables = Model(agents, m.product, m.territory, m.purchase, m.sale).tables()
    rows = report_xml.table_rows(tables, "agent").collect()
    assert rows[0].line == ('<row><agent_id>1</agent_id><agent_name>Tom &amp; "Jerry" &lt;x&gt;</agent_name>'
                            '<release_date xsi:nil="true"/></row>')


def test_rejects_unknown_table_and_fact_id(spark):
    tables = edge_model(spark).tables()
    with pytest.raises(KeyError):
        report_xml.tables_xml(spark, tables, [("nope", None)])
    with pytest.raises(ValueError):
        report_xml.tables_xml(spark, tables, [("sale", 1)])
    whole_fact = report_xml.table_rows(tables, "sale").count()
    assert whole_fact == 4
