"""JSON document queries (R5/R6 as JSON, R7, A13, A17, C1, C2, F2, F3, F15, J7, P9, P12, O1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlight.catalog import AS_OF, model, register, with_views
from ledgerlight.operators import report_json, stats
from ledgerlight.queries.stats import MEASURES, snapshot_cte

NAMED_CTE = snapshot_cte() + """, totals AS (
  SELECT a.agent_id, a.agent_name,
""" + ",\n".join(f"         CAST(coalesce(sum(x.{m}), 0) AS BIGINT) AS {m}" for m in MEASURES) + """
  FROM agent a LEFT JOIN snapshot x ON x.agent_id = a.agent_id
  GROUP BY a.agent_id, a.agent_name
), named AS (
  SELECT x.agent_id, a.agent_name, x.product_id, p.product_name,
""" + ",\n".join(f"         CAST(coalesce(x.{m}, 0) AS BIGINT) AS {m}" for m in MEASURES) + """
  FROM snapshot x JOIN agent a ON a.agent_id = x.agent_id JOIN product p ON p.product_id = x.product_id
)"""


def _json_obj(name_col: str, as_text: bool, q: str = "") -> str:
    parts = [f"'{name_col}', {q}{name_col}"]
    for m in MEASURES:
        parts.append(f"'{m}', CAST({q}{m} AS VARCHAR)" if as_text else f"'{m}', {q}{m}")
    return "json_object(" + ", ".join(parts) + ")::VARCHAR"


DOCUMENT_CTE = NAMED_CTE + f""",
agents_num AS (
  SELECT *, row_number() OVER (ORDER BY agent_name, agent_id) AS agent_no, {_json_obj('agent_name', True)} AS j
  FROM totals
), kids AS (
  SELECT *, row_number() OVER (PARTITION BY agent_id ORDER BY product_name, product_id) AS child_rank
  FROM named
), has_kids AS (SELECT DISTINCT agent_id FROM named)
SELECT 0 AS doc_part, CAST(0 AS BIGINT) AS agent_no, CAST(NULL AS BIGINT) AS agent_id, 0 AS part,
       CAST(NULL AS VARCHAR) AS child_name, CAST(NULL AS BIGINT) AS child_id,
       CASE WHEN (SELECT count(*) FROM totals) = 0 THEN '{{"agents":null}}' ELSE '{{"agents":[' END AS fragment
UNION ALL
SELECT 2, 0, NULL, 0, NULL, NULL, CASE WHEN (SELECT count(*) FROM totals) = 0 THEN '' ELSE ']}}' END
UNION ALL
SELECT 1, a.agent_no, a.agent_id, 0, NULL, NULL,
       CASE WHEN a.agent_no > 1 THEN ',' ELSE '' END || left(a.j, length(a.j) - 1)
       || CASE WHEN h.agent_id IS NULL THEN ',"data":null}}' ELSE ',"data":[' END
FROM agents_num a LEFT JOIN has_kids h ON h.agent_id = a.agent_id
UNION ALL
SELECT 1, a.agent_no, k.agent_id, 1, k.product_name, k.product_id,
       CASE WHEN k.child_rank = 1 THEN '' ELSE ',' END || {_json_obj('product_name', True, 'k.')}
FROM kids k JOIN agents_num a ON a.agent_id = k.agent_id
UNION ALL
SELECT 1, a.agent_no, a.agent_id, 2, NULL, NULL, ']}}'
FROM agents_num a JOIN has_kids h ON h.agent_id = a.agent_id"""
DOCUMENT_SQL = with_views(DOCUMENT_CTE)
# the agent with the lowest id, by filters on both frames that the document is made of
ONE_AGENT = "(SELECT min(agent_id) FROM agent)"
ONE_DOCUMENT_SQL = with_views(
    DOCUMENT_CTE.replace("GROUP BY a.agent_id, a.agent_name\n), named", f"WHERE a.agent_id = {ONE_AGENT}\n  GROUP BY a.agent_id, a.agent_name\n), named")
    .replace("ON p.product_id = x.product_id\n)", f"ON p.product_id = x.product_id\n  WHERE x.agent_id = {ONE_AGENT}\n)"))


@register("agent_documents", DOCUMENT_SQL)
def agent_documents(spark, sf_dir):
    return report_json.agent_documents(model(spark, sf_dir, up_to=AS_OF), AS_OF)


@register("agent_totals_json", with_views(NAMED_CTE + f"""
SELECT agent_id, {_json_obj('agent_name', False)} AS doc FROM totals"""))
def agent_totals_json(spark, sf_dir):
    return report_json.agent_stats_json(stats.agent_stats(model(spark, sf_dir, up_to=AS_OF), AS_OF))


@register("agent_product_json", with_views(NAMED_CTE + """
SELECT agent_id, product_id, json_object('agent_name', agent_name, 'product_name', product_name, """
          + ", ".join(f"'{m}', {m}" for m in MEASURES) + """)::VARCHAR AS doc FROM named"""))
def agent_product_json(spark, sf_dir):
    return report_json.agent_product_json(stats.agent_product_named(model(spark, sf_dir, up_to=AS_OF), AS_OF))


@register("profit_by_agent", with_views(NAMED_CTE + """
SELECT agent_id, agent_name, profit FROM totals"""))
def profit_by_agent(spark, sf_dir):
    return report_json.profit_by_agent(stats.agent_stats(model(spark, sf_dir, up_to=AS_OF), AS_OF))


@register("profit_by_product_pairs", with_views(NAMED_CTE + """
SELECT product_id, product_name, agent_id, agent_name, profit FROM named"""))
def profit_by_product_pairs(spark, sf_dir):
    return report_json.profit_by_product(stats.agent_product_named(model(spark, sf_dir, up_to=AS_OF), AS_OF))


@register("json_roundtrip", with_views(NAMED_CTE + """
SELECT agent_id, product_id, product_name, """ + ", ".join(MEASURES) + " FROM named"))
def json_roundtrip(spark, sf_dir):
    return report_json.parse_children(report_json.agent_documents(model(spark, sf_dir, up_to=AS_OF), AS_OF))


@register("agent_totals_json_array", with_views(NAMED_CTE + f"""
, items AS (
  SELECT row_number() OVER (ORDER BY agent_name, agent_id) AS item_no, {_json_obj('agent_name', False)} AS doc
  FROM totals
)
SELECT 0 AS doc_part, CAST(0 AS BIGINT) AS item_no,
       CASE WHEN (SELECT count(*) FROM totals) = 0 THEN 'null' ELSE '[' END AS fragment
UNION ALL SELECT 2, 0, CASE WHEN (SELECT count(*) FROM totals) = 0 THEN '' ELSE ']' END
UNION ALL SELECT 1, item_no, CASE WHEN item_no > 1 THEN ',' ELSE '' END || doc FROM items"""))
def agent_totals_json_array(spark, sf_dir):
    return report_json.agent_stats_document(model(spark, sf_dir, up_to=AS_OF), AS_OF)


@register("json_document_read", with_views(NAMED_CTE + """
SELECT a.agent_id, a.agent_name, n.product_id, n.product_name, """ + ", ".join(f"n.{m}" for m in MEASURES) + """
FROM agent a LEFT JOIN named n ON n.agent_id = a.agent_id"""))
def json_document_read(spark, sf_dir):
    docs = report_json.document_rows(model(spark, sf_dir, up_to=AS_OF), AS_OF)
    return report_json.read_documents(docs)


@register("profit_grouped_by_product", with_views(NAMED_CTE + """
SELECT product_id, product_name, agent_id, agent_name, profit,
       row_number() OVER (PARTITION BY product_id ORDER BY agent_name, agent_id) AS agent_no
FROM named"""))
def profit_grouped_by_product(spark, sf_dir):
    m = model(spark, sf_dir, up_to=AS_OF)
    return report_json.profit_per_product(report_json.read_documents(report_json.document_rows(m, AS_OF)), m.agent)


def first_agent(m) -> int:
    """Lowest agent id (a single aggregated value)."""
    return int(m.agent.agg(F.min("agent_id").alias("a")).first()["a"])


@register("agent_documents_one", ONE_DOCUMENT_SQL)
def agent_documents_one(spark, sf_dir):
    m = model(spark, sf_dir, up_to=AS_OF)
    return report_json.agent_documents(m, AS_OF, agent_id=first_agent(m))


@register("agent_product_json_array", with_views(NAMED_CTE + """
, items AS (
  SELECT row_number() OVER (ORDER BY agent_name, agent_id, product_name, product_id) AS item_no,
         json_object('agent_name', agent_name, 'product_name', product_name, """
          + ", ".join(f"'{m}', {m}" for m in MEASURES) + """)::VARCHAR AS doc FROM named
)
SELECT 0 AS doc_part, CAST(0 AS BIGINT) AS item_no,
       CASE WHEN (SELECT count(*) FROM named) = 0 THEN 'null' ELSE '[' END AS fragment
UNION ALL SELECT 2, 0, CASE WHEN (SELECT count(*) FROM named) = 0 THEN '' ELSE ']' END
UNION ALL SELECT 1, item_no, CASE WHEN item_no > 1 THEN ',' ELSE '' END || doc FROM items"""))
def agent_product_json_array(spark, sf_dir):
    return report_json.agent_product_document(model(spark, sf_dir, up_to=AS_OF), AS_OF)
